"""Whitening of embeddings by the exact characteristic polynomial of their integer scatter matrix.

The scatter matrix is summed in whole numbers. Its characteristic polynomial is found modulo many primes (reduction to Hessenberg
form), each in a task of its own, and put together by Chinese remainders. All roots are real, so the signs of a shifted
polynomial's coefficients count the roots beyond any place exactly: each root is isolated by bisection and refined to
``BITS`` binary digits. Components are null vectors of the matrix less the root, by inverse iteration in long decimals.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal, localcontext
from math import comb, prod

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.session import checkpoint_root

# x = floor(SCALE * c) + SHIFT, saturating at LIMIT; components at most.
SCALE, SHIFT, LIMIT, COMPONENTS = 64, 1_000_000, 1 << 62, 16
# Digits: of a root (relative), and of the decimals that null vectors are computed with. Roots that agree in all
# BITS share a null space of as many dimensions.
BITS, DIGITS = 200, 120
# Sums are cut into limbs of so many bits, so that Spark adds them as long numbers.
LIMB = 32


def usable(vectors: DataFrame) -> DataFrame:
    """The rows whose vector is there and holds no null and no non-finite entry, with the entries as doubles."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    return rows.where(F.col("embedding").isNotNull()).where(finite)


def _steps(column: pa.Array) -> list[np.ndarray]:
    """``floor(SCALE * c)`` of each vector, without zeros at its end: what a shorter vector lacks is 0."""
    offsets = column.offsets.to_numpy() - column.offsets[0].as_py() if len(column) else np.zeros(1, np.int64)
    values = np.floor(SCALE * column.flatten().to_numpy(zero_copy_only=False))
    values = np.where(np.abs(values) < LIMIT, values, 0).astype(np.int64) + np.where(np.abs(values) < LIMIT, 0, np.sign(values)).astype(np.int64) * LIMIT
    rows = []
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        own = values[a:b]
        rows.append(own[: int(np.flatnonzero(own).max(initial=-1)) + 1])
    return rows


def _canonical(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each vector in the narrowest whole numbers that hold it: equal vectors have equal bytes."""
    for batch in batches:
        out = []
        for row in _steps(batch.column("embedding")):
            top = int(np.abs(row).max(initial=0))
            kind = "<i2" if top < 1 << 15 else "<i4" if top < 1 << 31 else "<i8"
            out.append(kind.encode() + row.astype(kind).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(out, pa.binary())], names=["vec_id", "packed"])


def _unpacked(column: pa.Array, width: int) -> np.ndarray:
    out = np.zeros((len(column), width), np.int64)
    for i, raw in enumerate(column.to_pylist()):
        row = np.frombuffer(raw, raw[:3].decode(), offset=3)
        out[i, : len(row)] = row
    return out


def _limbs(values: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """``place, limb, value`` of whole numbers of any size; every limb but a number's last is not negative."""
    for place, value in enumerate(values.tolist()):
        limb = 0
        while True:
            rest, low = value >> LIMB, value & ((1 << LIMB) - 1)
            if -(1 << LIMB) <= rest < 1 << LIMB:
                yield place, limb, low
                if rest:
                    yield place, limb + 1, rest
                break
            yield place, limb, low
            value, limb = rest, limb + 1


def _summed(rows: DataFrame, sums, size: int) -> list[int]:
    """Exact sums over all rows of ``size`` whole numbers; ``sums`` gives those of a batch. One row per task, place and limb is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, object)
        for batch in batches:
            total = total + sums(batch)
        cells = list(_limbs(total)) if size else []
        columns = list(zip(*cells, strict=True)) or [[]] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["place", "limb", "value"])

    out = [0] * size
    # As many rows as the matrix has cells, times the limbs of a number.
    for r in rows.mapInArrow(run, "place long, limb long, value long").groupBy("place", "limb").agg(F.sum("value").alias("value")).collect():
        out[r.place] += r.value << (LIMB * r.limb)
    return out


def _gram(rows: np.ndarray) -> np.ndarray:
    """Exact sums of products of every two columns, on and above the diagonal."""
    width = rows.shape[1]
    upper = np.triu_indices(width)
    top = int(np.abs(rows).max(initial=0))
    total = np.zeros(len(upper[0]), object)
    if top >= 1 << 24:
        return total + (rows.astype(object).T @ rows.astype(object))[upper] if len(rows) else total
    step = max(1, (1 << 52) // max(1, top * top))
    for at in range(0, len(rows), step):
        part = rows[at : at + step].astype(np.float64)
        total = total + (part.T @ part).astype(np.int64)[upper].astype(object)
    return total


def primes(least: int) -> list[int]:
    """Primes below 2^31, falling, whose product is beyond ``least``."""
    found, product, p = [], 1, (1 << 31) - 1
    while product <= least:
        # Miller-Rabin with these bases is exact below 3.2e9.
        odd = p - 1
        twos = (odd & -odd).bit_length() - 1
        odd >>= twos
        if all(p % b and any(pow(b, odd << r, p) == p - 1 for r in range(twos)) or pow(b, odd, p) == 1 or p == b for b in (2, 3, 5, 7)):
            found.append(p)
            product *= p
        p -= 2
    return found


def hessenberg_polynomial(matrix: np.ndarray, p: int) -> list[int]:
    """Coefficients modulo ``p``, the lowest first, of the characteristic polynomial of a matrix modulo ``p``."""
    h = matrix.copy()
    n = len(h)
    for k in range(1, n - 1):
        below = np.flatnonzero(h[k:, k - 1])
        if not len(below):
            continue
        pivot = k + int(below[0])
        if pivot != k:
            h[[k, pivot]] = h[[pivot, k]]
            h[:, [k, pivot]] = h[:, [pivot, k]]
        factors = h[k + 1 :, k - 1] * pow(int(h[k, k - 1]), -1, p) % p
        h[k + 1 :] = (h[k + 1 :] - factors[:, None] * h[k] % p) % p
        # The inverse on the right, which keeps the polynomial: columns below are added to column k.
        h[:, k] = (h[:, k] + (h[:, k + 1 :] * factors % p).sum(axis=1)) % p
    # Polynomials of the leading parts, each from those before it.
    polys = np.zeros((n + 1, n + 1), np.int64)
    polys[0, 0] = 1
    for m in range(1, n + 1):
        own = np.zeros(n + 1, np.int64)
        own[1:] = polys[m - 1, :-1]
        own = (own - h[m - 1, m - 1] * polys[m - 1]) % p
        below = 1
        for i in range(m - 1, 0, -1):
            below = below * int(h[i, i - 1]) % p
            if not below:
                break
            own = (own - below * int(h[i - 1, m - 1]) % p * polys[i - 1]) % p
        polys[m] = own
    return polys[n].tolist()


def _remainders(matrix: list[list[int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in batch.column("p").to_pylist():
                own = np.array([[v % p for v in row] for row in matrix], np.int64).reshape(len(matrix), len(matrix))
                yield pa.RecordBatch.from_arrays([pa.array([p]), pa.array([hessenberg_polynomial(own, p)], pa.list_(pa.int64()))], names=["p", "rest"])

    return run


def characteristic_polynomial(spark, matrix: list[list[int]]) -> list[int]:
    """Whole coefficients, the lowest first, of a positive semidefinite matrix of whole numbers. One task per prime."""
    n = len(matrix)
    trace = sum(matrix[i][i] for i in range(n))
    # The k-th coefficient is at most that of n equal roots of this trace.
    bound = max((comb(n, k) * trace**k // n**k for k in range(1, n + 1)), default=1) + 1
    moduli = primes(2 * bound)
    table = spark.createDataFrame([(p,) for p in moduli], "p long").repartition(min(len(moduli), 4096), "p")
    rest = {r.p: r.rest for r in table.mapInArrow(_remainders(matrix), "p long, rest array<long>").collect()}  # a polynomial a prime
    whole = prod(moduli)
    out = [0] * (n + 1)
    for p, own in rest.items():
        other = whole // p
        factor = other * pow(other, -1, p)
        out = [(a + factor * b) % whole for a, b in zip(out, own, strict=True)]
    return [c - whole if c > whole // 2 else c for c in out]


def roots_beyond(poly: list[int], k: int, s: int) -> int:
    """How many roots of ``poly``, all of them real, are greater than ``k / 2^s``, with their multiplicity."""
    n = len(poly) - 1
    own = [c << (s * (n - i)) for i, c in enumerate(poly)]
    # Coefficients around the place; their changes of sign are as many as roots beyond it (exact, as all roots are real).
    for i in range(n):
        for j in range(n - 1, i - 1, -1):
            own[j] += k * own[j + 1]
    signs = [c > 0 for c in own if c]
    return sum(a != b for a, b in zip(signs, signs[1:], strict=False))


def root(poly: list[int], j: int) -> tuple[int, int, int, int]:
    """``k, s, first, last``: the ``j``-th greatest root lies in ``(k, k + 1] / 2^s``, with the ``first``-th to ``last``-th.

    ``s`` leaves ``BITS`` binary digits of the root; a root of 0 gives ``k = -1``.
    """
    if roots_beyond(poly, 0, 0) < j:
        return -1, 0, 0, 0
    high = 1
    while roots_beyond(poly, high, 0) >= j:
        high *= 2
    low, s, above, beyond = (high // 2 if high > 1 else 0), 0, None, None
    # From here (low, high] / 2^s holds the root; `above` roots are beyond high, `beyond` beyond low.
    above, beyond = roots_beyond(poly, high, s), roots_beyond(poly, low, s)
    n = len(poly) - 1

    def positive(k: int) -> int:
        value, power = 0, 1
        for i, c in enumerate(poly):
            value += (c * power) << (s * (n - i))
            power *= k
        return (value > 0) - (value < 0)

    side = None
    while high - low > 1 or low.bit_length() < BITS:
        if high - low == 1:
            low, high, s = 2 * low, 2 * high, s + 1
        middle = (low + high) // 2
        if beyond - above == 1:
            # A single root: the sign of the polynomial tells its side.
            if side is None:
                side = 1 if above % 2 == 0 else -1  # sign right of the root
            left = positive(middle) * side < 0
            if left:
                low = middle
            else:
                high = middle
        else:
            count = roots_beyond(poly, middle, s)
            if count >= j:
                low, beyond = middle, count
            else:
                high, above = middle, count
    return low, s, above + 1, beyond


def null_vectors(matrix: list[list[int]], k: int, s: int, count: int) -> list[list[Decimal]]:
    """Orthonormal vectors of the null space of the matrix less ``(2k + 1) / 2^(s + 1)``, by inverse iteration."""
    n = len(matrix)
    with localcontext() as context:
        context.prec = DIGITS
        shift = Decimal(2 * k + 1) / Decimal(1 << (s + 1))  # the middle of the root's interval
        a = [[Decimal(v) - (shift if i == j else 0) for j, v in enumerate(row)] for i, row in enumerate(matrix)]
        size = max(abs(v) for row in matrix for v in row) or 1
        order, tiny = list(range(n)), Decimal(size) * Decimal(10) ** (10 - DIGITS)
        for c in range(n):
            best = max(range(c, n), key=lambda r: abs(a[r][c]))
            a[c], a[best] = a[best], a[c]
            order[c], order[best] = order[best], order[c]
            if abs(a[c][c]) < tiny:
                a[c][c] = tiny
            pivot = a[c]
            for r in range(c + 1, n):
                if a[r][c]:
                    f = a[r][c] / pivot[c]
                    own = a[r]
                    own[c] = f
                    for i in range(c + 1, n):
                        own[i] -= f * pivot[i]

        def solve(b: list[Decimal]) -> list[Decimal]:
            x = [b[i] for i in order]
            for r in range(n):
                x[r] -= sum((a[r][i] * x[i] for i in range(r)), Decimal(0))
            for r in range(n - 1, -1, -1):
                x[r] = (x[r] - sum((a[r][i] * x[i] for i in range(r + 1, n)), Decimal(0))) / a[r][r]
            return x

        def unit(x: list[Decimal], others: list[list[Decimal]]) -> list[Decimal]:
            for _ in range(2):
                for o in others:
                    dot = sum((u * v for u, v in zip(x, o, strict=True)), Decimal(0))
                    x = [u - dot * v for u, v in zip(x, o, strict=True)]
                norm = sum((u * u for u in x), Decimal(0)).sqrt()
                x = [u / norm for u in x]
            return x

        # Any start with a part in the null space will do; these are fixed, so that reruns agree.
        start = np.random.default_rng(17).integers(1, 1 << 30, (count, n)).tolist()
        found = [[Decimal(v) for v in row] for row in start]
        for _ in range(3):
            done: list[list[Decimal]] = []
            for x in found:
                done.append(unit(solve(unit(x, done)), done))
            found = done
        return found


def _components(matrix: list[list[int]], poly: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for j in batch.column("component").to_pylist():
                k, s, first, last = root(poly, j)
                if k < 0:
                    continue
                vector = null_vectors(matrix, k, s, last - first + 1)[j - first]
                columns = [pa.array([j]), pa.array([str(2 * k + 1)]), pa.array([s + 1]), pa.array([[float(v) for v in vector]], pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays(columns, names=["component", "k", "s", "vector"])

    return run


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of each row of ``vectors (vec_id, embedding)`` and component.

    Rows without vector, or with null or non-finite entries, are left out. An entry c becomes ``x = floor(64 * c) + 1000000``
    (beyond 2^62 the same as there); what a shorter vector lacks counts as c = 0, an empty one is all zeros. The fit list has each different x
    vector once: ``n`` of them, with sums S. Components are the unit eigenvectors of their covariance with divisor n, by falling
    eigenvalue e, at most ``components`` of those with e > 0; each entry is correct to double precision, its sign is fixed by its computation. Equal
    eigenvalues have orthonormal vectors of their space. ``deviation`` is the exact sum of ``(n * x - S)^2`` (null beyond 64 bits), ``whitened``
    the projection of ``x - S / n`` over ``sqrt(e)``, ``explained`` is ``e / trace``, and ``identity_error`` the largest absolute entry of the fit
    list's whitened covariance less the identity. Rows that repeat are rows each; an id may be null. Without rows, or where all vectors
    are equal, nothing is returned. Other columns are ignored.

    Only sums as many as the matrix has cells, polynomials and the components pass the driver: their size depends on the vectors'
    width, not on the rows. The one shuffle of vectors finds the different ones, after each task has dropped its own repeats.
    """
    spark = vectors.sparkSession
    checkpoint_root(spark)
    schema = "vec_id long, whitened array<double>, deviation long"
    rows = usable(vectors).mapInArrow(_canonical, "vec_id long, packed binary")
    fit = rows.select("packed").distinct().checkpoint()
    facts = fit.agg(F.count("*").alias("n"), F.max(F.expr("CAST((length(packed) - 3) / CAST(substring(packed, 3, 1) AS STRING) AS INT)")).alias("width")).first()
    n, width = facts.n, facts.width or 0
    # Whole means first, so that all products are of centred numbers.
    sums = _summed(fit, lambda b: _unpacked(b.column("packed"), width).sum(axis=0, dtype=object), width)
    means = [v // n for v in sums] if n else []
    left = [v - n * m for v, m in zip(sums, means, strict=True)]
    centre = np.array(means, np.int64)
    flat = _summed(fit, lambda b: _gram(_unpacked(b.column("packed"), width) - centre), width * (width + 1) // 2)
    matrix = [[0] * width for _ in range(width)]
    for (i, j), value in zip(zip(*map(np.ndarray.tolist, np.triu_indices(width)), strict=True), flat, strict=True):
        matrix[i][j] = matrix[j][i] = n * value - left[i] * left[j]  # n^2 times the covariance
    trace = sum(matrix[i][i] for i in range(width))
    found = []
    if trace:
        poly = characteristic_polynomial(spark, matrix)
        numbers = spark.range(1, min(components, width) + 1, 1, min(components, width)).withColumnRenamed("id", "component")
        found = numbers.mapInArrow(_components(matrix, poly), "component long, k string, s long, vector array<double>").orderBy("component").collect()
    if not found:
        empty = spark.createDataFrame([], "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
        return empty
    with localcontext() as context:
        context.prec = DIGITS
        values = [Decimal(int(r.k)) / Decimal(1 << r.s) for r in found]  # n^2 times the eigenvalues
        scale = np.array([float(Decimal(n) / v.sqrt()) for v in values])
        explained = [float(v / Decimal(trace)) for v in values]
    axes = np.array([r.vector for r in found]).T
    part = np.array([v / n for v in left])

    def whitened(x: np.ndarray) -> np.ndarray:
        return ((x - centre).astype(np.float64) - part) @ axes * scale

    def covariance(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, k = np.zeros((len(scale), len(scale))), len(scale)
        for batch in batches:
            own = whitened(_unpacked(batch.column("packed"), width))
            total += own.T @ own
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(k), k)), pa.array(np.tile(np.arange(k), k)), pa.array(total.ravel())], names=["i", "j", "value"])

    cells = fit.mapInArrow(covariance, "i long, j long, value double").groupBy("i", "j").agg(F.sum("value").alias("value")).collect()
    error = max(abs(r.value / n - (r.i == r.j)) for r in cells)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _unpacked(batch.column("packed"), width) - centre
            top = n * (int(np.abs(x).max(initial=0)) + 1)
            if top * top * max(1, width) < 1 << 62:
                away = ((n * x - np.array(left, np.int64)) ** 2).sum(axis=1).tolist()
            else:
                away = ((n * x.astype(object) - np.array(left, object)) ** 2).sum(axis=1).tolist()
                away = [v if v < 1 << 63 else None for v in away]
            done = whitened(x + centre)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(scale)), pa.array(done.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), lists, pa.array(away, pa.int64())], names=["vec_id", "whitened", "deviation"])

    out = rows.mapInArrow(project, schema).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return out.select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.get(F.array(*map(F.lit, explained)), F.col("at")).alias("explained"), F.lit(float(error)).alias("identity_error"),
    )
