"""Hard negatives, whitening and min-max near duplicates against brute force."""

from __future__ import annotations

import collections
import math
from decimal import Decimal

import numpy as np
import pytest
from fixtures import documents, empty, texts, twins, words
from pyspark.sql import functions as F
from test_search import linked_rows

from tarn.llm import groups, hard_negatives, minhash_dedup, whitening

SCHEMA = "vec_id long, label int, embedding array<float>, block int, n int, packed int, score int, component int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, y, v, 1, 2, 3, 4, 5) for i, y, v in rows], SCHEMA).repartition(3)


def odd_rows():
    return [
        (None, 1, [0.5] * 6), (9001, None, [0.5] * 6), (9002, 1, None), (9003, 1, [0.1, None, 0.2]), (9004, 1, [0.1, math.nan]),
        (9005, 2, [math.inf, 0.0]), (9006, 2, [-math.inf]), (9007, 2, []), (9008, 1, [0.5, 0.25]),
    ]


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def brute_negatives(rows, is_anchor):
    rows = [(i, y, [math.floor(256 * float(np.float32(x))) for x in v]) for i, y, v in rows if i is not None and y is not None and usable(v)]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    out = collections.Counter()
    for i, y, v in rows:
        if not is_anchor(i):
            continue
        others = sorted((-dot(v, w), j, z) for j, z, w in rows if j != i)
        positives = [(-s, j) for s, j, z in others if z == y][:5]
        for p, j in positives:
            ok = [(-s, n) for s, n, z in others if z != y and 50 * p <= 100 * -s <= 95 * p][:3]
            out.update((i, j, r, n, p, s) for r, (s, n) in enumerate(ok, 1))
    return out


@pytest.mark.parametrize("scale", [1.0, 3000.0])
def test_hard_negatives(spark, monkeypatch, scale):
    monkeypatch.setattr(hard_negatives, "LEAST_ROWS", 40)
    monkeypatch.setattr(hard_negatives, "MOST_ROWS", 40)
    monkeypatch.setattr(hard_negatives, "ANCHORS", 4)
    monkeypatch.setattr(hard_negatives, "CHUNK", 2)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(4, 12))
    rows = []
    for i in range(300):
        label = int(rng.integers(0, 4)) if i % 3 else 0  # a hot label
        v = (centres[label] * rng.uniform(0, 1) + rng.normal(size=12)) * scale / 4
        rows.append((i, label, v.tolist()))
    rows += [(400 + i, int(i % 2), rows[0][2]) for i in range(20)] + [rows[7], rows[7], (500, 99, rows[3][2])] + odd_rows()
    got = hard_negatives.mine(vectors(spark, rows), F.col("vec_id") % 10 == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = brute_negatives(rows, lambda i: i % 10 == 0)
    assert len(want) > 300 and collections.Counter(tuple(r) for r in got.collect()) == want
    if scale == 1.0:
        assert hard_negatives.mine(vectors(spark, []), F.col("vec_id") % 10 == 0).count() == 0
        assert hard_negatives.mine(vectors(spark, rows[:9]), F.lit(False)).count() == 0


def test_scores_of_large_components_are_exact(spark):
    rows = [(i, i % 2, [float(2**17 - i), float(-(2**16) + 3 * i), 1.0 / (i + 1)] * 3) for i in range(40)] + [(100, 0, [1e30, 1.0]), (101, 1, [-1e30, 1.0])]
    cut = lambda v: [min(max(x, -(2.0**18)), 2.0**18) for x in v]
    got = hard_negatives.mine(vectors(spark, rows), F.col("vec_id") % 10 == 0, low=1, high=100).collect()
    rows = [(i, y, cut(v)) for i, y, v in rows]
    dots = {i: [math.floor(256 * float(np.float32(x))) for x in v] for i, _, v in rows}
    assert got and all(r["negative_score"] == sum(a * b for a, b in zip(dots[r["anchor_id"]], dots[r["negative_id"]], strict=False)) for r in got)


def test_vertical_scan_keeps_every_row_that_counts():
    rng = np.random.default_rng(8)
    for _ in range(30):
        cells = rng.integers(-300, 300, (16, 200)).astype(np.float32)
        anchor = rng.integers(-300, 300, 16).astype(np.float32)
        whole = anchor @ cells
        rows, scores = hard_negatives.vertical_scan(cells, cells.min(1), cells.max(1), anchor, hard_negatives._nearest(5))
        assert (scores == whole[rows]).all() and set(np.argsort(-whole, kind="stable")[:5]) <= set(rows.tolist())
        windows = [(1000, 200_000), (-5000, 0), (10**9, 10**9)]
        rows, scores = hard_negatives.vertical_scan(cells, cells.min(1), cells.max(1), anchor, hard_negatives._inside(windows, 3))
        for low, high in windows:
            inside = np.flatnonzero((whole >= low) & (whole <= high))
            assert set(inside[np.argsort(-whole[inside], kind="stable")][:3]) <= set(rows.tolist())


def test_modular_polynomials():
    rng = np.random.default_rng(2)
    for n in (1, 2, 3, 5, 8):
        base = rng.integers(-9, 9, (n, n))
        matrix = base @ base.T
        if n == 5:
            matrix[:, 0] = matrix[0, :] = 0
        for p in (101, (1 << 31) - 1):
            found = whitening.hessenberg_polynomial(matrix % p, p)
            for x in range(5):  # det(x - matrix) at some places
                minor = [[Decimal(int((x if i == j else 0) - matrix[i, j])) for j in range(n)] for i in range(n)]
                assert (sum(c * x**i for i, c in enumerate(found)) - determinant(minor)) % p == 0
    assert whitening.primes(1 << 100)[:4] == [2147483647, 2147483629, 2147483587, 2147483579]


def determinant(rows):
    """By expansion along the first row."""
    if len(rows) == 1:
        return int(rows[0][0])
    return sum((-1) ** j * int(v) * determinant([r[:j] + r[j + 1 :] for r in rows[1:]]) for j, v in enumerate(rows[0]) if v)


def test_roots_are_counted_and_isolated():
    poly = [1]
    roots = [0, 0, 1, 7, 7, 7, 10**30, 10**30 + 1]
    for r in roots:
        poly = [(poly[i - 1] if i else 0) - r * (poly[i] if i < len(poly) else 0) for i in range(len(poly) + 1)]
    for x in (0, 1, 6, 7, 10**30):
        assert whitening.roots_beyond(poly, x, 0) == sum(r > x for r in roots)
    assert whitening.roots_beyond(poly, 13, 1) == 5
    for j, r in enumerate(sorted(roots, reverse=True), 1):
        k, s, first, last = whitening.root(poly, j)
        same = [i for i, o in enumerate(sorted(roots, reverse=True), 1) if o == r]
        assert k < 0 if r == 0 else (k < r << s <= k + 1 << 0 or k < r * 2**s <= k + 1) and [first, last] == [same[0], same[-1]]


def whole(v):
    return [math.floor(64 * float(np.float32(x))) + 1_000_000 for x in v]


def check_whitening(got, rows, width, most=16):
    kept = [(i, whole(v) + [1_000_000] * (width - len(v))) for i, _, v in rows if usable(v)]
    fit = np.array(sorted({tuple(x) for _, x in kept}))
    n, sums = len(fit), fit.sum(axis=0)
    centred = (n * fit - sums) / n
    e, axes = np.linalg.eigh(centred.T @ centred / n)
    e, axes = e[::-1], axes[:, ::-1]
    rank = min(most, int((e > e.max() * 1e-9).sum()))
    assert len(got) == rank * len(kept)
    by_row = collections.Counter((r["vec_id"], r["component"], r["n"], r["deviation"]) for r in got)
    assert by_row == collections.Counter((i, c, n, int(((n * np.array(x) - sums) ** 2).sum())) for i, x in kept for c in range(1, rank + 1))
    for c in range(1, rank + 1):
        own = [r for r in got if r["component"] == c]
        assert abs(own[0]["explained"] / (e[c - 1] / e.sum()) - 1) < 1e-9
        assert all(r["identity_error"] < 1e-9 for r in own)
        if np.isclose(e, e[c - 1], rtol=1e-6).sum() == 1:
            want = {i: float((np.array(x) - sums / n) @ axes[:, c - 1] / math.sqrt(e[c - 1])) for i, x in kept}
            top = max((r for r in own), key=lambda r: abs(r["whitened"]))
            sign = 1 if top["whitened"] * want[top["vec_id"]] > 0 else -1
            assert all(abs(r["whitened"] - sign * want[r["vec_id"]]) < 1e-7 for r in own)
    return fit, got


def test_whitening(spark):
    rng = np.random.default_rng(6)
    rows = [(i, 0, (rng.normal(size=20) * np.linspace(0.2, 2, 20)).tolist()) for i in range(200)]
    rows += [rows[3], rows[3], (300, 0, rows[5][2]), *[r for r in odd_rows() if r[0] is not None]]
    got = whitening.whiten(vectors(spark, rows)).collect()
    check_whitening(got, rows, 20)
    nobody = whitening.whiten(vectors(spark, [(None, 0, [1.0, 2.0]), (1, 0, [2.0, 1.0])])).collect()
    assert sorted((r["vec_id"] or 0, r["component"], round(abs(r["whitened"]), 9), r["n"]) for r in nobody) == [(0, 1, 1.0, 2), (1, 1, 1.0, 2)]
    assert whitening.whiten(vectors(spark, [])).count() == 0
    assert whitening.whiten(vectors(spark, [(1, 0, [0.5]), (2, 0, [0.5])])).count() == 0


def test_whitening_of_equal_eigenvalues_and_few_dimensions(spark):
    signs = [[float(s * (j == i)) for j in range(6)] for i in range(4) for s in (-1, 1)]  # four equal ones, two of zero
    rows = [(i, 0, v) for i, v in enumerate(signs)]
    got = whitening.whiten(vectors(spark, rows)).collect()
    assert len(got) == 4 * 8 and all(abs(r["explained"] - 0.25) < 1e-12 and r["identity_error"] < 1e-12 for r in got)
    check_whitening(got, rows, 4)
    line = [(i, 0, [float(i * i)]) for i in range(5)]
    check_whitening(whitening.whiten(vectors(spark, line)).collect(), line, 1)


def test_whitening_of_large_entries(spark):
    big = 2.0**40
    rows = [(i, 0, [big * i, 1.0 * (i % 3), -big * i * i]) for i in range(7)]
    got = whitening.whiten(vectors(spark, rows)).collect()
    assert len(got) == 7 * 3 and all(r["identity_error"] < 1e-6 and r["n"] == 7 and r["deviation"] is None for r in got)


@pytest.mark.parametrize("small", [32, 2])
def test_minhash_dedup(spark, monkeypatch, small):
    monkeypatch.setattr(minhash_dedup, "SMALL", small)
    monkeypatch.setattr(groups, "BLOCK_ROWS", 20)
    monkeypatch.setattr(minhash_dedup, "STRIP", 500)
    base = words(2000, 300, 5000)
    rows = texts() + [(900 + i, t, "s") for i, t in enumerate(twins())]
    for i in range(40):  # copies at similarities around the limit, most of them nearer to each other than to the least id
        copy = list(base)
        for j in range(0, 4 + i // 4):
            copy[(37 * j + 13 * (i % 5)) % 300] = f"x{i % 7}_{j}"
        rows.append((1000 + i, " ".join(copy), "s"))
    want, least = linked_rows(rows, 3, 85)
    docs = documents(spark, rows)
    got = minhash_dedup.link(docs).collect()
    assert collections.Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == want
    if small == 2:
        kept = minhash_dedup.one_of_each(docs)
        assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} - {None} == set(least.values())
        assert minhash_dedup.link(empty(spark)).count() == 0


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(12)
    for shared in (0.2, 0.5, 0.85):
        estimates = []
        for _ in range(40):
            union = rng.integers(0, 1 << 63, 400).astype(np.uint64) * np.uint64(2)
            both = int(400 * shared)
            x, y = union[: both + (400 - both) // 2], np.concatenate((union[:both], union[both + (400 - both) // 2 :]))
            found = minhash_dedup.signatures([np.sort(x), np.sort(y)])
            estimates.append((found[:, :, 0] == found[:, :, 1]).mean())
        assert abs(np.mean(estimates) - both / 400) < 0.02
