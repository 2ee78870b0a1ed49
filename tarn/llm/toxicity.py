"""Toxicity by the nearest labelled examples under TF-IDF cosine, found through block-max inverted lists."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.llm import words
from tarn.llm.common import only_texts
from tarn.session import checkpoint_root

# Bounds of the sample: labelled rows that are drawn, and of these the examples and the numbers in their lists.
FIT_ROWS, EXAMPLES, POSTINGS = 20_000, 4_000, 2_000_000
# One drawn row in so many calibrates the votes and is no example.
CALIBRATE = 4
# Least labelled texts of a word that is counted as tested, and the weight of a word that tells nothing about labels.
LEAST_TEXTS, FLOOR = 3, 0.1
# Bytes of a stem: endings are cut off behind them.
STEM = 6
NEIGHBOURS = 15
# Weight of the base rate among the votes, examples of one block of the lists, and the score that marks a text.
PRIOR, BLOCK, TOXIC = 0.5, 128, 0.7


def _terms_of(data: np.ndarray, offsets: np.ndarray, vocabulary: np.ndarray | None) -> tuple[np.ndarray, ...]:
    """``(row, term, times)`` by row and term: each text's words, and the stems that it has more than once.

    With a ``vocabulary`` (sorted hashes) terms are places in it and others are left out; without, terms are hashes.
    """
    hashes, begins, stems = words.word_hashes(data, offsets, words.LETTERS, STEM)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(begins))
    longer = stems != hashes
    known = np.unique(np.concatenate((hashes, stems[longer]))) if vocabulary is None else vocabulary
    keys, times = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    if len(known):
        for term, of, least in ((hashes, row, 1), (stems[longer], row[longer], 2)):
            at = np.minimum(np.searchsorted(known, term), len(known) - 1)
            hit = known[at] == term
            key, n = np.unique(of[hit] * len(known) + at[hit], return_counts=True)
            keys.append(key[n >= least])
            times.append(n[n >= least])
    key, n = np.concatenate(keys), np.concatenate(times)
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    row, term = np.divmod(key, max(1, len(known)))
    return row, known[term].view(np.int64) if vocabulary is None else term, n


def _counted(keys: list[str]):
    """Arrow function: each text's terms as hashes, and how often it has them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [(begin, _terms_of(data, offsets, None)) for begin, _, data, offsets in words.slices(batch.column("text"))]
            sizes = np.zeros(batch.num_rows + 1, np.int32)
            for begin, (row, _, _) in parts:
                np.add.at(sizes, begin + row + 1, 1)
            ends = pa.array(np.cumsum(sizes, dtype=np.int32))
            lists = [
                pa.ListArray.from_arrays(ends, pa.array(np.concatenate([np.zeros(0, np.int64), *(p[1][j] for p in parts)])))
                for j in (1, 2)
            ]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keys), *lists], names=[*keys, "terms", "times"])

    return run


def _frequencies(vocabulary: np.ndarray):
    """Arrow function: a row for each term of the task's texts with the number of texts that have it; term -1 counts all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held = 0, np.zeros(len(vocabulary), np.int64)
        for batch in batches:
            total += batch.num_rows
            for _, _, data, offsets in words.slices(batch.column("text")):
                held += np.bincount(_terms_of(data, offsets, vocabulary)[1], minlength=len(vocabulary))
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(some, -1).astype(np.int32)), pa.array(np.append(held[some], total))], names=["term", "n"]
        )

    return run


@dataclass
class Model:
    """What is fitted: terms (sorted hashes), examples as sparse counts, base rates, weights of terms, and the calibration."""

    terms: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    rows: np.ndarray
    columns: np.ndarray
    counts: np.ndarray
    base: float
    without: float  # share of toxic ones among examples that hold no telling word
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    calibration: tuple[float, float] = (0.0, 1.0)


def _ranges(begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, one range after the other."""
    sizes = ends - begins
    return np.arange(sizes.sum()) + np.repeat(begins - np.cumsum(sizes) + sizes, sizes)


class BlockMaxIndex:
    """Inverted lists of unit vectors: a term's list is cut by blocks of examples, and each cut keeps its greatest weight.

    Blocks hold examples of one label that share their commonest term, thus a language, and are about as long: their greatest weights are
    near to what each example has.
    """

    def __init__(self, model: Model, weights: np.ndarray):
        self.weights, self.labels, self.ids = weights, model.labels, model.ids
        n = len(model.ids)
        value = (1 + np.log(model.counts)) * weights[model.columns]
        norms = np.sqrt(np.bincount(model.rows, value**2, minlength=n))
        held = np.bincount(model.columns, minlength=len(weights))
        by_row = np.lexsort((model.columns, -held[model.columns], model.rows))
        first = np.searchsorted(model.rows[by_row], np.arange(n), "left")
        commonest = np.append(model.columns[by_row], -1)[first]
        #: The example's number at each place, and its place.
        self.number = np.lexsort((norms, commonest, model.labels))
        place = np.empty(n, np.intp)
        place[self.number] = np.arange(n)
        rows = place[model.rows]
        order = np.lexsort((rows, model.columns))
        self.row, column = rows[order], model.columns[order]
        self.value = (value / np.where(norms > 0, norms, 1)[model.rows])[order]
        block = self.row // BLOCK
        new = np.ones(len(block), bool)
        new[1:] = (block[1:] != block[:-1]) | (column[1:] != column[:-1])
        cuts = np.flatnonzero(new)
        self.block, self.begin = block[cuts], np.append(cuts, len(block))
        self.most = np.maximum.reduceat(self.value, cuts) if len(cuts) else np.zeros(0)
        self.first = np.searchsorted(column[cuts], np.arange(len(weights) + 1))

    def nearest(self, terms: np.ndarray, times: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and cosines of the ``k`` nearest examples above 0; ties by number. No block is left out that could matter."""
        query = (1 + np.log(times)) * self.weights[terms]
        norm = np.sqrt((query**2).sum())
        if not norm:
            return np.zeros(0, np.int64), np.zeros(0)
        query = query / norm
        cuts = _ranges(self.first[terms], self.first[terms + 1])
        of = np.repeat(query, self.first[terms + 1] - self.first[terms])
        bounds = np.bincount(self.block[cuts], of * self.most[cuts])
        ahead = np.zeros(len(bounds), bool)
        ahead[np.argsort(-bounds, kind="stable")[:2]] = True
        numbers, values = self._within(ahead, cuts, of, k)
        # Only blocks whose bound reaches the last of the k can hold another.
        rest = ~ahead & (bounds > 0) & (bounds >= (values[-1] - 1e-9 if len(values) == k else 0))
        if rest.any():
            more, cosines = self._within(rest, cuts, of, k)
            numbers, values = np.concatenate((numbers, more)), np.concatenate((values, cosines))
            order = np.lexsort((numbers, -np.round(values, 12)))[:k]
            numbers, values = numbers[order], values[order]
        return numbers, values

    def _within(self, blocks: np.ndarray, cuts: np.ndarray, of: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` nearest of these blocks."""
        own = blocks[self.block[cuts]]
        cuts, of = cuts[own], of[own]
        at = _ranges(self.begin[cuts], self.begin[cuts + 1])
        cosines = np.bincount(self.row[at], np.repeat(of, self.begin[cuts + 1] - self.begin[cuts]) * self.value[at])
        places = np.flatnonzero(cosines > 0)
        if len(places) > k:
            least = np.partition(cosines[places], len(places) - k)[len(places) - k]
            places = places[cosines[places] >= least - 1e-9]
        numbers, cosines = self.number[places], cosines[places]
        order = np.lexsort((numbers, -np.round(cosines, 12)))[:k]
        return numbers[order], cosines[order]


EVIDENCE = pa.list_(pa.struct([("doc_id", pa.int64()), ("toxic", pa.int32()), ("cosine", pa.float64())]))


def _scored(model: Model, keys: list[str], k: int):
    """Arrow function: each text's score and the examples it rests on; squared cosines weigh the votes."""
    index = BlockMaxIndex(model, model.weights)
    terms, base, without, (shift, slope) = model.terms, model.base, model.without, model.calibration

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, near, sizes = np.full(batch.num_rows, without), [], np.zeros(batch.num_rows + 1, np.int32)
            for begin, end, data, offsets in words.slices(batch.column("text")):
                row, term, times = _terms_of(data, offsets, terms)
                cuts = np.searchsorted(row, np.arange(end - begin + 1))
                for i in np.flatnonzero(np.diff(cuts)):
                    numbers, cosines = index.nearest(term[cuts[i] : cuts[i + 1]], times[cuts[i] : cuts[i + 1]], k)
                    if len(numbers):
                        votes = cosines**2
                        share = ((votes * index.labels[numbers]).sum() + PRIOR * base) / (votes.sum() + PRIOR)
                        scores[begin + i] = calibrated(share, shift, slope)
                        sizes[begin + i + 1] = len(numbers)
                        near.append((numbers, cosines))
            numbers = np.concatenate([np.zeros(0, np.int64), *(n for n, _ in near)])
            found = pa.StructArray.from_arrays(
                [
                    pa.array(index.ids[numbers], pa.int64()), pa.array(index.labels[numbers], pa.int32()),
                    pa.array(np.concatenate([np.zeros(0), *(c for _, c in near)])),
                ],
                fields=list(EVIDENCE.value_type),
            )
            evidence = pa.ListArray.from_arrays(pa.array(np.cumsum(sizes, dtype=np.int32)), found)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(key) for key in keys), pa.array(scores), evidence], names=[*keys, "score", "evidence"]
            )

    return run


SCORED = "score double, evidence array<struct<doc_id:long,toxic:int,cosine:double>>"


def calibrated(share, shift: float, slope: float):
    """A share of votes as a chance, on the logistic line that :func:`calibration` fits."""
    share = np.clip(share, 1e-6, 1 - 1e-6)
    return 1 / (1 + np.exp(-(shift + slope * np.log(share / (1 - share)))))


def calibration(shares: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Shift and slope of greatest likelihood; a unit penalty holds them near (0, 1), which they are without rows."""
    shares = np.clip(shares, 1e-6, 1 - 1e-6)
    x, line = np.stack([np.ones(len(shares)), np.log(shares / (1 - shares))], 1), np.array([0.0, 1.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ line))
        slope = x.T @ (labels - p) - (line - [0, 1])
        line = line + np.linalg.solve((x.T * (p * (1 - p))) @ x + np.eye(2), slope)
    return float(line[0]), float(max(line[1], 0.0))


def _flat(column: pa.ChunkedArray) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False) if len(column) else np.zeros(0, np.int64)


def fit(docs: DataFrame, labels: DataFrame, k: int = NEIGHBOURS) -> Model:
    """Examples from at most ``FIT_ROWS`` rows of ``labels (doc_id, toxic)``, drawn by the ids' hashes.

    Terms are all words (letters and digits, lower case) of the examples, and stems of ``STEM`` bytes that a text has more
    than once. A term weighs its inverse document frequency over all of ``docs`` times a number from ``FLOOR`` to 1: the chance, by a
    likelihood-ratio test among as many terms as come in ``LEAST_TEXTS`` drawn texts, that it is tied to the labels. One drawn row in
    ``CALIBRATE`` is no example but calibrates; of the others the first by hash are examples, ``EXAMPLES`` with ``POSTINGS`` terms in all at
    most. Of several labels of one id the greatest holds, of several texts the one of least hash; null ids and labels are left out.
    """
    drawn = (
        labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(FIT_ROWS)
    )
    known = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .join(F.broadcast(drawn), "doc_id")  # FIT_ROWS short rows at most
        .groupBy("doc_id", "toxic").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
        .withColumn("calibrates", F.pmod(F.xxhash64("doc_id", F.lit("calibrates")), F.lit(CALIBRATE)) == 0)
        .checkpoint()
    )
    counted = known.where("NOT calibrates").mapInArrow(
        _counted(["doc_id", "toxic"]), "doc_id long, toxic int, terms array<long>, times array<long>"
    ).checkpoint()
    # At most FIT_ROWS short rows.
    listed = counted.select("doc_id", "toxic", F.size("terms").alias("n")).orderBy(F.xxhash64("doc_id"), "doc_id").collect()
    base = (sum(r.toxic for r in listed) + 0.5) / (len(listed) + 1)
    chosen, room = [], POSTINGS
    for row in listed:
        if 0 < row.n <= room and len(chosen) < EXAMPLES:
            chosen.append(row.doc_id)
            room -= row.n
    marked = counted.withColumn("example", F.col("doc_id").isin(chosen))
    held = (
        marked.select("toxic", "example", F.explode("terms").alias("term"))
        .groupBy("term").agg(F.count("*").alias("n"), F.sum("toxic").alias("a"), F.max("example").alias("example")).checkpoint()
    )
    tested = held.where(F.col("n") >= LEAST_TEXTS).count()
    # At most POSTINGS numbers each.
    known_terms = held.where("example").select("term", "n", "a").toArrow()
    examples = marked.where("example").select("doc_id", "toxic", "terms", "times").orderBy("toxic", "doc_id").toArrow()
    hashes, n, a = (known_terms.column(c).to_numpy().astype(np.int64) for c in ("term", "n", "a"))
    order = np.argsort(hashes.view(np.uint64))
    terms, n, a = hashes.view(np.uint64)[order], n[order], a[order]
    part = lambda count, rate: count * np.log(np.maximum(count, 1) / (np.maximum(n, 1) * rate))
    telling = 1 / (1 + max(tested, 1) * np.exp(-(part(a, base) + part(n - a, 1 - base))))
    columns = np.searchsorted(terms, _flat(examples.column("terms")).astype(np.int64).view(np.uint64))
    sizes = np.array([len(t) for t in examples.column("terms")], np.int64)
    rows, toxic = np.repeat(np.arange(len(sizes)), sizes), examples.column("toxic").to_numpy().astype(np.int64)
    plain = np.bincount(rows, telling[columns] > 0.5, minlength=len(sizes)) == 0
    seen = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(_frequencies(terms), "term int, n long")
    frequencies = seen.groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    at, texts = (frequencies.column(c).to_numpy() for c in ("term", "n"))
    total, having = int(texts[at < 0].sum()), np.zeros(len(terms), np.int64)
    having[at[at >= 0]] = texts[at >= 0]
    model = Model(
        terms, examples.column("doc_id").to_numpy().astype(np.int64), toxic, rows, columns, _flat(examples.column("times")).astype(np.int64),
        base, (toxic[plain].sum() + 0.5) / (plain.sum() + 1),
        (np.log((total + 1) / (having + 1)) + 1) * (FLOOR + (1 - FLOOR) * telling),
    )
    # At most FIT_ROWS votes of texts that are no examples.
    votes = (
        known.where("calibrates").select("toxic", "text").mapInArrow(_scored(model, ["toxic"], k), f"toxic int, {SCORED}")
        .where(F.size("evidence") > 0).select("toxic", "score").toArrow()
    )
    model.calibration = calibration(votes.column("score").to_numpy(), votes.column("toxic").to_numpy())
    return model


def score(docs: DataFrame, labels: DataFrame, k: int = NEIGHBOURS) -> DataFrame:
    """``doc_id, key, score, predicted, evidence`` for every row of ``docs (doc_id, text)``, as ``labels (doc_id, toxic)`` mark it.

    Texts are vectors of ``1 + ln tf`` times the weights of :func:`fit`. The ``k`` nearest examples by exact cosine vote with their
    squared cosines, and the base rate with ``PRIOR``; a logistic line fitted on labelled rows that are no examples turns the toxic
    share of the votes into a chance. ``evidence`` lists the examples. A text without a term (an empty or null one too) has the share of
    toxic ones among examples without a telling word. ``predicted`` is 1 from ``TOXIC`` on. Rows that repeat are
    scored each; without labels the score is a half. Only text enters a score; ``key`` is its hash. Other columns are ignored.
    """
    checkpoint_root(docs.sparkSession)
    model = fit(docs, labels, k)
    done = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("key"), F.col("text").cast("string").alias("text"))
        .mapInArrow(_scored(model, ["doc_id", "key"], k), f"doc_id long, key long, {SCORED}")
    )
    return done.select("doc_id", "key", "score", (F.col("score") >= TOXIC).cast("int").alias("predicted"), "evidence")


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with all their columns."""
    found = score(docs, labels).where("predicted = 1").select("doc_id", "key").distinct().checkpoint()
    return only_texts(docs, found, "left_anti")
