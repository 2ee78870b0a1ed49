"""Runs of words that came before, found by winnowing, and texts without them.

A passage repeats inside lines as well as over several, so the hashed units are not whole lines but all runs of ``GRAM`` words in them. Of every
window of such runs the least hash is a fingerprint: any two places that share ``GRAM + window - 1`` words share a fingerprint, wherever lines begin.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarn.llm import words
from tarn.session import checkpoint_root

# Words that a repeated run must hold.
LEAST_WORDS = 50
# Numbers of a list that may be broadcast.
FEW = 2_000_000
_FACTOR = np.uint64(0xD6E8FEB86659FD93)


def _gram(least: int) -> int:
    """Words of a hashed run: so many that two fingerprints in a row overlap or touch."""
    return least - least // 2 + 1


def gram_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """The hash of every run of ``size`` words, from hashes of shorter runs."""
    for step in (5, 3, 2):
        if size > step and size % step == 0:
            short = words.ngram_hashes(hashes, size // step)
            count = max(0, len(hashes) - size + 1)
            total = np.zeros(count, np.uint64)
            for j in range(step):
                total = words.mix(total * _FACTOR + short[j * (size // step) : j * (size // step) + count])
            return total
    return words.ngram_hashes(hashes, size)


def window_minima(grams: np.ndarray, window: int) -> np.ndarray:
    """The place of the least hash (the first of equal ones) in every window of ``window`` hashes."""
    at = np.arange(len(grams))
    least, width = grams, 1
    while width < window:
        step = min(width, window - width)
        n = max(0, len(least) - step)
        later = least[step : step + n] < least[:n]
        at = np.where(later, at[step : step + n], at[:n])
        least = np.minimum(least[step : step + n], least[:n])
        width += step
    return at


def _thinned(places: np.ndarray, grams: np.ndarray, window: int) -> np.ndarray:
    """Fingerprints without those that repeat the one before them within a window: text that repeats itself has one a window."""
    again = (grams[places[1:]] == grams[places[:-1]]) & (np.diff(places) < window)
    if not again.any():
        return places
    kept, last = [], None
    for place, value in zip(places.tolist(), grams[places].tolist(), strict=True):
        if last is None or value != last[1] or place - last[0] >= window:
            kept.append(place)
            last = (place, value)
    return np.array(kept, np.int64)


class Winnowed:
    """Run hashes and window minima of the texts of a slice."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, least: int):
        self.least, self.gram = least, _gram(least)
        self.window = least - self.gram + 1
        hashes, self.begins = words.word_hashes(data, offsets, exact=True)
        self.grams = gram_hashes(hashes, self.gram)
        self.minima = window_minima(self.grams, self.window)

    def starts(self, i: int) -> np.ndarray:
        """Where runs of the least words begin in the ``i``-th text."""
        return np.arange(self.begins[i], max(self.begins[i], self.begins[i + 1] - self.least + 1))

    def fingerprints(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes and places (in words of the text) of its fingerprints."""
        own = self.starts(i)
        if not len(own):
            return np.zeros(0, np.uint64), own
        places = self.minima[own]
        places = _thinned(places[np.append(True, np.diff(places) > 0)], self.grams, self.window)
        return self.grams[places], places - self.begins[i]

    def digests(self, starts: np.ndarray) -> np.ndarray:
        """A hash of each whole run of the least words: of its first and its last hashed part, which overlap."""
        return words.mix(self.grams[starts] * _FACTOR + self.grams[starts + self.least - self.gram])


def _lists(values: list[np.ndarray], kind: type = np.int64) -> pa.ListArray:
    ends = np.concatenate(([0], np.cumsum([len(v) for v in values]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, kind), *values]).astype(kind)))


def _fingerprints(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in words.slices(batch.column("text")):
                winnowed = Winnowed(data, offsets, least)
                found = [winnowed.fingerprints(i) for i in range(end - first)]
                some = pa.array([i for i, f in enumerate(found) if len(f[0])], pa.int64())
                own = batch.slice(first, end - first).take(some)
                found = [f for f in found if len(f[0])]
                yield pa.RecordBatch.from_arrays(
                    [own.column("doc_id"), own.column("key"), _lists([f[0].view(np.int64) for f in found]), _lists([f[1] for f in found], np.int32)],
                    names=["doc_id", "key", "prints", "places"],
                )

    return run


def _chains(least: int):
    """Of each text's shared fingerprints: the runs they prove, and the fingerprints at whose windows that is not enough.

    Fingerprints in a row that lie at the same distance from their first places in one text overlap there too, so
    what they cover together is equal word for word.
    """
    gram = _gram(least)
    window = least - gram + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            listed = batch.column("all")
            offsets = listed.offsets.to_numpy() - listed.offsets[0].as_py() if len(listed) else np.zeros(1, np.int32)
            flat = listed.flatten()
            place, mark, first, shift, later = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("place", "mark", "first", "shift", "later"))
            starts, ends, edges = [], [], []
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                open_runs: dict[tuple[int, int], list[int]] = {}
                runs, own = [], []
                order = (a + np.argsort(place[a:b], kind="stable")).tolist()
                for i in order:
                    if not later[i]:
                        continue
                    p, along = int(place[i]), (int(first[i]), int(shift[i]))
                    last = open_runs.get(along)
                    if last is not None and p <= last[1]:
                        last[1] = p + gram
                    else:
                        open_runs[along] = last = [p, p + gram]
                        runs.append(last)
                runs = [r for r in runs if r[1] - r[0] >= least]
                at, tops = 0, -1
                for i in order:
                    if not later[i]:
                        continue
                    p = int(place[i])
                    while at < len(runs) and runs[at][0] <= max(0, p - window + 1):
                        tops = max(tops, runs[at][1])
                        at += 1
                    if tops < p + least:
                        own.append(int(mark[i]))
                starts.append(np.array([r[0] for r in runs], np.int64))
                ends.append(np.array([r[1] for r in runs], np.int64))
                edges.append(np.unique(np.array(own, np.int64)))
            columns = [batch.column("doc_id"), batch.column("key"), _lists(starts), _lists(ends), _lists(edges)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "key", "starts", "ends", "edges"])

    return run


def _windows(least: int):
    """Digests of the runs of the least words whose fingerprint is asked for, but for those that are known to repeat."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            asked, low, high = (batch.column(c) for c in ("asked", "starts", "ends"))
            for first, end, data, offsets in words.slices(batch.column("text")):
                winnowed = Winnowed(data, offsets, least)
                starts, digests = [], []
                for i in range(end - first):
                    own = winnowed.starts(i)
                    if len(own):
                        marks = asked[first + i].values.to_numpy().view(np.uint64)
                        own = own[np.isin(winnowed.grams[winnowed.minima[own]], marks)]
                        at = own - winnowed.begins[i]
                        for a, b in zip(low[first + i].values.to_numpy().tolist(), high[first + i].values.to_numpy().tolist(), strict=True):
                            inside = (at >= a) & (at + least <= b)
                            own, at = own[~inside], at[~inside]
                    starts.append(own - winnowed.begins[i])
                    digests.append(winnowed.digests(own).view(np.int64) if len(own) else np.zeros(0, np.int64))
                part = batch.slice(first, end - first)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("key"), _lists(starts, np.int32), _lists(digests)], names=["doc_id", "key", "places", "digests"]
                )

    return run


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranges of each row that meet, as one."""
    for batch in batches:
        starts, ends = [], []
        for low, high in zip(batch.column("starts"), batch.column("ends"), strict=True):
            a, b = low.values.to_numpy(), high.values.to_numpy()
            order = np.argsort(a, kind="stable")
            a, b = a[order], np.maximum.accumulate(b[order])
            new = np.append(True, a[1:] > b[:-1])
            starts.append(a[new])
            ends.append(b[np.append(np.flatnonzero(new)[1:] - 1, len(b) - 1)])
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key"), _lists(starts), _lists(ends)], names=["doc_id", "key", "starts", "ends"])


def without(text: str, runs: list[dict]) -> str:
    """``text`` without the words of ``runs``, and without the white space behind each run, unless that ends a line that keeps words."""
    raw = text.encode()
    data = np.frombuffer(raw, np.uint8)
    inside = np.concatenate(([False], words.SPACED[data], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    begins, ends = edges[::2], edges[1::2]
    kept, at, some = [], 0, False  # whether the line so far keeps a word
    for run in runs:
        low, high = int(begins[run["start"]]), int(ends[run["end"] - 1])
        following = int(begins[run["end"]]) if run["end"] < len(begins) else len(raw)
        piece = raw[at:low]
        line = piece.rpartition(b"\n")
        some = bool(line[2].strip()) or some and not line[1]
        kept.append(piece if some else piece[: len(piece) - len(line[2])])
        at = high if some and b"\n" in raw[high:following] else following
    return b"".join([*kept, raw[at:]]).decode()


_RUNS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


@F.arrow_udf(T.StringType())
def _without(texts: pa.Array, runs: pa.Array) -> pa.Array:
    pairs = zip(texts.to_pylist(), runs.to_pylist(), strict=True)
    return pa.array([None if text is None else without(text, own) for text, own in pairs], pa.string())


def repeated_runs(docs: DataFrame, least: int = LEAST_WORDS) -> DataFrame:
    """``doc_id, key, runs``: the words of each row of ``docs (doc_id, text)`` that repeat earlier ones.

    Words are runs of anything but white space. ``runs`` are ranges ``[start, end)`` of words, in order and apart: exactly
    all words that lie in some run of ``least`` words which came before, that is in a text that is earlier by (doc_id, null ids
    last, hash of the text), or in the same text without sharing a word with it. So the first of each stays. ``key`` is the hash of the text; rows
    that repeat id and text have one result. Rows without such runs are left out.

    1. Only window minima leave the texts. Those that come more than once meet their first place.
    2. Matches that follow each other along one alignment are joined, which extends them word by word both ways. Only where such
       a match ends can more be repeated: of another earlier text, or up to the next fingerprint.
    3. There, whole runs of ``least`` words are compared by their hashes (64 bits), with the same runs of the first places and of
       all texts that end there too. A run's first place is never inside a joined match, so none is missed.
    """
    checkpoint_root(docs.sparkSession)
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("key"), F.col("text").cast("string").alias("text")
    )
    found = texts.mapInArrow(_fingerprints(least), "doc_id long, key long, prints array<long>, places array<int>").checkpoint()
    each = found.select("doc_id", "key", F.inline(F.arrays_zip("prints", "places"))).withColumnsRenamed({"prints": "mark", "places": "place"})
    often = each.groupBy("mark").agg(F.count("*").alias("n")).where("n > 1").select("mark")
    shared = each.join(often, "mark", "left_semi").checkpoint()
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col("key"), F.col("place"))
    firsts = shared.groupBy("mark").agg(F.min(place).alias("f")).checkpoint()
    same_text = F.col("doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("key") == F.col("f.key"))
    met = shared.join(firsts, "mark").select(
        "doc_id", "key",
        F.struct(
            F.col("place").cast("long").alias("place"), "mark", F.xxhash64("f.no_id", "f.doc_id", "f.key").alias("first"),
            (F.col("place") - F.col("f.place")).cast("long").alias("shift"),
            (~same_text | (F.col("place") - F.col("f.place") >= least)).alias("later"),
        ).alias("one"),
    )
    by_text = met.groupBy("doc_id", "key").agg(F.collect_set("one").alias("all"))
    chains = by_text.mapInArrow(
        _chains(least), "doc_id long, key long, starts array<long>, ends array<long>, edges array<long>"
    ).checkpoint()
    # Where more may be repeated: fingerprints at ends of matches, in the texts themselves and at their first places.
    open_marks = chains.select(F.explode("edges").alias("mark")).distinct()
    at_first = (
        firsts.join(open_marks, "mark").select(F.col("f.doc_id").alias("doc_id"), F.col("f.key").alias("key"), "mark")
        .groupBy("doc_id", "key").agg(F.collect_set("mark").alias("marks"))
    )
    none = F.array().cast("array<bigint>")
    same = lambda a, b: F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & (F.col(f"{a}.key") == F.col(f"{b}.key"))
    asked = (
        chains.alias("c").join(at_first.alias("f"), same("c", "f"), "left")
        .select("c.doc_id", "c.key", "c.starts", "c.ends", F.array_union("c.edges", F.coalesce("f.marks", none)).alias("asked"))
        .where(F.size("asked") > 0).checkpoint()
    )
    size = asked.agg(F.sum(F.size("asked") + 2 * F.size("starts") + 2)).first()[0] or 0
    near = F.broadcast(asked) if size <= FEW else asked
    windows = (
        texts.alias("t").join(near.alias("a"), same("t", "a")).select("t.doc_id", "t.key", "t.text", "a.asked", "a.starts", "a.ends")
        .mapInArrow(_windows(least), "doc_id long, key long, places array<int>, digests array<long>")
        .select("doc_id", "key", F.inline(F.arrays_zip("places", "digests"))).withColumnsRenamed({"places": "place", "digests": "digest"})
        .checkpoint()
    )
    earliest = windows.groupBy("digest").agg(F.min(place).alias("f"), F.count("*").alias("n")).where("n > 1").select("digest", "f").checkpoint()
    later = windows.join(earliest, "digest").where(~same_text | (F.col("place") - F.col("f.place") >= least))
    ranges = later.select("doc_id", "key", F.col("place").cast("long").alias("start"), (F.col("place") + least).cast("long").alias("end"))
    proven = chains.select("doc_id", "key", F.inline(F.arrays_zip("starts", "ends"))).withColumnsRenamed({"starts": "start", "ends": "end"})
    listed = (
        proven.unionByName(ranges).groupBy("doc_id", "key").agg(F.collect_list(F.struct("start", "end")).alias("all"))
        .select("doc_id", "key", F.col("all.start").alias("starts"), F.col("all.end").alias("ends"))
    )
    united = listed.mapInArrow(_united, "doc_id long, key long, starts array<long>, ends array<long>")
    return united.select("doc_id", "key", F.arrays_zip(F.col("starts").alias("start"), F.col("ends").alias("end")).cast(_RUNS).alias("runs"))


def dedup_lines(docs: DataFrame, least: int = LEAST_WORDS) -> DataFrame:
    """``docs`` with two more columns: ``runs`` (see :func:`repeated_runs`; empty if none) and ``kept_text``, the text without those
    words; a line that keeps no word goes with its line break.

    A null text stays null, and an empty table gives no rows. Columns named as these are replaced.
    """
    runs = repeated_runs(docs, least).checkpoint()
    few = (runs.agg(F.sum(2 * F.size("runs") + 2)).first()[0] or 0) <= FEW
    names = [c for c in docs.columns if c not in ("runs", "kept_text")]
    joined = docs.alias("d").join(
        (F.broadcast(runs) if few else runs).alias("r"),
        F.col("d.doc_id").cast("long").eqNullSafe(F.col("r.doc_id")) & (F.xxhash64(F.col("d.text")) == F.col("r.key")),
        "left",
    )
    flat = joined.select(*(f"d.`{c}`" for c in names), F.coalesce("r.runs", F.array().cast(_RUNS)).alias("runs"))
    # Only texts that change are sent to Python.
    cut = _without(F.when(F.size("runs") > 0, F.col("text")), F.col("runs"))
    return flat.withColumn("kept_text", F.when(F.size("runs") == 0, F.col("text")).otherwise(cut))
