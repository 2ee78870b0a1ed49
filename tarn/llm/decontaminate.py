"""Benchmark items in training texts, copied or edited: rare seeds of near word pairs and Smith-Waterman alignment."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.llm import words
from tarn.llm.common import only_texts
from tarn.session import checkpoint_root

# The score that counts as a copy.
SCORE = 0.4
MATCH, MISMATCH, GAP = 2, 1, 1
# Words of items that are sent to all tasks at a time (some 40 bytes each); a larger benchmark is scanned in several blocks.
BLOCK_WORDS = 500_000
_BITS = 20


def word_hashes(text: str) -> np.ndarray:
    data = np.frombuffer(text.encode(), np.uint8)
    return words.word_hashes(data, np.array([0, len(data)]), words.LETTERS)[0]


def align(x: np.ndarray, y: np.ndarray) -> tuple[int, int]:
    """Best local alignment score of two word sequences, and the first place in ``y`` where one of that score ends."""
    steps = GAP * np.arange(len(y) + 1)
    row = np.zeros(len(y) + 1, np.int64)
    best, end = 0, 0
    for word in x:
        moved = np.maximum(row[1:] - GAP, row[:-1] + np.where(y == word, MATCH, -MISMATCH))
        row[1:] = np.maximum(moved, 0)
        row = np.maximum.accumulate(row + steps) - steps
        at = int(row.argmax())
        top = int(row[at])
        if top > best or top == best and at < end:
            best, end = top, at
    return best, end


class Items:
    """A block of items: their words, and for each seed the items that have it and how often.

    Seeds of two words are neighbours and words with one other between, alike; the seed of an item of one word is that word.
    """

    def __init__(self, ids: list[int], texts: list[str], score: float):
        hashed = [word_hashes(t) for t in texts]
        kept = [i for i, h in enumerate(hashed) if len(h)]
        self.ids, self.words = [ids[i] for i in kept], [hashed[i] for i in kept]
        self.sizes = np.array([len(h) for h in self.words], np.int64)
        self.least = np.maximum(1, np.ceil(self.sizes * score - 1 - 1e-9)).astype(np.int64)
        found = [self._seeds(h) for h in self.words]
        item = np.repeat(np.arange(len(found)), [len(f) for f in found])
        pairs, times = np.unique(np.stack((np.concatenate([np.zeros(0, np.uint64), *found]), item.astype(np.uint64))), axis=1, return_counts=True)
        self.seeds, first, count = np.unique(pairs[0], return_index=True, return_counts=True)
        self.first, self.count, self.items, self.times = first, count, pairs[1].astype(np.int64), times
        self.rare = np.ones(len(self.items), bool)
        self.bits = np.zeros(1 << _BITS, bool)
        self.bits[(self.seeds & np.uint64((1 << _BITS) - 1)).astype(np.int64)] = True
        self.single = bool((self.sizes == 1).any())

    @staticmethod
    def _seeds(hashes: np.ndarray) -> np.ndarray:
        if len(hashes) == 1:
            return words.ngram_hashes(hashes, 1)
        return np.concatenate((words.ngram_hashes(hashes, 2), words.gapped_hashes(hashes) if len(hashes) > 2 else np.zeros(0, np.uint64)))

    def choose(self, corpus: np.ndarray) -> None:
        """Mark the rare seeds of every item, by how often the corpus holds each seed.

        A copy that counts shares ``least`` of an item's seeds, so it shares one of any but ``least - 1`` of them: of all but the commonest.
        """
        order = np.lexsort((np.repeat(corpus, self.count), self.items))
        item, times = self.items[order], self.times[order]
        total = np.bincount(item, times, len(self.ids)).astype(np.int64)
        upto = np.cumsum(times) - times
        upto -= (np.cumsum(np.bincount(item, times, len(self.ids)).astype(np.int64)) - total)[item]
        self.rare[order] = upto < (total - self.least + 1)[item]

    def hits(self, hashes: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the seeds in a run of texts, and their places: twice the first word's number, and one more with a word between."""
        seeds, places = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        kinds = [(2, 0, words.ngram_hashes(hashes, 2)), (2, 1, words.gapped_hashes(hashes))]
        if self.single:
            kinds.append((1, 0, words.ngram_hashes(hashes, 1)))
        for size, apart, grams in kinds:
            # Most seeds fail a table of their low bits, and are not looked up.
            at = np.flatnonzero(self.bits[(grams & np.uint64((1 << _BITS) - 1)).astype(np.int64)])
            near = np.minimum(np.searchsorted(self.seeds, grams[at]), len(self.seeds) - 1)
            same = self.seeds[near] == grams[at]
            at, near = at[same], near[same]
            inside = at + size + apart <= begins[np.searchsorted(begins, at, "right")]
            seeds.append(near[inside])
            places.append(2 * at[inside] + apart)
        return np.concatenate(seeds), np.concatenate(places)

    def _met(self, seeds: np.ndarray, rare: bool) -> tuple[np.ndarray, np.ndarray]:
        """Of each hit its number and one of its items; with ``rare``, only items that have the seed as a rare one."""
        count = self.count[seeds]
        hit = np.repeat(np.arange(len(seeds)), count)
        at = np.repeat(self.first[seeds] - (np.cumsum(count) - count), count) + np.arange(len(hit))
        if rare:
            hit, at = hit[self.rare[at]], at[self.rare[at]]
        return hit, at

    def copies(self, hashes: np.ndarray, begins: np.ndarray) -> Iterator[tuple[int, int, float, int]]:
        """``text, item, score, end`` of the texts that hold as many seeds of an item, within the words that a copy can span, as a copy must."""
        seeds, places = self.hits(hashes, begins)
        order = np.argsort(places, kind="stable")
        seeds, places = seeds[order], places[order]
        row = np.searchsorted(begins, places // 2, "right") - 1
        n = len(self.ids)
        hit, at = self._met(seeds, True)
        asked = np.unique(row[hit] * n + self.items[at])
        if not len(asked):
            return
        # Common seeds count only where a rare one was found.
        some = np.isin(row, asked // n)
        seeds, places, row = seeds[some], places[some], row[some]
        hit, at = self._met(seeds, False)
        pair = row[hit] * n + self.items[at]
        kept = asked[np.minimum(np.searchsorted(asked, pair), len(asked) - 1)] == pair
        pair, hit, at = pair[kept], hit[kept], at[kept]
        order = np.lexsort((places[hit], pair))
        pair, place, at = pair[order], places[hit][order], at[order]
        word, item = place // 2, pair % n
        reach = 3 * self.sizes[item]
        last = np.arange(len(pair)) + self.least[item] - 1
        full = last < len(pair)
        full[full] = (pair[last[full]] == pair[full]) & (word[last[full]] <= word[full] + reach[full])
        edges = np.flatnonzero(np.append(True, np.diff(pair) != 0))
        for a, b in zip(edges, np.append(edges[1:], len(pair)), strict=True):
            if not full[a:b].any():
                continue
            i, text = int(item[a]), int(pair[a] // n)
            own, span = word[a:b], 3 * int(self.sizes[i])
            dense = np.flatnonzero(full[a:b])
            inside = np.zeros(len(own) + 1, np.int64)
            np.add.at(inside, dense, 1)
            np.add.at(inside, np.searchsorted(own, own[dense] + span, "right"), -1)
            chosen = np.flatnonzero(np.cumsum(inside)[:-1] > 0)
            best = (0, 0)
            for part in np.split(chosen, np.flatnonzero(np.diff(own[chosen]) > 2 * span) + 1):
                # No copy uses a seed more often than the item has it.
                cell, times = np.unique(at[a + part], return_counts=True)
                if np.minimum(times, self.times[cell]).sum() < self.least[i]:
                    continue
                low, high = max(begins[text], own[part[0]] - span), min(begins[text + 1], own[part[-1]] + span)
                score, end = align(self.words[i], hashes[low:high])
                if score > best[0]:
                    best = (score, int(low - begins[text]) + end)
            if best[0]:
                yield text, i, best[0] / (MATCH * len(self.words[i])), best[1]


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for first, _, data, offsets in words.slices(batch.column("text")):
            yield batch, first, *words.word_hashes(data, offsets, words.LETTERS)


def _counts(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = sent.value
        total = np.zeros(len(items.seeds), np.int64)
        for _, _, hashes, begins in _texts(batches):
            total += np.bincount(items.hits(hashes, begins)[0], minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["seed", "n"])

    return run


def _copies(sent, score: float):
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = sent.value
        for batch, first, hashes, begins in _texts(batches):
            found = [(first + t, items.ids[i], s, e) for t, i, s, e in items.copies(hashes, begins) if s >= score]
            if found:
                at = pa.array([f[0] for f in found], pa.int64())
                columns = [batch.column("doc_id").take(at), batch.column("key").take(at), *(pa.array([f[j] for f in found], kinds[j + 1]) for j in (1, 2, 3))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "key", "item_id", "score", "ends_at"])

    return run


def leaks(docs: DataFrame, benchmark: DataFrame, score: float = SCORE) -> DataFrame:
    """``doc_id, key, item_id, score, ends_at``: each row of ``docs (doc_id, text)`` and item of ``benchmark (item_id, text)`` that it leaks.

    Words are runs of letters and digits in lower case. The seeds of an item are its pairs of words that are neighbours or
    have one word between (a single word: itself). An alignment of score ``score`` has at least ``score * words - 1`` steps from match to match
    with at most one edit, as a longer step costs what a match gains; each such step is a seed of both. So a text with fewer seeds of an item
    inside the words that an alignment may span is not aligned, and no copy of three words or more is lost; and as it must hold one of all but
    the commonest seeds of the item, only those rare ones, by their counts in all texts, make candidates. Around its seeds the text is
    aligned by Smith-Waterman over words (items of two words need a pair too); the score over that of a whole copy is
    ``score``, from 0 to 1, and ``ends_at`` is the word after the alignment; ``key`` is the text's hash. Rows below the least score are left out.

    Items are sent to all tasks, ``BLOCK_WORDS`` words of them at a time; each block reads the texts twice, once to count its seeds.
    Seeds are counted and texts aligned where they are read: nothing but results leaves a task. Null and empty texts and items without
    words leak nothing; of repeated rows each has its rows; items that repeat an id are one item with several texts, each with rows of its own.
    Other columns are ignored.
    """
    spark = docs.sparkSession
    checkpoint_root(spark)
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("key"), F.col("text").cast("string").alias("text")
    )
    items = (
        benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text IS NOT NULL").distinct()
    )
    total = items.agg(F.sum(F.length("text") / 4 + 1)).first()[0] or 0  # words, or more
    blocks = max(1, int(-(-total // BLOCK_WORDS)))
    parts = []
    for number in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == number).orderBy("item_id", "text").collect() if total else []
        block = Items([r.item_id for r in rows], [r.text for r in rows], score)
        if not len(block.seeds):
            continue
        counted = texts.mapInArrow(_counts(spark.sparkContext.broadcast(block)), "seed long, n long").groupBy("seed").agg(F.sum("n").alias("n"))
        corpus = np.zeros(len(block.seeds), np.int64)
        for r in counted.collect():  # at most a row for each seed of the block
            corpus[r.seed] = r.n
        block.choose(corpus)
        schema = "doc_id long, key long, item_id long, score double, ends_at long"
        parts.append(texts.mapInArrow(_copies(spark.sparkContext.broadcast(block), score), schema))
    if not parts:
        return spark.createDataFrame([], "doc_id long, key long, item_id long, score double, ends_at long")
    return reduce(DataFrame.unionByName, parts)


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that leak no item, with all their columns."""
    found = leaks(docs, benchmark).select("doc_id", "key").distinct().checkpoint()
    return only_texts(docs, found, "left_anti")
