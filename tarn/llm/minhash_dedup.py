"""Near duplicates by min-max hashing: of every permutation both the least and the greatest value are kept.

A permutation of the 64-bit numbers (an odd multiple plus a number) is evaluated once for each shingle and gives two places of the
signature, so half as many evaluations make a signature of a given length; a text's least and greatest values are almost
independent, and their share of agreement is an unbiased estimate of the similarity. Bands of places make candidates; links are confirmed on whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.llm import words
from tarn.llm.common import FEW_IDS, only_texts
from tarn.llm.components import components
from tarn.llm.groups import dense_links, links_of
from tarn.llm.jaccard_join import set_digest
from tarn.session import checkpoint_root

# Words of a shingle, and the similarity that links, in hundredths.
WORDS, PERCENT = 3, 85
# Bands, and permutations of a band: it holds twice as many values. Two sets of similarity 0.85 share no band
# with a chance of (1 - 0.85^6)^32, about 3 in 10 million.
BANDS, PERMUTATIONS = 32, 3
# Shingles that are hashed at a time, so that they stay in the cache.
STRIP = 1 << 15
# Buckets of more sets than this are compared in blocks instead of by pairs.
SMALL = 32

_FACTORS = words.mix(np.arange(7_000, 7_000 + BANDS * PERMUTATIONS, dtype=np.uint64)) | np.uint64(1)
_TERMS = words.mix(np.arange(9_000, 9_000 + BANDS * PERMUTATIONS, dtype=np.uint64))


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Least and greatest value under each permutation, by permutation, side and set; sets are not empty."""
    sizes = np.array([len(s) for s in sets], np.int64)
    out = np.empty((len(_FACTORS), 2, len(sets)), np.uint64)
    first = 0
    while first < len(sets):
        end = first + max(1, int(np.searchsorted(np.cumsum(sizes[first:]), STRIP, "right")))
        values = np.concatenate(sets[first:end])
        starts = np.cumsum(sizes[first:end]) - sizes[first:end]
        moved = np.empty_like(values)
        for i, (factor, term) in enumerate(zip(_FACTORS, _TERMS, strict=True)):
            np.multiply(values, factor, out=moved)
            moved += term
            out[i, 0, first:end] = np.minimum.reduceat(moved, starts)
            out[i, 1, first:end] = np.maximum.reduceat(moved, starts)
        first = end
    return out


def bands(signature: np.ndarray) -> np.ndarray:
    """A number for each set and band, which depends on the band and on all its places."""
    places = signature.reshape(BANDS, -1, signature.shape[2])
    total = np.zeros((BANDS, signature.shape[2]), np.uint64)
    for i in range(places.shape[1]):
        total = words.mix(total + words.mix(places[:, i] + np.uint64(i + 1)) * np.uint64(2 * i + 3))
    return words.mix(total ^ words.mix(np.arange(BANDS, dtype=np.uint64))[:, None]).T


def _scan(size: int):
    """Arrow function: size, digest and bands of each text's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in words.slices(batch.column("text")):
                sets = words.shingle_sets(data, offsets, size)
                ns = np.array([len(s) for s in sets], np.int64)
                full = [s for s in sets if len(s)]
                digests = [set_digest(s) if len(s) else (None, None) for s in sets]
                found = bands(signatures(full)).view(np.int64) if full else np.zeros((0, BANDS), np.int64)
                ends = np.concatenate(([0], np.cumsum(np.where(ns > 0, BANDS, 0)))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(first, end - first), batch.column("key").slice(first, end - first), pa.array(ns),
                        pa.array([d[0] for d in digests], pa.int64()), pa.array([d[1] for d in digests], pa.int64()),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(found.ravel())),
                    ],
                    names=["doc_id", "key", "n", "c1", "c2", "bands"],
                )

    return run


def _whole(size: int):
    """Arrow function: the whole sets of the texts that are asked for, with the hubs they are to be compared with."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in words.slices(batch.column("text")):
                sets = words.shingle_sets(data, offsets, size)
                digests = [set_digest(s) for s in sets]
                own = batch.slice(first, end - first)
                same = pa.array([(a, b) == d for a, b, d in zip(own.column("c1").to_pylist(), own.column("c2").to_pylist(), digests, strict=True)], pa.bool_())
                ends = np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int32)
                tokens = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets).view(np.int64)))
                yield pa.RecordBatch.from_arrays([own.column("set"), own.column("hubs"), tokens], names=["set", "hubs", "tokens"]).filter(same)

    return run


def _with_sets(texts: DataFrame, asked: DataFrame, classes: DataFrame, size: int) -> DataFrame:
    """``set, hubs, tokens`` of the sets of ``asked (set, hubs)``, read from the texts again.

    A short list of asked sets, by the number of its hubs, is broadcast; a long one is joined by shuffle.
    """
    jobs = asked.join(classes.select("set", "doc_id", "key", "c1", "c2"), "set").checkpoint()
    few = (jobs.agg(F.sum(F.size("hubs"))).first()[0] or 0) <= FEW_IDS
    left, right = texts.alias("t"), (F.broadcast(jobs) if few else jobs).alias("j")
    same = F.col("t.doc_id").eqNullSafe(F.col("j.doc_id")) & (F.col("t.key") == F.col("j.key"))
    joined = left.join(right, same).select("t.text", "j.set", "j.hubs", "j.c1", "j.c2")
    return joined.mapInArrow(_whole(size), "set long, hubs array<long>, tokens array<long>")


def _confirmed(pairs: DataFrame, texts: DataFrame, classes: DataFrame, size: int, percent: int) -> DataFrame:
    """The ``(a, b)`` of ``pairs`` whose whole sets link. Only b's set moves, to a's place, where a's set lies once."""
    hubs = pairs.select(F.col("a").alias("set"), F.col("a").alias("hub")).distinct()
    asked = hubs.unionByName(pairs.select(F.col("b").alias("set"), F.col("a").alias("hub"))).groupBy("set").agg(F.collect_list("hub").alias("hubs"))
    sets = _with_sets(texts, asked, classes, size).select("set", F.explode("hubs").alias("a"), "tokens").checkpoint()
    # Written down, so that the join deals both sides anew and a hub of many sets is split.
    own = sets.where("set = a").select("a", F.col("tokens").alias("left")).dropDuplicates(["a"]).checkpoint()
    members = sets.where("set <> a").select("a", F.col("set").alias("b"), F.col("tokens").alias("right"))
    return links_of(members.join(own, "a"), percent)


def link(docs: DataFrame, size: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``doc_id, key, n_shingles, component_id`` for every row of ``docs (doc_id, text)``.

    A text's set holds its distinct runs of ``size`` words (lower case, split at white space), the whole
    sequence if it is shorter; no words or no text give an empty set, linked with nothing. Two rows link when
    ``100 * intersection >= percent * union``; ``component_id`` is the smallest doc_id reachable by links, and
    ``key`` the hash of the text.

    1. Rows with equal sets (by 128 bits) go on as one. The bands of a set's signature are its buckets.
    2. Every set is confirmed against the least set that it shares a bucket with, which joins most of each group.
    3. Buckets whose sets are then still in different components are searched in full: the small ones by pairs of
       different components, larger ones in blocks (:func:`tarn.llm.groups.dense_links`). So every link of two sets that share a bucket counts,
       whatever the bucket's size; all confirmations are on whole sets.

    Rows that repeat an id are rows of their own, null ids form no component id (null, if all of a component are). An empty table
    gives no rows. Other columns are ignored.
    """
    checkpoint_root(docs.sparkSession)
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("key"), F.col("text").cast("string").alias("text")
    )
    found = (
        texts.mapInArrow(_scan(size), "doc_id long, key long, n long, c1 long, c2 long, bands array<long>")
        .withColumn("row", F.monotonically_increasing_id()).checkpoint()
    )
    rep = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("row"), F.col("key"))
    classes = (
        found.where("n > 0").groupBy("c1", "c2").agg(F.min(rep).alias("rep"), F.first("n").alias("n"))
        .select("c1", "c2", "n", F.col("rep.doc_id").alias("doc_id"), F.col("rep.key").alias("key"), F.col("rep.row").alias("set"))
        .checkpoint()
    )
    placed = (
        found.where("n > 0").select(F.col("row").alias("set"), "n", "bands").join(classes.select("set"), "set", "left_semi")
        .select("set", "n", F.explode("bands").alias("bucket"))
    )
    heads = placed.groupBy("bucket").agg(F.min("set").alias("hub"), F.count("*").alias("sets")).where("sets > 1").checkpoint()
    members = placed.join(heads, "bucket").select("bucket", "set", "n", "hub", "sets").checkpoint()
    nearest = members.where("set <> hub").groupBy(F.col("set").alias("b")).agg(F.min("hub").alias("a"))
    links = _confirmed(nearest, texts, classes, size, percent).checkpoint()
    # What is still apart within a bucket.
    named = members.join(components(links).withColumnRenamed("node", "set"), "set", "left").withColumn("component", F.coalesce("component", "set")).checkpoint()
    apart = named.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("bucket")
    rest = named.join(apart, "bucket", "left_semi").checkpoint()
    x, y = rest.where(F.col("sets") <= SMALL).alias("x"), rest.where(F.col("sets") <= SMALL).alias("y")
    may = (F.col("x.n") * 100 >= F.col("y.n") * percent) & (F.col("y.n") * 100 >= F.col("x.n") * percent)
    pairs = (
        x.join(y, (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.set") < F.col("y.set")) & (F.col("x.component") != F.col("y.component")) & may)
        .select(F.col("x.set").alias("a"), F.col("y.set").alias("b")).distinct()
        .join(nearest, ["a", "b"], "left_anti").checkpoint()
    )
    links = links.unionByName(_confirmed(pairs, texts, classes, size, percent))
    large = rest.where(F.col("sets") > SMALL).select(F.col("bucket").alias("token"), "set", "n")
    if large.limit(1).count():
        asked = large.select("set").distinct().withColumn("hubs", F.array("set"))
        sets = _with_sets(texts, asked, classes, size).select("set", F.size("tokens").cast("long").alias("n"), "tokens").dropDuplicates(["set"]).checkpoint()
        links = links.unionByName(dense_links(large, sets, percent))
    together = components(links.checkpoint()).withColumnRenamed("node", "set").checkpoint()
    within = classes.join(together, "set", "left").withColumn("component", F.coalesce("component", "set"))
    least = within.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    final = within.join(least, "component").select("c1", "c2", "component_id")
    return (
        found.select("doc_id", "key", "n", "c1", "c2").join(final, ["c1", "c2"], "left")
        .select("doc_id", "key", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
    )


def one_of_each(docs: DataFrame, size: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` whose doc_id is their component's, with all their columns; rows that repeat id and text all stay, as do rows without id in any of their component."""
    stays = link(docs, size, percent).where("doc_id <=> component_id").select("doc_id", "key").distinct().checkpoint()
    return only_texts(docs, stays)
