"""Near duplicates by word shingles: an exact Jaccard join with adaptive multi-match prefixes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarn.llm import words
from tarn.llm.common import only, only_texts
from tarn.llm.components import components
from tarn.llm.groups import dense_links, linked
from tarn.session import checkpoint_root

# Words of a shingle, and the similarity that links, in hundredths.
WORDS, PERCENT = 5, 80
# A token that more texts have in their prefixes than this makes no pairs.
HOT = 32
# What checking a pair costs, in pairs made.
CHECK = 8.0


def _least(n, percent: int):
    """The least number of shingles that a text of ``n`` shares with any text it is linked to."""
    return -(-n * percent // 100)


def _base(n, percent: int):
    """Length of the shortest prefix that must meet the prefix of any linked text."""
    return n - _least(n, percent) + 1


def _room(n):
    """Tokens that a prefix may be lengthened by. It does not fall with n."""
    return 2 + n // 20


def set_digest(tokens: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, as two signed numbers."""
    with np.errstate(over="ignore"):
        one = words.mix(tokens ^ np.uint64(0x5851F42D4C957F2D)).sum() + np.uint64(len(tokens))
        two = words.mix(tokens + np.uint64(0x14057B7EF767814F)).sum() ^ np.uint64(len(tokens))
    return int(np.int64(one)), int(np.int64(two))


def _sets(size: int, percent: int, whole: bool):
    """Arrow function from ``doc_id, key, text`` to sets: prefixes only, or whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in words.slices(batch.column("text")):
                sets = words.shingle_sets(data, offsets, size)
                digests = [set_digest(s) if len(s) else (None, None) for s in sets]
                ns = np.array([len(s) for s in sets], np.int64)
                kept = sets if whole else [s[: _base(len(s), percent) + _room(len(s))] if len(s) else s for s in sets]
                values = np.concatenate(kept).view(np.int64) if kept else np.zeros(0, np.int64)
                ends = np.concatenate(([0], np.cumsum([len(s) for s in kept]))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(first, end - first),
                        batch.column("key").slice(first, end - first),
                        pa.array(ns),
                        pa.array([d[0] for d in digests], pa.int64()),
                        pa.array([d[1] for d in digests], pa.int64()),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(values)),
                    ],
                    names=["doc_id", "key", "n", "c1", "c2", "tokens"],
                )

    return run


_SETS = "doc_id long, key long, n long, c1 long, c2 long, tokens array<long>"


def _choose(tokens: Column, n: Column, percent: int) -> Column:
    """The level and the cold matches a text asks for: ``struct(level, need)``, null where all is hot.

    ``tokens`` are the text's shared prefix tokens as ``(level, df)``. At level l a linked text has l tokens
    of this prefix or more, and at most as many of them as are hot do not count. The level may not pass the
    shortest room that a linked text can have. The cost is what the cold tokens' lists hold, and that part of it
    which is left to check when several matches are asked for.
    """
    highest = (F.lit(1) + 2 + F.floor(F.ceil(n * percent / 100) / 20)).cast("int")

    def at(level: Column) -> Column:
        hot = F.size(F.filter(tokens, lambda t: (t["level"] <= level) & (t["df"] > HOT)))
        lists = F.aggregate(
            tokens, F.lit(0.0),
            lambda s, t: s + F.when((t["level"] <= level) & (t["df"] <= HOT), t["df"].cast("double")).otherwise(0.0),
        )
        need = level - hot
        return F.struct(
            (need < 1).alias("no"), (lists + CHECK * lists / F.greatest(need, F.lit(1))).alias("cost"), level.alias("level"), need.alias("need")
        )

    # Tokens only enter at some levels; besides these, the first and the highest are enough to try.
    steps = F.array_distinct(
        F.concat(
            F.array(F.lit(1), highest),
            F.transform(F.sequence(F.lit(1), F.lit(8)), lambda i: F.greatest(F.lit(1), F.floor(highest * i / 8).cast("int"))),
        )
    )
    best = F.array_min(F.transform(steps, at))
    return F.when(best["no"], None).otherwise(F.struct(best["level"].alias("level"), best["need"].alias("need")))


def link(docs: DataFrame, size: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``doc_id, key, n_shingles, component_id`` for every row of ``docs (doc_id, text)``.

    A text's set holds its distinct runs of ``size`` words (lower case, split at white space), the whole
    sequence if it is shorter; no words or no text give an empty set, linked with nothing. Two rows link when
    ``100 * intersection >= percent * union``; ``component_id`` is the smallest doc_id reachable by links,
    and ``key`` the hash of the text.

    1. Sets are put in the order of their shingles' hashes. Only the first ``n - least + 1 + room`` tokens, the
       prefix, leave the task, with a digest of the set; rows with equal sets go on as one.
    2. Tokens are counted, and only shared ones go on. For every set the prefix is lengthened by the level that
       costs least by the estimate, and asks for as many more matches: at level l a linked set has l of the prefix's
       tokens or more, so beyond the hot ones (over ``HOT`` sets) a number of cold ones remains. Cold tokens make pairs, which
       must have that many matches and enough of the longest common prefix for the overlap that the pair needs.
    3. Pairs are checked on the whole sets.
    4. Sets whose prefixes are so hot that no level leaves a cold token are linked by :func:`tarn.llm.groups.dense_links`.

    No pair is lost: step 2 bounds hold for any order and any choice of levels. Rows that repeat an id are rows of
    their own, null ids form no component id (null, if all of a component are). An empty table gives no rows. Other columns are ignored.
    """
    checkpoint_root(docs.sparkSession)
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("key"), F.col("text").cast("string").alias("text")
    )
    found = texts.mapInArrow(_sets(size, percent, False), _SETS).withColumn("row", F.monotonically_increasing_id()).checkpoint()
    # One row per different set.
    classes = (
        found.where("n > 0").groupBy("c1", "c2")
        .agg(F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("row"), F.col("key"))).alias("rep"), F.first("n").alias("n"))
        .select("c1", "c2", "n", F.col("rep.doc_id").alias("doc_id"), F.col("rep.key").alias("key"), F.col("rep.row").alias("set"))
        .checkpoint()
    )
    others = found.where("n > 0").select("row").join(classes.select(F.col("set").alias("row")), "row", "left_anti").checkpoint()
    own = only(found.where("n > 0").select("row", "n", "tokens"), others, ["row"], "left_anti")
    # Level 1 is the base prefix, each further token is a level of its own.
    least = F.ceil(F.col("n") * percent / 100).cast("int")
    base = (F.col("n") - least + 1).cast("int")
    placed = own.select(
        F.col("row").alias("set"), F.col("n").cast("int").alias("n"), F.posexplode("tokens").alias("at", "token")
    ).withColumn("level", F.greatest(F.lit(1), F.col("at") - base + 2))
    counts = placed.groupBy("token").agg(F.count("*").cast("int").alias("df")).where("df > 1")
    shared = placed.join(counts, "token").select("token", "set", "n", "at", "level", "df").checkpoint()
    listed = shared.groupBy("set", "n").agg(F.collect_list(F.struct("level", "df")).alias("list"))
    chosen = listed.select(
        "set", _choose(F.col("list"), F.col("n"), percent).alias("ask"),
        F.size(F.filter("list", lambda t: t["df"] > HOT)).alias("hot"),
    ).select("set", "hot", "ask.level", "ask.need").withColumnRenamed("level", "upto").checkpoint()
    # A set that is all hot keeps its whole prefix, and one match will do for it.
    top = 3 + F.floor(F.col("n") / 20)
    asked = shared.where(F.col("df") <= HOT).join(chosen, "set").select(
        "token", "set", "n", "at", "hot", F.coalesce("upto", top).cast("int").alias("upto"), F.coalesce("need", F.lit(1)).alias("need"), "level",
    ).where("level <= upto")
    x, y = asked.alias("x"), asked.alias("y")
    size_ok = (F.col("x.n") * 100 >= F.col("y.n") * percent) & (F.col("y.n") * 100 >= F.col("x.n") * percent)
    met = x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.set") < F.col("y.set")) & size_ok)
    facts = ["n", "hot", "upto", "need"]
    pairs = met.groupBy(
        F.col("x.set").alias("a"), F.col("y.set").alias("b"),
        *(F.col(f"{s}.{c}").alias(f"{s}_{c}") for s in ("x", "y") for c in facts),
    ).agg(F.count("*").alias("met"), F.max("x.at").alias("x_at"), F.max("y.at").alias("y_at"))
    ask = F.when(F.col("x_upto") < F.col("y_upto"), F.col("x_need")).when(
        F.col("y_upto") < F.col("x_upto"), F.col("y_need")
    ).otherwise(F.greatest("x_need", "y_need"))
    # Up to its last cold match a prefix holds at + 1 tokens; those not shared are missing from the overlap.
    overlap = F.ceil((F.col("x_n") + F.col("y_n")) * percent / (100 + percent))
    could = lambda s: F.col(f"{s}_n") - (F.col(f"{s}_at") + 1) + F.col("met") + F.least("x_hot", "y_hot")
    pairs = (
        pairs.where((F.col("met") >= ask) & (F.least(could("x"), could("y")) >= overlap))
        .select("a", "b").checkpoint()
    )
    dense = shared.where((F.col("df") > HOT) & (F.col("level") == 1)).join(chosen.where("need IS NULL"), "set", "left_semi").select("token", "set", "n").checkpoint()
    wanted = pairs.select(F.col("a").alias("set")).union(pairs.select("b")).union(dense.select("set")).distinct().join(
        classes.select("set", "doc_id", "key", "c1", "c2"), "set"
    ).checkpoint()
    again = only(texts, wanted.select("doc_id", "key").distinct(), ["doc_id", "key"]).mapInArrow(_sets(size, percent, True), _SETS)
    sets = (
        again.join(wanted.select("set", "c1", "c2"), ["c1", "c2"]).select("set", "n", "tokens")
        .dropDuplicates(["set"]).checkpoint()
    )
    links = linked(pairs, sets, percent)
    if dense.limit(1).count():
        links = links.unionByName(dense_links(dense, sets, percent))
    together = components(links.checkpoint()).withColumnRenamed("node", "set").checkpoint()
    within = classes.join(together, "set", "left").withColumn("component", F.coalesce("component", "set"))
    heads = within.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = within.join(heads, "component").select("c1", "c2", "component_id")
    return (
        found.select("doc_id", "key", "n", "c1", "c2").join(named, ["c1", "c2"], "left")
        .select("doc_id", "key", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
    )


def one_of_each(docs: DataFrame, size: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The row with the smallest doc_id of each group of linked rows, with all its columns.

    Rows without words are groups of their own. Of rows that repeat the id, the one whose text has the least hash stays,
    and one row of those that repeat the text too. Rows that have no id, where none of their group has, all stay.
    """
    stays = link(docs, size, percent).where("doc_id <=> component_id")
    ids = stays.groupBy("doc_id").agg(F.min("key").alias("key"), F.count("*").alias("n"))
    ids = ids.where("doc_id IS NOT NULL").unionByName(
        stays.where("doc_id IS NULL").groupBy("doc_id", "key").agg(F.lit(1).cast("long").alias("n"))
    ).checkpoint()
    kept = only_texts(docs, ids.select("doc_id", "key"))
    if not ids.where("n > 1").limit(1).count():
        return kept
    return kept.where("doc_id IS NULL").unionByName(kept.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]))
