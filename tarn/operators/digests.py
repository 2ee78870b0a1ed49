"""Zones compared by a tree of digests: only parts whose digests differ are shuffled."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarn.session import checkpoint_root

# A leaf is 16 bits of the key's hash, a branch the upper 8 of them: whatever the zone's size, its tree has at most
# 65,536 short rows, which bounds what is broadcast below.
LEAF_BITS = 16
BRANCH_BITS = 8
SUMS = ("n", "high", "low")


def leaf_of(key: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(key), 64 - LEAF_BITS).cast("int")


def zone_digests(objects: DataFrame, marks: Sequence[str] = ("size",)) -> DataFrame:
    """``(branch, leaf, n, high, low)``: rows of each leaf, and the sums of both halves of their hashes.

    A row's hash is over its key and ``marks``. Sums do not depend on the order, and repeated rows count.
    """
    row = F.xxhash64("key", *(F.struct(F.isnull(mark), F.col(mark)) for mark in marks))
    leaf = leaf_of(F.col("key"))
    return (
        objects.select(leaf.alias("leaf"), row.alias("_row"))
        .groupBy("leaf")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.shiftrightunsigned("_row", 32)).alias("high"),
            F.sum(F.col("_row").bitwiseAND(F.lit(0xFFFFFFFF))).alias("low"),
        )
        .select(F.shiftright("leaf", LEAF_BITS - BRANCH_BITS).alias("branch"), "leaf", *SUMS)
    )


def updated_digests(digests: DataFrame, added: DataFrame, removed: DataFrame | None = None) -> DataFrame:
    """Stored digests after a batch, from the digests of what came and what went; the zone is not read."""
    parts = digests.unionByName(added)
    if removed is not None:
        parts = parts.unionByName(removed.select("branch", "leaf", *(-F.col(name) for name in SUMS)).toDF(*digests.columns))
    summed = parts.groupBy("branch", "leaf").agg(*(F.sum(name).alias(name) for name in SUMS))
    return summed.filter(" OR ".join(f"{name} <> 0" for name in SUMS))


def _unequal(source: DataFrame, dest: DataFrame, level: str) -> DataFrame:
    """Branches or leaves whose sums differ; one row for each that either side has goes in."""
    sides = source.select(level, *SUMS).unionByName(dest.select(level, *(-F.col(name) for name in SUMS)).toDF(level, *SUMS))
    summed = sides.groupBy(level).agg(*(F.sum(name).alias(name) for name in SUMS))
    return summed.filter(" OR ".join(f"{name} <> 0" for name in SUMS)).select(level)


def unequal_leaves(source: DataFrame, dest: DataFrame) -> DataFrame:
    """Leaves that differ, looked for only in branches that differ."""
    branches = F.broadcast(_unequal(source, dest, "branch"))
    return _unequal(source.join(branches, "branch", "left_semi"), dest.join(branches, "branch", "left_semi"), "leaf")


def open_rows(objects: DataFrame, leaves: DataFrame) -> DataFrame:
    """The objects in the given leaves. Leaves are at most 2^16 numbers, so they are sent to every task."""
    marked = objects.withColumn("_leaf", leaf_of(F.col("key")))
    return marked.join(F.broadcast(leaves.withColumnRenamed("leaf", "_leaf")), "_leaf", "left_semi").drop("_leaf")


def reconcile_tree(
    source: DataFrame,
    dest: DataFrame,
    marks: Sequence[str] = ("size",),
    source_digests: DataFrame | None = None,
    dest_digests: DataFrame | None = None,
    settled: bool = True,
) -> DataFrame:
    """Per key: ``ok``, ``changed`` (other ``marks``), ``missing`` from the destination or ``extra`` there.

    Digests that are not given are counted, in one pass over their zone without a shuffle of its rows. Keys in equal leaves are ``ok``
    and are read off the source where they lie, or left out without ``settled``; the others meet by key.
    Keys are unique in a zone, as in a bucket; a key that a zone repeats is one row in an open leaf, and ``changed`` compares
    its greatest marks. Null marks equal null marks.
    """
    checkpoint_root(source.sparkSession)
    # Digests that are counted here are read three times, so they are written down.
    known_source = zone_digests(source, marks).checkpoint() if source_digests is None else source_digests
    known_dest = zone_digests(dest, marks).checkpoint() if dest_digests is None else dest_digests
    leaves = unequal_leaves(known_source, known_dest).checkpoint()

    def side(objects: DataFrame, is_source: bool) -> DataFrame:
        shown = F.struct(F.lit(True).alias("_there"), *(F.col(mark) for mark in marks))
        return open_rows(objects, leaves).select(
            "key",
            (shown if is_source else F.lit(None)).alias("here"),
            (F.lit(None) if is_source else shown).alias("there"),
        )

    met = side(source, True).unionByName(side(dest, False)).groupBy("key").agg(
        F.max("here").alias("here"), F.max("there").alias("there")
    )
    status = (
        F.when(F.col("there").isNull(), "missing")
        .when(F.col("here").isNull(), "extra")
        .when(F.col("here").eqNullSafe(F.col("there")), "ok")
        .otherwise("changed")
    )
    result = met.select("key", status.alias("status"))
    if not settled:
        return result.filter("status <> 'ok'")
    equal = source.withColumn("_leaf", leaf_of(F.col("key"))).join(
        F.broadcast(leaves.withColumnRenamed("leaf", "_leaf")), "_leaf", "left_anti"
    )
    return result.unionByName(equal.select("key", F.lit("ok").alias("status")))
