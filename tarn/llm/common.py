"""What the operators share: tables, word rules, seeded numbers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# White space and words as the contracts write them.
SPACES = r"[\x20\x09-\x0D]+"
WORDS = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column), F.lit(""))


def unit(*parts: Column) -> Column:
    """A number in [0, 1) that depends on ``parts`` alone."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / F.lit(float(1 << 53))


# Rows of ids that may be broadcast: two numbers each.
FEW_IDS = 500_000


def only(rows: DataFrame, ids: DataFrame, on: list[str], how: str = "left_semi") -> DataFrame:
    """The rows of these ids (``left_anti``: the others), null being equal to null.

    A short list, by count, is broadcast; a long one is joined by shuffle.
    """
    left, right = rows.alias("l"), (F.broadcast(ids) if ids.count() <= FEW_IDS else ids).alias("r")
    same = F.lit(True)
    for name in on:
        same = same & F.col(f"l.{name}").eqNullSafe(F.col(f"r.{name}"))
    return left.join(right, same, how)


def only_texts(docs: DataFrame, ids: DataFrame, how: str = "left_semi") -> DataFrame:
    """The rows of ``docs`` whose id and text's hash are in ``ids (doc_id, key)``, with their own columns alone."""
    whole = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("key"))
    return only(whole, ids, ["doc_id", "key"], how).select("row.*")


def dealt(docs: DataFrame, extra: dict[str, Column], decisions: DataFrame, on: list[str], value: str) -> DataFrame:
    """``row`` (all of a row of ``docs``) and one of the ``value`` s that ``decisions`` hold for its key.

    ``on`` names columns of ``decisions``; ``extra`` gives them for ``docs``. Rows of one key get its values in turn, in
    the order of their texts' hashes.
    """
    values = decisions.groupBy(*on).agg(F.count("*").alias("n"), F.min(value).alias("least")).checkpoint()
    whole = docs.select(F.struct("*").alias("row"), *(c.alias(name) for name, c in extra.items()))
    same = lambda more: reduce(lambda s, name: s & F.col(f"d.{name}").eqNullSafe(F.col(f"k.{name}")), [*on, *more], F.lit(True))
    # Most keys are one row's alone.
    single = values.where("n = 1")
    out = whole.alias("d").join(single.alias("k"), same([])).select("d.row", F.col("k.least").alias(value))
    several = values.where("n > 1").select(*on)
    if not several.limit(1).count():
        return out
    rows = whole.alias("d").join(several.alias("k"), same([]), "left_semi")
    turns = rows.withColumn("turn", F.row_number().over(Window.partitionBy(*on).orderBy(F.xxhash64("row.text"))))
    dealt_out = decisions.withColumn("turn", F.row_number().over(Window.partitionBy(*on).orderBy(value)))
    more = turns.alias("d").join(dealt_out.select(*on, "turn", value).alias("k"), same(["turn"])).select("d.row", F.col(f"k.{value}").alias(value))
    return out.unionByName(more)
