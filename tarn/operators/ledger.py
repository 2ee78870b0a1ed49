"""Numbers that run on from batch to batch, kept with the keys that have them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarn.operators.ordinal import ordinal

_SCHEMA = "prefix string, key string, number long"


class NumberLedger:
    """A table of all keys ever numbered, per prefix. The highest number of a prefix is its high-water mark.

    Marks and rows are one table, so no commit can hold the one without the other. Numbers are never given again: a batch that stopped
    before its objects were stored finds its keys numbered when it is run again.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        spark.createDataFrame([], _SCHEMA).write.mode("ignore").parquet(path)

    def table(self, prefix: str) -> DataFrame:
        return self.spark.read.schema(_SCHEMA).parquet(self.path).filter(F.col("prefix") == prefix)

    def mark(self, prefix: str) -> int:
        """The highest number given so far, 0 if none."""
        return self.table(prefix).agg(F.max("number")).first()[0] or 0

    def extend(self, objects: DataFrame, prefix: str, key: str = "key") -> DataFrame:
        """``objects`` with ``id`` = prefix and number; keys that have no number get the next ones, in key order.

        New keys are range partitioned; each partition adds the rows of those before it and the mark to its own positions.
        A key that repeats has one number. Objects without key get no id. Filter unusable objects afterwards, so that they keep their number.
        """
        keys = objects.select(F.col(key).alias("_order"), F.col(key).cast("string").alias("key")).filter(F.col("key").isNotNull()).distinct()
        fresh = keys.join(self.table(prefix).select("key"), "key", "left_anti")
        placed = ordinal(fresh, ["_order"], "position")
        number = (F.col("position") + self.mark(prefix)).cast("long").alias("number")
        placed.select(F.lit(prefix).alias("prefix"), "key", number).write.mode("append").parquet(self.path)
        known = self.table(prefix).select(F.col("key").alias("_key"), F.concat(F.lit(prefix + "_"), "number").alias("id"))
        return objects.join(known, F.col(key).cast("string") == F.col("_key"), "left").drop("_key")
