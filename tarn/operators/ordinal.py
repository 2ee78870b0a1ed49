"""Global row numbers and running totals without moving all rows to one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarn.operators.skew import join_facts
from tarn.session import checkpoint_root


def running_total(df: DataFrame, by: Sequence[str], weight: str, name: str) -> DataFrame:
    """Add ``name``: the sum of ``weight`` over all earlier rows in the order of ``by``.

    Rows are range partitioned by the key, and their partition number and local order are written down
    once (a checkpoint), so that both later passes see the same partitions. Each partition then needs
    only its own total; the totals, one row per partition, are added up and joined back.
    """
    checkpoint_root(df.sparkSession)
    placed = (
        df.repartitionByRange(*(F.col(c).asc_nulls_first() for c in by))
        .sortWithinPartitions(*(F.col(c).asc_nulls_first() for c in by))
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_place", F.monotonically_increasing_id())
        .checkpoint()
    )
    totals = placed.groupBy("_part").agg(F.sum(weight).alias("_total"))
    # One row per partition: a bounded table.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_part", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset")
    )
    inside = Window.partitionBy("_part").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    return (
        placed.withColumn("_inside", F.coalesce(F.sum(weight).over(inside), F.lit(0)))
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + F.col("_inside"))
        .drop("_part", "_place", "_inside", "_offset")
    )


def ordinal(
    df: DataFrame,
    by: Sequence[str],
    name: str = "ordinal",
    within: Sequence[str] = (),
    size: str | None = None,
) -> DataFrame:
    """Add the 1-based position of every row in the order of ``by``, globally or inside ``within``.

    Rows are range partitioned whole and written down once, so keys may repeat: rows of one key get
    neighbouring positions. A group may be of any size: its rows keep their share of the global
    order, and the group's first position is subtracted. ``size`` names a column for the group's rows.
    """
    keys = [*within, *by]
    checkpoint_root(df.sparkSession)
    placed = (
        df.repartitionByRange(*(F.col(c).asc_nulls_first() for c in keys))
        .sortWithinPartitions(*(F.col(c).asc_nulls_first() for c in keys))
        # (partition << 33) + place inside the partition
        .withColumn("_row", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_row", 33))
        .withColumn("_place", F.col("_row").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("_row")
        .checkpoint()
    )
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_size"))
    # One row per partition: a bounded table.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    numbered = (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + F.col("_place") + 1)
        .select(*df.columns, name)
    )
    if not within:
        return numbered
    facts = numbered.groupBy(*within).agg(F.min(name).alias("_first"), F.count("*").alias("_rows"))
    place = (F.col(name) - F.col("_first") + 1).alias(name)
    more = [F.col("_rows").alias(size)] if size else []
    return join_facts(numbered, facts, within).select(*df.columns, place, *more)
