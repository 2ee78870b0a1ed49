"""Profiles of batches that can be merged: quantiles, distinct counts and frequent values without a second reading."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Sizes of the sketches. They decide the errors below and must be the same in all batches that are merged.
QUANTILE_K = 800
DISTINCT_LOG2 = 14
TRACKED = 10_000

# A quantile's rank is off by at most 0.6 % of the rows (2.296 / k^0.9021 is 0.55 %), a distinct count by 3 % (three standard errors), each with a
# chance of at least 99 %. A frequent value's count is off by at most 3.5 / 16,384 of the rows, and by nothing
# while a column has fewer than TRACKED values.
RANK_ERROR = 0.006
DISTINCT_ERROR = 0.03


def batch_profile(
    df: DataFrame, by: Sequence[str] = (), numbers: Sequence[str] = (), labels: Sequence[str] = ()
) -> DataFrame:
    """One row for each batch (the values of ``by``) and column: exact counts and bounds, and three sketches.

    Columns: ``by``, ``column``, ``rows``, ``nulls``, ``nans``, ``least``, ``greatest``, ``total`` (of finite and infinite
    numbers; null for labels), ``quantiles``, ``distinct``, ``frequent``. One pass whose partial aggregates are short.
    Quantile sketches draw lots: what is used more than once is stored first, or it comes out differently each time.
    NaN counts as neither a value nor a null; -0.0 is 0.0. No rows and no ``by``: one row a column, of zeros and nulls.
    """
    cells = []
    for name in [*numbers, *labels]:
        value = F.col(f"`{name}`")
        if name in numbers:
            value = value.cast("double") + F.lit(0.0)
            number, nan = F.when(~F.isnan(value), value), F.isnan(value)
            hashed, text = number, "NULL"
        else:
            number, nan = F.lit(None).cast("double"), F.lit(False)
            hashed, text = value.cast("string"), f"`{name}`"
        cells.append(
            F.struct(
                F.lit(name).alias("column"),
                F.count(F.lit(1)).alias("rows"),
                F.count_if(value.isNull()).alias("nulls"),
                F.count_if(nan).alias("nans"),
                F.min(number).alias("least"),
                F.max(number).alias("greatest"),
                F.sum(number).alias("total"),
                F.kll_sketch_agg_double(number, F.lit(QUANTILE_K)).alias("quantiles"),
                F.hll_sketch_agg(F.when(hashed.isNotNull(), F.xxhash64(hashed)), F.lit(DISTINCT_LOG2)).alias("distinct"),
                # Without the filter a null would count as a value.
                F.expr(
                    f"approx_top_k_accumulate(CAST({text} AS STRING), {TRACKED}) FILTER (WHERE {text} IS NOT NULL)"
                ).alias("frequent"),
            )
        )
    return _inlined(df.groupBy(*by), by, cells)


def _inlined(grouped, by: Sequence[str], cells: list[Column]) -> DataFrame:
    """Aggregates side by side, then one row each."""
    wide = grouped.agg(*(cell.alias(f"_{i}") for i, cell in enumerate(cells)))
    return wide.select(*by, F.inline(F.array(*(F.col(f"_{i}") for i in range(len(cells))))))


def merged_profile(profiles: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row for each column (and value of ``by``) from the rows of many batches; no batch is read again."""
    return profiles.groupBy(*by, "column").agg(
        *(F.sum(name).alias(name) for name in ("rows", "nulls", "nans")),
        F.min("least").alias("least"),
        F.max("greatest").alias("greatest"),
        F.sum("total").alias("total"),
        F.kll_merge_agg_double("quantiles", F.lit(QUANTILE_K)).alias("quantiles"),
        F.hll_union_agg("distinct").alias("distinct"),
        F.call_function("approx_top_k_combine", F.col("frequent"), F.lit(TRACKED)).alias("frequent"),
    )


def profile_report(profiles: DataFrame, levels: Sequence[float] = (0.25, 0.5, 0.75), top: int = 10) -> DataFrame:
    """Readable form: ``mean``, ``n_distinct``, ``quantiles`` (a value a level) and ``top`` (item and count; ties by item).

    ``quantiles`` and ``mean`` are null and ``top`` is empty where a column has no such values.
    """
    sketch = F.col("quantiles")
    filled = F.kll_sketch_get_n_double(sketch) > 0
    wanted = F.array(*(F.lit(float(level)) for level in levels))
    n = F.col("rows") - F.col("nulls") - F.col("nans")
    rest = [c for c in profiles.columns if c not in ("quantiles", "distinct", "frequent", "total")]
    found = F.call_function("approx_top_k_estimate", F.col("frequent"), F.lit(int(top)))
    by_count = lambda a, b: (
        F.when(a["count"] > b["count"], -1)
        .when(a["count"] < b["count"], 1)
        .when(a["item"] < b["item"], -1)
        .when(a["item"] > b["item"], 1)
        .otherwise(0)
    )
    return profiles.select(
        *rest,
        (F.col("total") / F.nullif(n, F.lit(0))).alias("mean"),
        F.hll_sketch_estimate("distinct").alias("n_distinct"),
        F.when(filled, F.kll_sketch_get_quantile_double(F.when(filled, sketch), wanted)).alias("quantiles"),
        F.array_sort(found, by_count).alias("top"),
    )


def store_profile(profile: DataFrame, path: str, batch: int | str) -> None:
    """Write one batch's rows to its own folder of the table at ``path``; a batch that is run again replaces itself."""
    profile.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch}")


def stored_profiles(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all batches stored, with their ``batch``."""
    return spark.read.parquet(path)


def quantile_ranks(df: DataFrame, report: DataFrame, numbers: Sequence[str]) -> DataFrame:
    """The exact path beside the sketches: ``(column, place, below, upto, n)`` for each quantile of a report.

    Counts the rows whose value is less than the reported one, and those that are not greater, in one pass.
    """
    values = report.filter(F.col("column").isin(*numbers)).select(
        "column", F.posexplode("quantiles").alias("place", "reported")
    )
    cells = F.array(*(F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("double").alias("value")) for c in numbers))
    exact = df.select(F.inline(cells)).filter(F.col("value").isNotNull() & ~F.isnan("value"))
    # A report has a row for each column, so one short list a column is sent to every task.
    joined = exact.join(F.broadcast(values), "column")
    return joined.groupBy("column", "place").agg(
        F.count_if(F.col("value") < F.col("reported")).alias("below"),
        F.count_if(F.col("value") <= F.col("reported")).alias("upto"),
        F.count(F.lit(1)).alias("n"),
    )
