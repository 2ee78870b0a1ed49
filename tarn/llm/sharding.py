"""Shards of near equal size by sampled splitters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarn.llm.common import dealt, text_of, unit
from tarn.session import checkpoint_root

# Rows that one range is planned for, draws of the sample for each range, and how full a range may be
# against plan before it is divided again.
RANGE_ROWS = 250_000
DRAWS = 32
OVERFULL = 2
# A group of equal texts below this part of a shard is not cut by a shard's border.
WHOLE = 0.005


def _key(crc: Column, size: Column, doc_id: Column) -> Column:
    """Fixed-width text that sorts by checksum, size and id: equal texts are neighbours."""
    hexed = lambda value, width: F.lpad(F.hex(value), width, "0")
    return F.concat(hexed(crc, 8), hexed(size, 10), F.coalesce(hexed(doc_id, 16), F.lit("~")))


def _range_of(key: Column, splitters: list[str]) -> Column:
    """How many splitters are not above the key, by a coarse and a fine step."""
    if not splitters:
        return F.lit(0)
    step = max(1, int(len(splitters) ** 0.5))
    parts = [splitters[i : i + step] for i in range(0, len(splitters), step)]
    below = lambda values: F.size(F.filter(values, lambda s: s <= key))
    if len(parts) == 1:
        return below(F.lit(splitters))
    part = below(F.lit([p[0] for p in parts]))
    fine = F.array(*(F.lit(p) for p in parts))
    return F.when(part == 0, 0).otherwise((part - 1) * step + below(F.get(fine, part - 1)))


def _splitters(rows: DataFrame, pieces: Column, bytes_each: Column) -> list[str]:
    """Size-weighted draws in every ``range`` of ``rows``, cut at quantiles into ``pieces`` parts.

    A row is drawn as often as its size is worth in draws, the rest by a seeded number. Only borders leave
    the executors: as many as there will be ranges.
    """
    worth = F.col("size") * F.col("n") * DRAWS / bytes_each
    draws = F.floor(worth + unit(F.lit("draw"), F.col("key")))
    drawn = rows.withColumn("draws", draws).where("draws > 0")
    ordered = Window.partitionBy("range").orderBy("key")
    whole = Window.partitionBy("range")
    upto = F.sum("draws").over(ordered)
    cut = lambda total: F.floor(total * F.col("pieces") / F.col("all_draws"))
    placed = (
        drawn.withColumn("pieces", pieces)
        .withColumn("all_draws", F.sum("draws").over(whole))
        .withColumn("upto", upto)
        .where((cut(F.col("upto") - F.col("draws")) < cut(F.col("upto"))) & (F.col("upto") < F.col("all_draws")))
    )
    return [r.key for r in placed.select("key").distinct().collect()]


def _identity() -> dict[str, Column]:
    """What a row of documents is placed by."""
    size = (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long")
    return {"doc_id": F.col("doc_id").cast("long"), "size": size, "text_crc32": F.crc32(text_of()).cast("long")}


def shard(docs: DataFrame, shards: int = 16, range_rows: int = RANGE_ROWS) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` of every row of ``docs (doc_id, text)``.

    Size is the text's UTF-8 bytes plus one (a null text has none, and the checksum of an empty one). Rows
    are put in order by checksum, size and id, cut into ranges at quantiles of a size-weighted sample,
    and a range that turns out overfull is sampled and cut again. Inside its range a row gets the bytes
    and rows before it; with the totals of the ranges before (one short row per range) that is its place
    in the whole, and its shard is the one its middle byte falls in. So shards differ by about one row's
    size, and equal texts stay together, but for groups of more than ``WHOLE`` of a shard, which may be cut at a border. ``slot``
    counts the shard's rows from 0. Rows that repeat an id and a text are counted first and dealt apart;
    null ids come last in their group. An empty table gives no rows. Other columns are ignored.
    """
    checkpoint_root(docs.sparkSession)
    rows = docs.select(*(c.alias(name) for name, c in _identity().items())).withColumnRenamed("text_crc32", "crc")
    rows = (
        rows.groupBy("doc_id", "size", "crc").agg(F.count("*").alias("n"))
        .withColumn("key", _key(F.col("crc"), F.col("size"), F.col("doc_id")))
        .checkpoint()
    )
    total = rows.agg(F.count("*").alias("rows"), F.sum(F.col("size") * F.col("n")).alias("bytes")).first()
    all_bytes = total.bytes or 1
    planned = shards * max(1, -(-total.rows // (shards * range_rows)))
    each = all_bytes / planned
    splitters = sorted(_splitters(rows.withColumn("range", F.lit(0)), F.lit(planned), F.lit(each)))
    while True:
        ranged = rows.withColumn("range", _range_of(F.col("key"), splitters))
        full = F.greatest(
            F.sum(F.col("size") * F.col("n")) / F.lit(each), F.count("*") / F.lit(range_rows)
        )
        over = (
            ranged.groupBy("range")
            .agg(full.alias("full"), F.count("*").alias("rows"), F.sum(F.col("size") * F.col("n")).alias("bytes"))
            .where((F.col("full") > OVERFULL) & (F.col("rows") > 1))
        )
        inside = ranged.join(F.broadcast(over), "range")  # one row per range
        more = _splitters(inside, F.ceil("full"), F.col("bytes") / F.ceil("full"))
        fresh = set(more) - set(splitters)
        if not fresh:
            break
        splitters = sorted(set(splitters) | fresh)
    ordered = Window.partitionBy("range").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    before = lambda value: F.coalesce(F.sum(value).over(ordered), F.lit(0))
    inside = ranged.withColumns(
        {"bytes_before": before(F.col("size") * F.col("n")), "rows_before": before(F.col("n"))}
    )
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("range")
        .agg(F.sum(F.col("size") * F.col("n")).alias("b"), F.sum("n").alias("r"))
        .select(
            "range",
            F.coalesce(F.sum("b").over(earlier), F.lit(0)).alias("first_byte"),
            F.coalesce(F.sum("r").over(earlier), F.lit(0)).alias("first_row"),
        )
    )
    middle = (
        F.col("first_byte") + F.col("bytes_before") + F.col("copy") * F.col("size") + F.shiftright("size", 1)
    ).cast("decimal(38,0)")
    placed = (
        inside.join(F.broadcast(offsets), "range")
        .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
        .withColumn("shard", F.floor(middle * shards / F.lit(all_bytes).cast("decimal(38,0)")).cast("int"))
        .withColumn("place", F.col("first_row") + F.col("rows_before") + F.col("copy"))
        .select("doc_id", "size", "crc", "shard", "place")
        .checkpoint()
    )
    # Of the groups that a border cuts, one a border, the short ones go to the shard they begin in.
    cut = (
        placed.groupBy("crc", "size")
        .agg(F.min("shard").alias("begins"), F.max("shard").alias("ends"), F.sum("size").alias("bytes"))
        .where((F.col("begins") < F.col("ends")) & (F.col("bytes") <= F.lit(WHOLE * all_bytes / shards)))
        .select("crc", "size", "begins")
    )
    joined = placed.join(F.broadcast(cut), ["crc", "size"], "left").withColumn(
        "shard", F.coalesce("begins", "shard")
    )
    starts = joined.groupBy("shard").agg(F.min("place").alias("start"))  # one row per shard
    return joined.join(F.broadcast(starts), "shard").select(
        "doc_id", "size", F.col("crc").alias("text_crc32"), "shard", (F.col("place") - F.col("start")).alias("slot")
    )


def sharded(docs: DataFrame, shards: int = 16) -> DataFrame:
    """The rows of ``docs`` with ``shard`` and ``slot`` (which replace columns of these names)."""
    places = shard(docs, shards).withColumn("place", F.struct("shard", "slot"))
    rows = dealt(docs, _identity(), places, ["doc_id", "size", "text_crc32"], "place")
    names = [c for c in docs.columns if c not in ("shard", "slot")]
    return rows.select(*(f"row.`{c}`" for c in names), "place.shard", "place.slot")
