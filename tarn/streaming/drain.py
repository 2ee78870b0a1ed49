"""The staging drain as a stream: every arriving file is promoted once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tarn.operators.landing import drop_placeholders, list_objects, promote_landing
from tarn.sources.tables import content_type_of, relative


def object_stream(
    spark: SparkSession, root: str, schema: T.StructType | str, pattern: str | None = None
) -> DataFrame:
    """Object rows arriving as parquet files below ``root``, or as the files and folders of files that ``pattern`` names there."""
    # In braces a plain name is a pattern too: Spark takes a path without one for a folder, and a table may be one file.
    path = f"{root.rstrip('/')}/{{{pattern}}}" if pattern else root
    return spark.readStream.schema(schema).parquet(path)


def file_stream(spark: SparkSession, root: str, bucket: str = "landing-zone") -> DataFrame:
    """Files arriving below ``root`` as objects with their bodies; the key is the path below it."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    files = (
        spark.readStream.format("binaryFile")
        .schema(schema)
        .option("recursiveFileLookup", "true")
        .load(root)
    )
    return files.select(
        F.lit(bucket).alias("bucket"),
        F.concat(F.lit("temporal-landing/"), relative(F.col("path"), root)).alias("key"),
        F.col("length").alias("size"),
        content_type_of(F.col("path")).alias("content_type"),
        "content",
    )


def promote_landing_stream(
    objects: DataFrame, dest: str, checkpoint: str, ts_ms: int, prefix: str = "temporal-landing/"
) -> StreamingQuery:
    """Promote everything that has arrived and stop.

    Each micro-batch owns one folder and writes it whole, so a repeated batch replaces its own output.
    Batch n is stamped ``ts_ms + n``, which keeps names of different batches apart.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        moved = promote_landing(batch, ts_ms + batch_id, prefix)
        moved.write.mode("overwrite").partitionBy("category").parquet(f"{dest}/batch={batch_id}")

    return (
        objects.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def content_identity() -> Column:
    """Type and digest of an object's ``content``; an object without content is known by its bucket and key."""
    return F.coalesce(
        F.concat(F.coalesce("content_type", F.lit("")), F.lit(":"), F.sha2("content", 256)),
        F.concat(F.coalesce("bucket", F.lit("")), F.lit("/"), F.col("key")),
    )


def first_arrivals(objects: DataFrame, identity: Column, expiry: str = "30 days", salts: int = 32) -> DataFrame:
    """Of all arriving rows with one identity the first, remembered for ``expiry`` after it arrived.

    The clock of the state is the arrival, so no row is ever late, whatever its own times say. Rows of one identity in
    one batch are cut down in ``salts`` parts first: an identity that a third of the rows share is no single task's work.
    Which of several rows of one batch stays is open. Rows whose identity is null all stay, with their key as identity.
    """
    known = (
        objects.withColumn("_identity", F.coalesce(identity, F.concat(F.lit("key "), F.col("key"))))
        .withColumn("_salt", F.pmod(F.xxhash64("key"), F.lit(salts)))
        .withColumn("_arrived", F.current_timestamp())
        .withWatermark("_arrived", expiry)
    )
    fewer = known.dropDuplicatesWithinWatermark(["_identity", "_salt"])
    return fewer.dropDuplicatesWithinWatermark(["_identity"]).drop("_identity", "_salt", "_arrived")


def promote_once_stream(
    objects: DataFrame,
    dest: str,
    checkpoint: str,
    ts_ms: int,
    prefix: str = "temporal-landing/",
    identity: Column | None = None,
    expiry: str = "30 days",
) -> StreamingQuery:
    """Promote every object once, though it arrives again: replayed, under another name, or in a later batch or run.

    What an object is, ``identity`` says (by default its content). It is state of the stream, kept beside ``checkpoint``
    until ``expiry`` after the first arrival; then the object counts as new. Folder marks and rows outside
    ``prefix`` neither move nor count as first arrivals. Output is written as by ``promote_landing_stream``.
    """
    staged = drop_placeholders(list_objects(objects, prefix=prefix))
    fresh = first_arrivals(staged, content_identity() if identity is None else identity, expiry)
    return promote_landing_stream(fresh, dest, checkpoint, ts_ms, prefix)
