"""Source tables and file listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# File extension -> content type, where a listing carries none.
CONTENT_TYPES = {
    "txt": "text/plain",
    "html": "text/html",
    "htm": "text/html",
    "md": "text/markdown",
    "rtf": "text/rtf",
    "jpg": "image/jpeg",
    "jpeg": "image/jpeg",
    "png": "image/png",
    "gif": "image/gif",
    "bmp": "image/bmp",
    "mp4": "video/mp4",
    "webm": "video/webm",
    "pdf": "application/pdf",
    "zip": "application/zip",
    "epub": "application/epub+zip",
}


def content_type_of(key: Column) -> Column:
    pairs = [F.lit(part) for pair in CONTENT_TYPES.items() for part in pair]
    ext = F.lower(F.substring_index(key, ".", -1))
    return F.coalesce(F.create_map(*pairs)[ext], F.lit("application/octet-stream"))


def list_files(spark: SparkSession, root: str, bucket: str) -> DataFrame:
    """Manifest of the files below ``root``; bodies are not read.

    Spark leaves out zero-byte files: ``sources.listing.object_listing`` lists them too.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return files.select(
        F.lit(bucket).alias("bucket"),
        relative(F.col("path"), root).alias("key"),
        F.col("length").alias("size"),
        content_type_of(F.col("path")).alias("content_type"),
        F.col("modificationTime").alias("modified"),
    )


def read_bodies(spark: SparkSession, root: str) -> DataFrame:
    """``(key, size, content)`` of the files below ``root``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return files.select(
        relative(F.col("path"), root).alias("key"), F.col("length").alias("size"), "content"
    )


def relative(path: Column, root: str) -> Column:
    folder = root.split("://", 1)[-1].removeprefix("file:").rstrip("/") + "/"
    return F.substring_index(path, folder, -1)


def read_images(spark: SparkSession, root: str) -> DataFrame:
    """Decoded images of every format the image source knows; undecodable files are left out."""
    images = spark.read.format("image").option("dropInvalid", "true").option(
        "recursiveFileLookup", "true"
    ).load(root)
    return images.select("image.*")


def image_metadata(images: DataFrame, objects: DataFrame, root: str) -> DataFrame:
    """``(key, size, width, height, mode)`` of images decoded below ``root``, sizes from their manifest."""
    # The image source's codes for 8-bit grey, BGR and BGRA.
    mode = F.when(F.col("mode") == 0, "L").when(F.col("mode") == 16, "RGB").when(F.col("mode") == 24, "RGBA")
    shown = images.select(relative(F.col("origin"), root).alias("key"), "width", "height", mode.alias("mode"))
    return shown.join(objects.select("key", "size"), "key")
