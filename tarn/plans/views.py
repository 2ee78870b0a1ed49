"""Lake inputs derived from the given tables, as frames and as the same SQL for the oracle."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarn.functions.text import WHITESPACE
from tarn.functions.vectors import as_double
from tarn.operators.media import number_frames

LAKE_TS = 1_700_000_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as text objects ``(key, text)``."""
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("key"), "text")


def games(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two source tables of different shape: documents and pages."""
    first = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("game_id"),
        F.when(F.col("n_chars") < 20, "").otherwise(F.col("text")).alias("about_the_game"),
        F.concat(
            F.lit("https://img.example.com/"), "source", F.lit("/"), "doc_id", F.lit(".jpg?t=1."), "n_chars"
        ).alias("header_image"),
        F.concat(F.lit("https://cdn.example.com/v."), "doc_id", F.lit(".mp4")).alias("movies"),
    )
    second = table(spark, sf_dir, "pages").select(
        "page_id", F.col("html").alias("description"), F.col("url").alias("background_image")
    )
    return first, second


GAMES_SQL = """
games1 AS (
  SELECT doc_id AS pos, CASE WHEN n_chars < 20 THEN '' ELSE text END AS text,
         'https://img.example.com/' || source || '/' || doc_id || '.jpg?t=1.' || n_chars AS image,
         'https://cdn.example.com/v.' || doc_id || '.mp4' AS video
  FROM documents),
games2 AS (SELECT page_id AS pos, html AS text, url AS image, NULL::VARCHAR AS video FROM pages)
"""


def objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest of the staging area over all source tables."""

    def listing(name: str, key, size, content_type) -> DataFrame:
        return table(spark, sf_dir, name).select(
            F.lit("landing-zone").alias("bucket"),
            F.concat(F.lit("temporal-landing/"), *key).alias("key"),
            size.cast("long").alias("size"),
            content_type.alias("content_type"),
        )

    image_ext = F.when(F.col("vec_id") % 2 == 0, "jpg").otherwise("png")
    video_ext = F.when(F.col("event_type") == "view", "mp4").otherwise("webm")
    parts = [
        listing("documents", (F.lit("text_"), "doc_id", F.lit(".txt")), F.col("n_chars"), F.lit("text/plain")),
        listing("pages", (F.lit("page_"), "page_id", F.lit(".html")), F.length("html"), F.lit("text/html")),
        listing(
            "embeddings",
            (F.lit("image_"), "vec_id", F.lit("."), image_ext),
            F.col("label") * 1000,
            F.concat(F.lit("image/"), image_ext),
        ),
        listing(
            "events",
            (F.lit("video_"), "event_id", F.lit("."), video_ext),
            F.floor("value"),
            F.concat(F.lit("video/"), video_ext),
        ),
        listing("region", ("r_name", F.lit("/")), F.lit(0), F.lit("")),
        listing(
            "supplier", (F.lit("supplier_"), "s_suppkey", F.lit(".pdf")), F.lit(10), F.lit("application/pdf")
        ),
    ]
    return reduce(DataFrame.unionByName, parts)


OBJECTS_SQL = """
objects AS (
  SELECT 'landing-zone' AS bucket, 'temporal-landing/text_' || doc_id || '.txt' AS key,
         n_chars::BIGINT AS size, 'text/plain' AS content_type FROM documents
  UNION ALL SELECT 'landing-zone', 'temporal-landing/page_' || page_id || '.html', length(html), 'text/html' FROM pages
  UNION ALL SELECT 'landing-zone', 'temporal-landing/image_' || vec_id || '.' || CASE WHEN vec_id % 2 = 0 THEN 'jpg' ELSE 'png' END,
         label::BIGINT * 1000, 'image/' || CASE WHEN vec_id % 2 = 0 THEN 'jpg' ELSE 'png' END FROM embeddings
  UNION ALL SELECT 'landing-zone', 'temporal-landing/video_' || event_id || '.' || CASE WHEN event_type = 'view' THEN 'mp4' ELSE 'webm' END,
         floor(value)::BIGINT, 'video/' || CASE WHEN event_type = 'view' THEN 'mp4' ELSE 'webm' END FROM events
  UNION ALL SELECT 'landing-zone', 'temporal-landing/' || r_name || '/', 0, '' FROM region
  UNION ALL SELECT 'landing-zone', 'temporal-landing/supplier_' || s_suppkey || '.pdf', 10, 'application/pdf' FROM supplier)
"""


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings of three buckets that should agree but do not."""
    documents = table(spark, sf_dir, "documents")
    talks = table(spark, sf_dir, "conversations")
    region = table(spark, sf_dir, "region")
    name = F.concat(F.lit("texts/text_"), "doc_id", F.lit(".txt"))
    size = F.col("n_chars").cast("long").alias("size")
    parts = [
        documents.select(
            F.lit("landing-zone").alias("bucket"),
            F.concat(F.lit("persistent-landing/"), name).alias("key"),
            size,
        ),
        region.select(
            F.lit("landing-zone"), F.concat(F.lit("persistent-landing/"), "r_name", F.lit("/")), F.lit(0)
        ),
        documents.filter(F.col("lang") != "es").select(
            F.lit("formatted-zone"), name, F.lit(1).cast("long")
        ),
        talks.select(
            F.lit("formatted-zone"),
            F.concat(F.lit("texts/talk_"), "conv_id", F.lit("_"), "turn", F.lit(".txt")),
            F.length("text"),
        ),
        region.select(F.lit("trusted-zone"), F.concat(F.lit("_"), "r_name"), F.lit(7)),
    ]
    return reduce(DataFrame.union, parts)


ZONES_SQL = """
zones AS (
  SELECT 'landing-zone' AS bucket, 'persistent-landing/texts/text_' || doc_id || '.txt' AS key, n_chars::BIGINT AS size FROM documents
  UNION ALL SELECT 'landing-zone', 'persistent-landing/' || r_name || '/', 0 FROM region
  UNION ALL SELECT 'formatted-zone', 'texts/text_' || doc_id || '.txt', 1 FROM documents WHERE lang <> 'es'
  UNION ALL SELECT 'formatted-zone', 'texts/talk_' || conv_id || '_' || turn || '.txt', length(text) FROM conversations
  UNION ALL SELECT 'trusted-zone', '_' || r_name, 7 FROM region)
"""


def media_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded image metadata, one row per line item; some heights are zero."""
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("images/"), "l_orderkey", F.lit("_"), "l_linenumber", F.lit(".png")).alias("key"),
        F.floor("l_extendedprice").alias("size"),
        (F.col("l_quantity") * 16).cast("int").alias("width"),
        (F.col("l_partkey") % 50 * 8).cast("int").alias("height"),
        F.when(F.col("l_returnflag") == "A", "RGB")
        .when(F.col("l_returnflag") == "N", "L")
        .otherwise("P")
        .alias("mode"),
        F.when(F.col("l_linestatus") == "O", 3).when(F.col("l_linenumber") < 4, 1).alias("n_channels"),
    )


def round_sql(value: str) -> str:
    """Round to two digits by the exact binary value, half to even."""
    product = f"(({value}) * 100)"
    high = f"(({value}) * 134217729.0::DOUBLE - (({value}) * 134217729.0::DOUBLE - ({value})))"
    error = f"(({high} * 100 - {product}) + (({value}) - {high}) * 100)"
    half = f"{product} - floor({product}) = 0.5"
    return (
        f"(CASE WHEN {half} AND {error} > 0 THEN floor({product}) + 1 WHEN {half} AND {error} < 0 THEN floor({product}) "
        f"ELSE round_even({product}, 0) END / 100)"
    )


MEDIA_SQL = f"""
media_meta AS (
  SELECT 'images/' || l_orderkey || '_' || l_linenumber || '.png' AS key,
         floor(l_extendedprice)::BIGINT AS size, (l_quantity * 16)::INT AS width,
         (l_partkey % 50 * 8)::INT AS height,
         CASE l_returnflag WHEN 'A' THEN 'RGB' WHEN 'N' THEN 'L' ELSE 'P' END AS mode,
         CASE WHEN l_linestatus = 'O' THEN 3 WHEN l_linenumber < 4 THEN 1 END AS n_channels
  FROM lineitem),
media AS (
  SELECT key AS file_name, size / 1024.0::DOUBLE AS file_size, width, height,
         CASE WHEN height > 0 THEN {round_sql('width / nullif(height, 0)::DOUBLE')} END AS aspect_ratio,
         mode, n_channels FROM media_meta)
"""


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings as a collection over three modalities."""
    kind = F.col("vec_id") % 3
    folder = F.when(kind == 0, "texts").when(kind == 1, "images").otherwise("videos")
    ext = F.when(kind == 0, "txt").when(kind == 1, "png").otherwise("mp4")
    modality = F.when(kind == 0, "text").when(kind == 1, "image").otherwise("video")
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("string").alias("id"),
        F.concat(F.lit("trusted-zone/"), folder, F.lit("/"), "vec_id", F.lit("."), ext).alias("document"),
        modality.alias("modality"),
        "embedding",
        F.col("label").cast("string").alias("label"),
    )


VECTORS_SQL = """
vectors AS (
  SELECT vec_id::VARCHAR AS id,
         'trusted-zone/' || CASE vec_id % 3 WHEN 0 THEN 'texts' WHEN 1 THEN 'images' ELSE 'videos' END || '/' || vec_id
           || '.' || CASE vec_id % 3 WHEN 0 THEN 'txt' WHEN 1 THEN 'png' ELSE 'mp4' END AS document,
         CASE vec_id % 3 WHEN 0 THEN 'text' WHEN 1 THEN 'image' ELSE 'video' END AS modality,
         embedding::DOUBLE[] AS embedding, label::VARCHAR AS label
  FROM embeddings)
"""


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frame vectors: a label is a video, its vectors are the frames in id order."""
    rows = table(spark, sf_dir, "embeddings").select(
        F.concat(F.lit("video_"), "label").alias("video_id"), "vec_id", "embedding"
    )
    return number_frames(rows, "vec_id")


FRAMES_SQL = """
frames AS (
  SELECT 'video_' || label AS video_id, vec_id, embedding::DOUBLE[] AS embedding,
         row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS frame_no,
         count(*) OVER (PARTITION BY label) AS total
  FROM embeddings)
"""


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames without payload: a user is a video, their events are its frames."""
    rows = table(spark, sf_dir, "events").select(
        F.concat(F.lit("user_"), "user_id").alias("video_id"),
        "event_id",
        (F.col("user_id") % 6 * 15).cast("double").alias("fps"),
    )
    return number_frames(rows, "event_id")


TICKS_SQL = """
ticks AS (
  SELECT 'user_' || user_id AS video_id, event_id, (user_id % 6 * 15)::DOUBLE AS fps,
         row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS frame_no,
         count(*) OVER (PARTITION BY user_id) AS total
  FROM events)
"""


def digest(df: DataFrame, keys: list[str], column: str = "embedding") -> DataFrame:
    """Comparable numbers of a vector: width, first element, weighted sum, norm."""
    vector = as_double(F.col(column))
    weighted = F.aggregate(
        F.transform(vector, lambda x, i: x * (i + 1)), F.lit(0.0), lambda total, x: total + x
    )
    size = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda total, x: total + x * x))
    return df.select(
        *keys,
        F.size(column).cast("long").alias("dim"),
        (F.round(F.get(vector, F.lit(0)), 5) + 0.0).alias("first"),
        (F.round(weighted, 5) + 0.0).alias("weighted"),
        (F.round(size, 5) + 0.0).alias("norm"),
    )


def digest_sql(keys: str, source: str, column: str = "embedding") -> str:
    v = f"{column}::DOUBLE[]"
    return f"""
SELECT {keys}, len({column})::BIGINT AS dim, round(({v})[1], 5) + 0.0 AS first,
       round(list_sum(list_transform({v}, lambda x, i: x * i)), 5) + 0.0 AS weighted,
       round(sqrt(list_sum(list_transform({v}, lambda x: x * x))), 5) + 0.0 AS norm
FROM {source}"""


def trim_sql(text: str) -> str:
    return f"trim({text}, '{WHITESPACE}')"


def unit_sql(vector: str) -> str:
    """Unit vector of a DOUBLE[] expression; zero stays zero."""
    size = f"sqrt(list_sum(list_transform({vector}, lambda x: x * x)))"
    return f"CASE WHEN {size} > 0 THEN list_transform({vector}, lambda x: x / {size}) ELSE {vector} END"
