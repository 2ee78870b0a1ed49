"""From objects to vectors: encode, pool, project, normalise, number."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.functions import encoders as E
from tarn.functions import text as X
from tarn.functions import vectors as V
from tarn.operators.hold import hold
from tarn.operators.media import MAX_FRAMES, frame_sample
from tarn.operators.ordinal import ordinal


# Fixed value: tokens that a model reads of a text.
MAX_TOKENS = 512


def l2_normalize(df: DataFrame, column: str = "embedding") -> DataFrame:
    return df.withColumn(column, V.l2_normalize(F.col(column)))


def encode_batch(
    df: DataFrame, factory: E.EncoderFactory, source: str, column: str = "embedding"
) -> DataFrame:
    """Add the vectors of a column of inputs; the encoder is built once per task."""
    return df.withColumn(column, E.encode_column(F.col(source), factory))


def hash_encode(docs: DataFrame, width: int = 64) -> DataFrame:
    """``(key, embedding)`` by counting words per hash slot, all in the JVM and inside the row."""
    slots = F.transform(X.words(F.coalesce("text", F.lit(""))), lambda w: F.conv(F.substring(F.md5(w), 1, 4), 16, 10).cast("int") % width)
    hashed = hold(docs.select("key", "text").withColumn("slots", F.array().cast("array<int>")), "slots", slots)
    # One lambda for all slots: an expression for each makes a method so long that the JVM does not compile it.
    counts = F.transform(
        F.sequence(F.lit(0), F.lit(width - 1)),
        lambda place: (F.size("slots") - F.size(F.array_remove("slots", place))).cast("double"),
    )
    dense = hold(hashed.withColumn("dense", F.array().cast("array<double>")), "dense", counts)
    return dense.select("key", V.l2_normalize(F.col("dense")).cast("array<float>").alias("embedding"))


def mean_pool(df: DataFrame, group: Sequence[str], column: str = "embedding") -> DataFrame:
    """Element-wise mean of the vectors of each group, summed up before the shuffle."""
    mean = Summarizer.mean(array_to_vector(V.as_double(F.col(column))))
    return df.groupBy(*group).agg(vector_to_array(mean).alias(column))


def embed_paragraphs(
    docs: DataFrame, factory: E.EncoderFactory, separator: str = "\n\n", tokens: int | None = None
) -> DataFrame:
    """``(key, embedding)``: each paragraph (its first ``tokens`` tokens, if given) encoded, averaged and normalised inside the row."""
    parts = X.paragraphs(F.col("text"), separator)
    if tokens is not None:
        parts = F.transform(parts, lambda part: F.array_join(X.truncate_tokens(part, tokens), " "))
    return docs.select("key", E.encode_pooled(parts, factory).alias("embedding"))


def project_linear(
    df: DataFrame, weights: np.ndarray, bias: np.ndarray, column: str = "embedding"
) -> DataFrame:
    """Affine map of a vector column to another width, then normalised."""
    return df.withColumn(column, E.project_column(F.col(column), weights, bias))


def embed_videos(
    frames: DataFrame,
    factory: E.EncoderFactory | None = None,
    max_frames: int = MAX_FRAMES,
    total: str | None = None,
) -> DataFrame:
    """``(video_id, embedding)``: sample frames, encode their payload (unless vectors are stored),
    average and normalise. Videos without a readable frame give no row."""
    sampled = frame_sample(frames, max_frames, total)
    if factory is not None:
        sampled = encode_batch(sampled, factory, "payload")
    pooled = mean_pool(sampled, ["video_id"])
    return l2_normalize(pooled).withColumn("embedding", F.col("embedding").cast("array<float>"))


def assign_ids(objects: DataFrame, prefix: str, key: str = "key") -> DataFrame:
    """Add ``id`` = prefix and 1-based position in key order. Filter unusable objects afterwards, so
    that they keep their number."""
    placed = ordinal(objects, [key], "_position")
    return placed.withColumn("id", F.concat(F.lit(prefix + "_"), F.col("_position"))).drop("_position")
