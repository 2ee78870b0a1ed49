"""Profiles of text objects and the decisions taken on them. Everything happens inside the row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarn.functions import text as X
from tarn.functions.language import LEXICON, language_of, translator_code

# Limits of the quality flags.
MIN_LENGTH = 20
MIN_PRINTABLE = 0.9


def size_flags(docs: DataFrame) -> DataFrame:
    """Byte size, blank and too-short flags of ``(key, text)``."""
    stripped = F.length(X.strip(F.col("text")))
    return docs.select(
        "key",
        F.octet_length("text").cast("long").alias("size_bytes"),
        (stripped == 0).alias("empty"),
        (stripped < MIN_LENGTH).alias("too_short"),
    )


def printable_ratio(docs: DataFrame) -> DataFrame:
    """Share of printable or white-space characters and the flag for a low one."""
    return docs.select(
        "key",
        X.unprintable_count(F.col("text")).alias("n_unprintable"),
        X.printable_ratio(F.col("text")).alias("ratio"),
    ).withColumn("low_printable_ratio", F.col("ratio") < MIN_PRINTABLE)


def paragraph_stats(docs: DataFrame, separator: str = "\n\n") -> DataFrame:
    """Lengths of the paragraphs, in characters, and their average, maximum and minimum."""
    lengths = F.transform(X.paragraphs(F.col("text"), separator), F.length)
    listed = docs.select("key", lengths.alias("paragraph_token_list"))
    return listed.select("key", *_length_stats(F.col("paragraph_token_list")), "paragraph_token_list")


def _length_stats(lengths: Column) -> list[Column]:
    total = F.aggregate(lengths, F.lit(0).cast("long"), lambda n, size: n + size)
    average = F.when(F.size(lengths) > 0, X.python_round(total / F.size(lengths))).otherwise(F.lit(0.0))
    return [
        average.alias("avg_tokens_per_paragraph"),
        F.coalesce(F.array_max(lengths), F.lit(0)).alias("max_tokens_paragraph"),
        F.coalesce(F.array_min(lengths), F.lit(0)).alias("min_tokens_paragraph"),
    ]


def text_profile(
    docs: DataFrame, separator: str = "\n\n", lexicon: dict[str, tuple[str, ...]] = LEXICON
) -> DataFrame:
    """The profile of each ``(key, text)``, one row per object.

    An empty body has a key and the empty flag; its other columns are NULL.
    """
    text = F.col("text")
    trimmed = X.strip(text)
    has_body = F.octet_length(text) > 0
    base = docs.select(
        "key",
        F.when(has_body, text).alias("text"),
        F.coalesce(trimmed == "", F.lit(True)).alias("empty"),
    )
    measured = base.select(
        "*",
        F.length(X.strip(text)).alias("_stripped"),
        F.transform(X.paragraphs(text, separator), F.length).alias("paragraph_token_list"),
    )
    lengths = F.col("paragraph_token_list")
    return measured.select(
        "key",
        F.octet_length("text").cast("long").alias("size_bytes"),
        F.when(text.rlike(X.NON_ASCII), "utf-8").when(text.isNotNull(), "ascii").alias("encoding"),
        "empty",
        (F.col("_stripped") < MIN_LENGTH).alias("too_short"),
        (X.printable_ratio(text) < MIN_PRINTABLE).alias("low_printable_ratio"),
        X.line_count(text).alias("lines"),
        *(F.when(text.isNotNull(), stat).alias(name) for stat, name in zip(
            _length_stats(lengths),
            ("avg_tokens_per_paragraph", "max_tokens_paragraph", "min_tokens_paragraph"),
            strict=True,
        )),
        lengths.alias("paragraph_token_list"),
        F.when(text.isNotNull(), language_of(text, lexicon)).alias("origin_language"),
    )


def language_vote(docs: DataFrame, lexicon: dict[str, tuple[str, ...]] = LEXICON) -> DataFrame:
    """Language of each document by marker words."""
    return docs.select("key", language_of(F.col("text"), lexicon).alias("language"))


def route_translation(profile: DataFrame, language: str = "origin_language") -> DataFrame:
    """Work list for a translator: its code for each language, and whether translation is due."""
    code = F.col(language)
    return profile.select(
        "key",
        code.alias("language"),
        translator_code(code).alias("translator_code"),
        (code != "en").alias("translate"),
    )


def keeps_quality(text: Column) -> Column:
    """True for texts that are neither blank, too short nor full of unprintable characters."""
    return (F.length(X.strip(text)) >= MIN_LENGTH) & (X.printable_ratio(text) >= MIN_PRINTABLE)


def drop_low_quality(docs: DataFrame, profile: DataFrame | None = None) -> DataFrame:
    """Documents that pass the quality flags.

    Without a stored profile the flags are computed in the row, which spares a join of the texts.
    """
    if profile is None:
        return docs.filter(F.coalesce(keeps_quality(F.col("text")), F.lit(False)))
    flagged = profile.filter(
        F.col("empty")
        | F.coalesce(F.col("too_short"), F.lit(True))
        | F.coalesce(F.col("low_printable_ratio"), F.lit(True))
    ).select("key")
    return docs.join(flagged, "key", "left_anti")


__all__ = [
    "UNKNOWN",
    "drop_low_quality",
    "keeps_quality",
    "language_vote",
    "paragraph_stats",
    "printable_ratio",
    "route_translation",
    "size_flags",
    "text_profile",
]
