"""Cleaning and chunking of text objects ``(key, text)``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.functions import chunks as C
from tarn.functions import text as X
from tarn.functions.language import LEXICON, language_of, translator_code
from tarn.operators.hold import hold
from tarn.operators.text_quality import drop_low_quality


def basic_clean(docs: DataFrame) -> DataFrame:
    return hold(docs, "text", X.basic_clean(F.col("text")))


def final_scrub(docs: DataFrame, keep_unicode: bool = False) -> DataFrame:
    return docs.withColumn("text", X.final_scrub(F.col("text"), keep_unicode))


def split_sentences(docs: DataFrame) -> DataFrame:
    """One row per sentence."""
    return docs.select(
        "key", F.posexplode(X.split_sentences(F.col("text"))).alias("sentence_no", "sentence")
    )


def chunk_documents(
    docs: DataFrame,
    max_tokens: int = C.MAX_TOKENS,
    stride: int = C.STRIDE,
    reserve_special: int = C.RESERVE_SPECIAL,
    separator: str = "\n\n",
    tokenizer: C.Tokenizer = C.Tokenizer(),
) -> DataFrame:
    """Chunk rows of every paragraph; numbers start at zero."""
    paragraphs = docs.select(
        "key",
        F.posexplode(X.paragraphs(F.col("text"), separator)).alias("paragraph_no", "paragraph"),
    )
    chunks = C.chunk_text(F.col("paragraph"), max_tokens, stride, reserve_special, tokenizer)
    return paragraphs.select(
        "key", "paragraph_no", F.posexplode(chunks).alias("chunk_no", "chunk")
    ).select("key", "paragraph_no", "chunk_no", "chunk.text", "chunk.n_tokens")


def rechunk_paragraphs(
    docs: DataFrame,
    max_tokens: int = C.MAX_TOKENS,
    stride: int = C.STRIDE,
    reserve_special: int = C.RESERVE_SPECIAL,
    separator: str = "\n\n",
    tokenizer: C.Tokenizer = C.Tokenizer(),
) -> DataFrame:
    return hold(
        docs,
        "text",
        C.rechunk_paragraphs(
            F.col("text"), max_tokens, stride, reserve_special, separator, tokenizer
        ),
    )


def clean_text(
    docs: DataFrame,
    translated: DataFrame | None = None,
    max_tokens: int = C.MAX_TOKENS,
    separator: str = "\n\n",
    lexicon: dict[str, tuple[str, ...]] = LEXICON,
    tokenizer: C.Tokenizer = C.Tokenizer(),
    keep_unicode: bool = False,
) -> DataFrame:
    """The cleaning job: drop, clean, translate, re-chunk, scrub. Adds language and translator code.

    ``translated`` holds ``(key, text)`` that an outside translator made of basically cleaned texts;
    without an entry a text is kept as it is. Without that table the job is one pass with no shuffle.
    """
    kept = drop_low_quality(docs)
    language = language_of(F.col("text"), lexicon)
    cleaned = basic_clean(
        kept.withColumn("language", language).withColumn(
            "translator_code", translator_code(F.col("language"))
        )
    )
    if translated is not None:
        foreign = F.col("language") != "en"
        cleaned = (
            cleaned.join(translated.select("key", F.col("text").alias("_english")), "key", "left")
            .withColumn("text", F.when(foreign, F.coalesce("_english", "text")).otherwise(F.col("text")))
            .drop("_english")
        )
    rebuilt = rechunk_paragraphs(
        cleaned, max_tokens, separator=separator, tokenizer=tokenizer
    )
    return final_scrub(rebuilt, keep_unicode)
