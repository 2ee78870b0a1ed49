"""Token-budget chunks of a text as one expression: no explode, no shuffle, linear in the text."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from tarn.functions.bind import let
from tarn.functions.text import paragraphs, split_sentences

# Defaults of the chunker.
MAX_TOKENS = 512
STRIDE = 64
RESERVE_SPECIAL = 2


@dataclass(frozen=True)
class Tokenizer:
    """How a sentence becomes an array of tokens and back. Blanks by default: sentences hold no other
    white space."""

    encode: Callable[[Column], Column] = lambda text: F.split(text, " ")
    decode: Callable[[Column], Column] = lambda tokens: F.array_join(tokens, " ")

    def count(self, text: Column) -> Column:
        return F.size(self.encode(text))


def token_budget(max_tokens: int = MAX_TOKENS, reserve_special: int = RESERVE_SPECIAL) -> int:
    budget = max_tokens - reserve_special
    if budget <= 0:
        raise ValueError("max_tokens must exceed the reserved special tokens")
    return budget


def pack_starts(lengths: Column, budget: int) -> Column:
    """First sentence (0-based) of every chunk when sentences are packed greedily.

    A sentence joins the open chunk while the summed length stays within the budget. One above the
    budget stands alone: it leaves the running length above the budget, so the next one opens anew.
    Only chunk starts are appended, so the fold copies little.
    """
    start = F.struct(
        F.array().cast("array<int>").alias("starts"),
        F.lit(budget + 1).alias("filled"),
        F.lit(0).alias("at"),
    )

    def step(state: Column, length: Column) -> Column:
        fits = state["filled"] + length <= budget
        return F.struct(
            F.when(fits, state["starts"])
            .otherwise(F.concat(state["starts"], F.array(state["at"])))
            .alias("starts"),
            F.when(fits, state["filled"] + length).otherwise(length).alias("filled"),
            (state["at"] + 1).alias("at"),
        )

    return F.aggregate(lengths, start, step, lambda state: state["starts"])


def window_starts(size: Column, budget: int, stride: int) -> Column:
    """Starts of overlapping windows over ``size`` tokens; the last window ends at the end."""
    step = max(budget - stride, 1)
    further = F.ceil((size - budget) / F.lit(step)).cast("int")
    last = F.when(size > budget, further * step).otherwise(F.lit(0))
    return F.sequence(F.lit(0), last, F.lit(step))


def windows(tokens: Column, budget: int, stride: int, tokenizer: Tokenizer) -> Column:
    """A long sentence as overlapping windows of at most ``budget`` tokens."""

    def cut(bound: Column) -> Column:
        def one(start: Column) -> Column:
            piece = F.slice(bound, start + 1, F.lit(budget))
            return F.struct(
                F.btrim(tokenizer.decode(piece)).alias("text"), F.size(piece).alias("n_tokens")
            )

        return F.transform(window_starts(F.size(bound), budget, stride), one)

    return let(tokens, cut)


def pack_sentences(
    sentences: Column,
    budget: int,
    stride: int = STRIDE,
    tokenizer: Tokenizer = Tokenizer(),
) -> Column:
    """Chunks ``array<struct<text,n_tokens>>`` of an array of sentences."""

    def joined(piece: Column) -> Column:
        return let(
            F.array_join(piece, " "),
            lambda text: F.array(
                F.struct(text.alias("text"), tokenizer.count(text).alias("n_tokens"))
            ),
        )

    def chunk(piece: Column, first_length: Column) -> Column:
        return F.when(
            first_length > budget,
            windows(tokenizer.encode(F.get(piece, F.lit(0))), budget, stride, tokenizer),
        ).otherwise(joined(piece))

    def build(bound: Column) -> Column:
        def with_lengths(lengths: Column) -> Column:
            def with_starts(starts: Column) -> Column:
                def one(start: Column, position: Column) -> Column:
                    end = F.coalesce(F.get(starts, position + 1), F.size(bound))
                    return chunk(
                        F.slice(bound, start + 1, end - start), F.get(lengths, start)
                    )

                return F.flatten(F.transform(starts, one))

            return let(pack_starts(lengths, budget), with_starts)

        return let(F.transform(bound, tokenizer.count), with_lengths)

    return let(sentences, build)


def chunk_text(
    text: Column,
    max_tokens: int = MAX_TOKENS,
    stride: int = STRIDE,
    reserve_special: int = RESERVE_SPECIAL,
    tokenizer: Tokenizer = Tokenizer(),
) -> Column:
    """Chunks of one paragraph."""
    budget = token_budget(max_tokens, reserve_special)
    return pack_sentences(split_sentences(text), budget, stride, tokenizer)


def rechunk_paragraphs(
    text: Column,
    max_tokens: int = MAX_TOKENS,
    stride: int = STRIDE,
    reserve_special: int = RESERVE_SPECIAL,
    separator: str = "\n\n",
    tokenizer: Tokenizer = Tokenizer(),
) -> Column:
    """Replace paragraphs of more than ``max_tokens`` characters by their chunks, blank lines between.

    The threshold counts characters while the chunk budget counts tokens.
    """

    def rebuilt(paragraph: Column) -> Column:
        chunks = F.transform(
            chunk_text(paragraph, max_tokens, stride, reserve_special, tokenizer),
            lambda chunk: F.btrim(chunk["text"]),
        )
        return F.when(
            F.length(paragraph) > max_tokens,
            F.array_join(F.filter(chunks, lambda part: part != ""), "\n\n"),
        ).otherwise(paragraph)

    return F.array_join(F.transform(paragraphs(text, separator), rebuilt), "\n\n")
