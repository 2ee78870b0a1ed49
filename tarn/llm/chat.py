"""Conversations as one string each, with a loss mask, and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The template: a block is OPEN role MID text {JOIN text} END. All marks begin with "<".
OPEN, MID, JOIN, END = "<|", "|>", "<+>", "</s>"
LEARNED = "assistant"


def escape(text: Column) -> Column:
    r"""Put ``\`` behind each ``<``, ``[`` and ``\``: no mark of this or an ``[INST]`` template is left inside."""
    return F.regexp_replace(text, r"([<\[\\])", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[\\])\\", "$1")


def format_chats(rows: DataFrame) -> DataFrame:
    """``conv_id, formatted, loss_spans`` of ``rows (conv_id, turn, role, text)``.

    A conversation's rows are sorted by turn (null first; ties by role and text; repeated rows all stay),
    neighbours of one role become one block with ``JOIN`` between their texts, and blocks are concatenated.
    ``loss_spans`` are the code point ranges ``[start, end)`` of the escaped assistant texts. Null texts
    are empty, null roles have an empty name, rows without conv_id are one conversation. An empty table
    gives no rows. Other columns are ignored. A conversation is one row here and must fit in memory.
    """
    turns = rows.groupBy("conv_id").agg(
        F.sort_array(
            F.collect_list(
                F.struct(
                    "turn",
                    F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                    F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
                )
            )
        ).alias("turns")
    )
    block = "struct<role:string,texts:array<string>>"

    def merge(blocks: Column, turn: Column) -> Column:
        last = F.get(blocks, F.size(blocks) - 1)
        longer = F.struct(turn["role"].alias("role"), F.concat(last["texts"], F.array(escape(turn["text"]))).alias("texts"))
        single = F.struct(turn["role"].alias("role"), F.array(escape(turn["text"])).alias("texts"))
        return F.when(
            last["role"] == turn["role"], F.concat(F.slice(blocks, 1, F.size(blocks) - 1), F.array(longer))
        ).otherwise(F.concat(blocks, F.array(single)))

    blocks = F.aggregate("turns", F.array().cast(f"array<{block}>"), merge)
    head = lambda b: F.concat(F.lit(OPEN), escape(b["role"]), F.lit(MID))
    body = lambda b: F.array_join(b["texts"], JOIN)
    span = "array<struct<start:bigint,end:bigint>>"

    def measure(state: Column, b: Column) -> Column:
        start = state["at"] + F.length(head(b))
        inner = F.aggregate(
            b["texts"],
            F.struct(start.alias("at"), F.array().cast(span).alias("spans")),
            lambda s, t: F.struct(
                (s["at"] + F.length(t) + len(JOIN)).alias("at"),
                F.concat(
                    s["spans"], F.array(F.struct(s["at"].alias("start"), (s["at"] + F.length(t)).alias("end")))
                ).alias("spans"),
            ),
        )
        return F.struct(
            (start + F.length(body(b)) + len(END)).alias("at"),
            F.when(b["role"] == LEARNED, F.concat(state["spans"], inner["spans"])).otherwise(state["spans"]).alias("spans"),
        )

    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(span).alias("spans"))
    return turns.select("conv_id", blocks.alias("blocks")).select(
        "conv_id",
        F.array_join(F.transform("blocks", lambda b: F.concat(head(b), body(b), F.lit(END))), "").alias("formatted"),
        F.aggregate("blocks", zero, measure)["spans"].alias("loss_spans"),
    )


def read_chats(formatted: DataFrame) -> DataFrame:
    """The turns and the text under the loss mask, from the formatted strings alone.

    ``conv_id, turns`` (array of role and text) and ``loss_text``.
    """
    quoted = lambda mark: rf"\Q{mark}\E"
    blocks = F.slice(F.split("formatted", quoted(END)), 1, F.size(F.split("formatted", quoted(END))) - 1)

    def turns_of(b: Column) -> Column:
        at = F.instr(b, MID)
        role = unescape(F.substring(b, F.lit(len(OPEN) + 1), at - len(OPEN) - 1))
        texts = F.split(F.substring(b, at + len(MID), F.length(b)), quoted(JOIN))
        return F.transform(texts, lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    learned = F.transform(
        "loss_spans", lambda s: unescape(F.substring(F.col("formatted"), s["start"] + 1, s["end"] - s["start"]))
    )
    return formatted.select(
        "conv_id",
        "formatted",
        F.flatten(F.transform(blocks, turns_of)).alias("turns"),
        F.array_join(learned, "").alias("loss_text"),
    )
