"""Small documents with the hard cases: nulls, empty and long texts, copies, ties, repeated rows, clashing columns."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row int, key int, tokens int, shard int, level int"


def words(seed: int, n: int, size: int = 400) -> list[str]:
    rng = random.Random(seed)
    return [f"w{rng.randrange(size)}" for _ in range(n)]


def texts() -> list[tuple]:
    """``(doc_id, text, source)``."""
    rng = random.Random(1)
    rows = [(i, " ".join(words(i, rng.randint(1, 120))), f"s{i % 4}") for i in range(60)]
    base = words(1000, 80)
    for i in range(100, 160):  # near copies at all distances around the limit
        copy = list(base)
        for _ in range(i % 7):
            copy[rng.randrange(80)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(copy), "s0"))
    rows += [(200 + i, rows[3][1].upper() + "  \n", "s1") for i in range(5)]
    rows += [(300, None, "s1"), (301, "", None), (302, " \t\n", "s2"), (303, "one two", "s2"), (304, "ONE  two", "s3")]
    rows += [(None, "no id here at all", None), (None, None, "s1"), (None, rows[5][1], "s1")]
    rows += [rows[7], rows[7], (7, "another text of the same id", "s9")]
    rows.append((400, " ".join(words(5, 30_000, 50_000)), "s0"))
    rows.append((401, "é" * 20_000 + " " + "z" * 70_000, "s\U0001f600"))
    return rows


def documents(spark, rows=None):
    rows = texts() if rows is None else rows
    full = [(i, t, "en", s, -1, 1, 2, 3, 4, 5) for i, t, s in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def twins(n: int = 1024) -> tuple[str, str]:
    """Two words that every polynomial hash modulo a power of two takes for one: the Thue-Morse word and its complement."""
    bits = [i.bit_count() % 2 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)
