"""Joins in which one key may hold a large share of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_safe(left: str, right: str, names: Sequence[str]) -> Column:
    """Equality of the named columns of two aliased frames, NULL being equal to NULL."""
    condition = F.lit(True)
    for name in names:
        condition = condition & F.col(f"{left}.{name}").eqNullSafe(F.col(f"{right}.{name}"))
    return condition


def join_facts(many: DataFrame, facts: DataFrame, on: Sequence[str]) -> DataFrame:
    """Inner join of a large frame to per-key facts with one short row per key; NULL keys match.

    One side is unique, so the adaptive skew join may split a hot key's rows into as many tasks as
    they need; facts that turn out small at run time are broadcast.
    """
    added = [c for c in facts.columns if c not in on]
    joined = many.alias("m").join(facts.alias("u"), null_safe("m", "u", on))
    return joined.select(*(f"m.`{c}`" for c in many.columns), *(f"u.`{c}`" for c in added))
