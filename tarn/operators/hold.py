"""A column that is worked out once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hold(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Set ``name`` to ``value`` as a column of its own.

    Catalyst merges neighbouring projections, and what is mentioned several times is then computed
    several times, around Arrow functions even across their boundary. A one-element explode keeps its
    result apart.
    """
    others = [c for c in df.columns if c != name]
    return df.select(*others, F.explode(F.array(value)).alias(name)).select(*df.columns)
