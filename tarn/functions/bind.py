"""Name an intermediate value inside an expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and pass it to ``body``.

    A value mentioned several times inside a lambda would be computed at every mention; a one-element
    ``transform`` makes it a bound variable instead.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
