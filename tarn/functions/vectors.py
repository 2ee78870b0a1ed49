"""Vector algebra on ``array<float>`` columns, computed in double."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

METRICS = ("l2", "cosine", "ip")


def as_double(vector: Column) -> Column:
    return vector.cast("array<double>")


def dot(left: Column, right: Column) -> Column:
    products = F.zip_with(as_double(left), as_double(right), lambda a, b: a * b)
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def norm(vector: Column) -> Column:
    return F.sqrt(F.aggregate(as_double(vector), F.lit(0.0), lambda total, x: total + x * x))


def l2_normalize(vector: Column) -> Column:
    """Unit vector in double; a zero vector stays as it is."""
    length = norm(vector)
    # The norm is bound once per row, not once per element.
    scaled = F.transform(F.array(length), lambda size: F.transform(as_double(vector), lambda x: x / size))
    return F.when(length > 0, F.get(scaled, F.lit(0))).otherwise(as_double(vector))


def distance(left: Column, right: Column, metric: str = "l2") -> Column:
    """Squared Euclidean (the store's default), cosine or inner-product distance."""
    if metric == "l2":
        gaps = F.zip_with(as_double(left), as_double(right), lambda a, b: (a - b) * (a - b))
        return F.aggregate(gaps, F.lit(0.0), lambda total, x: total + x)
    if metric == "cosine":
        # NULL where a vector is zero.
        return 1.0 - dot(left, right) / F.nullif(norm(left) * norm(right), F.lit(0.0))
    if metric == "ip":
        return 1.0 - dot(left, right)
    raise ValueError(f"unknown metric {metric!r}; choose from {METRICS}")


def similarity(distance_: Column) -> Column:
    """The reported similarity, whatever the metric."""
    return 1.0 - distance_


def cosine_of_l2(distance_: Column) -> Column:
    """True cosine of two unit vectors from their squared Euclidean distance."""
    return 1.0 - distance_ / 2.0
