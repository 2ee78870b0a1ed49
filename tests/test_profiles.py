"""Profiles of batches: merged sketches against one pass and against exact values."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarn.operators import profiles as P

LEVELS = (0.01, 0.25, 0.5, 0.9, 0.999)


@pytest.fixture(scope="module")
def rows(spark):
    # A third of the rows share one value; the rest are spread over many.
    return spark.range(60_000, numPartitions=5).select(
        (F.col("id") % 3).alias("batch"),
        F.when(F.col("id") % 3 == 1, 7.0).otherwise(F.pow((F.col("id") * 7919 % 60_000) / 1000.0, F.lit(2.0))).alias("x"),
        F.when(F.col("id") % 11 == 0, None).otherwise(F.concat(F.lit("w"), F.floor(F.sqrt(F.col("id") % 400)))).alias("w"),
    ).cache()


def report(frame, **options):
    return {r["column"]: r for r in P.profile_report(frame, LEVELS, **options).collect()}


def test_merged_batches_hold_the_bounds_of_one_pass(spark, rows, tmp_path):
    for batch in range(3):
        part = rows.filter(F.col("batch") == batch)
        P.store_profile(P.batch_profile(part, numbers=["x"], labels=["w"]), str(tmp_path / "p"), batch)
    # A batch that is run again replaces itself.
    P.store_profile(P.batch_profile(rows.filter("batch = 1"), numbers=["x"], labels=["w"]), str(tmp_path / "p"), 1)
    stored = P.stored_profiles(spark, str(tmp_path / "p"))
    assert stored.count() == 6
    merged = report(P.merged_profile(stored), top=5)
    whole = report(P.batch_profile(rows, numbers=["x"], labels=["w"]), top=5)
    xs = np.array([r["x"] for r in rows.select("x").collect()])
    words = Counter(r["w"] for r in rows.select("w").collect() if r["w"] is not None)
    for got in (merged, whole):
        x, w = got["x"], got["w"]
        assert (x["rows"], x["nulls"], x["least"], x["greatest"]) == (60_000, 0, xs.min(), xs.max())
        assert x["mean"] == pytest.approx(xs.mean())
        for level, value in zip(LEVELS, x["quantiles"], strict=True):
            assert (xs < value).mean() - P.RANK_ERROR <= level <= (xs <= value).mean() + P.RANK_ERROR
        assert x["n_distinct"] == pytest.approx(len(set(xs)), rel=P.DISTINCT_ERROR)
        assert (w["nulls"], w["quantiles"], w["mean"]) == (60_000 - sum(words.values()), None, None)
        assert w["n_distinct"] == pytest.approx(len(words), rel=P.DISTINCT_ERROR)
        assert [(t["item"], t["count"]) for t in w["top"]] == sorted(words.items(), key=lambda p: (-p[1], p[0]))[:5]


def test_exact_ranks_of_reported_quantiles(spark, rows, tmp_path):
    P.store_profile(P.batch_profile(rows, numbers=["x"]), str(tmp_path / "p"), "a")
    made = P.profile_report(P.stored_profiles(spark, str(tmp_path / "p")), LEVELS)
    values = made.first()["quantiles"]
    xs = np.array([r["x"] for r in rows.select("x").collect()])
    got = {r["place"]: (r["below"], r["upto"], r["n"]) for r in P.quantile_ranks(rows, made, ["x"]).collect()}
    assert got == {i: ((xs < v).sum(), (xs <= v).sum(), len(xs)) for i, v in enumerate(values)}


def test_batches_by_column_equal_batches_by_filter(rows):
    together = P.batch_profile(rows, ["batch"], ["x"], ["w"])
    assert together.count() == 6
    shared = [r["top"][0]["item"] if r["top"] else r["least"] for r in P.profile_report(together, top=1).collect()]
    assert len(shared) == 6 and None not in shared


def test_nulls_nans_and_no_rows(spark):
    odd = spark.createDataFrame(
        [(None, None), (float("nan"), ""), (math.inf, "é"), (-0.0, ""), (0.0, None)], "`a.b` double, t string"
    )
    got = report(P.merged_profile(P.batch_profile(odd, numbers=["a.b"], labels=["t"])))
    a, t = got["a.b"], got["t"]
    assert (a["rows"], a["nulls"], a["nans"], a["least"], a["greatest"], a["n_distinct"]) == (5, 1, 1, 0.0, math.inf, 2)
    assert [tuple(x) for x in t["top"]] == [("", 2), ("é", 1)] and t["nulls"] == 2
    none = report(P.batch_profile(odd.limit(0), numbers=["a.b"], labels=["t"]))
    assert (none["a.b"]["rows"], none["a.b"]["quantiles"], none["a.b"]["mean"], none["t"]["top"]) == (0, None, None, [])
    assert P.batch_profile(odd.limit(0), ["t"], ["a.b"]).count() == 0
    both = P.batch_profile(odd, numbers=["a.b"]).unionByName(P.batch_profile(odd.limit(0), numbers=["a.b"]))
    assert report(P.merged_profile(both))["a.b"]["rows"] == 5
