"""Digest trees: the same result as a full comparison, and only unequal leaves are opened."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tarn.operators import digests as D
from tarn.operators import landing as L

N = 30_000


@pytest.fixture(scope="module")
def zone(spark):
    return spark.range(N, numPartitions=6).select(
        F.concat(F.lit("texts/text_"), "id").alias("key"), F.when(F.col("id") % 50 != 0, F.col("id") % 9).alias("size")
    ).cache()


def statuses(frame):
    rows = [(r["key"], r["status"]) for r in frame.collect()]
    assert len(rows) == len(set(rows))
    return dict(rows)


def test_equal_zones_open_nothing(zone):
    shuffled = zone.repartition(3).orderBy(F.desc("key"))
    leaves = D.unequal_leaves(D.zone_digests(zone), D.zone_digests(shuffled))
    assert leaves.count() == 0
    assert D.reconcile_tree(zone, shuffled, settled=False).count() == 0
    assert D.reconcile_tree(zone, shuffled).groupBy("status").count().collect() == [("ok", N)]
    branches = D.zone_digests(zone).select("branch").distinct()
    assert branches.count() == 2**D.BRANCH_BITS


def test_one_changed_object_opens_one_leaf(zone):
    changed = zone.withColumn("size", F.when(F.col("key") == "texts/text_77", 99).otherwise(F.col("size")))
    leaves = D.unequal_leaves(D.zone_digests(zone), D.zone_digests(changed))
    assert leaves.count() == 1
    opened = D.open_rows(zone, leaves)
    assert 1 <= opened.count() < 20 and opened.filter("key = 'texts/text_77'").count() == 1
    assert statuses(D.reconcile_tree(zone, changed, settled=False)) == {"texts/text_77": "changed"}
    assert D.reconcile_tree(zone, changed).count() == N


def test_same_result_as_the_full_comparison(zone):
    dest = zone.filter("pmod(hash(key), 10) <> 0").unionByName(
        zone.limit(100).select(F.concat(F.lit("new/"), "key").alias("key"), "size")
    )
    both = zone.withColumn("bucket", F.lit("a")).unionByName(dest.withColumn("bucket", F.lit("b")))
    full = statuses(L.reconcile_zones(both, "a", "b"))
    assert statuses(D.reconcile_tree(zone, dest, marks=())) == full
    assert statuses(D.reconcile_tree(zone, dest)) == full
    assert {s for s in full.values()} == {"ok", "missing", "extra"}
    assert statuses(D.reconcile_tree(zone, dest, settled=False)) == {k: s for k, s in full.items() if s != "ok"}


def test_nulls_and_repeats_are_seen(spark):
    def zone(*rows):
        return spark.createDataFrame(rows, "key string, size long")

    # A null mark is neither 0 nor absent; pairs of repeated rows do not cancel out.
    assert statuses(D.reconcile_tree(zone(("a", None), ("b", 0)), zone(("a", 0), ("b", None)))) == {"a": "changed", "b": "changed"}
    assert statuses(D.reconcile_tree(zone(("a", None)), zone(("a", None)))) == {"a": "ok"}
    assert statuses(D.reconcile_tree(zone(("a", 1), ("a", 1)), zone(("b", 1), ("b", 1)))) == {"a": "missing", "b": "extra"}
    assert statuses(D.reconcile_tree(zone(("a", 1), ("a", 1)), zone(("a", 1)))) == {"a": "ok"}
    none = zone(("a", 1)).limit(0)
    assert statuses(D.reconcile_tree(none, none)) == {}
    assert statuses(D.reconcile_tree(none, zone(("a", 1)))) == {"a": "extra"}
    assert statuses(D.reconcile_tree(zone((None, 1), ("", 1)), none)) == {None: "missing", "": "missing"}


def test_digests_are_brought_up_to_date_by_a_batch(spark, zone, tmp_path):
    before, gone, came = zone.filter("size <> 3"), zone.filter("size = 5"), zone.filter("size = 3")
    after = zone.filter("size <> 5")
    D.zone_digests(before).write.parquet(str(tmp_path / "d"))
    stored = spark.read.parquet(str(tmp_path / "d"))
    updated = D.updated_digests(stored, D.zone_digests(came), D.zone_digests(gone))
    assert sorted(updated.collect()) == sorted(D.zone_digests(after).collect())
    found = statuses(D.reconcile_tree(after, before, source_digests=updated, dest_digests=stored, settled=False))
    assert found == statuses(D.reconcile_tree(after, before, settled=False))
    everything = D.updated_digests(stored, stored.limit(0), stored)
    assert everything.count() == 0


def test_settled_keys_are_not_shuffled(zone):
    digests = D.zone_digests(zone)
    plan = D.reconcile_tree(zone, zone, source_digests=digests, dest_digests=digests)._jdf.queryExecution()
    by_key = [line for line in plan.executedPlan().toString().splitlines() if "hashpartitioning(key" in line]
    assert len(by_key) == 1  # The open leaves of both zones, together.
