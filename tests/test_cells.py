"""Stored cells: exact and approximate searches against brute force."""

from __future__ import annotations

import os

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_retrieval import asked, brute, collection, ranked

from tarn.operators import cells as C
from tarn.operators import retrieval as R
from tarn.plans import cases_search, views


@pytest.fixture(scope="module")
def clustered():
    random = np.random.default_rng(11)
    centres = random.normal(size=(40, 16))
    matrix = np.repeat(centres, 50, axis=0) + random.normal(size=(2000, 16)) * 0.05
    matrix[100:150] = matrix[100]  # copies
    return matrix[::97] + random.normal(size=matrix[::97].shape) * 0.02, matrix


def share(index, queries, k, probes):
    """Rows in visited cells over all pairs."""
    facts = index._facts()
    visits = index._visits(R.asked_vectors(queries), facts, k, probes).collect()
    size = dict(zip(facts[0].tolist(), facts[1].tolist(), strict=True))
    return sum(size[v["cell"]] for v in visits) / (queries.count() * sum(size.values()))


@pytest.mark.parametrize("k", [1, 10, 60, 5000])
def test_pivots_give_the_exact_neighbours(spark, tmp_path, clustered, k):
    queries, matrix = clustered
    far = np.concatenate((queries[:6], queries[:2] + 30))
    index = C.CellIndex.build(collection(spark, matrix), str(tmp_path / "index"))
    assert ranked(index.nearest(asked(spark, far), k)) == brute(far, matrix, k)
    assert ranked(R.knn(asked(spark, far), collection(spark, matrix), k)) == brute(far, matrix, k)


def test_clusters_need_few_pairs(spark, tmp_path, clustered):
    queries, matrix = clustered
    index = C.CellIndex.build(collection(spark, matrix), str(tmp_path / "index"), C.fitted_centres(collection(spark, matrix), 40))
    want = brute(queries, matrix, 10)
    got = index.search(asked(spark, queries), 10, 2)
    assert share(index, asked(spark, queries), 10, 2) < 0.1
    found = ranked(got)
    assert set(found) == set(want) and np.mean([len(set(found[q]) & set(want[q])) / 10 for q in want]) >= 0.9
    proven = {r["query_id"] for r in got.where("certain").collect()}
    assert proven and all(found[q] == want[q] for q in proven)


def test_additions_and_odd_queries(spark, tmp_path, clustered):
    queries, matrix = clustered
    whole = collection(spark, matrix)
    index = C.CellIndex.build(whole.where("id % 2 = 0"), str(tmp_path / "index"), C.axis_centres(16))
    index.add(whole.where("id % 2 = 1"))
    assert index.rows().count() == 2000
    odd = asked(spark, queries[:3]).unionByName(spark.createDataFrame([("nothing", None)], "query_id string, embedding array<double>"))
    assert ranked(index.nearest(odd, 7)) == brute(queries[:3], matrix, 7)
    assert index.nearest(odd.limit(0), 7).count() == 0 and index.search(odd.limit(0), 7).count() == 0
    # A single probe holds too few rows for this many neighbours, so further cells are visited.
    assert {q: len(v) for q, v in ranked(index.search(odd, 500, 1)).items()} == {"q0": 500, "q1": 500, "q2": 500}
    same = asked(spark, np.repeat(queries[:1], 5, axis=0)).withColumn("query_id", F.lit("q0"))
    assert index.nearest(same, 2).count() == 10
    with pytest.raises(Exception, match="width"):
        index.nearest(asked(spark, queries[:, :5])).collect()
    empty = C.CellIndex.build(whole.limit(0), str(tmp_path / "empty"), C.axis_centres(16))
    assert empty.nearest(asked(spark, queries), 3).count() == 0
    assert C.knn_approx(asked(spark, queries), whole.limit(0), 3).count() == 0


def test_only_visited_cells_are_read(spark, tmp_path, clustered):
    index = C.CellIndex.build(collection(spark, clustered[1]), str(tmp_path / "index"), C.axis_centres(16))
    plan = index.in_cells([3, 4])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [cell" in plan
    assert {r["cell"] for r in index.in_cells([3, 4]).select("cell").distinct().collect()} <= {3, 4}


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_recall_of_the_registered_defaults(spark, sf):
    if not os.path.isdir(sf):
        pytest.skip("no test tables")
    stored = views.vectors(spark, sf)
    queries = stored.filter(F.col("id").cast("long") % 100 == 0).select(F.col("id").alias("query_id"), "embedding")
    want = ranked(R.knn(queries, stored, 10))
    for got in (ranked(cases_search.knn_approx(spark, sf)), ranked(C.knn_approx(queries, stored, 10))):
        assert len(want) >= 5 and set(got) == set(want)
        recall = np.mean([len(set(got[q]) & set(want[q])) / 10 for q in want])
        print(sf, recall)
        assert recall >= 0.9
