"""Searches against brute force."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarn.operators import retrieval as R
from tarn.plans import cases_search as cases

KINDS = (("text", "txt"), ("image", "png"), ("video", "mp4"))


def collection(spark, matrix):
    rows = [
        (str(i), f"trusted-zone/x/{i}.{KINDS[i % 3][1]}", KINDS[i % 3][0], [float(x) for x in v])
        for i, v in enumerate(matrix)
    ]
    schema = "id string, document string, modality string, embedding array<double>"
    return spark.createDataFrame(rows, schema).repartition(6)


def asked(spark, matrix):
    rows = [(f"q{i}", [float(x) for x in v]) for i, v in enumerate(matrix)]
    return spark.createDataFrame(rows, "query_id string, embedding array<double>")


def brute(queries, matrix, k, metric="l2"):
    out = {}
    for q, v in enumerate(queries):
        if metric == "l2":
            d = ((matrix - v) ** 2).sum(axis=1)
        elif metric == "ip":
            d = 1 - matrix @ v
        else:
            d = 1 - matrix @ v / (np.linalg.norm(matrix, axis=1) * np.linalg.norm(v))
        out[f"q{q}"] = [str(i) for _, i in sorted((round(x, 12), str(i)) for i, x in enumerate(d))][:k]
    return {q: ids for q, ids in out.items()}


def ranked(hits):
    out = {}
    for row in sorted(hits.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(row["query_id"], []).append(row["id"])
    return out


@pytest.fixture(scope="module")
def data():
    random = np.random.default_rng(5)
    matrix = random.normal(size=(300, 8))
    matrix[50:90] = matrix[50]  # a third-ish of copies: ties on every distance
    return random.normal(size=(7, 8)), matrix


@pytest.mark.parametrize("metric", ["l2", "cosine", "ip"])
@pytest.mark.parametrize("k", [1, 10, 120, 1000])
def test_knn(spark, data, metric, k):
    queries, matrix = data
    hits = R.knn(asked(spark, queries), collection(spark, matrix), k, metric)
    got, want = ranked(hits), brute(queries, matrix, k, metric)
    assert {q: len(v) for q, v in got.items()} == {q: len(v) for q, v in want.items()}
    assert got == want


def test_knn_in_blocks_equals_one_block(spark, data):
    queries, matrix = data
    hits = R.knn(asked(spark, queries), collection(spark, matrix), 9, query_bytes=2 * 8 * 8)
    assert ranked(hits) == brute(queries, matrix, 9)


def test_stored_query_is_its_own_nearest(spark, data):
    _, matrix = data
    stored = collection(spark, matrix)
    queries = stored.filter("id in ('3', '200')").select(F.col("id").alias("query_id"), "embedding")
    first = R.knn(queries, stored, 1).collect()
    assert {(r["query_id"], r["id"], r["distance"]) for r in first} == {("3", "3", 0.0), ("200", "200", 0.0)}
    others = R.knn(queries, stored, 4, exclude_self=True)
    same = R.exclude_self(R.knn(queries, stored, 5), 4)
    assert ranked(others) == ranked(same)


def test_no_queries_and_wrong_width(spark, data):
    queries, matrix = data
    stored = collection(spark, matrix)
    assert R.knn(asked(spark, queries).limit(0), stored).count() == 0
    with pytest.raises(Exception, match="width"):
        R.knn(asked(spark, queries[:, :5]), stored).collect()
    with pytest.raises(ValueError):
        R.knn(asked(spark, queries), stored, metric="hamming")


def test_quota(spark, data):
    queries, matrix = data
    order = brute(queries, matrix, 100)
    for videos in (False, True):
        hits = R.cross_modal_search(asked(spark, queries), collection(spark, matrix), 5, 100, videos)
        kinds = ("text", "image", "video")[: 3 if videos else 2]
        want = {}
        for q, ids in order.items():
            left = dict.fromkeys(kinds, 5)
            want[q] = []
            for i in ids:
                kind = KINDS[int(i) % 3][0]
                if left.get(kind, 0) > 0:
                    left[kind] -= 1
                    want[q].append(i)
        assert ranked(hits) == want


def test_no_modality_is_lost_behind_another(spark):
    random = np.random.default_rng(8)
    near, far = random.normal(size=(2500, 6)) * 0.01, random.normal(size=(2, 6)) + 50
    rows = [(f"t{i}", "d", "text", v.tolist()) for i, v in enumerate(near)] + [(f"i{i}", "d", "image", v.tolist()) for i, v in enumerate(far)]
    stored = spark.createDataFrame(rows, "id string, document string, modality string, embedding array<double>").repartition(5)
    hits = R.cross_modal_search(asked(spark, np.zeros((1, 6))), stored).collect()
    assert [r["modality"] for r in sorted(hits, key=lambda r: r["rank"])] == ["text"] * 5 + ["image"] * 2
    apart = {r["id"]: r["distance"] for r in hits}
    assert apart["i0"] == pytest.approx((far[0] ** 2).sum()) and set(apart) >= {"i0", "i1"}


def test_null_and_zero_vectors_are_no_hits(spark, data):
    queries, matrix = data
    odd = spark.createDataFrame([("null", "d", "text", None), ("zero", "d", "text", [0.0] * 8)], collection(spark, matrix).schema)
    stored = collection(spark, matrix).unionByName(odd)
    more = asked(spark, queries).unionByName(spark.createDataFrame([("nothing", None)], "query_id string, embedding array<double>"))
    assert ranked(R.knn(more, stored, 1000, "cosine")) == brute(queries, matrix, 1000, "cosine")
    assert "zero" in ranked(R.knn(more, stored, 1000))["q0"] and "null" not in ranked(R.knn(more, stored, 1000))["q0"]


def test_repeated_query_ids_in_blocks(spark, data):
    queries, matrix = data
    same = asked(spark, np.repeat(queries[:1], 60, axis=0)).withColumn("query_id", F.lit("q0"))
    got = R.knn(same, collection(spark, matrix), 3, query_bytes=5 * 8 * 8)
    assert got.select("query_id").distinct().count() == 1


def test_hydrate(spark):
    hits = spark.createDataFrame([("q", "1", "trusted-zone/texts/a.txt"), ("q", "2", "trusted-zone/trusted-zone/b.txt")], "query_id string, id string, document string")
    objects = spark.createDataFrame([("texts/a.txt", "A"), ("trusted-zone/b.txt", "B")], "key string, text string")
    assert {(r["id"], r["text"]) for r in R.hydrate_hits(hits, objects).collect()} == {("1", "A"), ("2", "B")}


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Vectors of three labels; two ids are divisible by 100."""
    folder = tmp_path_factory.mktemp("stored")
    random = np.random.default_rng(5)
    rows = [(i, random.normal(size=8).tolist(), i % 3) for i in (0, 1, 2, 50, 99, 100, 101, 102, 103, 104)]
    rows.append((105, None, 0))
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{folder}/embeddings.parquet")
    return str(folder)


VIDEOS_AND_HUNDREDTHS = {"video_0", "video_1", "video_2", "0", "100"}


def asked_by(hits):
    return {r["query_id"] for r in hits.select("query_id").distinct().collect()}


def test_metrics_are_asked_by_videos_and_hundredths(spark, stored):
    for metric in ("cosine", "ip"):
        assert asked_by(cases.knn_metrics(spark, stored).filter(F.col("metric") == metric)) == VIDEOS_AND_HUNDREDTHS


def test_similarity_is_asked_by_videos_and_hundredths(spark, stored):
    assert asked_by(cases.similarity(spark, stored)) == VIDEOS_AND_HUNDREDTHS


def test_cross_modal_search_is_asked_by_means_and_hundredths(spark, stored):
    held = {(("text", "image", "video")[r["vec_id"] % 3], r["label"]) for r in spark.read.parquet(f"{stored}/embeddings.parquet").collect()}
    expected = {f"{kind}-{label}" for kind, label in held} | {"0", "100"}
    assert asked_by(cases.cross_modal_search(spark, stored)) == expected


def test_stored_videos_ask_and_are_found(spark, stored):
    hits = cases.exclude_self(spark, stored)
    assert asked_by(hits) == VIDEOS_AND_HUNDREDTHS
    # Ten vectors and three videos are stored, so a query finds the ten nearest of twelve others.
    assert hits.filter("id LIKE 'video%'").count() > 0 and hits.count() == 50
    assert hits.filter("id = query_id").count() == 0


def test_hash_encode_stays_within_what_the_jvm_compiles(spark, capsys):
    import re

    from tarn.functions.encoders import encode_column, hash_encoder
    from tarn.operators import embeddings as EM

    rows = [("a", "one two two  three four"), ("b", ""), ("c", None), ("c", "one"), (None, "x y")]
    docs = spark.createDataFrame(rows, "key string, text string")
    for width in (64, 100):
        encoded = EM.hash_encode(docs, width)
        want = docs.select("key", encode_column(F.col("text"), hash_encoder(width)).alias("embedding"))
        assert [r["embedding"] for r in encoded.collect()] == [r["embedding"] for r in want.collect()]
    EM.hash_encode(docs).explain("codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    # Methods of 8,000 bytes and more are interpreted.
    assert sizes and max(sizes) < 8000
