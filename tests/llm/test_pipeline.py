"""The pipeline against a plain reading of its stages, and the registered queries on the smallest tables."""

from __future__ import annotations

import collections
import os
import re

import pytest
from fixtures import words
from test_search import components_of, linked, shingles

import corpus_pipeline
from tarn.llm.cases import CASES, held_out

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def tables(spark, root):
    item = words(5000, 40, 10_000)
    rows, labels = [], []
    for i in range(300):
        own = words(i, 60, 3000) + (["vile", "nasty"] if i % 4 == 0 else [])
        rows.append((i, " ".join(own), "en", f"s{i % 5}", 0))
        labels.append((i, 1, int(i % 4 == 0)))
    for i in range(300, 340):  # copies of one text, some edited
        copy = words(1, 60, 3000)
        copy[i % 60] = f"e{i}"
        rows.append((i, " ".join(copy), "en", None, 0))
    rows += [(400 + i, " ".join(words(400 + i, 30) + item), "en", "s1", 0) for i in range(5)]
    rows += [(500, None, "en", "s2", 0), (501, "", None, None, 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame([(1, " ".join(item))], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return rows


def test_pipeline(spark, tmp_path):
    rows = tables(spark, tmp_path)
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    clean = {r[0]: r for r in rows if not (r[0] < 300 and r[0] % 4 == 0)}
    sets = {i: shingles(r[1]) for i, r in clean.items()}
    ids = sorted(sets)
    group = components_of(ids, [(a, b) for b in ids for a in ids if a < b and linked(sets[a], sets[b])])
    kept = {i for i in ids if group[i] == i and not 400 <= i < 405}
    size = {i: len((clean[i][1] or "").split()) for i in kept}
    copies = collections.Counter(r["doc_id"] for r in got)
    assert set(copies) <= {i for i in kept if size[i]} and max(copies.values()) <= 3
    per = collections.Counter()
    for i in kept:
        per[clean[i][3]] += size[i]
    taken = collections.Counter()
    for i, n in copies.items():
        taken[clean[i][3]] += n * size[i]
    order = sorted(s for s in per if s is not None) + ([None] if per[None] else [])
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    left, stopped = sum(per.values()), set()
    while True:
        share = (left - sum(3 * per[s] for s in stopped)) / sum(weight[s] for s in order if s not in stopped)
        over = {s for s in order if s not in stopped and share * weight[s] > 3 * per[s]}
        if not over:
            break
        stopped |= over
    for s in order:
        assert abs(taken[s] - (3 * per[s] if s in stopped else share * weight[s])) <= 64
    for row in got:
        assert (row["text"], row["lang"], row["source"]) == clean[row["doc_id"]][1:4]
    shards = collections.defaultdict(list)
    for row in got:
        shards[row["shard"]].append(row)
    assert set(shards) == set(range(16))
    total = sum(len(r["text"].encode()) + 1 for r in got)
    for part in shards.values():
        assert sorted(r["slot"] for r in part) == list(range(len(part)))
        assert abs(sum(len(r["text"].encode()) + 1 for r in part) - total / 16) < 1000


def test_stage_columns(spark, tmp_path):
    tables(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, empty, str(tmp_path))
        assert out.columns == docs.columns + (["shard", "slot"] if name == "sharding" else []) and out.count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", [n for n, case in CASES.items() if case[1]])
def test_queries_with_sql(spark, name):
    from oracle import compare, connect

    assert compare(spark, connect(SF), name, CASES[name], SF) is None


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_contract_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    n = docs.count()
    for name in ("op3_jaccard_join", "op4_mixing", "op5_sharding", "op8_toxicity", "op10_secret_scans"):
        frame = CASES[name][0](spark, SF)
        rows = frame.collect()
        assert len(rows) == n and sorted(r["doc_id"] for r in rows) == sorted(r["doc_id"] for r in docs.collect())
        if name == "op8_toxicity":
            want = {r["doc_id"]: r["h"] for r in docs.select("doc_id", held_out().alias("h")).collect()}
            assert all(r["held_out"] == want[r["doc_id"]] and (r["score"] >= 0.7) == (r["predicted"] == 1) for r in rows)
        if name == "op4_mixing":
            size = {r["doc_id"]: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for r in docs.collect()}
            assert all(r["size"] == size[r["doc_id"]] for r in rows)
