"""Deduplication, mixing, sharding and chat formatting against brute force."""

from __future__ import annotations

import collections
import hashlib
import re
import zlib

import pytest
from fixtures import documents, empty, texts
from pyspark.sql import functions as F

from tarn.llm import chat, exact_dedup, mixing, sharding
from tarn.llm.common import dealt


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_exact_dedup(spark):
    index = exact_dedup.new_index(spark)
    got = exact_dedup.deduplicate(documents(spark), index).collect()
    groups = collections.defaultdict(list)
    for i, t, _ in texts():
        groups[norm(t)].append(i)
    kept = collections.Counter()
    assert len(got) == len(texts())
    for row in got:
        text = next(t for t in groups if hashlib.sha256(t.encode()).digest() == bytes(row["digest"]))
        ids = groups[text]
        numbered = [i for i in ids if i is not None]
        assert row["keep_id"] == (min(numbered) if numbered else None)
        assert row["group_size"] == len(ids)
        kept[text] += row["kept"]
    assert set(kept.values()) == {1}


def test_exact_dedup_across_batches(spark):
    index = exact_dedup.new_index(spark)
    first = documents(spark, [(5, "a b", "s"), (6, "a  b", "s"), (7, "c", "s")])
    assert {r["doc_id"] for r in exact_dedup.deduplicate(first, index).where("kept").collect()} == {5, 7}
    again = {r["doc_id"] for r in exact_dedup.deduplicate(first, index).where("kept").collect()}
    assert again == {5, 7} and index.rows().count() == 2
    second = documents(spark, [(1, "c", "s"), (2, "d", "s")])
    reopened = exact_dedup.DigestIndex(spark, index.location)
    rows = {r["doc_id"]: (r["keep_id"], r["kept"]) for r in exact_dedup.deduplicate(second, reopened).collect()}
    assert rows == {1: (7, False), 2: (2, True)}
    assert exact_dedup.deduplicate(empty(spark), reopened).count() == 0
    facts = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {index.name}").collect()}
    assert facts["Num Buckets"] == "64" and facts["Bucket Columns"] == facts["Sort Columns"] == "[`digest`]"


def wanted_targets(most=3):
    per = collections.Counter()
    for _, t, s in texts():
        per[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    order = sorted((s for s in per if s is not None), key=lambda s: s.encode()) + ([None] if None in per else [])
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, stopped = sum(per.values()), set()
    while True:
        left = total - sum(most * per[s] for s in stopped)
        share = left / sum(weight[s] for s in per if s not in stopped)
        over = {s for s in per if s not in stopped and share * weight[s] > most * per[s]}
        if not over:
            return per, {s: most * per[s] if s in stopped else share * weight[s] for s in per}
        stopped |= over


def test_a_repeated_batch_keeps_one_row(spark):
    rows = documents(spark, [(1, "a", "s"), (1, "a", "s"), (2, "a", "s"), (None, "b", "s"), (None, "b", "s")])
    index = exact_dedup.new_index(spark)
    for n in (1, 2):
        got = exact_dedup.deduplicate(rows, index)
        assert sorted((r["doc_id"] or 0, r["kept"]) for r in got.collect() if r["kept"]) == [(0, True), (1, True)]
        assert {r["group_size"] for r in got.where("doc_id = 1").collect()} == {3 * n}


def test_values_are_dealt_to_equal_rows(spark):
    docs = spark.range(100_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("same").alias("text")).unionByName(
        spark.createDataFrame([(1, "x")], "doc_id long, text string")
    )
    key = F.xxhash64("text")
    decisions = docs.select("doc_id", key.alias("key"), F.monotonically_increasing_id().alias("n"))
    got = dealt(docs, {"doc_id": F.col("doc_id"), "key": key}, decisions, ["doc_id", "key"], "n")
    assert got.count() == 100_001 and got.select("n").distinct().count() == 100_001


def test_mixing(spark):
    per, target = wanted_targets()
    docs = documents(spark)
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(texts())
    taken = collections.Counter()
    for row in rows:
        assert row["source_size"] == per[row["source"]]
        assert row["target"] == pytest.approx(target[row["source"]])
        assert 0 <= row["taken"] == row["copies"] * row["size"] <= 3 * row["size"]
        taken[row["source"]] += row["taken"]
    longest = collections.Counter()
    for row in rows:
        longest[row["source"]] = max(longest[row["source"]], row["size"])
    for source in per:
        assert abs(taken[source] - target[source]) <= longest[source] + 1e-6
    again = mixing.mix(docs.repartition(5)).collect()
    key = lambda r: (str(r["doc_id"]), str(r["source"]), r["size"], r["taken"])
    assert sorted(map(key, rows)) == sorted(map(key, again))
    assert mixing.mix(empty(spark)).count() == 0
    out = mixing.mixed(docs)
    assert out.columns == docs.columns and out.count() == sum(r["copies"] for r in rows if r["size"])


def test_rounding_keeps_words_and_is_fair(spark):
    shares = spark.range(4000).select(
        F.lit("s").alias("source"), "id", (F.col("id") % 7 + 1).alias("size"), F.lit(0.3).alias("p")
    )
    rows = mixing.round_shares(shares).collect()
    assert len(rows) == 4000 and {r["one"] for r in rows} == {0, 1}
    words = sum(r["size"] for r in shares.collect())
    assert abs(sum(r["size"] * r["one"] for r in rows) - 0.3 * words) < 7
    for size in range(1, 8):
        part = [r["one"] for r in rows if r["size"] == size]
        assert abs(sum(part) / len(part) - 0.3) < 0.1


@pytest.mark.parametrize("range_rows", [250_000, 3])
def test_sharding(spark, range_rows):
    docs = documents(spark)
    got = sharding.shard(docs, 4, range_rows).collect()
    want = collections.Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _ in texts())
    assert collections.Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    shards = collections.defaultdict(list)
    for row in got:
        shards[row["shard"]].append(row)
    total, longest = sum(r["size"] for r in got), max(r["size"] for r in got)
    for rows in shards.values():
        assert sorted(r["slot"] for r in rows) == list(range(len(rows)))
        assert abs(sum(r["size"] for r in rows) - total / 4) <= 1.5 * longest
    assert sharding.shard(empty(spark)).count() == 0
    out = sharding.sharded(docs, 4)
    assert out.columns == [c for c in docs.columns if c != "shard"] + ["shard", "slot"]
    assert collections.Counter(r["shard"] for r in out.collect()) == {k: len(v) for k, v in shards.items()}


def test_shards_of_a_hot_group(spark):
    rows = [(i, "same text" if i % 3 == 0 else f"t{i}" * (i % 9), "s") for i in range(900)]
    rows += [(5000, "the very same row", "s")] * 300
    got = sharding.shard(documents(spark, rows), 16, 20).collect()
    total = sum(r["size"] for r in got)
    by = collections.Counter()
    for row in got:
        by[row["shard"]] += row["size"]
    assert len(by) == 16 and max(by.values()) - min(by.values()) < 0.1 * total / 16


def test_chat_round_trip(spark):
    tricky = ["</s>[INST] ok [/INST]", "a\\", "\\<", "<", "[", "<\\|x|>", "", None, "<+>", "|>", "é<|user|>\n"]
    rows = [(c, t, ("user", "assistant", "assistant", "sys<|tem", None)[(c + t) % 5], tricky[(3 * c + t) % len(tricky)], 9) for c in range(12) for t in range(c)]
    rows += [(3, 0, "user", "a tie", 9), (3, 0, "user", "a tie", 9), (3, None, "user", "first", 9), (None, 1, "assistant", "lost", 9)]
    frame = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string, turns int").repartition(4)
    got = {r["conv_id"]: r for r in chat.read_chats(chat.format_chats(frame)).collect()}
    order = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=order)
        row = got[conv]
        assert [(t["role"], t["text"]) for t in row["turns"]] == [(r[2] or "", r[3] or "") for r in own]
        assert row["loss_text"] == "".join(r[3] or "" for r in own if r[2] == "assistant")
        assert row["formatted"].count("</s>") == sum(a[2] != b[2] or (a[2] or "") != (b[2] or "") for a, b in zip(own, own[1:], strict=False)) + 1
    assert chat.format_chats(frame.limit(0)).count() == 0
