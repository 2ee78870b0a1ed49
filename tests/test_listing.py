"""Object listings: all files, empty ones and marks; only asked folders are opened."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, In, StringStartsWith

from tarn.operators import landing as L
from tarn.operators import media as M
from tarn.sources.listing import ListingReader, _outermost, object_listing

FILES = {
    "temporal-landing/a.txt": b"hello",
    "temporal-landing/empty.png": b"",
    "temporal-landing/video_1.mp4": b"123",
    "persistent-landing/texts/t 1.txt": b"x",
    "persistent-landing/texts/deep/t2.txt": b"",
    "persistent-landing/images/é.JPG": b"12",
    "top.bin": b"1234",
}
MARKS = {"persistent-landing/videos/", "quarantine/"}


@pytest.fixture
def tree(tmp_path):
    root = tmp_path / "bucket"
    for key, body in FILES.items():
        (root / key).parent.mkdir(parents=True, exist_ok=True)
        (root / key).write_bytes(body)
    for mark in MARKS:
        (root / mark).mkdir(parents=True)
    return str(root)


def keys(df):
    return {row["key"]: row["size"] for row in df.collect()}


@pytest.mark.parametrize("address", ["{}", "file://{}", "file:{}", "{}/"])
def test_all_files_and_marks_are_listed(spark, tree, address):
    found = object_listing(spark, address.format(tree), "landing-zone")
    assert keys(found) == {**{k: len(v) for k, v in FILES.items()}, **dict.fromkeys(MARKS, 0)}
    assert found.count() == len(FILES) + len(MARKS)
    row = found.filter(F.col("key") == "persistent-landing/images/é.JPG").first()
    assert (row["bucket"], row["content_type"]) == ("landing-zone", "image/jpeg")
    assert row["modified"].timestamp() == pytest.approx(
        os.path.getmtime(f"{tree}/persistent-landing/images/é.JPG"), abs=1e-3
    )


def test_landing_operators_read_the_listing(spark, tree):
    found = object_listing(spark, tree, "landing-zone")
    assert keys(L.drop_placeholders(found)) == {k: len(v) for k, v in FILES.items()}
    assert keys(L.drop_placeholders(found, strict_zero=True)) == {k: len(v) for k, v in FILES.items() if v}
    purged = {r["key"] for r in M.purge_zero_size(L.drop_placeholders(found)).collect() if r["purge"]}
    assert purged == {k for k, v in FILES.items() if not v}
    assert keys(L.list_objects(found, "landing-zone", "temporal-landing/video_")) == {"temporal-landing/video_1.mp4": 3}


@pytest.mark.parametrize(
    "condition",
    [
        "key LIKE 'persistent-landing/t%'",
        "key LIKE 'persistent-landing/videos/%'",
        "key LIKE 'persistent-landing/%'",
        "startswith(key, '')",
        "key LIKE 'nowhere/x%'",
        "key = 'persistent-landing/texts/deep/t2.txt'",
        "key = 'quarantine/'",
        "key IN ('top.bin', 'temporal-landing/a.txt')",
        "key LIKE 'temporal%' AND size > 3",
        "key LIKE 'temporal%' OR size > 3",
        "key LIKE 'persistent-landing/%' AND key LIKE 'persistent-landing/images/%'",
        "key = 'top.bin' AND key = 'quarantine/'",
        "key IS NULL",
    ],
)
def test_pushed_conditions_change_no_result(spark, tree, condition):
    rows = [(k, len(v)) for k, v in FILES.items()] + [(k, 0) for k in MARKS]
    whole = spark.createDataFrame(rows, "key string, size long")
    found = object_listing(spark, tree, "b").select("key", "size")
    assert keys(found.filter(condition)) == keys(whole.filter(condition))


@pytest.mark.parametrize("prefix, n", [("persistent-landing/t", 2), ("nowhere/", 0), ("persistent-landing/videos/", 1)])
def test_pushed_conditions_meet_named_prefixes(spark, tree, prefix, n):
    found = object_listing(spark, tree, "b", ["persistent-landing", "temporal-landing/", "quarantine"])
    assert found.filter(F.startswith("key", F.lit(prefix))).count() == n


def test_named_prefixes_are_the_partitions(spark, tree):
    found = object_listing(spark, tree, "b", ["persistent-landing/texts/", "persistent-landing/images", "nowhere"])
    assert found.rdd.getNumPartitions() == 3
    assert set(keys(found)) == {k for k in FILES if k.startswith(("persistent-landing/texts", "persistent-landing/im"))}


def opened(tree, filters, prefixes=None):
    reader = ListingReader(tree, "b", prefixes)
    assert list(reader.pushFilters(filters)) == filters
    return {(p.folder, p.deep) for p in reader.partitions()}


def test_only_asked_folders_are_opened(tree):
    assert opened(tree, []) == {("", False), ("persistent-landing", True), ("quarantine", True), ("temporal-landing", True)}
    assert opened(tree, [StringStartsWith(("key",), "temporal-landing/video_")]) == {("temporal-landing", False)}
    assert opened(tree, [StringStartsWith(("key",), "temporal")]) == {("", False), ("temporal-landing", True)}
    assert opened(tree, [StringStartsWith(("key",), "quarantine/")]) == {("quarantine", False)}
    assert opened(tree, [StringStartsWith(("key",), "persistent-landing/te")]) == {
        ("persistent-landing", False),
        ("persistent-landing/texts", True),
    }
    assert opened(tree, [EqualTo(("key",), "persistent-landing/texts/deep/t2.txt")]) == {
        ("persistent-landing/texts/deep", False)
    }
    assert opened(tree, [In(("key",), ("temporal-landing/a.txt", "persistent-landing/images/x.png"))]) == {
        ("temporal-landing", False),
        ("persistent-landing/images", False),
    }
    assert opened(tree, [StringStartsWith(("key",), "persistent-landing/texts/t")], ["persistent-landing", "temporal-landing"]) == {
        ("persistent-landing/texts", True)
    }
    assert opened(tree, [StringStartsWith(("key",), "elsewhere/x")], ["persistent-landing"]) == set()


def test_empty_and_missing_roots(spark, tmp_path):
    assert object_listing(spark, str(tmp_path / "none"), "b").count() == 0
    (tmp_path / "empty").mkdir()
    assert object_listing(spark, str(tmp_path / "empty"), "b").count() == 0
    assert object_listing(spark, str(tmp_path / "empty"), "b", []).count() == 0


def test_outermost_folders():
    assert _outermost(["a/b", "a", "a b", "a/b/c", "c"]) == ["a", "a b", "c"]
    assert _outermost(["x", ""]) == [""]
    assert _outermost([]) == []
