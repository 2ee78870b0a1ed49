"""The keyed drain: an object moves once, whatever its name, batch or run."""

from __future__ import annotations

import time

import pytest

from tarn.plans import cases_landing as cases
from tarn.streaming.drain import object_stream, promote_once_stream

SCHEMA = "bucket string, key string, size long, content_type string, content binary"


class Lake:
    def __init__(self, spark, folder):
        self.spark = spark
        self.source, self.dest, self.progress = (str(folder / n) for n in ("in", "out", "progress"))

    def arrive(self, *files):
        rows = [
            ("landing-zone", key, None if body is None else len(body), kind, None if body is None else bytearray(body))
            for key, body, kind in files
        ]
        self.spark.createDataFrame(rows, SCHEMA).repartition(3).write.mode("append").parquet(self.source)

    def run(self, **options):
        stream = object_stream(self.spark, self.source, SCHEMA)
        promote_once_stream(stream, self.dest, self.progress, 100, **options).awaitTermination()
        moved = self.spark.read.parquet(self.dest).select("key", "content").collect()
        return sorted((r["key"].removeprefix("temporal-landing/"), r["content"] and bytes(r["content"])) for r in moved)


def text(name, body):
    return f"temporal-landing/{name}", body, "text/plain"


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, tmp_path)


def test_an_object_moves_once(lake):
    lake.arrive(text("a.txt", b"alpha"), text("b.txt", b"beta"))
    first = lake.run()
    assert first == [("a.txt", b"alpha"), ("b.txt", b"beta")]
    # Nothing new, the same files again, other names, and a repeat within the batch.
    assert lake.run() == first
    lake.arrive(text("a.txt", b"alpha"), text("renamed.txt", b"beta"))
    assert lake.run() == first
    lake.arrive(text("late.txt", b"alpha"), text("c.txt", b"gamma"))
    assert lake.run() == [*first, ("c.txt", b"gamma")]


def test_equal_bytes_of_another_type_and_rows_without_content_are_objects_of_their_own(lake):
    lake.arrive(
        text("a.txt", b"x"),
        ("temporal-landing/a.png", b"x", "image/png"),
        text("n1.txt", None),
        text("n2.txt", None),
        ("temporal-landing/untyped", b"x", None),
    )
    names = [name for name, _ in lake.run()]
    assert names == ["a.png", "a.txt", "n1.txt", "n2.txt", "untyped"]


def test_marks_and_other_prefixes_are_no_first_arrivals(lake):
    lake.arrive(text("folder/", b""), ("elsewhere/a.txt", b"alpha", "text/plain"))
    lake.arrive(text("empty.txt", b""), text("a.txt", b"alpha"))
    assert lake.run() == [("a.txt", b"alpha"), ("empty.txt", b"")]


def test_one_content_under_very_many_names(lake):
    lake.arrive(*(text(f"{i}.txt", b"same") for i in range(3000)), text("other.txt", b"other"))
    moved = lake.run()
    assert sorted(body for _, body in moved) == [b"other", b"same"]


def test_after_its_expiry_an_object_counts_as_new(lake):
    short = {"expiry": "1 second"}
    lake.arrive(text("a.txt", b"alpha"))
    assert len(lake.run(**short)) == 1
    time.sleep(3)
    lake.arrive(text("b.txt", b"beta"))
    assert len(lake.run(**short)) == 2
    lake.arrive(text("a.txt", b"alpha"))
    assert [name for name, _ in lake.run(**short)] == ["a.txt", "a.txt", "b.txt"]


def test_the_rows_of_one_identity_are_dealt_to_many_tasks(spark, lake):
    from tarn.streaming.drain import content_identity, first_arrivals

    lake.arrive(text("a.txt", b"alpha"))
    stream = first_arrivals(object_stream(spark, lake.source, SCHEMA), content_identity())
    plan = stream._jdf.queryExecution().logical().toString()
    first_step = [line for line in plan.splitlines() if "Deduplicate" in line][-1]
    assert "_salt" in first_step and "_identity" in first_step


@pytest.mark.parametrize("files", [1, 3])
def test_registered_streams_read_a_table_of_files(spark, tmp_path, files):
    rows = [(i, f"text {i // 2}", "en", "web", 6) for i in range(6)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    table.repartition(files).write.parquet(str(tmp_path / "documents.parquet"))
    # A neighbour that the pattern must not take.
    table.write.parquet(str(tmp_path / "documents.parquet.old"))
    moved = cases.promote_landing_stream_case(spark, str(tmp_path)).collect()
    assert sorted(r["key"] for r in moved) == [f"temporal-landing/text_{i}.txt" for i in range(6)]
    assert cases.promote_once_stream_case(spark, str(tmp_path)).count() == 3
