"""A corpus from raw documents to shards: five stages, each over all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tarn.llm import decontaminate, jaccard_join, mixing, sharding, toxicity
from tarn.llm.cases import training_labels
from tarn.llm.common import table
from tarn.session import work_path


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the nearest labelled examples call toxic go."""
    return toxicity.without_toxic(docs, training_labels(spark, sf_dir))


def near_copies_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays."""
    return jaccard_join.one_of_each(docs)


def leaks_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a copy of a benchmark item, edited or not, go."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents come as often as their source's target asks."""
    return mixing.mixed(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row's shard and its place in it are added."""
    return sharding.sharded(docs)


STAGES = [
    ("toxicity", toxic_out),
    ("ngram_jaccard_join", near_copies_out),
    ("decontamination", leaks_out),
    ("mixing", mixed),
    ("sharding", sharded),
]

# Alignments, nearest examples and dependent rounding have no SQL form; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = work_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


CASES = {"pipeline": (run, ORACLE_SQL)}
