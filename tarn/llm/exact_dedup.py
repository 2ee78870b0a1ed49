"""Exact deduplication against a persistent digest index."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarn.llm.common import SPACES, text_of
from tarn.session import checkpoint_root, work_path

BUCKETS = 64


def normalised(text: Column) -> Column:
    """Each run of white space as one space."""
    return F.regexp_replace(text, SPACES, " ")


class DigestIndex:
    """A table ``(digest, keep_id, n_rows)`` bucketed and sorted by digest, kept under ``location``.

    Opening the same location again, also in another session, gives the same index. Rows are only ever
    added, and a digest is added once, so a batch that is run again meets its own rows and changes nothing.
    """

    def __init__(self, spark: SparkSession, location: str, buckets: int = BUCKETS):
        self.spark, self.location, self.buckets = spark, location, buckets
        self.name = f"digest_index_{uuid.uuid5(uuid.NAMESPACE_URL, location).hex}"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} (digest BINARY, keep_id BIGINT, n_rows BIGINT) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{location}'"
        )

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def append(self, fresh: DataFrame) -> None:
        """Add rows of digests that are not in the index; one task writes one bucket."""
        rows = fresh.select("digest", "keep_id", "n_rows").repartition(self.buckets, "digest")
        rows.write.insertInto(self.name)
        self.spark.catalog.refreshTable(self.name)


def deduplicate(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """One row per row of ``docs (doc_id, text)``: ``doc_id, keep_id, group_size, kept, digest``.

    Texts are equal when their normalised forms are; a null text is an empty one. The text is hashed once
    into narrow rows, which are written to the checkpoint folder. A digest's rows are counted before they
    are shuffled, the counts meet the index in a sort-merge anti join, and what is new is appended. Of a
    digest that no earlier batch had, the row with the smallest doc_id stays (null ids last; of rows that
    repeat an id, one). A row whose digest an earlier batch had goes, unless it has the id that was kept
    then (of such rows, one). ``group_size`` counts the rows of this batch and those counted when the digest was added; a batch
    that is run again counts its rows once more. An empty table gives no rows. Other columns are ignored.
    """
    checkpoint_root(docs.sparkSession)
    hashed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.unhex(F.sha2(normalised(text_of()), 256)).alias("digest"),
        F.monotonically_increasing_id().alias("row"),
    ).checkpoint()
    first = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("row")))
    groups = hashed.groupBy("digest").agg(first.alias("first"), F.count("*").alias("n_rows"))
    fresh = groups.join(index.rows().select("digest").hint("merge"), "digest", "left_anti").checkpoint()
    counted = (
        groups.select("digest", "n_rows").alias("g").join(index.rows().alias("i").hint("merge"), "digest")
        .select("digest", "i.keep_id", (F.col("g.n_rows") + F.col("i.n_rows")).alias("n_rows")).checkpoint()
    )
    # Where the kept row comes again, one of its rows stays.
    again = hashed.join(counted.select("digest", "keep_id"), "digest").where(F.col("doc_id").eqNullSafe(F.col("keep_id"))).groupBy("digest").agg(F.min("row").alias("row"))
    known = counted.join(again, "digest", "left").select("digest", "keep_id", F.coalesce("row", F.lit(-1).cast("long")).alias("row"), "n_rows").checkpoint()
    decided = fresh.select("digest", F.col("first.doc_id").alias("keep_id"), F.col("first.row").alias("row"), "n_rows")
    index.append(decided)
    # Both sides are shuffled, so adaptive execution can split a hot digest of the left one.
    return (
        hashed.alias("h")
        .join(decided.unionByName(known).alias("k"), "digest")
        .select(
            "h.doc_id",
            "k.keep_id",
            F.col("k.n_rows").alias("group_size"),
            (F.col("h.row") == F.col("k.row")).alias("kept"),
            "digest",
        )
    )


def new_index(spark: SparkSession) -> DigestIndex:
    """An empty index in the shared folder."""
    return DigestIndex(spark, work_path(spark, "digest-index"))
