"""Connected components by star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.session import checkpoint_root


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node it reaches) of every node of ``edges (a, b)``.

    Large and small stars in turn: each node hands its neighbours to its least neighbour, until every edge
    leads to its component's least node. Neighbourhoods are only reduced to a least node and joined back, so a
    hub of any degree is no row and no task of its own; adaptive execution splits its join. The number of
    rounds is about the logarithm of the longest path. Each round is written to the checkpoint folder.
    """
    checkpoint_root(edges.sparkSession)
    # (v, u): v above u.
    links = (
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u"))
        .distinct()
        .checkpoint()
    )
    while True:
        both = links.unionByName(links.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("v").agg(F.min("u").alias("m")).select("v", F.least("v", "m").alias("m"))
        # Large star: the neighbours above a node go to the least of its neighbourhood.
        large = (
            links.select(F.col("u").alias("v"), F.col("v").alias("w")).join(least, "v")
            .where("w <> m").select(F.col("w").alias("v"), F.col("m").alias("u")).distinct()
        )
        # Small star: the neighbours below a node, and the node, go to the least of them.
        low = large.groupBy("v").agg(F.min("u").alias("m"))
        moved = large.join(low, "v")
        small = (
            moved.where("u <> m").select(F.col("u").alias("v"), F.col("m").alias("u"))
            .unionByName(low.select("v", F.col("m").alias("u")))
            .distinct()
            .checkpoint()
        )
        links = small
        # Stars are stable: nobody is both above and below, and nobody has two below.
        ends = links.select(F.col("v").alias("node"), F.lit(1).alias("above")).unionByName(
            links.select(F.col("u").alias("node"), F.lit(0).alias("above"))
        )
        seen = ends.groupBy("node").agg(F.sum("above").alias("above"), F.min("above").alias("least"))
        if not seen.where("above > 1 OR (above = 1 AND least = 0)").limit(1).count():
            break
    nodes = links.select(F.col("v").alias("node"), F.col("u").alias("component"))
    return nodes.unionByName(links.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct())
