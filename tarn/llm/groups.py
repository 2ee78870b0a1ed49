"""Links among sets, and among all sets of a group whatever its size."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A block of a dense group: texts and shingles, at most (one larger text is a block).
BLOCK_ROWS, BLOCK_TOKENS = 512, 1_000_000


def links_of(pairs: DataFrame, percent: int) -> DataFrame:
    """The ``(a, b)`` of ``pairs (a, b, left, right)`` whose sets, each without repeats, link."""
    shared = pairs.select("a", "b", F.size("left").cast("long").alias("x"), F.size("right").cast("long").alias("y"), F.size(F.array_intersect("left", "right")).cast("long").alias("n"))
    return shared.where(100 * F.col("n") >= percent * (F.col("x") + F.col("y") - F.col("n"))).select("a", "b")


def linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs ``(a, b)`` of set numbers whose sets ``(set, tokens)`` link."""
    left = sets.select(F.col("set").alias("a"), F.col("tokens").alias("left"))
    right = sets.select(F.col("set").alias("b"), F.col("tokens").alias("right"))
    return links_of(pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right"), percent)


def _forest(percent: int):
    """Links between two blocks of a dense group, as many as keep what they connect connected."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        members = frame.drop_duplicates("set").sort_values(["n", "set"])
        ids = members["set"].to_numpy()
        fresh = members["fresh"].to_numpy()
        ns = members["n"].to_numpy()
        part = members["part"].to_numpy()
        sets = [np.asarray(t) for t in members["tokens"]]
        tokens, place, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        shared = count > 1
        column = np.cumsum(shared) - 1
        owner = np.repeat(np.arange(len(ids)), ns)
        use = shared[place]
        rows, cols = owner[use], column[place[use]]
        # A text links to nobody here if too few of its shingles are anybody else's.
        able = np.bincount(rows, minlength=len(ids)) * 100 >= percent * ns
        rows, cols = rows[able[rows]], cols[able[rows]]
        order = np.argsort(cols, kind="stable")
        rows, cols = rows[order], cols[order]
        overlap = np.zeros((len(ids), len(ids)), np.float32)
        width = 2048
        for low in range(0, int(cols[-1]) + 1 if len(cols) else 0, width):
            a, b = np.searchsorted(cols, [low, low + width])
            matrix = np.zeros((len(ids), width), np.float32)
            matrix[rows[a:b], cols[a:b] - low] = 1
            overlap += matrix @ matrix.T
        inter = overlap.astype(np.int64)
        link = 100 * inter >= percent * (ns[:, None] + ns[None, :] - inter)
        link &= np.triu(np.ones_like(link), 1) & (fresh[:, None] | fresh[None, :])
        if len(np.unique(part)) > 1:
            link &= part[:, None] != part[None, :]
        parent = np.arange(len(ids))

        def root(i: int) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        edges = []
        for i, j in zip(*np.nonzero(link), strict=True):
            x, y = root(i), root(j)
            if x != y:
                parent[y] = x
                edges.append((ids[i], ids[j]))
        return pd.DataFrame(edges, columns=["a", "b"], dtype=np.int64)

    return run


def dense_links(hot: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links among sets whose prefixes are hot: ``hot (token, set, n)``.

    The sets of a token are gathered under the least of them, its hub; tokens with one hub make one group, and two sets
    that share a token share a group. Each set is first checked against the hub. Those that link to it need no check
    among themselves; the others are checked against all of the group in blocks of bounded size, a task for each pair of
    blocks, which gives as few links as keep its sets connected. Blocks are cut by length, and pairs of blocks
    whose lengths rule a link out are left out.
    """
    firsts = hot.groupBy("token").agg(F.min("set").alias("grp"))
    members = hot.join(firsts, "token").select("grp", "set", "n").distinct().checkpoint()
    spokes = members.where("set <> grp").select(F.col("grp").alias("a"), F.col("set").alias("b"))
    close = linked(spokes, sets, percent).checkpoint()
    near = close.select(F.col("a").alias("grp"), F.col("b").alias("set"), F.lit(True).alias("near"))
    # Blocks: ranges of length in quarter powers of two, cut by hash to the block's size.
    sized = (
        members.join(near, ["grp", "set"], "left")
        .select("grp", "set", "n", (F.col("near").isNull() & (F.col("set") != F.col("grp"))).alias("fresh"))
        .withColumn("band", F.floor(F.log2("n") * 4).cast("int"))
        .checkpoint()
    )
    per = sized.groupBy("grp", "fresh", "band").agg(F.count("*").alias("rows"), F.sum("n").alias("total"), F.min("n").alias("low"), F.max("n").alias("high"))
    per = per.withColumn("cuts", F.ceil(F.greatest(F.col("rows") / BLOCK_ROWS, F.col("total") / BLOCK_TOKENS))).checkpoint()
    blocked = sized.join(per.select("grp", "fresh", "band", "cuts"), ["grp", "fresh", "band"]).withColumn(
        "cut", F.pmod(F.xxhash64("set"), F.col("cuts"))
    )
    blocks = per.select("grp", "fresh", "band", "low", "high", F.explode(F.sequence(F.lit(0).cast("long"), F.col("cuts") - 1)).alias("cut"))
    left, right = blocks.alias("x"), blocks.alias("y")
    name = lambda s: F.struct(f"{s}.band", f"{s}.cut", f"{s}.fresh")
    meets = left.join(
        right,
        (F.col("x.grp") == F.col("y.grp"))
        & F.col("x.fresh")
        & (~F.col("y.fresh") | (name("x") <= name("y")))
        & (F.col("x.low") * percent <= F.col("y.high") * 100)
        & (F.col("y.low") * percent <= F.col("x.high") * 100),
    ).select(
        F.monotonically_increasing_id().alias("task"),
        F.array(
            F.struct("x.grp", "x.fresh", "x.band", "x.cut", F.lit(0).alias("part")),
            F.struct("y.grp", "y.fresh", "y.band", "y.cut", F.when(name("x") == name("y"), 0).otherwise(1).alias("part")),
        ).alias("two"),
    ).checkpoint()
    sides = meets.select("task", F.inline("two")).distinct()
    work = (
        sides.join(blocked, ["grp", "fresh", "band", "cut"]).select("task", "part", "set", "n", "fresh")
        .join(sets.select("set", "tokens"), "set")
    )
    crossed = work.groupBy("task").applyInPandas(_forest(percent), "a long, b long")
    return close.unionByName(crossed)
