"""Nearest neighbours over vector collections ``(id, document, modality, embedding)``."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarn.functions import vectors as V
from tarn.functions.encoders import as_matrix
from tarn.session import checkpoint_root

# Defaults of the searches.
NEIGHBOURS = 5
MODALITIES = ("text", "image", "video")

# Largest part of the query vectors that a task holds, in bytes of doubles.
QUERY_BYTES = 32 << 20
# Kept hits per task: queries x k.
TASK_HITS = 1_000_000
# Collection rows and queries measured at once inside a task, and rows of a group.
_ROWS_AT_ONCE, _QUERIES_AT_ONCE = 4096, 512
GROUP_ROWS = 1 << 16
# Groups between the tasks' hits and the final ranking of a query.
MERGE_GROUPS = 64

_HITS = "query_id string, id string, document string, modality string, distance double, scan_group int"
_HIT_TABLE = pa.schema(
    [("query_id", pa.string()), ("id", pa.string()), ("document", pa.string()), ("modality", pa.string()), ("distance", pa.float64()), ("scan_group", pa.int32())]
)


def _pairwise(queries: np.ndarray, rows: np.ndarray, metric: str) -> np.ndarray:
    """Approximate distances by one matrix product: good enough to find candidates."""
    products = queries @ rows.T
    if metric == "ip":
        return 1.0 - products
    query_sizes, row_sizes = (queries**2).sum(axis=1), (rows**2).sum(axis=1)
    if metric == "l2":
        return query_sizes[:, None] - 2.0 * products + row_sizes[None, :]
    with np.errstate(divide="ignore", invalid="ignore"):
        return 1.0 - products / np.sqrt(query_sizes[:, None] * row_sizes[None, :])


def _exact(query: np.ndarray, rows: np.ndarray, metric: str) -> np.ndarray:
    """Distances computed alike for equal vectors, so that ties stay ties."""
    if metric == "l2":
        return ((rows - query) ** 2).sum(axis=1)
    products = (rows * query).sum(axis=1)
    if metric == "ip":
        return 1.0 - products
    with np.errstate(divide="ignore", invalid="ignore"):
        return 1.0 - products / (np.sqrt((query**2).sum()) * np.sqrt((rows**2).sum(axis=1)))


def _scan(query_ids: list[str], queries: np.ndarray, k: int, metric: str, exclude_self: bool, per_modality: bool):
    """Per task: the k nearest rows of each query (and modality), kept while the rows stream by."""
    from pyspark import TaskContext

    names = list(query_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        group = context.partitionId() % MERGE_GROUPS if context else 0
        # (query, kind of rows) -> distances and labels of the rows kept
        best: dict[tuple[int, str | None], tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for start in range(0, batch.num_rows, _ROWS_AT_ONCE):
                part = batch.slice(start, _ROWS_AT_ONCE)
                rows = as_matrix(part.column("embedding"))
                if rows.shape[1] != queries.shape[1]:
                    raise ValueError("query and collection vectors differ in width")
                labels = [part.column(name) for name in ("id", "document", "modality")]
                kinds = [(None, np.arange(len(rows)))]
                if per_modality:
                    own_kind = labels[2].to_numpy(zero_copy_only=False)
                    present = pc.unique(labels[2]).to_pylist()
                    kinds = [(kind, np.flatnonzero(own_kind == kind)) for kind in present]
                rough = _pairwise(queries, rows, metric)
                # Above the rounding error of the matrix product.
                slack = 1e-12 * (1.0 + (queries**2).sum(axis=1).max() + (rows**2).sum(axis=1).max())
                for q, name in enumerate(names):
                    others = None
                    if exclude_self:
                        others = ~pc.equal(labels[0], name).to_numpy(zero_copy_only=False)
                    for kind, members in kinds:
                        if others is not None:
                            members = members[others[members]]
                        line = rough[q, members]
                        kept = best.get((q, kind))
                        bound = kept[0][-1] if kept is not None and len(kept[0]) == k else np.inf
                        if bound == np.inf and len(line) > k:
                            bound = np.partition(line, k)[k]
                        # Rows within rounding of the k-th are kept for the exact comparison.
                        near = members[~(line > bound + slack)]
                        distances = _exact(queries[q], rows[near], metric)
                        # The cosine of a zero vector is not defined, and such a row is no hit.
                        known = ~np.isnan(distances)
                        near, distances = near[known], distances[known]
                        if len(near) == 0:
                            continue
                        taken = pa.array(near)
                        found = np.column_stack(
                            [label.take(taken).to_numpy(zero_copy_only=False) for label in labels]
                        )
                        if kept is not None:
                            distances = np.concatenate([kept[0], distances])
                            found = np.concatenate([kept[1], found])
                        order = np.lexsort((found[:, 0].astype(str), distances))[:k]
                        best[q, kind] = (distances[order], found[order])
        for (q, _), (distances, found) in best.items():
            n = len(distances)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([names[q]] * n, pa.string()),
                    *(pa.array(found[:, column].tolist(), pa.string()) for column in range(3)),
                    pa.array(distances, pa.float64()),
                    pa.array(np.full(n, group, dtype=np.int32)),
                ],
                names=["query_id", "id", "document", "modality", "distance", "scan_group"],
            )

    return run


def top_k(hits: DataFrame, k: int, within: Sequence[str], name: str = "rank") -> DataFrame:
    """Rank hits by distance and id inside ``within`` and keep the first k.

    Spark cuts each task's part of a group to k rows before the shuffle.
    """
    order = Window.partitionBy(*within).orderBy("distance", "id")
    return hits.withColumn(name, F.row_number().over(order)).filter(F.col(name) <= k)


def knn(
    queries: DataFrame,
    collection: DataFrame,
    k: int = NEIGHBOURS,
    metric: str = "l2",
    exclude_self: bool = False,
    query_bytes: int = QUERY_BYTES,
    per_modality: bool = False,
) -> DataFrame:
    """Exact k nearest rows of every query ``(query_id, embedding)``, or of every query and modality.

    Both sides are tables: rows are dealt once into groups of at most ``GROUP_ROWS``, queries go to each group in parts of about
    ``query_bytes`` of doubles, and a task keeps k hits per query (and modality) of its group. The hits are merged in two
    steps, by query and scan group and then by query. The collection is read once however many queries there are. NULL
    vectors on either side are left out, and so is a zero vector under ``cosine``, whose distance is not defined.
    """
    if metric not in V.METRICS:
        raise ValueError(f"unknown metric {metric!r}; choose from {V.METRICS}")
    rows = collection.select("id", "document", "modality", "embedding").filter(F.col("embedding").isNotNull())
    asked = asked_vectors(queries)
    groups = max(collection.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // GROUP_ROWS))
    parts = query_parts(asked, k, query_bytes)
    left = in_parts(asked, parts).withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    right = rows.withColumn("group", F.pmod(F.monotonically_increasing_id(), F.lit(groups)).cast("int"))
    return _ranked(meet(left, for_parts(right, parts), ["group"], k, metric, exclude_self, per_modality), k, ["modality"] if per_modality else [])


def asked_vectors(queries: DataFrame) -> DataFrame:
    """``query_id, v, query``: the queries with a vector, numbered and written down once."""
    checkpoint_root(queries.sparkSession)
    return (
        queries.filter(F.col("embedding").isNotNull())
        .select("query_id", V.as_double(F.col("embedding")).alias("v"), F.monotonically_increasing_id().alias("query"))
        .checkpoint()
    )


def query_parts(asked: DataFrame, k: int, query_bytes: int = QUERY_BYTES) -> int:
    """In how many parts queries meet a group of rows, so that vectors and kept hits of a part are bounded."""
    size = asked.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("width")).first()
    limit = max(1, min(query_bytes // (8 * max(1, size["width"] or 1)), TASK_HITS // k))
    return max(1, -(-size["n"] // limit))


def in_parts(asked: DataFrame, parts: int) -> DataFrame:
    return asked.withColumn("part", F.pmod(F.xxhash64("query"), F.lit(parts)).cast("int"))


def for_parts(rows: DataFrame, parts: int) -> DataFrame:
    return rows.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))) if parts > 1 else F.lit(0))


def meet(
    asked: DataFrame, rows: DataFrame, keys: Sequence[str], k: int, metric: str = "l2", exclude_self: bool = False, per_modality: bool = False
) -> DataFrame:
    """The k best hits of each query in each group of ``keys`` and ``part``, which both sides carry; groups are bounded by the caller."""
    by = [*keys, "part"]

    def run(queries: pa.Table, group: pa.Table) -> pa.Table:
        batches = group.select(["id", "document", "modality", "embedding"]).to_batches()
        found = []
        for start in range(0, queries.num_rows, _QUERIES_AT_ONCE):
            some = queries.slice(start, _QUERIES_AT_ONCE).combine_chunks()
            names = some.column("query_id").to_pylist()
            found += _scan(names, as_matrix(some.column("v").combine_chunks()), k, metric, exclude_self, per_modality)(iter(batches))
        return pa.Table.from_batches(found, _HIT_TABLE)

    left = asked.select("query_id", "v", *(F.col(c).alias(f"_{c}") for c in by)).groupBy(*(f"_{c}" for c in by))
    return left.cogroup(rows.groupBy(*by)).applyInArrow(run, _HITS)


def _ranked(hits: DataFrame, k: int, within: Sequence[str] = ()) -> DataFrame:
    merged = top_k(hits, k, ["query_id", *within, "scan_group"], "_place")
    return top_k(merged, k, ["query_id", *within]).select(
        "query_id",
        "rank",
        "id",
        "document",
        "modality",
        "distance",
        V.similarity(F.col("distance")).alias("similarity"),
    )


def quota_topk(
    hits: DataFrame, k: int = NEIGHBOURS, modalities: Sequence[str] = ("text", "image")
) -> DataFrame:
    """The first k candidates of each wanted modality, with their place among all those shown."""
    wanted = hits.filter(F.col("modality").isin(*modalities))
    kept = top_k(wanted, k, ["query_id", "modality"], "modality_rank")
    # At most k rows per modality and query reach this window.
    shown = Window.partitionBy("query_id").orderBy("distance", "id")
    return kept.withColumn("rank", F.row_number().over(shown))


def cross_modal_search(
    queries: DataFrame,
    collection: DataFrame,
    k: int = NEIGHBOURS,
    candidates: int | None = None,
    videos: bool = False,
    metric: str = "l2",
) -> DataFrame:
    """The k nearest rows of each modality shown.

    The scan keeps k rows per query and modality, so no modality is lost behind another. With ``candidates``, only that
    many nearest rows over all modalities are considered.
    """
    modalities = MODALITIES if videos else MODALITIES[:2]
    if candidates is not None:
        return quota_topk(knn(queries, collection, candidates, metric), k, modalities)
    shown = collection.filter(F.col("modality").isin(*modalities))
    return quota_topk(knn(queries, shown, k, metric, per_modality=True), k, modalities)


def exclude_self(hits: DataFrame, k: int | None = None) -> DataFrame:
    """Drop the query's own object from its hits, rank again, and keep k."""
    others = hits.filter(F.col("id") != F.col("query_id"))
    order = Window.partitionBy("query_id").orderBy("distance", "id")
    ranked = others.withColumn("rank", F.row_number().over(order))
    return ranked if k is None else ranked.filter(F.col("rank") <= k)


def hydrate_hits(hits: DataFrame, objects: DataFrame, bucket: str = "trusted-zone") -> DataFrame:
    """Fetch the stored object of each hit by key, the bucket name taken off once.

    Hits are few; their size is known when the join is planned at run time.
    """
    key = F.regexp_replace("document", f"^{bucket}/", "")
    return hits.withColumn("key", key).join(objects, "key", "left")


def cosine(distance: str = "distance") -> Column:
    """True cosine of unit vectors from the squared Euclidean distance."""
    return V.cosine_of_l2(F.col(distance))
