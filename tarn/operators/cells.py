"""Vectors stored by cell: approximate search of the nearest cells, and exact search by the triangle inequality.

Every vector lies with the nearest of some centres, its pivot. For a query at distance d of a pivot, no row of its cell is nearer than
``d - high`` or ``low - d``, where ``low`` and ``high`` are the least and greatest distances of the cell's rows from the pivot.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarn.functions import vectors as V
from tarn.functions.encoders import as_matrix
from tarn.operators import retrieval as R
from tarn.session import checkpoint_root, work_path

# Rows that centres are fitted on, drawn by the hash of their ids, and cells unless said otherwise.
FIT_ROWS, CELLS = 20_000, 64
# The share of the cells that an approximate search visits: what vectors without any clusters need for a recall of 0.9. Clustered ones need a few cells.
PROBES = 0.6
# Above the rounding error of distances.
_SLACK = 1e-9


def axis_centres(width: int) -> np.ndarray:
    """Centres by a formula: both directions of every axis. A vector's cell is that of its greatest component."""
    one = np.eye(width)
    return np.stack((one, -one), axis=1).reshape(2 * width, width)


def fitted_centres(vectors: DataFrame, cells: int = CELLS, rows: int = FIT_ROWS, seed: int = 7) -> np.ndarray:
    """Centres by k-means on at most ``rows`` vectors, those whose ids have the least hashes. Fewer rows than cells give a cell each, at most."""
    drawn = (
        vectors.filter(F.col("embedding").isNotNull()).orderBy(F.xxhash64("id"), "id").limit(rows)
        .select(array_to_vector(V.as_double(F.col("embedding"))).alias("features"))
    )
    if not drawn.limit(1).count():
        return np.zeros((0, 0))
    if drawn.limit(2).distinct().count() < 2 or cells < 2:
        return np.array([drawn.first()["features"].toArray()])
    return np.array(KMeans(k=cells, seed=seed, maxIter=10).fit(drawn).clusterCenters())


def _apart(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """What orders the centres of a row by distance: the squared distance without the row's own square."""
    return (centres**2).sum(axis=1) - 2.0 * rows @ centres.T


def assign(vectors: DataFrame, centres: np.ndarray) -> DataFrame:
    """Add ``cell``, the nearest centre (the first of equally near ones), and ``apart``, the distance from it. Rows without vector go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells, apart = np.zeros(0, np.int32), np.zeros(0)
            if batch.num_rows:
                rows = as_matrix(batch.column("embedding"))
                if rows.shape[1] != centres.shape[1]:
                    raise ValueError("vectors and centres differ in width")
                cells = _apart(rows, centres).argmin(axis=1).astype(np.int32)
                apart = np.sqrt(((rows - centres[cells]) ** 2).sum(axis=1))
            columns = [batch.column(c) for c in ("id", "document", "modality", "embedding")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(cells), pa.array(apart)], names=["id", "document", "modality", "embedding", "cell", "apart"])

    rows = vectors.filter(F.col("embedding").isNotNull()).select("id", "document", "modality", V.as_double(F.col("embedding")).alias("embedding"))
    return rows.mapInArrow(run, "id string, document string, modality string, embedding array<double>, cell int, apart double")


@dataclass
class CellIndex:
    """Vectors as a Parquet table partitioned by cell, and its centres as a small table beside it."""

    spark: SparkSession
    path: str

    @classmethod
    def build(cls, vectors: DataFrame, path: str, centres: np.ndarray | None = None) -> CellIndex:
        """Write all rows of ``vectors (id, document, modality, embedding)`` below ``path``; a crowded cell is written by several tasks."""
        spark = vectors.sparkSession
        centres = fitted_centres(vectors) if centres is None else centres
        rows = [(i, [float(x) for x in c]) for i, c in enumerate(centres)]
        spark.createDataFrame(rows, "cell int, centre array<double>").write.parquet(f"{path}/centres")
        index = cls(spark, path)
        index._write(assign(vectors, centres), "errorifexists")
        return index

    def _write(self, rows: DataFrame, mode: str) -> None:
        rows.hint("rebalance", "cell").write.mode(mode).partitionBy("cell").parquet(f"{self.path}/rows")

    def add(self, vectors: DataFrame) -> None:
        """Append rows to their cells; the centres stay."""
        self._write(assign(vectors, self.centres()), "append")

    def centres(self) -> np.ndarray:
        rows = self.spark.read.parquet(f"{self.path}/centres").orderBy("cell").collect()  # as many as cells
        return np.array([r["centre"] for r in rows]).reshape(len(rows), -1)

    def rows(self) -> DataFrame:
        schema = "id string, document string, modality string, embedding array<double>, apart double, cell int"
        return self.spark.read.schema(schema).parquet(f"{self.path}/rows")

    def in_cells(self, cells: list[int]) -> DataFrame:
        """The rows of these cells; no other folder is read."""
        return self.rows().filter(F.col("cell").isin(cells))

    def _facts(self) -> tuple[np.ndarray, ...]:
        """Number, least and greatest distance from the pivot of each cell that has rows, from one column of the table."""
        found = self.rows().groupBy("cell").agg(F.count("*").alias("n"), F.min("apart").alias("low"), F.max("apart").alias("high")).orderBy("cell").collect()
        return tuple(np.array([r[c] for r in found]) for c in ("cell", "n", "low", "high"))

    def _visits(self, asked: DataFrame, facts: tuple[np.ndarray, ...], k: int, probes: int | None) -> DataFrame:
        """A row per query and cell that it visits.

        With ``probes``, the nearest so many, and more until they hold ``k`` rows; ``rest`` bounds the distance of all other cells from below. Without, those
        of the others that may hold a row nearer than the query's ``bound``.
        """
        cells, sizes, low, high = facts
        centres = self.centres()[cells] if len(cells) else np.zeros((0, 0))
        most = None if probes is None else max(1, min(probes, len(cells)))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows or not len(cells):
                    continue
                rows = as_matrix(batch.column("v"))
                if rows.shape[1] != centres.shape[1]:
                    raise ValueError("query and collection vectors differ in width")
                order = np.argsort(_apart(rows, centres), axis=1, kind="stable")
                firsts = batch.column("first").to_pylist()
                bounds = batch.column("bound").to_pylist()
                taken, chosen, rests, counts = [], [], [], []
                for i, row in enumerate(rows):
                    apart = np.sqrt(((centres - row) ** 2).sum(axis=1))
                    least = np.maximum(0.0, np.maximum(apart - high, low - apart)) * (1 - _SLACK) - _SLACK
                    if most is not None:
                        enough = int(np.searchsorted(np.cumsum(sizes[order[i]]), k)) + 1
                        n = min(len(cells), max(most, enough))
                        own, left = order[i, :n], order[i, n:]
                    else:
                        left = order[i, firsts[i] :]
                        own = left[least[left] <= (np.inf if bounds[i] is None else bounds[i])]
                        n = firsts[i]
                    taken += [i] * len(own)
                    chosen += cells[own].tolist()
                    rests += [float(least[left].min(initial=np.inf))] * len(own)
                    counts += [n] * len(own)
                at = pa.array(taken, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("query_id").take(at), batch.column("v").take(at), batch.column("query").take(at),
                     pa.array(chosen, pa.int32()), pa.array(rests, pa.float64()), pa.array(counts, pa.int32())],
                    names=["query_id", "v", "query", "cell", "rest", "first"],
                )

        names = asked.columns
        full = asked if "bound" in names else asked.withColumn("first", F.lit(0)).withColumn("bound", F.lit(None).cast("double"))
        return full.select("query_id", "v", "query", "first", "bound").mapInArrow(
            run, "query_id string, v array<double>, query long, cell int, rest double, first int"
        )

    def _hits(self, visits: DataFrame, facts: tuple[np.ndarray, ...], asked: DataFrame, k: int) -> DataFrame:
        """Hits in the visited cells alone; a cell is met in groups of bounded size."""
        chunks = [(int(c), int(-(-n // R.GROUP_ROWS))) for c, n in zip(facts[0], facts[1], strict=True)]
        known = F.broadcast(self.spark.createDataFrame(chunks, "cell int, chunks int"))  # as many rows as cells
        parts = R.query_parts(asked, k)
        left = R.in_parts(visits.join(known, "cell"), parts).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        rows = self.in_cells([r["cell"] for r in visits.select("cell").distinct().collect()])  # as many as cells
        right = rows.join(known, "cell").withColumn("chunk", F.pmod(F.monotonically_increasing_id(), F.col("chunks")).cast("int"))
        # Hits carry the query's number, as ids may repeat.
        return R.meet(left.withColumn("query_id", F.col("query").cast("string")), R.for_parts(right, parts), ["cell", "chunk"], k)

    def _named(self, hits: DataFrame, asked: DataFrame, *more: str) -> DataFrame:
        names = asked.select(F.col("query").cast("string").alias("query_no"), F.col("query_id").alias("name"))
        named = hits.withColumnRenamed("query_id", "query_no").join(names, "query_no")
        return named.select(F.col("name").alias("query_id"), "rank", "id", "document", "modality", "distance", "similarity", *more)

    def search(self, queries: DataFrame, k: int = R.NEIGHBOURS, probes: int | float = PROBES) -> DataFrame:
        """Approximate k nearest rows by Euclidean distance of each query ``(query_id, embedding)``: all rows of its nearest cells.

        ``probes`` is a number of cells or, below 1, a share of all cells. A query whose cells hold fewer than ``k`` rows visits further ones. Distances are exact,
        and ``certain`` tells whether the bounds prove that no other cell has a nearer row than the last one given.
        """
        asked, facts = R.asked_vectors(queries), self._facts()
        number = int(np.ceil(probes * len(facts[0]))) if probes < 1 else int(probes)
        visits = self._visits(asked, facts, k, number).checkpoint()
        hits = R._ranked(self._hits(visits, facts, asked, k), k)
        rest = visits.groupBy(F.col("query").cast("string").alias("q")).agg(F.min("rest").alias("rest"))
        last = F.max("distance").over(Window.partitionBy("query_id"))
        proven = hits.withColumn("last", last).join(rest, F.col("query_id") == F.col("q"))
        return self._named(proven.withColumn("certain", F.sqrt("last") <= F.col("rest")), asked, "certain")

    def nearest(self, queries: DataFrame, k: int = R.NEIGHBOURS) -> DataFrame:
        """Exact k nearest rows by Euclidean distance of each query ``(query_id, embedding)``, as :func:`tarn.operators.retrieval.knn` gives them.

        A query first visits its nearest cells that hold ``k`` rows. The distance of its ``k``-th hit there bounds the others: only cells
        whose pivot is so near that they can hold a nearer row are visited next. Queries stay a table.
        """
        asked, facts = R.asked_vectors(queries), self._facts()
        visits = self._visits(asked, facts, k, 1).checkpoint()
        first = self._hits(visits, facts, asked, k).checkpoint()
        ranked = R._ranked(first, k)
        bounds = ranked.groupBy("query_id").agg(F.count("*").alias("n"), F.sqrt(F.max("distance")).alias("far"))
        seen = visits.groupBy(F.col("query").alias("query")).agg(F.max("first").alias("first"))
        again = (
            asked.join(seen, "query").join(bounds.withColumnRenamed("query_id", "q"), F.col("query").cast("string") == F.col("q"), "left")
            .select("query_id", "v", "query", "first", F.when(F.col("n") >= k, F.col("far")).alias("bound"))
        )
        second = self._hits(self._visits(again, facts, k, None).checkpoint(), facts, asked, k)
        return self._named(R._ranked(first.unionByName(second), k), asked)


def knn_approx(
    queries: DataFrame, collection: DataFrame, k: int = R.NEIGHBOURS, probes: int | float = PROBES, centres: np.ndarray | None = None
) -> DataFrame:
    """Approximate k nearest rows through an index that is built for this search; see :meth:`CellIndex.search`.

    Without ``centres``, they are fitted on ``FIT_ROWS`` rows at most. An index that is kept answers later searches without reading other cells.
    """
    checkpoint_root(collection.sparkSession)
    index = CellIndex.build(collection, work_path(collection.sparkSession, "cells"), centres)
    return index.search(queries, k, probes)
