"""Hard negatives by a vertical scan of columnar blocks (BOND).

Vectors lie in blocks, one dimension after the other. An anchor reads a block's dimensions in falling order of its own magnitudes;
what the dimensions still to come can add at least and at most, by their least and greatest values in the block, shrinks the
bitmap of candidates until only rows are left whose exact scores decide.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarn.session import checkpoint_root

POSITIVES, NEGATIVES = 5, 3
# A negative's score is from LOW to HIGH hundredths of the positive's.
LOW, HIGH = 50, 95
# A component is floor(SCALE * x), cut at LIMIT.
SCALE, LIMIT = 256, 1 << 26
# Rows of a block: a share of all rows, between these bounds. Anchors of a block, and blocks of anchors that one task gets.
BLOCKS, LEAST_ROWS, MOST_ROWS = 24, 2048, 65_536
ANCHORS, CHUNK = 256, 512

_BLOCK = "block long, n long, known array<long>, ids binary, labels binary, cells binary"


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, label, embedding`` of the rows that take part: with an id, a label, and a vector of finite numbers."""
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("embedding")
    )
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL").where(finite)


def _matrix(column: pa.Array) -> np.ndarray:
    """Whole-number components, rows by dimensions; what a shorter vector lacks is 0."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = np.clip(np.floor(SCALE * column.flatten().to_numpy(zero_copy_only=False)), -LIMIT, LIMIT).astype(np.int64)
    width = int(lengths.max()) if len(lengths) else 0
    if (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def _pack(most: int):
    """Blocks of at most ``most`` consecutive rows, dimension by dimension, in the narrowest whole numbers that hold them."""

    def block(number: int, ids: list, labels: list, parts: list) -> pa.RecordBatch:
        width = max(p.shape[1] for p in parts)
        cells = np.concatenate([np.pad(p, ((0, 0), (0, width - p.shape[1]))) for p in parts]).T
        kind = "<i2" if np.abs(cells).max(initial=0) < 1 << 15 else "<i4"
        ids, labels = np.concatenate(ids), np.concatenate(labels)
        row = [(TaskContext.get().partitionId() << 32) + number, len(ids), np.unique(labels), ids.astype("<i8").tobytes(), labels.astype("<i8").tobytes()]
        row.append(kind.encode() + np.ascontiguousarray(cells, kind).tobytes())
        kinds = (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds, strict=True)], names=["block", "n", "known", "ids", "labels", "cells"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = 0, 0
        ids: list = []
        labels: list = []
        parts: list = []
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                own = batch.slice(at, most - held)
                ids.append(own.column("vec_id").to_numpy())
                labels.append(own.column("label").to_numpy())
                parts.append(_matrix(own.column("embedding")))
                at, held = at + own.num_rows, held + own.num_rows
                if held == most:
                    yield block(number, ids, labels, parts)
                    number, held, ids, labels, parts = number + 1, 0, [], [], []
        if held:
            yield block(number, ids, labels, parts)

    return run


def _blocks(rows: DataFrame, parts: int, most: int) -> DataFrame:
    """Blocks of rows in the order of label and id, so that a block holds few labels. A hot label is cut by its ids."""
    by = ["label", "vec_id", "row"]
    numbered = rows.withColumn("row", F.monotonically_increasing_id())
    return numbered.repartitionByRange(parts, *by).sortWithinPartitions(*by).select("vec_id", "label", "embedding").mapInArrow(_pack(most), _BLOCK)


class Block:
    """A block as arrays: ids, labels (in order), and cells by dimension and row."""

    def __init__(self, ids: bytes, labels: bytes, cells: bytes):
        self.ids, self.labels = np.frombuffer(ids, "<i8"), np.frombuffer(labels, "<i8")
        self.cells = np.frombuffer(cells, cells[:3].decode(), offset=3).reshape(-1, len(self.ids))
        self.most = int(np.abs(self.cells.astype(np.int64)).max(initial=0))
        self.views: dict = {}

    def view(self, width: int, kind: type, low: int, high: int, outside: bool) -> tuple:
        """Cells of the first ``width`` dimensions of rows ``low`` to ``high`` (or of all others), their ids, least and greatest values."""
        key = (width, kind, low, high, outside)
        if key not in self.views:
            if len(self.views) >= 8:
                self.views.clear()
            cells, ids = self.cells[:width], self.ids
            if outside and low < high:
                cells, ids = np.delete(cells, np.s_[low:high], axis=1), np.delete(ids, np.s_[low:high])
            elif not outside:
                cells, ids = cells[:, low:high], ids[low:high]
            cells = np.ascontiguousarray(cells).astype(kind)
            sides = (cells.min(axis=1), cells.max(axis=1)) if len(ids) else (np.zeros(width, kind),) * 2
            self.views[key] = (cells, ids, *sides)
        return self.views[key]


def _exact(bound: int) -> type:
    """The fastest kind of number that adds whole numbers up to ``bound`` exactly."""
    return np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else object


def vertical_scan(cells: np.ndarray, least: np.ndarray, most: np.ndarray, anchor: np.ndarray, needed: Callable) -> tuple[np.ndarray, np.ndarray]:
    """The rows that may matter, and their exact inner products with ``anchor``.

    ``needed(scores, low, high)`` marks those of the candidates that may still matter, when what is left to read adds ``low`` to ``high``.
    """
    order = np.argsort(-np.abs(anchor), kind="stable")
    q = anchor[order]
    a, b = q * least[order], q * most[order]
    rest = lambda x: np.append(np.cumsum(x[::-1])[::-1], x.dtype.type(0) if x.dtype != object else 0)
    low, high = rest(np.minimum(a, b)), rest(np.maximum(a, b))
    rows, scores = np.arange(cells.shape[1]), np.zeros(cells.shape[1], cells.dtype)
    if not needed(scores[:1], low[0], high[0]).any():
        return rows[:0], scores[:0]
    whole, at, step = True, 0, max(1, len(q) // 8)
    while at < len(q):
        end = min(len(q), at + (step if at < len(q) // 2 else 2 * step))
        dims = order[at:end]
        scores = scores + q[at:end] @ (cells[dims] if whole else cells[np.ix_(dims, rows)])
        at = end
        alive = needed(scores, low[at], high[at])
        # The bitmap is followed once it spares a quarter of what would be read.
        if 4 * np.count_nonzero(alive) <= 3 * len(alive) or at == len(q):
            rows, scores, whole = rows[alive], scores[alive], False
            if not len(rows):
                break
    return rows, scores


def _nearest(k: int) -> Callable:
    def needed(scores: np.ndarray, low, high) -> np.ndarray:
        if len(scores) <= k:
            return np.ones(len(scores), bool)
        return scores + high >= np.partition(scores, -k)[-k] + low

    return needed


def _inside(windows: list[tuple[int, int]], k: int) -> Callable:
    def needed(scores: np.ndarray, low, high) -> np.ndarray:
        alive = np.zeros(len(scores), bool)
        lower, upper = scores + low, scores + high
        for first, last in windows:
            own = (upper >= first) & (lower <= last)
            sure = lower[(lower >= first) & (upper <= last)]
            if len(sure) > k:
                own &= upper >= np.partition(sure, -k)[-k]
            alive |= own
        return alive

    return needed


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, ties by smaller id."""
    if len(ids) > k:
        at = np.flatnonzero(scores >= np.partition(scores, -k)[-k])
        return at[np.lexsort((ids[at], -scores[at]))][:k]
    return np.lexsort((ids, -scores))


_NAMES = ["part", "slot", "anchor_id", "id", "score"]


def _positives(k: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        for row in left.to_pylist():
            block = Block(row["ids"], row["labels"], row["cells"])
            for other in right.to_pylist():
                anchors = Block(other["ids"], other["labels"], other["cells"])
                width = min(len(block.cells), len(anchors.cells))
                kind = _exact(max(1, width) * block.most * anchors.most)
                for i, (own, label) in enumerate(zip(anchors.ids.tolist(), anchors.labels.tolist(), strict=True)):
                    low, high = np.searchsorted(block.labels, [label, label + 1]).tolist()
                    if low == high:
                        continue
                    cells, ids, least, most = block.view(width, kind, low, high, False)
                    # One more for each row of the anchor's own id, which is no other row.
                    same = int(np.count_nonzero(ids == own))
                    rows, scores = vertical_scan(cells, least, most, anchors.cells[:width, i].astype(kind), _nearest(k + same))
                    rows, scores = rows[ids[rows] != own], scores[ids[rows] != own]
                    best = _best(ids[rows], scores, k)
                    out += [(other["part"], i, own, n, int(s)) for n, s in zip(ids[rows[best]].tolist(), scores[best].tolist(), strict=True)]
        return _table(out, _NAMES)

    return run


def _table(rows: list[tuple], names: list[str]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [[]] * len(names)
    return pa.table([pa.array(c, pa.int64()) for c in columns], names=names)


_FOUND = [*_NAMES, "positive_id", "positive_score", "nth"]


def _negatives(k: int, low_share: int, high_share: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        for row in left.to_pylist():
            block = Block(row["ids"], row["labels"], row["cells"])
            for other in right.to_pylist():
                anchors = Block(other["ids"], other["labels"], other["cells"])
                width = min(len(block.cells), len(anchors.cells))
                kind = _exact(max(1, width) * block.most * anchors.most)
                asked: dict[int, list] = {}
                for p in other["positives"]:
                    first, last = -(-low_share * p["score"] // 100), high_share * p["score"] // 100
                    if first <= last:
                        asked.setdefault(p["slot"], []).append((first, last, p))
                for i, own in asked.items():
                    label = int(anchors.labels[i])
                    low, high = np.searchsorted(block.labels, [label, label + 1]).tolist()
                    cells, ids, least, most = block.view(width, kind, low, high, True)
                    if not len(ids):
                        continue
                    windows = list({(first, last) for first, last, _ in own})
                    rows, scores = vertical_scan(cells, least, most, anchors.cells[:width, i].astype(kind), _inside(windows, k))
                    for first, last, p in own:
                        at = np.flatnonzero((scores >= first) & (scores <= last))
                        best = at[_best(ids[rows[at]], scores[at], k)]
                        out += [
                            (other["part"], i, int(anchors.ids[i]), n, int(s), p["id"], p["score"], p["nth"])
                            for n, s in zip(ids[rows[best]].tolist(), scores[best].tolist(), strict=True)
                        ]
        return _table(out, _FOUND)

    return run


def mine(
    vectors: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``: for each anchor and positive, its hard negatives.

    ``vectors`` has ``vec_id, label, embedding``; ``is_anchor`` marks anchors among them, by these columns. Rows without id, label or vector, or
    with a null or non-finite component, take no part. A score is the inner product of ``floor(256 * x)``; higher ones come first, ties
    by smaller id. Positives are an anchor's first ``positives`` rows of its label with another id; negatives of a positive are the
    first ``negatives`` rows of other labels with a score from ``low`` to ``high`` hundredths of the positive's (none, if that is negative).
    Of vectors of different widths the shorter lacks zeros, an empty one is all zeros. Rows that repeat an id are rows of their own. Whole
    numbers of components are cut at 2^26, so that every score is exact in 64 bits. An empty table gives no rows; other columns are ignored.

    Every anchor meets every row, in blocks: those of its label for the positives, all for the negatives. Rows of all sides move
    as packed blocks; results are merged by rank from each block's best.
    """
    checkpoint_root(vectors.sparkSession)
    rows = usable(vectors)
    sizes = rows.agg(F.count("*").alias("n"), F.count_if(F.coalesce(is_anchor, F.lit(False))).alias("anchors")).first()
    most = max(LEAST_ROWS, min(MOST_ROWS, -(-sizes.n // BLOCKS)))
    n_blocks = max(1, -(-sizes.n // most))
    blocks = _blocks(rows, n_blocks, most).checkpoint()
    packed = _blocks(rows.where(is_anchor), max(1, -(-sizes.anchors // (8 * ANCHORS))), ANCHORS).withColumnRenamed("block", "part")
    # Chunks are runs of anchor blocks of about one size.
    chunk = (F.pmod(F.xxhash64("part"), F.lit(max(1, -(-sizes.anchors // (ANCHORS * CHUNK)))))).cast("long")
    anchors = packed.withColumn("chunk", chunk).checkpoint()
    tasks = max(1, blocks.count() * (anchors.select("chunk").distinct().count() or 1))

    # Blocks that share a label meet once.
    near = (
        blocks.select("block", F.explode("known").alias("label"))
        .join(anchors.select("part", "chunk", F.explode("known").alias("label")), "label")
        .select("block", "part").distinct()
    )
    facts = ["part", "chunk", "ids", "labels", "cells"]
    by = ["block", "chunk"]

    def meet(pairs: DataFrame, sides: DataFrame, function, schema: str) -> DataFrame:
        """Each task holds one block of rows and one chunk of anchor blocks at a time."""
        met = pairs.join(sides, "part").repartition(tasks, *by)
        keys = pairs.join(anchors.select("part", "chunk"), "part").select(*by).distinct()
        own = keys.join(blocks.select("block", "ids", "labels", "cells"), "block").withColumnsRenamed({"block": "b", "chunk": "c"})
        return own.repartition(tasks, "b", "c").groupBy("b", "c").cogroup(met.groupBy(*by)).applyInArrow(function, schema)

    first = Window.partitionBy("part", "slot").orderBy(F.desc("score"), "id")
    best = (
        meet(near, anchors.select(*facts), _positives(positives), ", ".join(f"{c} long" for c in _NAMES))
        .withColumn("nth", F.row_number().over(first).cast("long")).where(F.col("nth") <= positives).checkpoint()
    )
    asked = best.groupBy("part").agg(F.collect_list(F.struct("slot", "id", "score", "nth")).alias("positives"))
    # The stated query set against all rows: a row per block of either side, dealt by the blocks' numbers.
    numbers = blocks.agg(F.collect_list("block").alias("all"))
    every = asked.select("part", F.lit(1).alias("one")).join(F.broadcast(numbers.withColumn("one", F.lit(1))), "one").select("part", F.explode("all").alias("block"))
    found = meet(every, anchors.select(*facts).join(asked, "part"), _negatives(negatives, low, high), ", ".join(f"{c} long" for c in _FOUND))
    top = Window.partitionBy("part", "slot", "nth").orderBy(F.desc("score"), "id")
    return (
        found.withColumn("rank", F.row_number().over(top)).where(F.col("rank") <= negatives)
        .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
    )
