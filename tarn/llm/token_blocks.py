"""Token ids in patched frame-of-reference blocks."""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarn.llm import words
from tarn.session import checkpoint_root

# Ids of one block, the share of them that the packed width must hold, and ids of a segment, about. An exception takes
# 40 bits and a wider block 128, so one bit less pays if at most one id in 40 does not fit.
BLOCK = 128
PERCENTILE = 98
SEGMENT = 1 << 17
END_ID = 2
# Pieces of text that a task remembers the ids of, and bytes of the longest that it remembers.
REMEMBERED, SHORT = 2_000_000, 64
# A piece that white space before or behind it does not change.
_ALONE = re.compile(r"[ \n]?\S(?:.*\S)?\Z", re.DOTALL)


def _ceil_log2(values: np.ndarray) -> np.ndarray:
    """Bits that each non-negative value needs."""
    return np.frexp(values.astype(np.float64))[1].astype(np.uint8)


def pack(ids: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Blocks of ``BLOCK`` ids (the last is padded with its minimum), and where each block starts.

    A block is: minimum (uint32), width (uint8), number of exceptions (uint8), the low ``width`` bits of each
    id less the minimum as 64-bit words, the exceptions' places (uint8), and what is above ``width``
    bits in them (uint32). All little-endian.
    """
    n = -(-len(ids) // BLOCK)
    filled = np.empty(n * BLOCK, np.uint32)
    filled[: len(ids)] = ids
    filled[len(ids) :] = ids[(n - 1) * BLOCK :].min() if n else 0
    rows = filled.reshape(n, BLOCK)
    least = rows.min(axis=1)
    rows = rows - least[:, None]
    at = BLOCK * PERCENTILE // 100 - 1
    width = _ceil_log2(np.partition(rows, at, axis=1)[:, at])
    high = (rows.astype(np.uint64) >> width[:, None].astype(np.uint64)).astype(np.uint32)
    odd_row, odd_at = np.nonzero(high)
    odd = high[odd_row, odd_at]
    count = np.bincount(odd_row, minlength=n)
    sizes = 6 + BLOCK // 8 * width.astype(np.int64) + 5 * count
    starts = np.concatenate(([0], np.cumsum(sizes)))
    out = np.zeros(starts[-1], np.uint8)
    head = np.empty((n, 6), np.uint8)
    head[:, :4] = least.astype("<u4").view(np.uint8).reshape(n, 4)
    head[:, 4], head[:, 5] = width, count
    out[starts[:-1, None] + np.arange(6)] = head
    for w in np.unique(width):
        own = np.flatnonzero(width == w)
        if w:
            low = (rows[own] & np.uint32((1 << int(w)) - 1)).astype(np.uint64)
            words = np.zeros((len(own), 2 * int(w)), np.uint64)
            for j in range(BLOCK):
                word, shift = divmod(j * int(w), 64)
                words[:, word] |= low[:, j] << np.uint64(shift)
                if shift + int(w) > 64:
                    words[:, word + 1] |= low[:, j] >> np.uint64(64 - shift)
            data = words.astype("<u8").view(np.uint8)
            out[starts[own][:, None] + 6 + np.arange(data.shape[1])] = data
    if len(odd):
        lists = starts[:-1] + 6 + BLOCK // 8 * width.astype(np.int64)
        rank = np.arange(len(odd)) - (np.cumsum(count) - count)[odd_row]
        out[lists[odd_row] + rank] = odd_at
        where = lists[odd_row] + count[odd_row] + 4 * rank
        out[where[:, None] + np.arange(4)] = odd.astype("<u4").view(np.uint8).reshape(-1, 4)
    return out.tobytes(), starts[:-1]


def unpack(data: bytes, starts: np.ndarray, n_ids: int) -> np.ndarray:
    """The ids of :func:`pack`. With part of ``starts`` (whole blocks), the ids of these blocks."""
    raw = np.frombuffer(data, np.uint8)
    n = len(starts)
    head = raw[starts[:, None] + np.arange(6)]
    least = np.ascontiguousarray(head[:, :4]).view("<u4").reshape(n)
    width, count = head[:, 4].astype(np.int64), head[:, 5].astype(np.int64)
    rows = np.zeros((n, BLOCK), np.uint32)
    for w in np.unique(width):
        own = np.flatnonzero(width == w)
        if w:
            packed = np.ascontiguousarray(raw[starts[own][:, None] + 6 + np.arange(16 * w)]).view("<u8")
            mask = np.uint64((1 << int(w)) - 1)
            for j in range(BLOCK):
                word, shift = divmod(j * int(w), 64)
                value = packed[:, word] >> np.uint64(shift)
                if shift + w > 64:
                    value |= packed[:, word + 1] << np.uint64(64 - shift)
                rows[own, j] = value & mask
    odd_row = np.repeat(np.arange(n), count)
    if len(odd_row):
        lists = starts + 6 + BLOCK // 8 * width
        rank = np.arange(len(odd_row)) - (np.cumsum(count) - count)[odd_row]
        where = lists[odd_row] + count[odd_row] + 4 * rank
        high = np.ascontiguousarray(raw[where[:, None] + np.arange(4)]).view("<u4").reshape(-1)
        rows[odd_row, raw[lists[odd_row] + rank]] += high << width[odd_row].astype(np.uint32)
    return (rows + least[:, None]).reshape(-1)[:n_ids]


def _cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where pieces begin that the tokenizer takes one by one.

    They begin at texts' starts; at a space or line end that stands alone between two other characters; and at a
    mark behind a letter or digit. Where a neighbour might be white space or no letter beyond ASCII, there is no cut.
    """
    n = len(data)
    padded = np.zeros(n + 6, np.uint8)
    padded[3 : n + 3] = data
    b3, b2, b1, own, a1, a2 = (padded[i : i + n] for i in range(6))
    kind = _KIND[own]
    space = np.flatnonzero(kind == 1)
    p3, p2, p1, f1, f2 = b3[space], b2[space], b1[space], a1[space], a2[space]
    wide = lambda lead: (lead >= 0xE1) & (lead <= 0xE3)
    odd = lambda lead, rest: (lead == 0xC2) & ((rest == 0x85) | (rest == 0xA0))
    plain = (_KIND[p1] != 1) & (_KIND[p1] != 2) & (_KIND[f1] != 1) & (_KIND[f1] != 2)
    space = space[plain & ~odd(p2, p1) & ~wide(p3) & ~odd(f1, f2) & ~wide(f1)]
    mark = np.flatnonzero(kind == 3)
    p2, p1 = b2[mark], b1[mark]
    mark = mark[(_KIND[p1] == 4) | ((p2 == 0xC3) & (p1 >= 0x80) & (p1 != 0x97) & (p1 != 0xB7))]
    begins = np.zeros(n + 1, bool)
    begins[space] = begins[mark] = True
    begins[offsets] = True
    begins[n] = False
    return np.flatnonzero(begins)


# Bytes: 1 space and line end, 2 other white space and controls, 3 marks, 4 ASCII letters and digits, 0 the rest.
_KIND = np.zeros(256, np.uint8)
_KIND[:33] = 2
_KIND[[32, 10]] = 1
_KIND[[ord(c) for c in ".,;:!?"]] = 3
_KIND[[*range(48, 58), *range(65, 91), *range(97, 123)]] = 4


class Encoder:
    """A tokenizer that encodes each different piece of text once.

    Pieces are known by 64-bit hashes of their bytes (see :mod:`tarn.llm.words`). Only short pieces are remembered, with their ids
    and nothing else; all is forgotten when the pieces or their ids are too many.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Special tokens are found in texts, so none may be cut.
        for token in self.tokenizer.get_added_tokens_decoder().values():
            raw = np.frombuffer(token.content.encode(), np.uint8)
            if len(_cuts(raw, np.array([0, len(raw)]))) > 1:
                raise ValueError("a special token of this tokenizer would be cut")
        self.lengths = np.zeros(self.tokenizer.get_vocab_size(), np.int64)
        for token, number in self.tokenizer.get_vocab().items():
            self.lengths[number] = len(token)  # byte-level tokens are written with a letter for each byte
        self._forget()

    def _forget(self) -> None:
        self.hashes, self.at, self.count = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _fresh(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the pieces, and how many each has. Most are encoded together, as lines of one text."""
        alone = [i for i, p in enumerate(pieces) if _ALONE.match(p)]
        together = set(alone)
        found: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(pieces)
        groups = [alone[at : at + 1024] for at in range(0, len(alone), 1024)]
        joined = ["\n" + "\n".join([pieces[i] for i in some]) + "\n" for some in groups]
        for some, code in zip(groups, self.tokenizer.encode_batch_fast(joined, add_special_tokens=False), strict=True):
            ids = np.array(code.ids, np.uint32)
            sizes = np.array([len(pieces[i].encode()) + 1 for i in some])
            # The token of the line end before each piece, and the one behind the last.
            marks = np.searchsorted(np.cumsum(self.lengths[ids]), 1 + np.concatenate(([0], np.cumsum(sizes)))).tolist()
            for i, a, b in zip(some, marks[:-1], marks[1:], strict=True):
                found[i] = ids[a + 1 : b]
        others = [i for i in range(len(pieces)) if i not in together]
        codes = self.tokenizer.encode_batch_fast([pieces[i] for i in others], add_special_tokens=False)
        for i, code in zip(others, codes, strict=True):
            found[i] = np.array(code.ids, np.uint32)
        return np.concatenate([np.zeros(0, np.uint32), *found]), np.array([len(f) for f in found], np.int64)

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and where each text's begin (and the end)."""
        starts = _cuts(data, offsets)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        sizes = np.diff(np.append(starts, len(data)))
        different, first, which = np.unique(words.range_hashes(data, starts, sizes), return_index=True, return_inverse=True)
        if max(len(self.hashes), len(self.ids) // 4) > REMEMBERED:
            self._forget()
        place = np.minimum(np.searchsorted(self.hashes, different), max(0, len(self.hashes) - 1))
        known = self.hashes[place] == different if len(self.hashes) else np.zeros(len(different), bool)
        new = np.flatnonzero(~known)
        raw = data.tobytes()
        begins, ends = starts[first[new]], starts[first[new]] + sizes[first[new]]
        ids, count = self._fresh([raw[a:b].decode() for a, b in zip(begins.tolist(), ends.tolist(), strict=True)])
        store = np.concatenate((self.ids, ids))
        at, n = np.empty(len(different), np.int64), np.empty(len(different), np.int64)
        at[known], n[known] = self.at[place[known]], self.count[place[known]]
        at[new], n[new] = len(self.ids) + np.cumsum(count) - count, count
        short = sizes[first[new]] <= SHORT
        keep = new[short]
        spot = np.searchsorted(self.hashes, different[keep])
        self.hashes, self.count = np.insert(self.hashes, spot, different[keep]), np.insert(self.count, spot, n[keep])
        self.at = np.insert(self.at, spot, len(self.ids) + np.cumsum(n[keep]) - n[keep])
        self.ids = np.concatenate((self.ids, ids[np.repeat(short, count)]))
        each = n[which]
        upto = np.concatenate(([0], np.cumsum(each)))
        out = store[np.repeat(at[which] - upto[:-1], each) + np.arange(upto[-1])]
        return out, upto[np.searchsorted(starts, offsets)]


@lru_cache(maxsize=1)
def _encoder(path: str) -> Encoder:
    """One for all tasks of a Python worker, so that a task begins with what earlier ones have learned."""
    return Encoder(path)


_SEGMENT = pa.schema(
    [
        ("part", pa.int32()), ("segment", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())),
        ("block_starts", pa.list_(pa.int64())), ("blocks", pa.large_binary()),
    ]
)


def _encode(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = _encoder(path), np.array([end_id], np.uint32)
        part, number, first = TaskContext.get().partitionId(), 0, 0
        ids: list[np.ndarray] = []
        doc_ids: list[int | None] = []
        held = 0

        def segment() -> pa.RecordBatch:
            nonlocal number, first, held
            lengths = [len(x) for x in ids]
            data, starts = pack(np.concatenate(ids))
            row = [part, number, first, held, doc_ids[:], lengths, starts, data]
            number, first, held = number + 1, first + held, 0
            ids.clear()
            doc_ids.clear()
            return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, _SEGMENT, strict=True)], schema=_SEGMENT)

        for batch in batches:
            numbers = batch.column("doc_id").to_pylist()
            for low, high, data, offsets in words.slices(batch.column("text")):
                coded, begins = encoder(data, offsets)
                for i, doc_id in enumerate(numbers[low:high]):
                    own = np.append(coded[begins[i] : begins[i + 1]], end)
                    ids.append(own)
                    doc_ids.append(doc_id)
                    held += len(own)
                    if held >= SEGMENT:
                        yield segment()
        if ids:
            yield segment()

    return run


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["part", "doc_id", "start", "n_tokens", "ids_crc32"]
    for batch in batches:
        for row in batch.to_pylist():
            ids = unpack(row["blocks"], np.array(row["block_starts"]), row["n_ids"]).astype("<u4")
            ends = np.cumsum(row["lengths"])
            starts = ends - row["lengths"]
            sums = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts, ends, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([row["part"]] * len(sums), pa.int32()), pa.array(row["doc_ids"], pa.int64()),
                    pa.array(starts + row["first"]), pa.array(row["lengths"], pa.int64()), pa.array(sums, pa.int64()),
                ],
                names=names,
            )


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> None:
    """Encode the texts of ``docs (doc_id, text)`` into files below ``path``, in ascending doc_id order.

    Rows are put in order by range partition (null ids first; rows of one id in the order of their texts' hashes).
    A file holds segments: whole documents of at least ``SEGMENT`` ids together (a longer one is a segment),
    with their ids and lengths, the packed blocks and the index of block starts, and how many ids
    the file has before it. Files are Parquet, uncompressed, so any store that Spark reaches will do, and a lost
    task writes its file anew. A null or empty text is its end id alone; an empty table gives no segment.
    ``tokenizer`` is a file every executor has. Other columns are ignored.
    """
    by = [F.col("doc_id").asc_nulls_first(), F.col("tie")]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    (
        rows.withColumn("tie", F.xxhash64("text"))
        .repartitionByRange(*by)
        .sortWithinPartitions(*by)
        .select("doc_id", "text")
        .mapInArrow(
            _encode(tokenizer, end_id),
            "part int, segment int, first long, n_ids long, doc_ids array<long>, lengths array<long>, "
            "block_starts array<long>, blocks binary",
        )
        .write.option("compression", "none")
        .parquet(path)
    )


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files below ``path`` alone."""
    checkpoint_root(spark)
    segments = spark.read.parquet(path)
    # One row per file.
    totals = {r.part: r.n for r in segments.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()}
    before, offsets = 0, []
    for part in sorted(totals):
        offsets.append((part, before))
        before += totals[part]
    known = spark.createDataFrame(offsets, "part int, before long")
    rows = segments.mapInArrow(_decode, "part int, doc_id long, start long, n_tokens long, ids_crc32 long")
    return rows.join(F.broadcast(known), "part").select(
        "doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"
    )
