"""Encoders: from a batch of inputs to a matrix of vectors, run as Arrow functions."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# An encoder turns n inputs into an n x width matrix. A factory builds one; it is called once per task,
# which is where a model is loaded.
Encoder = Callable[[Sequence], np.ndarray]
EncoderFactory = Callable[[], Encoder]

_FLOATS = T.ArrayType(T.FloatType())
# Inputs handed to the encoder at once.
_ENCODE_BATCH = 4096


def hash_encoder(width: int = 64) -> EncoderFactory:
    """A model-free encoder: white-space words counted by hash slot, then normalised."""

    def build() -> Encoder:
        slots: dict[str, int] = {}

        def slot(word: str) -> int:
            found = slots.get(word)
            if found is None:
                if len(slots) > 200_000:
                    slots.clear()
                found = int(hashlib.md5(word.encode()).hexdigest()[:4], 16) % width
                slots[word] = found
            return found

        def encode(texts: Sequence[str | None]) -> np.ndarray:
            counts = np.zeros((len(texts), width))
            for row, text in enumerate(texts):
                if text:
                    places = np.fromiter((slot(word) for word in text.split()), dtype=np.int64)
                    counts[row] = np.bincount(places, minlength=width)
            return unit_rows(counts)

        return encode

    return build


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    """Rows divided by their norm; zero rows stay zero."""
    sizes = np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))
    return np.divide(matrix, sizes, out=np.zeros_like(matrix), where=sizes > 0)


def as_lists(matrix: np.ndarray) -> pa.Array:
    """A matrix as an Arrow list column of 32-bit floats."""
    rows, width = matrix.shape
    offsets = pa.array(np.arange(rows + 1, dtype=np.int32) * width)
    flat = pa.array(np.ascontiguousarray(matrix, dtype=np.float32).reshape(-1))
    return pa.ListArray.from_arrays(offsets, flat)


def as_matrix(vectors: pa.Array) -> np.ndarray:
    """An Arrow list column of equally wide vectors as a matrix of doubles."""
    if len(vectors) == 0:
        return np.zeros((0, 0))
    if vectors.null_count:
        raise ValueError("vectors must not be NULL")
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    widths = np.diff(vectors.offsets.to_numpy())
    if (widths != widths[0]).any():
        raise ValueError("all vectors must have the same width")
    return flat.reshape(len(vectors), int(widths[0]))


def encode_column(inputs: Column, factory: EncoderFactory) -> Column:
    """Vectors of a column of inputs; only this column crosses to Python."""

    @F.arrow_udf(_FLOATS)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode = factory()
        for batch in batches:
            items = batch.to_pylist()
            blocks = [
                encode(items[start : start + _ENCODE_BATCH])
                for start in range(0, len(items), _ENCODE_BATCH)
            ]
            yield as_lists(np.vstack(blocks)) if blocks else pa.array([], pa.list_(pa.float32()))

    return run(inputs)


def encode_pooled(inputs: Column, factory: EncoderFactory) -> Column:
    """One vector per array of inputs: encode each, average, normalise.

    An empty array gives the zero vector and a single input its own vector. Pooling inside the row
    needs no shuffle.
    """

    @F.arrow_udf(_FLOATS)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode = factory()
        width = encode([None]).shape[1]
        for batch in batches:
            sizes = np.array([0 if v is None else v for v in pc.list_value_length(batch).to_pylist()])
            owners = np.repeat(np.arange(len(batch)), sizes)
            items = batch.flatten().to_pylist()
            sums = np.zeros((len(batch), width))
            for start in range(0, len(items), _ENCODE_BATCH):
                part = slice(start, start + _ENCODE_BATCH)
                np.add.at(sums, owners[part], encode(items[part]))
            yield as_lists(unit_rows(sums))

    return run(inputs)


def project_column(vector: Column, weights: np.ndarray, bias: np.ndarray) -> Column:
    """``weights @ vector + bias`` for a fixed ``out x in`` matrix, then normalised."""
    transposed, offset = np.asarray(weights, dtype=np.float64).T.copy(), np.asarray(bias, dtype=np.float64)

    @F.arrow_udf(_FLOATS)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            matrix = as_matrix(batch)
            if len(matrix) == 0:
                yield pa.array([], pa.list_(pa.float32()))
            else:
                yield as_lists(unit_rows(matrix @ transposed + offset))

    return run(vector)


def projection_weights(width_in: int, width_out: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Seeded affine weights, uniform within one over the square root of the input width."""
    random = np.random.default_rng(seed)
    limit = 1.0 / np.sqrt(width_in)
    return random.uniform(-limit, limit, (width_out, width_in)), random.uniform(-limit, limit, width_out)
