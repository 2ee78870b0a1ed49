"""Images and frames to one size and pixel format. Pixels need numpy; Spark hands out small batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

# Fixed value: target width and height.
TARGET_SIZE = (512, 512)
# Standardised images handed back per Arrow batch.
_BATCH = 16

_PIXELS = "height int, width int, nChannels int, data binary"


def lanczos_weights(size: int, target: int) -> np.ndarray:
    """Lanczos-3 weights, one row per output pixel; the kernel widens when shrinking."""
    scale = size / target
    stretch = max(scale, 1.0)
    centers = (np.arange(target) + 0.5) * scale
    offsets = (np.arange(size)[None, :] + 0.5 - centers[:, None]) / stretch
    weights = np.where(np.abs(offsets) < 3.0, np.sinc(offsets) * np.sinc(offsets / 3.0), 0.0)
    return weights / weights.sum(axis=1, keepdims=True)


def area_weights(size: int, target: int) -> np.ndarray:
    """Share of each input pixel in the area of each output pixel."""
    edges = np.arange(target + 1) * (size / target)
    low = np.maximum(edges[:-1, None], np.arange(size)[None, :])
    high = np.minimum(edges[1:, None], np.arange(1, size + 1)[None, :])
    weights = np.clip(high - low, 0.0, None)
    return weights / weights.sum(axis=1, keepdims=True)


def _to_bytes(values: np.ndarray) -> np.ndarray:
    values += 0.5
    return np.clip(values, 0, 255.5, out=values).astype(np.uint8)


def resize(pixels: np.ndarray, across: np.ndarray, down: np.ndarray) -> np.ndarray:
    """Resample ``(height, width, 3)`` by one weight matrix per direction, rounding in between."""
    height, width, channels = pixels.shape
    columns = pixels.transpose(1, 0, 2).reshape(width, height * channels)
    wide = _to_bytes(across @ columns).reshape(-1, height, channels)
    lines = wide.transpose(1, 0, 2).reshape(height, -1)
    return _to_bytes(down @ lines).reshape(len(down), len(across), channels)


def standardize_pixels(
    data: bytes,
    height: int,
    width: int,
    channels: int,
    target: tuple[int, int] = TARGET_SIZE,
    weights: Callable[[int, int], np.ndarray] = lanczos_weights,
) -> np.ndarray:
    """RGB bytes ``(height, width, 3)`` at the target size from BGR, BGRA or grey bytes."""
    pixels = np.frombuffer(data, dtype=np.uint8).reshape(height, width, channels)
    rgb = np.repeat(pixels, 3, axis=2) if channels == 1 else pixels[:, :, 2::-1]
    return resize(rgb.astype(np.float64), weights(width, target[0]), weights(height, target[1]))


def _standardize(
    images: DataFrame,
    keys: Sequence[str],
    target: tuple[int, int],
    weights: Callable[[int, int], np.ndarray],
) -> DataFrame:
    def convert(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[tuple[int, int], np.ndarray] = {}

        def remembered(size: int, wanted: int) -> np.ndarray:
            if (size, wanted) not in known:
                if len(known) >= 64:
                    known.clear()
                known[size, wanted] = weights(size, wanted)
            return known[size, wanted]

        for batch in batches:
            for start in range(0, len(batch), _BATCH):
                part = batch.iloc[start : start + _BATCH]
                resized = [
                    standardize_pixels(d, h, w, c, target, remembered).tobytes()
                    for d, h, w, c in zip(
                        part["data"], part["height"], part["width"], part["nChannels"], strict=True
                    )
                ]
                yield part[list(keys)].assign(height=target[1], width=target[0], nChannels=3, data=resized)

    kept = images.select(*keys)
    schema = ", ".join([f"`{name}` {kind}" for name, kind in kept.dtypes] + [_PIXELS])
    return images.select(*keys, "height", "width", "nChannels", "data").mapInPandas(convert, schema)


def image_standardize(images: DataFrame, target: tuple[int, int] = TARGET_SIZE) -> DataFrame:
    """Standardise the rows ``(origin, height, width, nChannels, data)`` of Spark's image source.

    The result keeps the layout with three channels in RGB order; divide by 255 for a tensor in [0,1].
    """
    return _standardize(images, ["origin"], target, lanczos_weights)


def frame_standardize(frames: DataFrame, target: tuple[int, int] = TARGET_SIZE) -> DataFrame:
    """Standardise decoded frames ``(video_id, frame_no, height, width, nChannels, data)`` by area."""
    return _standardize(frames, ["video_id", "frame_no"], target, area_weights)
