"""Words and word shingles of Arrow string columns as 64-bit hashes, by array operations.

Words are maximal runs of bytes other than white space (``\\x20 \\x09-\\x0D``), with A-Z in lower case. The
hash of a word is a sum of one scrambled number for each place and byte, no polynomial: two different words or shingles, however
regular, share a hash with a chance of about 2^-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Bytes of text that are worked on at a time (a longer text is worked on whole).
SLICE_BYTES = 1 << 21
_M = (1 << 64) - 1


def _numbers(seed: int, n: int) -> np.ndarray:
    """Seeded odd 64-bit numbers."""
    return mix(np.arange(seed, seed + n, dtype=np.uint64)) | np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit numbers over the whole word."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTES = np.arange(256)
#: Bytes of words: all but white space; and only ASCII letters and digits and what is beyond ASCII.
SPACED = ~((_BYTES == 0x20) | ((_BYTES >= 0x09) & (_BYTES <= 0x0D)))
_LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES)
LETTERS = (_BYTES >= 0x80) | ((_LOWER >= 97) & (_LOWER <= 122)) | ((_BYTES >= 48) & (_BYTES <= 57))
_CODE = _numbers(1000, 256)[_LOWER]
_EXACT = _numbers(2000, 256)
_PLACES = mix(np.arange(1 << 12, dtype=np.uint64) ^ np.uint64(0xA0761D6478BD642F))
_ODD = np.uint64(0xE7037ED1A0B428DB)


def _cells(place: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """A number for each byte that depends on its code and on its place in the word, and not linearly on either."""
    longest = int(place.max()) + 1
    places = _PLACES if longest <= len(_PLACES) else mix(np.arange(longest, dtype=np.uint64) ^ np.uint64(0xA0761D6478BD642F))
    values = places[place]
    values ^= codes
    values *= _ODD
    values ^= values >> np.uint64(32)
    values *= _ODD
    values ^= values >> np.uint64(29)
    return values


def slices(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, end row, bytes, offsets)`` of runs of rows; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if not n:
        return
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        end = int(np.searchsorted(offsets, offsets[first] + SLICE_BYTES, "right")) - 1
        end = min(n, max(end, first + 1))
        own = offsets[first : end + 1]
        yield first, end, data[own[0] : own[-1]], own - own[0]
        first = end


def word_hashes(
    data: np.ndarray, offsets: np.ndarray, letters: np.ndarray = SPACED, stem: int = 0, exact: bool = False
) -> tuple[np.ndarray, ...]:
    """The hash of each word, and for each text (and the end) the number of its first word.

    Words are runs of the bytes that ``letters`` marks; with ``exact``, A-Z stay as they are. With ``stem``, also the hash of each word's first so many bytes,
    which is the word's own where it has no more.
    """
    none = np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64), *([np.zeros(0, np.uint64)] if stem else [])
    if not len(data):
        return none
    inside = letters[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    begins[edges] = inside[edges]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return none
    place = np.arange(starts[0], len(data)) - np.repeat(starts, np.diff(np.append(starts, len(data))))
    outside = ~inside[starts[0] :]
    place[outside] = 0
    values = _cells(place, (_EXACT if exact else _CODE)[data[starts[0] :]])
    values[outside] = 0
    hashes, begins = mix(np.add.reduceat(values, starts - starts[0])), np.searchsorted(starts, offsets)
    if not stem:
        return hashes, begins
    values[place >= stem] = 0
    stems = mix(np.add.reduceat(values, starts - starts[0]))
    return hashes, begins, np.where(stems == hashes, hashes, mix(stems))


def range_hashes(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The hash of each range of bytes; ranges follow each other from the first to the end of ``data``."""
    place = np.arange(starts[0], len(data)) - np.repeat(starts, sizes)
    return mix(np.add.reduceat(_cells(place, _EXACT[data[starts[0] :]]), starts - starts[0]))


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """The hash of every run of ``n`` words (over the borders of texts too)."""
    count = max(0, len(words) - n + 1)
    total = np.zeros(count, np.uint64)
    for j, factor in enumerate(_numbers(n << 8, n)):
        total += words[j : j + count] * factor
    return mix(total)


def gapped_hashes(words: np.ndarray) -> np.ndarray:
    """The hash of every two words with one between, the same as if they were neighbours."""
    one, two = _numbers(2 << 8, 2)
    return mix(words[:-2] * one + words[2:] * two)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int) -> list[np.ndarray]:
    """Each text's distinct shingles of ``n`` words, sorted; a shorter text is one shingle, without words none."""
    words, first = word_hashes(data, offsets)
    grams = ngram_hashes(words, n)
    sets = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= n:
            sets.append(np.unique(grams[a : b - n + 1]))
        elif b > a:
            sets.append(ngram_hashes(words[a:b], int(b - a)))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets
