"""The two text rules without a Spark built-in, as Arrow functions over the rows that need them."""

from __future__ import annotations

import html
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ASCII and the Latin-1 letters are their own NFKC form as long as no combining mark follows; marks
# lie outside this class.
_MAY_CHANGE = r"[^\x00-\x7F\u00BF-\u00FF]"

# Entities decoded in the JVM. "&amp;" comes last, so that "&amp;lt;" stays "&lt;".
_COMMON_ENTITIES = {
    "lt": "<",
    "gt": ">",
    "quot": '"',
    "apos": "'",
    "nbsp": "\xa0",
    "copy": "\xa9",
    "reg": "\xae",
    "middot": "\xb7",
    "amp": "&",
}
# Texts that are Python strings at once, in bytes.
_PART_BYTES = 1 << 20
_RARE_ENTITY = rf"&(?!(?:{'|'.join(_COMMON_ENTITIES)});)[#a-zA-Z]"


def _in_parts(rule: Callable[[str | bytes], str | None], batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """``rule`` of all values, a part of a batch at a time: Python holds no more texts than fit ``_PART_BYTES``, or one."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch), 0).to_numpy()
        # Values that begin in the same stretch of bytes are one part.
        stretch = (np.cumsum(sizes, dtype=np.int64) - sizes) // _PART_BYTES
        starts = [0, *(np.flatnonzero(np.diff(stretch)) + 1).tolist(), len(batch)]
        for start, end in zip(starts, starts[1:]):
            values = (value.as_py() for value in batch.slice(start, end - start))
            yield pa.array([None if value is None else rule(value) for value in values], pa.string())


@F.arrow_udf(T.StringType())
def _nfkc(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    yield from _in_parts(lambda text: unicodedata.normalize("NFKC", text), batches)


@F.arrow_udf(T.StringType())
def _unescape(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    yield from _in_parts(html.unescape, batches)


@F.arrow_udf(T.StringType())
def _decode_marked(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    def decode(body: bytes) -> str:
        name = "utf-8-sig" if body.startswith(b"\xef\xbb\xbf") else "utf-16"
        return body.decode(name, errors="ignore")

    yield from _in_parts(decode, batches)


def decode_marked(content: Column, marked: Column) -> Column:
    """Text of bodies that start with a byte-order mark, undecodable parts left out.

    Spark's own decoding fails on a damaged body, and with it the job; only ``marked`` rows leave the
    JVM.
    """
    return _decode_marked(F.when(marked, content))


def nfkc(text: Column) -> Column:
    """Compatibility normal form. Rows that cannot change cross to Python as NULL, without their text."""
    return F.coalesce(_nfkc(F.when(text.rlike(_MAY_CHANGE), text)), text)


def unescape_html(text: Column, source: Column) -> Column:
    """Decode character references; only texts with uncommon ones in their ``source`` leave the JVM.

    Testing the source instead of the text spares working out the text twice.
    """
    simple = text
    for name, character in _COMMON_ENTITIES.items():
        simple = F.replace(simple, F.lit(f"&{name};"), F.lit(character))
    return F.coalesce(_unescape(F.when(source.rlike(_RARE_ENTITY), text)), simple)
