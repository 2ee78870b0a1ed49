"""Pages inside EPUB and ZIP bodies."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

# Member names that count as pages.
PAGE_SUFFIXES = (".xhtml", ".html", ".htm")


def _pages(body: bytes) -> tuple[list[str], str | None]:
    try:
        with zipfile.ZipFile(io.BytesIO(body)) as archive:
            names = sorted(n for n in archive.namelist() if n.lower().endswith(PAGE_SUFFIXES))
            return [archive.read(n).decode("utf-8", errors="replace") for n in names], None
    except Exception as problem:  # a broken archive is an outcome, not the end of the job
        return [], f"{type(problem).__name__}: {problem}"


def _unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        # One archive at a time: members may be many times larger than the body.
        for key, body in zip(batch["key"], batch["content"], strict=True):
            members, error = _pages(body or b"")
            yield pd.DataFrame({"key": [key], "members": [members], "error": [error]})


def with_members(bodies: DataFrame) -> DataFrame:
    """``(key, content)`` -> ``(key, members, error)`` with page bodies in name order."""
    return bodies.select("key", "content").mapInPandas(
        _unpack, "key string, members array<string>, error string"
    )
