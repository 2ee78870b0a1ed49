"""Credentials in texts: single spans, and parts that are weak alone but strong together."""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The kinds of single spans in their order, with patterns and least lengths.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 12, 18, 16
# The words that an assignment needs, in lower case, for a cheap test before the pattern.
ASSIGN_WORDS = ("passw", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
# Runs that may hold a hex span or a secret-like string.
RUN = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
HEX = re.compile(r"[0-9a-f]{16,}")
# Parts of multipart credentials, as fixed values. A part counts only where one of another kind is near.
IDENTIFIER = re.compile(
    r"""AKIA[A-Z0-9]{4,}|(?:client|account|tenant|user|access_?key)_?id["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]{4,}""",
    re.IGNORECASE | re.ASCII,
)
URL = re.compile(r"https?://[A-Za-z0-9.-]+(?::[0-9]+)?(?:/[A-Za-z0-9._~/-]*)?")
HOST = re.compile(r"[a-z0-9-]+(?:\.[a-z0-9-]+)+")
HOST_END = re.compile(r"\.(?:amazonaws\.com|internal)\b")
HOST_START = re.compile(r"\b(?=[a-z0-9-])")
SECRET_LEAST = 20
# Code points that may lie between two parts of one credential.
SCOPE = 256


def base_spans(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[int, int]]]:
    """``(kind, start, end)`` in code points, by start, then kind as listed; and the long runs of the text."""
    found = []
    low = text.lower()
    if any(word in low for word in ASSIGN_WORDS):
        found += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)]
    runs = [m.span() for m in RUN.finditer(text)]
    found += [("hex", m.start(), m.end()) for a, b in runs for m in HEX.finditer(text, a, b)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]))), runs


def endpoints(text: str) -> list[tuple[int, int]]:
    """Addresses, and host names that end in one of the known domains: the longest in each run of dotted names, found in one pass."""
    found = [(*m.span(), m.end()) for m in URL.finditer(text)] if "http" in text else []
    if ".amazonaws." in text or ".internal" in text:
        for run in HOST.finditer(text):
            ends = [m.span() for m in HOST_END.finditer(text, run.start(), run.end())]
            # A border at the run's end depends on what follows it.
            ends = [(a, b) for a, b in ends if b < run.end() or HOST_END.match(text, a)]
            if ends:
                found.append((run.start(), ends[-1][1], ends[-1][0]))
    kept: list[tuple[int, int]] = []
    for a, b, last in sorted(found):
        least = max(a, kept[-1][1] if kept else 0)
        if last == b:  # an address begins where it was found
            kept += [(a, b)] if least == a else []
        elif start := HOST_START.search(text, least, last) if least < last else None:
            kept.append((start.start(), b))
    return kept


def part_spans(text: str, base: list[tuple[str, int, int]], runs: list[tuple[int, int]]) -> list[tuple[str, int, int]]:
    """Identifiers, endpoints, secret-like strings (``weak``), and the assignments of ``base`` (``sure``).

    No part overlaps one that was named before it, so none is its own partner.
    """
    parts = [("sure", a, b) for kind, a, b in base if kind == "assign"]
    low = text.lower()
    # As the pattern, without regard to case.
    if "akia" in low or "_id" in low:
        parts += [("id", m.start(), m.end()) for m in IDENTIFIER.finditer(text)]
    parts += [("endpoint", a, b) for a, b in endpoints(text)]
    for a, b in runs:
        run = text[a:b]
        if b - a >= SECRET_LEAST and not run.isalpha() and any(map(str.isdigit, run)) and run.upper() != run and run.lower() != run:
            parts.append(("weak", a, b))
    taken, kept = [], []
    for part in parts:
        at = bisect.bisect_left(taken, (part[2],))
        if not at or taken[at - 1][1] <= part[1]:
            taken.insert(at, part[1:])
            kept.append(part)
    starts = [a for _, a, _ in base]
    tops = [0, *accumulate((b for _, _, b in base), max)]
    return [p for p in kept if p[0] != "weak" or tops[bisect.bisect_left(starts, p[2])] <= p[1]]


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("begin", pa.int64()), ("end", pa.int64())]))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    named = lambda spans: [{"kind": k, "begin": a, "end": b} for k, a, b in spans]
    for batch in batches:
        texts = batch.column("text").to_pylist()
        base, parts = [], []
        for text in texts:
            spans, runs = base_spans(text or "")
            base.append(spans)
            parts.append(part_spans(text or "", spans, runs))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(map(named, base), _SPANS), pa.array(map(named, parts), _SPANS)],
            names=["doc_id", "base", "parts"],
        )


def scan(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """``doc_id, base, linked`` for every row of ``docs (doc_id, text)``, each an array of ``(kind, begin, end)``.

    ``base`` are the single spans by start and kind. Parts of credentials are joined by interval inside
    scopes: a secret-like string or an endpoint is reported only if a part of another kind begins within
    ``scope`` code points of it (an endpoint needs an identifier or a secret, a secret an identifier or an endpoint). Identifiers
    and assignments among ``base`` are partners, but not reported here. For the join a part goes to the cell ``begin / scope`` of its text; of
    every cell and kind only the first and last position is kept, which tells whether a partner is near, so
    many parts in one text make no pairs. Positions are code points, ends exclusive. A null text is
    empty, an empty table gives no rows; rows that repeat an id stay apart. Other columns are ignored.
    """
    found = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .mapInArrow(
            _scan,
            "doc_id long, base array<struct<kind:string,begin:long,end:long>>, parts array<struct<kind:string,begin:long,end:long>>",
        )
        # The row's own number, written down once, keeps rows of one id apart.
        .withColumn("row", F.monotonically_increasing_id())
        .checkpoint()
    )
    parts = found.where(F.size("parts") > 0).select("row", F.inline("parts")).withColumn("cell", F.floor(F.col("begin") / scope))
    cells = parts.groupBy("row", "cell", "kind").agg(F.min("begin").alias("first"), F.max("begin").alias("last"))
    near = cells.select(
        "row", F.col("kind").alias("other"), "first", "last",
        F.explode(F.array(F.col("cell") - 1, F.col("cell"), F.col("cell") + 1)).alias("cell"),
    )
    reach = lambda c: F.abs(F.col(c) - F.col("begin")) <= scope
    linked = (
        parts.where("kind IN ('weak', 'endpoint')").alias("p")
        .join(near.alias("n"), ["row", "cell"])
        .where((F.col("p.kind") != F.col("n.other")) & ~((F.col("p.kind") == "weak") & (F.col("n.other") == "sure")))
        .where(reach("first") | reach("last"))
        .groupBy("row", "kind", "begin", "end").agg(F.lit(1))
        .groupBy("row").agg(F.sort_array(F.collect_list(F.struct("begin", "end", "kind"))).alias("linked"))
    )
    none = F.array().cast("array<struct<begin:bigint,end:bigint,kind:string>>")
    return found.join(linked, "row", "left").select("doc_id", "base", F.coalesce("linked", none).alias("linked"))

