"""Object listings as a data source: every prefix is a partition, and asked keys choose the folders that are opened."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    In,
    InputPartition,
    StringStartsWith,
)
from pyspark.sql.types import StructType

from tarn.sources.tables import content_type_of

SCHEMA = "bucket string, key string, size long, modified timestamp"
BATCH_ROWS = 10_000
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


def _folder(prefix: str) -> str:
    """The deepest folder that holds every key with this prefix; the root is the empty string."""
    return prefix.rpartition("/")[0]


def _outermost(folders: Iterable[str]) -> list[str]:
    """The folders that lie in no other of them, each once."""
    kept: list[str] = []
    for folder in sorted(set(folders), key=lambda f: f.split("/") if f else []):
        if not kept or not (kept[-1] == "" or folder == kept[-1] or folder.startswith(kept[-1] + "/")):
            kept.append(folder)
    return kept


class Opened(InputPartition):
    """A folder below the root; with ``deep`` all that lies under it, else its own files."""

    def __init__(self, folder: str, deep: bool):
        self.folder = folder
        self.deep = deep


class ListingReader(DataSourceReader):
    def __init__(self, root: str, bucket: str | None, prefixes: list[str] | None):
        self.root = root
        self.bucket = bucket
        self.prefixes = prefixes
        self.asked: list[str] | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Keys and key prefixes choose folders; all filters stay with Spark, which applies them to the rows."""
        for f in filters:
            if isinstance(f, StringStartsWith) and f.attribute == ("key",):
                self._narrow([f.value])
            elif isinstance(f, EqualTo) and f.attribute == ("key",):
                self._narrow([f.value])
            elif isinstance(f, In) and f.attribute == ("key",):
                self._narrow([value for value in f.value if value is not None])
            yield f

    def _narrow(self, prefixes: list[str]) -> None:
        """Of several conditions the one with the fewest and longest prefixes counts; Spark applies the others."""

        def reach(asked: list[str]) -> tuple[int, int]:
            return len(asked), -min(map(len, asked), default=0)

        if self.asked is None or reach(prefixes) < reach(self.asked):
            self.asked = prefixes

    def partitions(self) -> list[InputPartition]:
        starts = [""] if self.asked is None else _outermost(map(_folder, self.asked))
        if self.prefixes is not None:
            named = _outermost(p.strip("/") for p in self.prefixes)
            # A named folder is read from where the asked keys lie, or not at all.
            both = (_deeper(start, folder) for start in starts for folder in named)
            return [Opened(folder, True) for folder in _outermost(f for f in both if f is not None)]
        opened: list[InputPartition] = []
        store, base = located(self.root)
        for start in starts:
            opened.append(Opened(start, False))
            for entry in _entries(store, base, start):
                folder = f"{start}/{entry.base_name}".lstrip("/")
                if entry.type == fs.FileType.Directory and self._may_hold(folder + "/"):
                    opened.append(Opened(folder, True))
        return opened

    def _may_hold(self, folder: str) -> bool:
        return self.asked is None or any(folder.startswith(p) or p.startswith(folder) for p in self.asked)

    def read(self, partition: Opened | None) -> Iterator[pa.RecordBatch]:
        """Folder by folder, so that a task holds the entries of one folder. An empty folder is its mark."""
        if partition is None:  # Spark's single partition where none was planned.
            return
        store, base = located(self.root)
        waiting = [partition.folder]
        rows: list[tuple] = []
        while waiting:
            folder = waiting.pop()
            entries = _entries(store, base, folder)
            if not entries and folder and _exists(store, base, folder):
                rows.append((folder + "/", 0, None))
            for entry in entries:
                key = f"{folder}/{entry.base_name}".lstrip("/")
                if entry.type == fs.FileType.Directory:
                    if partition.deep:
                        waiting.append(key)
                else:
                    rows.append((key, entry.size, entry.mtime))
                if len(rows) >= BATCH_ROWS:
                    yield self._batch(rows)
                    rows = []
        if rows:
            yield self._batch(rows)

    def _batch(self, rows: list[tuple]) -> pa.RecordBatch:
        keys, sizes, times = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([self.bucket] * len(rows), pa.string()),
                pa.array(keys, pa.string()),
                pa.array(sizes, pa.int64()),
                pa.array(times, pa.timestamp("us", "UTC")),
            ],
            names=["bucket", "key", "size", "modified"],
        )


def _deeper(one: str, other: str) -> str | None:
    """The deeper of two folders where one holds the other."""
    for outer, inner in ((one, other), (other, one)):
        if outer == "" or inner == outer or inner.startswith(outer + "/"):
            return inner
    return None


def located(root: str) -> tuple[fs.FileSystem, str]:
    """File system and base path of a folder: a local path or any address that Arrow's file systems know."""
    root = root.rstrip("/") or "/"
    if root.startswith("file:") and not root.startswith("file://"):
        root = "file://" + root.removeprefix("file:")
    store, base = fs.FileSystem.from_uri(root)
    return store, base.rstrip("/")


def _entries(store: fs.FileSystem, base: str, folder: str) -> list[fs.FileInfo]:
    """Files and folders right below a folder; none where it is missing. A store's own mark of the folder is left out."""
    path = f"{base}/{folder}".rstrip("/") or "/"
    found = store.get_file_info(fs.FileSelector(path, allow_not_found=True))
    return [entry for entry in found if entry.base_name and entry.path.rstrip("/") != path]


def _exists(store: fs.FileSystem, base: str, folder: str) -> bool:
    return store.get_file_info(f"{base}/{folder}").type == fs.FileType.Directory


class ListingSource(DataSource):
    """``spark.read.format("tarn_listing")`` with the options ``path``, ``bucket`` and ``prefixes`` (comma between)."""

    @classmethod
    def name(cls) -> str:
        return "tarn_listing"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> ListingReader:
        named = self.options.get("prefixes")
        prefixes = None if named is None else [p for p in named.split(",") if p]
        return ListingReader(self.options["path"], self.options.get("bucket"), prefixes)


def object_listing(
    spark: SparkSession, root: str, bucket: str, prefixes: list[str] | None = None
) -> DataFrame:
    """Manifest of all objects below ``root``: empty files are rows of size 0, empty folders marks that end in a slash.

    A condition on ``key`` (a prefix, a value or values) is pushed to the source: only folders that can hold such keys
    are opened. Each folder below is a partition, read by a task. With ``prefixes`` those folders are the partitions and
    nothing is listed on the driver; otherwise the driver lists one level, of the root or of the asked folder. A folder
    that does not exist holds nothing. ``modified`` of a mark is null. Keys are paths below the root.
    """
    spark.conf.set(PUSHDOWN, "true")
    spark.dataSource.register(ListingSource)
    reader = spark.read.format(ListingSource.name()).option("path", root).option("bucket", bucket)
    if prefixes is not None:
        reader = reader.option("prefixes", ",".join(prefixes))
    return reader.load().select("bucket", "key", "size", content_type_of(F.col("key")).alias("content_type"), "modified")
