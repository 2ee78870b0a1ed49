"""Zone tables as numbered parquet snapshots: what is written is never changed, so readers never see half of it."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession


class Snapshots:
    """``root/name/v=N`` folders and the additions ``v=N.K`` to each, all with a success mark.

    The table is the newest snapshot with its additions. A write that failed has no mark and is not seen.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    def _path(self, text: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(text)

    def _files(self):
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        return self._path(self.root).getFileSystem(conf)

    def names(self) -> list[str]:
        files, root = self._files(), self._path(self.root)
        if not files.exists(root):
            return []
        found = [status.getPath().getName() for status in files.listStatus(root)]
        return sorted(name for name in found if self._versions(name))

    def _done(self, name: str) -> list[tuple[int, int]]:
        """Finished writes as ``(snapshot, addition)``, addition 0 being the snapshot itself."""
        files, folder = self._files(), self._path(f"{self.root}/{name}")
        if not files.exists(folder):
            return []
        found = []
        for status in files.listStatus(folder):
            match = re.fullmatch(r"v=(\d+)(?:\.(\d+))?", status.getPath().getName())
            if match and files.exists(self._path(f"{self.root}/{name}/{match[0]}/_SUCCESS")):
                found.append((int(match[1]), int(match[2] or 0)))
        return sorted(found)

    def _versions(self, name: str) -> list[int]:
        return [snapshot for snapshot, addition in self._done(name) if not addition]

    def exists(self, name: str) -> bool:
        return bool(self._versions(name))

    def version(self, name: str) -> tuple[int, int]:
        """The newest snapshot and its last addition."""
        versions = self._versions(name)
        if not versions:
            raise KeyError(f"no snapshot of {name!r} under {self.root}")
        return max(v for v in self._done(name) if v[0] == versions[-1])

    def read(self, name: str, version: tuple[int, int] | None = None) -> DataFrame:
        """The table as it is now, or as it was at a version."""
        snapshot, last = version or self.version(name)
        parts = [a for v, a in self._done(name) if v == snapshot and a <= last]
        paths = [f"{self.root}/{name}/v={snapshot}" + (f".{a}" if a else "") for a in parts]
        # Each folder is a table of its own; a common schema, but no common partitions.
        frames = [self.spark.read.parquet(path) for path in paths]
        table = frames[0]
        for frame in frames[1:]:
            table = table.unionByName(frame, allowMissingColumns=True)
        return table

    def write(self, name: str, df: DataFrame, partition_by: tuple[str, ...] = ()) -> DataFrame:
        """Write the next snapshot, switch to it, and return it."""
        number = (self._versions(name) or [0])[-1] + 1
        self._store(df, f"{self.root}/{name}/v={number}", partition_by)
        return self.read(name)

    def append(self, name: str, df: DataFrame, partition_by: tuple[str, ...] = ()) -> DataFrame:
        """Add rows: a folder of its own beside the newest snapshot, seen once it is finished."""
        if not self.exists(name):
            return self.write(name, df, partition_by)
        snapshot, last = self.version(name)
        self._store(df, f"{self.root}/{name}/v={snapshot}.{last + 1}", partition_by)
        return self.read(name)

    @staticmethod
    def _store(df: DataFrame, path: str, partition_by: tuple[str, ...]) -> None:
        # Only a write that failed can have left something there.
        writer = df.write.mode("overwrite")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)

    def drop(self, name: str) -> None:
        self._files().delete(self._path(f"{self.root}/{name}"), True)
