"""Vector collections ``(id, document, modality, embedding)``: as frames and as stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarn.functions import keys as K
from tarn.operators.ledger import NumberLedger
from tarn.sources.snapshots import Snapshots

COLLECTION = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("document", T.StringType()),
        T.StructField("modality", T.StringType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
    ]
)
_COLUMNS = COLLECTION.fieldNames()


def one_per_id(rows: DataFrame) -> DataFrame:
    """The row with the smallest document per id."""
    others = [c for c in _COLUMNS if c != "id"]
    return (
        rows.groupBy("id")
        .agg(F.min_by(F.struct(*others), "document").alias("row"))
        .select("id", "row.*")
        .select(*_COLUMNS)
    )


def as_collection(rows: DataFrame) -> DataFrame:
    """``(id, document, embedding)`` with the modality its document implies."""
    return rows.select(
        "id",
        "document",
        K.modality_of(F.col("document")).alias("modality"),
        F.col("embedding").cast("array<float>").alias("embedding"),
    )


def collection_add(collection: DataFrame, rows: DataFrame, mode: str = "add") -> DataFrame:
    """The collection after adding rows: ids already there stay, or with ``upsert`` are replaced."""
    new = one_per_id(rows)
    if mode == "add":
        fresh = new.join(collection.select("id"), "id", "left_anti")
        return collection.select(*_COLUMNS).unionByName(fresh)
    if mode == "upsert":
        kept = collection.select(*_COLUMNS).join(new.select("id"), "id", "left_anti")
        return kept.unionByName(new)
    raise ValueError(f"unknown mode {mode!r}; choose add or upsert")


def collection_width(collection: DataFrame) -> int | None:
    """The vector width, from one row: a collection holds a single width. None if it is empty."""
    row = collection.select(F.size("embedding").alias("width")).first()
    return None if row is None else row["width"]


def enforce_width(rows: DataFrame, width: int | None) -> DataFrame:
    """Fail on a vector of another width, while the rows pass by and without a scan of its own."""
    if width is None:
        return rows
    message = F.concat(
        F.lit(f"the collection holds vectors of width {width}, found width "), F.size("embedding")
    )
    checked = F.when(F.size("embedding") == width, F.col("embedding")).otherwise(
        F.raise_error(message).cast("array<float>")
    )
    return rows.withColumn("embedding", checked)


def collection_merge(dest: DataFrame, source: DataFrame) -> DataFrame:
    """All rows of both collections; ids of ``dest`` win. Both must have one vector width."""
    width = collection_width(dest)
    return collection_add(dest, enforce_width(source, width))


def collection_peek(collection: DataFrame, x: int | None = None, dims: int = 5) -> DataFrame:
    """Id, document and first dimensions of the first ``x`` rows by id, or of all rows."""
    shown = collection.select(
        "id", "document", F.slice("embedding", 1, dims).alias("first_dims")
    )
    return shown.orderBy("id").limit(x) if x else shown


class CollectionStore:
    """Collections kept as snapshot tables below one folder."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.tables = Snapshots(spark, root)
        self.ledger = NumberLedger(spark, f"{root.rstrip('/')}/_ledger")

    def names(self) -> list[str]:
        return [name for name in self.tables.names() if not name.startswith("_")]

    def get_or_create(self, name: str) -> DataFrame:
        if not self.tables.exists(name):
            self.tables.write(name, self.spark.createDataFrame([], COLLECTION))
        return self.tables.read(name)

    def add(self, name: str, rows: DataFrame) -> DataFrame:
        """Append the rows whose id is new. Adding the same rows twice changes nothing."""
        stored = self.get_or_create(name)
        new = self._checked(stored, rows)
        fresh = one_per_id(new).join(stored.select("id"), "id", "left_anti")
        return self.tables.append(name, fresh)

    def upsert(self, name: str, rows: DataFrame) -> DataFrame:
        """Replace rows by id in a new snapshot."""
        stored = self.get_or_create(name)
        return self.tables.write(name, collection_add(stored, self._checked(stored, rows), "upsert"))

    @staticmethod
    def _checked(stored: DataFrame, rows: DataFrame) -> DataFrame:
        new = as_collection(rows)
        return enforce_width(new, collection_width(stored) or collection_width(new))

    def merge(self, dest: str, source: str) -> DataFrame:
        return self.add(dest, self.get_or_create(source))

    def peek(self, name: str, x: int | None = None) -> DataFrame:
        return collection_peek(self.get_or_create(name), x)

    def drop(self, name: str) -> None:
        self.tables.drop(name)
