"""Source tables, object naming, manifests and zone promotion."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarn.functions import keys as K
from tarn.functions.text import strip
from tarn.operators.ordinal import ordinal

# Fixed value: rows kept of each source table.
HEAD_ROWS = 500


def source_head(df: DataFrame, n: int = HEAD_ROWS, by: Sequence[str] = ()) -> DataFrame:
    """The first ``n`` rows in the order of ``by``: a distributed top-n."""
    return df.orderBy(*by).limit(n)


def project_modalities(df: DataFrame, mapping: Mapping[str, str | Column]) -> DataFrame:
    """Bring a source table under one schema: output name -> column name or expression."""
    return df.select(
        *(
            (F.col(source) if isinstance(source, str) else source).alias(name)
            for name, source in mapping.items()
        )
    )


def union_sources(sources: Sequence[DataFrame]) -> DataFrame:
    """All rows of all sources, duplicates kept, with ``source_no`` to order them."""
    numbered = [df.withColumn("source_no", F.lit(n)) for n, df in enumerate(sources, start=1)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), numbered)


def source_counts(sources: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per source table, empty ones included."""
    counted = [
        df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("source"), "n_rows")
        for name, df in sources.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def text_objects(
    df: DataFrame,
    by: Sequence[str],
    text: str = "text",
    path: str = "temporal-landing/",
    prefix: str = "text",
) -> DataFrame:
    """One object per non-empty string; positions are counted before empty ones are left out."""
    placed = ordinal(df.select(*by, F.col(text).alias("_text")), by, "position")
    return placed.filter(F.length("_text") > 0).select(
        F.concat(F.lit(path + prefix + "_"), F.col("position"), F.lit(".txt")).alias("key"),
        F.col("_text").alias("text"),
        F.octet_length("_text").cast("long").alias("size"),
        F.lit("text/plain").alias("content_type"),
    )


def media_objects(
    df: DataFrame,
    by: Sequence[str],
    link: str = "url",
    path: str = "temporal-landing/",
    prefix: str = "image",
) -> DataFrame:
    """Object key and content type of every non-empty link, numbered like ``text_objects``."""
    placed = ordinal(df.select(*by, F.col(link).alias("url")), by, "position")
    ext = K.link_extension(F.col("url"))
    return placed.filter(F.length("url") > 0).select(
        F.concat(F.lit(path + prefix + "_"), F.col("position"), F.lit("."), ext).alias("key"),
        "url",
        F.concat(F.lit(prefix + "/"), ext).alias("content_type"),
    )


def explode_delimited(df: DataFrame, column: str, separator: str = ",") -> DataFrame:
    """One row per trimmed non-blank part; empty cells give no row. ``part_no`` keeps the order."""
    parts = F.filter(
        F.transform(F.split(column, f"\\Q{separator}\\E"), strip), lambda part: part != ""
    )
    others = [c for c in df.columns if c != column]
    return df.filter(F.length(column) > 0).select(
        *others, F.posexplode(parts).alias("part_no", column)
    )


def explode_records(
    df: DataFrame, column: str, field: str = "image", separator: str = "|", kind: str = "string"
) -> DataFrame:
    """Split a cell into dict literals and take one field of each; a malformed one gives NULL.

    Dict literals are read as lenient JSON. Only where that fails, the words None, True and False
    standing as values are spelled the JSON way and the record is read again.
    """
    options = {"allowSingleQuotes": "true", "allowBackslashEscapingAnyCharacter": "true"}
    schema = f"`{field}` {kind}"

    def spelled(record: Column) -> Column:
        for word, json_word in (("None", "null"), ("True", "true"), ("False", "false")):
            record = F.regexp_replace(record, rf"(:\s*){word}(?=\s*[,}}])", "$1" + json_word)
        return record

    others = [c for c in df.columns if c != column]
    records = df.filter(F.length(column) > 0).select(
        *others, F.posexplode(F.split(column, f"\\Q{separator}\\E")).alias("record_no", "_record")
    )
    first = F.from_json("_record", schema, options)[field]
    second = F.from_json(spelled(F.col("_record")), schema, options)[field]
    return records.select(*others, "record_no", F.coalesce(first, second).alias(field))


def fetch_outcomes(links: DataFrame, fetch_log: DataFrame) -> DataFrame:
    """Outcome of every link from a log ``(url, status, error)`` with one row per url.

    A link may repeat any number of times: the log side is unique, so the adaptive skew join can
    split a hot url's links.
    """
    blank = F.col("url").isNull() | (F.col("url") == "")
    # Blank links would all meet in one key; they need no look-up.
    known = links.filter(~blank).join(fetch_log.select("url", "status", "error"), "url", "left")
    joined = known.unionByName(links.filter(blank), allowMissingColumns=True)
    outcome = (
        F.when(blank, "skipped_empty")
        .when(F.col("status") == 404, "skipped_not_found")
        .when(F.col("error") == "timeout", "skipped_timeout")
        .when(F.col("status") >= 400, "http_error")
        .when(F.col("error").isNotNull() | F.col("status").isNull(), "failed")
        .otherwise("uploaded")
    )
    return joined.withColumn("outcome", outcome)


def list_objects(objects: DataFrame, bucket: str | None = None, prefix: str = "") -> DataFrame:
    """Objects of a bucket whose key starts with ``prefix``: plain filters that reach the scan."""
    found = objects if bucket is None else objects.filter(F.col("bucket") == bucket)
    return found.filter(F.startswith("key", F.lit(prefix))) if prefix else found


def drop_placeholders(objects: DataFrame, strict_zero: bool = False) -> DataFrame:
    """Leave out folder marks, or with ``strict_zero`` every empty object."""
    if strict_zero:
        return objects.filter(F.col("size") != 0)
    return objects.filter(~K.is_placeholder(F.col("key"), F.col("size")))


def classify_objects(objects: DataFrame) -> DataFrame:
    """Add the zone category of each object's content type."""
    return objects.withColumn("category", K.category_of(F.col("content_type")))


def persistent_keys(
    objects: DataFrame, ts_ms: int, dest: str = "persistent-landing/"
) -> DataFrame:
    """Timestamped destination key of each classified object.

    A batch shares one timestamp. Where several objects of a category share an extension, a position
    in source-key order keeps their names apart.
    """
    named = objects.withColumn("ext", K.link_extension(F.col("key")))
    placed = ordinal(named, ["key"], "place", ["category", "ext"], "same_name")
    stem = K.category_stem(F.col("category"))
    suffix = F.when(F.col("same_name") > 1, F.concat(F.lit("_"), F.col("place"))).otherwise("")
    return (
        placed.withColumn(
            "dest_key",
            F.concat(
                F.lit(dest), "category", F.lit("/"), stem, F.lit(f"_{ts_ms}"), suffix, F.lit("."), "ext"
            ),
        )
        .drop("place", "same_name")
    )


def promote_landing(
    objects: DataFrame,
    ts_ms: int,
    source: str = "temporal-landing/",
    dest: str = "persistent-landing/",
) -> DataFrame:
    """Plan of one drain of the staging area: every staged object with its class and new key.

    The writer stores the moved rows and then drops the staged snapshot, see ``plans.zones``.
    """
    staged = drop_placeholders(list_objects(objects, prefix=source))
    return persistent_keys(classify_objects(staged), ts_ms, dest)


def replicate_zone(
    source: DataFrame, dest: DataFrame, dest_bucket: str, src_prefix: str = ""
) -> DataFrame:
    """The destination after copying: replaced by key, never pruned; the last source key wins."""
    copied = drop_placeholders(list_objects(source, prefix=src_prefix)).select(
        F.lit(dest_bucket).alias("bucket"),
        K.strip_prefix(F.col("key"), src_prefix).alias("key"),
        F.col("key").alias("_source_key"),
        *(c for c in source.columns if c not in ("bucket", "key")),
    )
    values = [c for c in copied.columns if c != "key"]
    latest = (
        copied.groupBy("key")
        .agg(F.max_by(F.struct(*values), "_source_key").alias("_row"))
        .select("key", "_row.*")
        .drop("_source_key")
    )
    kept = dest.join(latest.select("key"), "key", "left_anti")
    return kept.unionByName(latest)


def zone_counts(objects: DataFrame) -> DataFrame:
    """Files per bucket; a bucket with folder marks or system files only reports zero."""
    return objects.groupBy("bucket").agg(F.count_if(K.is_counted(F.col("key"))).alias("n_files"))


def reconcile_zones(objects: DataFrame, source: str, dest: str, src_prefix: str = "") -> DataFrame:
    """Per key: ``ok`` in both zones, ``missing`` from the destination, or ``extra`` there.

    One aggregation over both zones instead of a full outer join of two.
    """
    is_source = F.col("bucket") == source
    both = drop_placeholders(objects.filter(F.col("bucket").isin(source, dest)))
    both = both.filter(~is_source | F.startswith("key", F.lit(src_prefix)))
    key = F.when(is_source, K.strip_prefix(F.col("key"), src_prefix)).otherwise(F.col("key"))
    seen = both.select(key.alias("key"), "bucket").groupBy("key").agg(
        F.bool_or(F.col("bucket") == source).alias("in_source"),
        F.bool_or(F.col("bucket") == dest).alias("in_dest"),
    )
    status = (
        F.when(F.col("in_source") & F.col("in_dest"), "ok")
        .when(F.col("in_source"), "missing")
        .otherwise("extra")
    )
    return seen.select("key", status.alias("status"))
