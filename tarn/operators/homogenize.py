"""Bring texts, images and videos to one format per kind."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarn.functions import keys as K
from tarn.functions import text as X
from tarn.functions.unicode import decode_marked
from tarn.operators.skew import join_facts
from tarn.sources.archives import with_members

# Target extension and content type of each category.
TARGETS = {
    "texts": (".txt", "text/plain"),
    "images": (".png", "image/png"),
    "videos": (".mp4", "video/mp4"),
}

# Text extension -> extractor.
EXTRACTORS = {
    ".docx": "docx",
    ".pdf": "pdf",
    ".epub": "archive",
    ".zip": "archive",
    ".html": "html",
    ".odt": "odt",
    ".rtf": "rtf",
    ".md": "markdown",
}


def conversion_plan(objects: DataFrame, target: str, content_type: str) -> DataFrame:
    """Objects to convert: old key, new key, new type, how many share the new key, and who wins.

    Objects in the target format are left alone. Where several sources meet in one new key, or meet an
    object that has it already, the greatest old key is kept.
    """
    named = K.replace_extension(F.col("key"), target)
    listed = objects.filter(~K.is_placeholder(F.col("key"), F.col("size"))).select(
        F.col("key").alias("old_key"),
        F.when(K.extension(F.col("key")) == target, F.col("key")).otherwise(named).alias("new_key"),
        (K.extension(F.col("key")) != target).alias("convert"),
    )
    claims = listed.groupBy("new_key").agg(
        F.count("*").alias("n_sources"), F.max("old_key").alias("winner")
    )
    return (
        join_facts(listed.filter("convert"), claims, ["new_key"])
        .select(
            "old_key",
            "new_key",
            F.lit(content_type).alias("content_type"),
            "n_sources",
            (F.col("old_key") == F.col("winner")).alias("kept"),
        )
    )


def extract_dispatch(
    objects: DataFrame, dest_bucket: str | None = None, keep_original: bool = False
) -> DataFrame:
    """Extractor of each text object, whether it is supported, and whether its source is deleted."""
    ext = K.extension(F.col("key"))
    pairs = [F.lit(part) for pair in EXTRACTORS.items() for part in pair]
    extractor = F.when(ext == ".txt", F.lit("plain")).otherwise(F.create_map(*pairs)[ext])
    converts = extractor.isNotNull() & (ext != ".txt")
    deletes = F.lit(dest_bucket is None and not keep_original)
    bucket = F.col("bucket") if dest_bucket is None else F.lit(dest_bucket)
    return objects.select(
        F.col("key"),
        extractor.alias("extractor"),
        extractor.isNotNull().alias("supported"),
        bucket.alias("target_bucket"),
        F.when(converts, K.replace_extension(F.col("key"), ".txt"))
        .otherwise(F.col("key"))
        .alias("new_key"),
        (converts & deletes).alias("delete_source"),
    )


def archive_members_to_text(bodies: DataFrame) -> DataFrame:
    """Text of EPUB and ZIP bodies ``(key, content)``: pages in name order, blank lines between.

    Python only unpacks; the pages of an archive stay in its row and are turned to text in the JVM.
    """
    return with_members(bodies).select(
        "key", X.html_pages_to_text(F.col("members")).alias("text"), "error"
    )


def paragraph_join(blocks: DataFrame) -> DataFrame:
    """Text per ``key`` from blocks ``(key, page, y, x, text)`` in page, y, x order.

    Joined page by page first, so that the last step sorts one row per page.
    """
    stripped = blocks.withColumn("text", X.strip(F.col("text"))).filter(F.col("text") != "")
    pages = stripped.groupBy("key", "page").agg(
        F.array_join(
            F.transform(
                F.array_sort(F.collect_list(F.struct("y", "x", "text"))), lambda block: block["text"]
            ),
            "\n\n",
        ).alias("text")
    )
    return pages.groupBy("key").agg(
        X.normalize_spacing(
            F.array_join(
                F.transform(
                    F.array_sort(F.collect_list(F.struct("page", "text"))), lambda page: page["text"]
                ),
                "\n\n",
            )
        ).alias("text")
    )


# The control characters of Latin-1 that are signs in Windows-1252, and these.
_SIGNS = [bytes([b]).decode("cp1252", "ignore") for b in range(0x80, 0xA0)]
_CP1252 = ("".join(chr(0x80 + i) for i, sign in enumerate(_SIGNS) if sign), "".join(_SIGNS))


# The extractor of each format that is no archive.
_EXTRACTOR_OF = {".txt": "plain", ".html": "html", ".md": "markdown", ".rtf": "rtf"}


def transcode_utf8(bodies: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """UTF-8 text of plain bodies ``(key, content)`` with the encoding found and the outcome.

    Byte-order marks decide first, then validity as UTF-8; what remains is read as Latin-1, in which
    every byte sequence is valid, with the quotes and signs that Windows-1252 has among its controls. Marks are dropped.
    """
    content = F.col("content")
    mark = F.hex(F.substring(content, 1, 3))
    plain = content.cast("string")
    encoding = (
        F.when(F.octet_length(content) == 0, "empty")
        .when(mark == "EFBBBF", "utf-8-sig")
        .when(mark.startswith("FFFE") | mark.startswith("FEFF"), "utf-16")
        .when(F.is_valid_utf8(plain), F.when(plain.rlike(X.NON_ASCII), "utf-8").otherwise("ascii"))
        .otherwise("iso-8859-1")
    )
    found = bodies.withColumn("encoding", encoding)
    marked = F.col("encoding").isin("utf-8-sig", "utf-16")
    text = (
        F.when(F.col("encoding").isin("empty", "ascii", "utf-8"), plain)
        .when(marked, decode_marked(content, marked))
        .otherwise(F.translate(F.decode(content, "ISO-8859-1"), *_CP1252))
    )
    outcome = F.when(
        F.col("encoding").isin("empty", "ascii", "utf-8"), "already_utf8"
    ).otherwise("replaced")
    return found.select("key", text.alias("text"), "encoding", outcome.alias("outcome"), *keep)


def extract_texts(bodies: DataFrame) -> DataFrame:
    """Text of every body ``(key, content)``: one pass for all formats, and one for archives alone.

    Columns: key (with its new extension), source_key, text, extractor, outcome. Formats whose parsers
    are outside Spark come back as ``unsupported`` and keep their key.
    """
    ext = K.extension(F.col("key"))
    archive = ext.isin(".epub", ".zip")
    decoded = X.lossy_utf8(F.col("content"))

    def of(extension: str) -> Column:
        """The decoded body where it has this extension, so that no rule works on others."""
        return F.when(ext == extension, decoded)

    plain = transcode_utf8(bodies.filter(~archive), keep=("content",))
    known = ext.isin(".txt", ".html", ".md", ".rtf")
    text = (
        F.when(ext == ".txt", F.col("text"))
        .when(ext == ".html", X.html_to_text(of(".html")))
        .when(ext == ".md", X.markdown_strip_images(of(".md")))
        .when(ext == ".rtf", X.rtf_strip(F.replace(of(".rtf"), F.lit("\ufffd"), F.lit(""))))
    )
    extractor = F.create_map(*(F.lit(x) for pair in _EXTRACTOR_OF.items() for x in pair))[ext]
    outcome = F.when(ext == ".txt", F.col("outcome")).when(known, "replaced").otherwise("unsupported")
    single = plain.select(
        F.when(known & (ext != ".txt"), K.replace_extension(F.col("key"), ".txt")).otherwise(F.col("key")).alias("key"),
        F.col("key").alias("source_key"),
        text.alias("text"),
        extractor.alias("extractor"),
        outcome.alias("outcome"),
    )
    archives = archive_members_to_text(bodies.filter(archive)).select(
        K.replace_extension(F.col("key"), ".txt").alias("key"),
        F.col("key").alias("source_key"),
        "text",
        F.lit("archive").alias("extractor"),
        F.when(F.col("error").isNull(), "replaced").otherwise("failed").alias("outcome"),
    )
    return single.unionByName(archives)


def conversion_outcomes(objects: DataFrame) -> DataFrame:
    """What homogenising does with each classified object."""
    ext = K.extension(F.col("key"))
    target = F.create_map(
        *(F.lit(part) for name, (suffix, _) in TARGETS.items() for part in (name, suffix))
    )[F.col("category")]
    supported = F.when(F.col("category") == "texts", ext.isin(list(EXTRACTORS))).otherwise(
        F.col("category").isin("images", "videos")
    )
    outcome = (
        F.when(ext == target, "already_target").when(supported, "replaced").otherwise("unsupported")
    )
    return objects.withColumn("outcome", outcome)


def conversion_report(outcomes: DataFrame) -> DataFrame:
    """Objects per category and outcome."""
    return outcomes.groupBy("category", "outcome").agg(F.count("*").alias("n_objects"))
