"""Object keys, links and content types."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Media class -> zone category and file-name stem.
CATEGORIES = {"text": "texts", "image": "images", "video": "videos"}
QUARANTINE = "quarantine"

# Stored file type -> modality.
MODALITY_OF_EXTENSION = {"txt": "text", "png": "image", "mp4": "video"}

# The last dot counts as an extension mark only after a character that is neither a dot nor a slash,
# so ".hidden" has no extension.
_WITH_EXTENSION = r"([^/.][^/]*)\.[^./]*$"
_EXTENSION = r"[^/.][^/]*(\.[^./]*)$"


def link_extension(url: Column) -> Column:
    """Text after the last dot, cut at the first question mark."""
    return F.substring_index(F.substring_index(url, ".", -1), "?", 1)


def extension(key: Column) -> Column:
    """Lower-case extension with its dot, or the empty string."""
    return F.lower(F.regexp_extract(key, _EXTENSION, 1))


def replace_extension(key: Column, target: str) -> Column:
    """Swap the extension for ``target`` (such as ``.png``), adding it where there is none."""
    return F.when(
        key.rlike(_WITH_EXTENSION), F.regexp_replace(key, _WITH_EXTENSION, "$1" + target)
    ).otherwise(F.concat(key, F.lit(target)))


def category_of(content_type: Column) -> Column:
    """Zone category of a content type; anything unknown goes to quarantine."""
    found = F.when(F.lit(False), F.lit(None).cast("string"))
    for media, category in CATEGORIES.items():
        found = found.when(F.startswith(content_type, F.lit(media + "/")), F.lit(category))
    return found.otherwise(F.lit(QUARANTINE))


def category_stem(category: Column) -> Column:
    """``images`` -> ``image``; the quarantine category keeps its name."""
    return F.when(category == QUARANTINE, category).otherwise(
        F.regexp_replace(category, "s$", "")
    )


def modality_of(document: Column) -> Column:
    """Modality by the extension after the last dot; NULL for anything else."""
    ext = F.substring_index(document, ".", -1)
    found = F.when(F.lit(False), F.lit(None).cast("string"))
    for name, modality in MODALITY_OF_EXTENSION.items():
        found = found.when(ext == name, F.lit(modality))
    return found


def strip_prefix(key: Column, prefix: str) -> Column:
    """Drop a leading ``prefix`` and one slash left in front."""
    return F.regexp_replace(F.substring(key, len(prefix) + 1, 2**31 - 1), "^/", "")


def is_placeholder(key: Column, size: Column) -> Column:
    """Zero-byte keys that stand for folders."""
    return (size == 0) & F.endswith(key, F.lit("/"))


def is_counted(key: Column) -> Column:
    """Keys that count as files: no folder marks, no system or hidden files."""
    return ~(
        F.endswith(key, F.lit("/")) | F.startswith(key, F.lit("_")) | F.startswith(key, F.lit("."))
    )
