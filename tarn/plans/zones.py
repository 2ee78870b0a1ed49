"""The lake's jobs: each reads the newest snapshot of a zone and writes the next zone's."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.functions import keys as K
from tarn.functions.chunks import MAX_TOKENS
from tarn.operators import homogenize as H
from tarn.operators import landing as L
from tarn.operators.text_clean import clean_text
from tarn.operators.text_quality import text_profile
from tarn.sources.snapshots import Snapshots


def drain_landing(zone: Snapshots, ts_ms: int) -> DataFrame:
    """Move everything staged in ``temporal`` to ``persistent``, by batch and category.

    The moved rows carry the version of the staging area they were read from. A drain that stopped before it emptied
    the staging area finds that version moved and only empties it. What is emptied is what was moved:
    objects staged meanwhile, and folder marks, stay in the newest version.
    """
    version = zone.version("temporal")
    drained = ".".join(map(str, version))
    staged = zone.read("temporal", version)
    gone = L.drop_placeholders(staged).select("key").distinct()
    known = zone.read("persistent") if zone.exists("persistent") else None
    moved_before = known is not None and known.filter(F.col("drained") == drained).limit(1).count() > 0
    if not moved_before and (known is None or gone.limit(1).count()):
        moved = L.promote_landing(staged, ts_ms).withColumn("batch", F.lit(ts_ms).cast("long"))
        zone.append("persistent", moved.withColumn("drained", F.lit(drained)), ("batch", "category"))
    newest = zone.version("temporal")
    rows = zone.read("temporal", newest)
    if newest == version:
        left = rows.filter(K.is_placeholder(F.col("key"), F.col("size")))
    else:
        left = rows.join(gone, "key", "left_anti")
    zone.write("temporal", left)
    return zone.read("persistent")


def format_texts(zone: Snapshots) -> DataFrame:
    """Persistent text bodies ``(dest_key, category, content)`` to ``formatted_texts``."""
    bodies = (
        zone.read("persistent")
        .filter("category = 'texts'")
        .select(K.strip_prefix(F.col("dest_key"), "persistent-landing").alias("key"), "content")
    )
    return zone.write("formatted_texts", H.extract_texts(bodies))


def trust_texts(
    zone: Snapshots, translated: DataFrame | None = None, max_tokens: int = MAX_TOKENS
) -> DataFrame:
    """Profile and clean the formatted texts into ``text_profiles`` and ``trusted_texts``."""
    texts = zone.read("formatted_texts").filter(F.col("text").isNotNull()).select("key", "text")
    zone.write("text_profiles", text_profile(texts))
    return zone.write("trusted_texts", clean_text(texts, translated, max_tokens))
