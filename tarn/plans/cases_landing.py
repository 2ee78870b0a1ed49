"""Landing, manifest and homogenising operators bound to the given tables."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarn.functions import keys as K
from tarn.functions import text as X
from tarn.operators import digests as D
from tarn.operators import homogenize as H
from tarn.operators import landing as L
from tarn.plans import views as V
from tarn.plans.zones import drain_landing
from tarn.session import work_path
from tarn.sources.snapshots import Snapshots
from tarn.streaming.drain import object_stream, promote_landing_stream, promote_once_stream

TRIM = V.trim_sql


def source_head(spark: SparkSession, sf: str) -> DataFrame:
    return L.source_head(V.table(spark, sf, "documents"), by=["doc_id"]).select("doc_id", "lang", "n_chars")


def _projected(spark: SparkSession, sf: str) -> list[DataFrame]:
    first, second = V.games(spark, sf)
    return [
        L.project_modalities(
            first, {"pos": "game_id", "text": "about_the_game", "image": "header_image", "video": "movies"}
        ),
        L.project_modalities(
            second,
            {
                "pos": "page_id",
                "text": "description",
                "image": "background_image",
                "video": F.lit(None).cast("string"),
            },
        ),
    ]


def project_modalities(spark: SparkSession, sf: str) -> DataFrame:
    """Both sources under one schema."""
    first, second = _projected(spark, sf)
    return first.unionByName(second)


def union_sources(spark: SparkSession, sf: str) -> DataFrame:
    return L.union_sources(_projected(spark, sf)).select(
        F.col("source_no").cast("long").alias("source_no"), "pos", F.md5("text").alias("text_md5"), "image", "video"
    )


def text_objects(spark: SparkSession, sf: str) -> DataFrame:
    objects = L.text_objects(L.union_sources(_projected(spark, sf)), ["source_no", "pos"])
    return objects.select("key", "size", "content_type", F.md5("text").alias("text_md5"))


def explode_delimited(spark: SparkSession, sf: str) -> DataFrame:
    return L.explode_delimited(V.docs(spark, sf), "text").select(
        "key", F.col("part_no").cast("long").alias("part_no"), "text"
    )


def explode_records(spark: SparkSession, sf: str) -> DataFrame:
    cell = F.concat(
        "props",
        F.lit("|{'id': -1, 'trailer': None, 'image': 'https://img.example.com/"),
        "event_id",
        F.lit(".jpg'}|{broken"),
    )
    cells = V.table(spark, sf, "events").select("event_id", cell.alias("short_screenshots"))
    return L.explode_records(cells, "short_screenshots").select(
        "event_id", F.col("record_no").cast("long").alias("record_no"), "image"
    )


def _links(spark: SparkSession, sf: str) -> DataFrame:
    url = F.when(F.contains("url", F.lit("spam")), "").otherwise(F.col("url"))
    return V.table(spark, sf, "pages").select("page_id", url.alias("url"))


LINKS_SQL = "links AS (SELECT page_id, CASE WHEN contains(url, 'spam') THEN '' ELSE url END AS url FROM pages)"


def link_extension(spark: SparkSession, sf: str) -> DataFrame:
    return _links(spark, sf).select("page_id", K.link_extension(F.col("url")).alias("extension"))


def media_objects(spark: SparkSession, sf: str) -> DataFrame:
    return L.media_objects(_links(spark, sf), ["page_id"])


def fetch_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    links = _links(spark, sf)
    kind = F.length("url") % 6
    log = links.filter(kind != 5).select("url").distinct().select(
        "url",
        F.when(kind == 0, 404).when(kind == 1, 500).when(kind == 4, 200).alias("status"),
        F.when(kind == 2, "timeout").when(kind == 3, "reset").alias("error"),
    )
    return L.fetch_outcomes(links, log).select("page_id", "outcome")


def source_counts(spark: SparkSession, sf: str) -> DataFrame:
    keys = {"documents": "doc_id", "pages": "page_id", "events": "event_id", "conversations": "conv_id"}
    tables = {name: V.table(spark, sf, name) for name in keys}
    heads = {name: L.source_head(df, by=[keys[name]]) for name, df in tables.items()}
    before = L.source_counts(tables).withColumn("stage", F.lit("before"))
    return before.unionByName(L.source_counts(heads).withColumn("stage", F.lit("after")))


def list_objects(spark: SparkSession, sf: str) -> DataFrame:
    return L.list_objects(V.objects(spark, sf), "landing-zone", "temporal-landing/video_").select("key", "size")


def drop_placeholders(spark: SparkSession, sf: str) -> DataFrame:
    objects = V.objects(spark, sf).select("key", "size")
    loose = L.drop_placeholders(objects).withColumn("strict_zero", F.lit(False))
    return loose.unionByName(L.drop_placeholders(objects, True).withColumn("strict_zero", F.lit(True)))


def classify_objects(spark: SparkSession, sf: str) -> DataFrame:
    return L.classify_objects(V.objects(spark, sf)).select("key", "category")


def persistent_keys(spark: SparkSession, sf: str) -> DataFrame:
    return L.persistent_keys(L.classify_objects(V.objects(spark, sf)), V.LAKE_TS).select("key", "dest_key")


def promote_landing(spark: SparkSession, sf: str) -> DataFrame:
    """The drain as a job: writes the zone by category, reads it back."""
    zone = Snapshots(spark, work_path(spark, "landing"))
    zone.write("temporal", V.objects(spark, sf))
    return drain_landing(zone, V.LAKE_TS).select("key", "dest_key", "category")


def promote_landing_stream_case(spark: SparkSession, sf: str) -> DataFrame:
    arriving = object_stream(
        spark, sf, V.table(spark, sf, "documents").schema, "documents.parquet"
    ).select(
        F.lit("landing-zone").alias("bucket"),
        F.concat(F.lit("temporal-landing/text_"), "doc_id", F.lit(".txt")).alias("key"),
        F.col("n_chars").alias("size"),
        F.lit("text/plain").alias("content_type"),
    )
    dest = work_path(spark, "stream")
    promote_landing_stream(arriving, f"{dest}/zone", f"{dest}/progress", V.LAKE_TS).awaitTermination()
    return spark.read.parquet(f"{dest}/zone").select("key", "dest_key", "category")


def promote_once_stream_case(spark: SparkSession, sf: str) -> DataFrame:
    """Every document arrives twice, under two names; equal texts are one object."""
    arriving = object_stream(spark, sf, V.table(spark, sf, "documents").schema, "documents.parquet").select(
        F.lit("landing-zone").alias("bucket"),
        F.explode(
            F.array(*(F.concat(F.lit(f"temporal-landing/{stem}_"), "doc_id", F.lit(".txt")) for stem in ("text", "copy")))
        ).alias("key"),
        F.length("text").cast("long").alias("size"),
        F.lit("text/plain").alias("content_type"),
        F.md5("text").alias("text_md5"),
    )
    dest = work_path(spark, "once")
    promote_once_stream(
        arriving, f"{dest}/zone", f"{dest}/progress", V.LAKE_TS, identity=F.col("text_md5")
    ).awaitTermination()
    return spark.read.parquet(f"{dest}/zone").select("text_md5", "size", "category")


def replicate_zone(spark: SparkSession, sf: str) -> DataFrame:
    zones = V.zones(spark, sf)
    return L.replicate_zone(
        zones.filter("bucket = 'landing-zone'"),
        zones.filter("bucket = 'formatted-zone'"),
        "formatted-zone",
        "persistent-landing",
    ).select("bucket", "key", "size")


def zone_counts(spark: SparkSession, sf: str) -> DataFrame:
    return L.zone_counts(V.zones(spark, sf))


def reconcile_zones(spark: SparkSession, sf: str) -> DataFrame:
    return L.reconcile_zones(V.zones(spark, sf), "landing-zone", "formatted-zone", "persistent-landing")


def reconcile_tree(spark: SparkSession, sf: str) -> DataFrame:
    """Keys and sizes of two zones by their digests."""
    zones = V.zones(spark, sf)
    source = L.drop_placeholders(zones.filter("bucket = 'landing-zone'"))
    stripped = source.withColumn("key", K.strip_prefix(F.col("key"), "persistent-landing"))
    return D.reconcile_tree(stripped, zones.filter("bucket = 'formatted-zone'"))


def replace_extension(spark: SparkSession, sf: str) -> DataFrame:
    key = F.regexp_replace("url", "^https?://", "")
    urls = V.table(spark, sf, "pages").select(key.alias("key"))
    both = V.objects(spark, sf).select("key").unionByName(urls)
    return both.select("key", K.replace_extension(F.col("key"), ".png").alias("new_key"))


def conversion_plan(spark: SparkSession, sf: str) -> DataFrame:
    ext = F.when(F.col("vec_id") % 2 == 0, "JPG").otherwise("png")
    images = V.table(spark, sf, "embeddings").select(
        F.concat(F.lit("images/image_"), F.floor(F.col("vec_id") / 3), F.lit("."), ext).alias("key"),
        (F.col("vec_id") + 1).alias("size"),
    ).distinct()
    return H.conversion_plan(images.groupBy("key").agg(F.max("size").alias("size")), *H.TARGETS["images"])


def extract_dispatch(spark: SparkSession, sf: str) -> DataFrame:
    return H.extract_dispatch(V.objects(spark, sf)).select(
        "key", "extractor", "supported", "new_key", "delete_source"
    )


def _text_case(rule):
    def run(spark: SparkSession, sf: str, wrap) -> DataFrame:
        return V.docs(spark, sf).select("key", F.md5(rule(wrap(F.col("text")))).alias("text_md5"))

    return run


def normalize_spacing(spark: SparkSession, sf: str) -> DataFrame:
    return _text_case(X.normalize_spacing)(
        spark, sf, lambda t: F.concat(F.lit("\u2003\r\n"), F.replace(t, F.lit(". "), F.lit(".\r\n\r\n\r")))
    )


def html_to_text(spark: SparkSession, sf: str) -> DataFrame:
    text = X.html_to_text(F.col("html"))
    return V.table(spark, sf, "pages").select("page_id", text.alias("text")).select(
        "page_id", F.md5("text").alias("text_md5"), F.length("text").cast("long").alias("n_chars")
    )


HTML_SQL = r"""
shown AS (
  SELECT page_id, regexp_replace(regexp_replace(regexp_replace(html,
      '(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>|<template\b.*?</template\s*>|<![^>]*>', '<x>', 'g'),
      '(?:</?[a-zA-Z][^>]*>)+', chr(10), 'g'), '\r\n?', chr(10), 'g') AS t FROM pages),
decoded AS (
  SELECT page_id, replace(replace(replace(replace(replace(replace(t, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'),
      '&copy;', chr(169)), '&middot;', chr(183)), '&amp;', '&') AS t FROM shown),
html_texts AS (SELECT page_id, regexp_replace({trim}, '\n{{3,}}', chr(10) || chr(10), 'g') AS text FROM decoded)
""".format(trim=TRIM("t"))


def markdown_strip_images(spark: SparkSession, sf: str) -> DataFrame:
    return _text_case(X.markdown_strip_images)(
        spark,
        sf,
        lambda t: F.concat(
            F.lit('![[cover.png]] <IMG src="a.png"\n> ![a](http://u.example/x.png "t") '),
            t,
            F.lit('\n![b][img1]\n\n\n\n [img1]: <https://u.example/y.png> "t"\n[img2]: https://u.example\n'),
            t,
            F.lit("\n[img3]: <data:image/png;base64,AAAA\nBBBB>\nlost"),
        ),
    )


def rtf_strip(spark: SparkSession, sf: str) -> DataFrame:
    return _text_case(X.rtf_strip)(
        spark,
        sf,
        lambda t: F.concat(
            F.lit("{\\rtf1\\ansi{\\fonttbl\\f0 Swiss;}\\f0\\fs-24 "),
            F.replace(t, F.lit("\n"), F.lit("\\pard ")),
            F.lit("\\par}"),
        ),
    )


def _zip_pages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        bodies = []
        for page in batch["html"]:
            buffer = io.BytesIO()
            with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
                archive.writestr("b/second.XHTML", page)
                archive.writestr("notes.txt", "no page")
                archive.writestr("a/first.html", "<p>Cover &#8212; one</p>")
            bodies.append(buffer.getvalue())
        yield pd.DataFrame({"key": batch["page_id"].astype(str) + ".epub", "content": bodies})


def archive_members_to_text(spark: SparkSession, sf: str) -> DataFrame:
    pages = V.table(spark, sf, "pages").select("page_id", "html")
    bodies = pages.mapInPandas(_zip_pages, "key string, content binary")
    return H.archive_members_to_text(bodies).select("key", F.md5("text").alias("text_md5"))


def extract_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as texts, markdown and a format without a parser, and pages as HTML, in one conversion."""
    kind = F.col("doc_id") % 3
    text = F.encode(F.when(kind == 1, F.concat("text", F.lit("![x](http://u.example/x.png)"))).otherwise(F.col("text")), "UTF-8")
    ending = F.when(kind == 0, ".txt").when(kind == 1, ".md").otherwise(".pdf")
    documents = V.table(spark, sf, "documents").select(
        F.concat(F.lit("d"), "doc_id", ending).alias("key"), text.alias("content")
    )
    pages = V.table(spark, sf, "pages").select(
        F.concat(F.lit("p"), "page_id", F.lit(".html")).alias("key"), F.encode("html", "UTF-8").alias("content")
    )
    done = H.extract_texts(documents.unionByName(pages))
    return done.select("key", "source_key", F.md5("text").alias("text_md5"), "extractor", "outcome")


def paragraph_join(spark: SparkSession, sf: str) -> DataFrame:
    lines = V.docs(spark, sf).select("key", F.posexplode(F.split("text", "\n")).alias("n", "text"))
    blocks = lines.select(
        "key",
        F.floor(F.col("n") / 10).alias("page"),
        F.floor(F.col("n") % 10 / 2).alias("y"),
        (F.col("n") % 2).alias("x"),
        F.concat(F.lit("\t"), "text", F.lit(" \n")).alias("text"),
    )
    return H.paragraph_join(blocks).select("key", F.md5("text").alias("text_md5"))


def transcode_utf8(spark: SparkSession, sf: str) -> DataFrame:
    text = F.col("text")
    narrow = text.rlike(r"\A[\x00-\xff]*\z")
    content = (
        F.when(F.col("lang") == "fr", F.concat(F.unhex(F.lit("EFBBBF")), F.encode(text, "UTF-8")))
        .when(F.col("lang") == "es", F.encode(text, "UTF-16"))
        .when((F.col("lang") == "de") & narrow, F.encode(F.when(narrow, text), "ISO-8859-1"))
        .otherwise(F.encode(text, "UTF-8"))
    )
    bodies = V.table(spark, sf, "documents").select(F.col("doc_id").alias("key"), content.alias("content"))
    return H.transcode_utf8(bodies).select("key", "encoding", "outcome", F.md5("text").alias("text_md5"))


def conversion_report(spark: SparkSession, sf: str) -> DataFrame:
    objects = L.classify_objects(L.drop_placeholders(V.objects(spark, sf)))
    return H.conversion_report(H.conversion_outcomes(objects))


_CATEGORY = """CASE WHEN content_type LIKE 'text/%' THEN 'texts' WHEN content_type LIKE 'image/%' THEN 'images'
     WHEN content_type LIKE 'video/%' THEN 'videos' ELSE 'quarantine' END"""


def _promoted_sql(source: str) -> str:
    return f"""
named AS (
  SELECT key, {_CATEGORY} AS category, string_split(string_split(key, '.')[-1], '?')[1] AS ext FROM {source}),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY category, ext ORDER BY key) AS place,
         count(*) OVER (PARTITION BY category, ext) AS n FROM named),
promoted AS (
  SELECT key, 'persistent-landing/' || category || '/'
         || CASE category WHEN 'texts' THEN 'text' WHEN 'images' THEN 'image' WHEN 'videos' THEN 'video' ELSE category END
         || '_{V.LAKE_TS}' || CASE WHEN n > 1 THEN '_' || place ELSE '' END || '.' || ext AS dest_key, category
  FROM placed)"""


_STAGED = "staged AS (SELECT * FROM objects WHERE NOT (size = 0 AND key LIKE '%/'))"
_NEW_KEY = r"""CASE WHEN regexp_matches(key, '[^/.][^/]*\.[^./]*$')
      THEN regexp_replace(key, '([^/.][^/]*)\.[^./]*$', '\1{ext}') ELSE key || '{ext}' END"""
_EXT = r"lower(regexp_extract(key, '[^/.][^/]*(\.[^./]*)$', 1))"
_SP = r"[\s\p{Z}\x1c-\x1f\x{85}]"
_NSP = r"\s\p{Z}\x1c-\x1f\x{85}"


def _squeeze(text: str) -> str:
    return f"regexp_replace({TRIM(text)}, '\\n{{3,}}', chr(10) || chr(10), 'g')"


def _markdown_sql() -> str:
    forms = [
        r"!\[\[[^\]]+\]\]",
        r"(?is)<img\b[^>]*>",
        rf"!\[[^\]]*\]\({_SP}*<?[^){_NSP}>]+[^)]*?>?{_SP}*(?:\"[^\"]*\"|''[^'']*''|\([^)]+\))?{_SP}*\)",
        r"!\[[^\]]*\]\[[^\]]*\]",
        rf"(?im)^{_SP}*\[[^\]]+\]:{_SP}*(?:<[^>\n]+>|[^{_NSP}]+)(?:{_SP}+(?:\"[^\"]*\"|''[^'']*''|\([^)]+\)))?{_SP}*$",
        rf"(?ism)^{_SP}*\[[^\]]+\]:{_SP}*<?{_SP}*data:image[^>{_NSP}]*.*$",
    ]
    text = (
        "'![[cover.png]] <IMG src=\"a.png\"' || chr(10) || '> ![a](http://u.example/x.png \"t\") ' || text || chr(10) "
        "|| '![b][img1]' || chr(10) || chr(10) || chr(10) || chr(10) || ' [img1]: <https://u.example/y.png> \"t\"' || chr(10) "
        "|| '[img2]: https://u.example' || chr(10) || text || chr(10) || '[img3]: <data:image/png;base64,AAAA' || chr(10) "
        "|| 'BBBB>' || chr(10) || 'lost'"
    )
    for form in forms:
        text = f"regexp_replace({text}, '{form}', '', 'g')"
    return f"SELECT doc_id AS key, md5({_squeeze(text)}) AS text_md5 FROM documents"


def _rtf_sql() -> str:
    text = (
        r"'{\rtf1\ansi{\fonttbl\f0 Swiss;}\f0\fs-24 ' || replace(text, chr(10), '\pard ') || '\par}'"
    )
    for pattern, new in (
        (r"\\par[d]?", "chr(10) || chr(10)"),
        (r"\{\\[^}]*\}", "' '"),
        (r"\\[a-zA-Z]+-?\d*", "' '"),
        (r"[{}]", "' '"),
    ):
        text = f"regexp_replace({text}, '{pattern}', {new}, 'g')"
    return f"SELECT doc_id AS key, md5({_squeeze(text)}) AS text_md5 FROM documents"


CASES = {
    "source_head": (source_head, "SELECT doc_id, lang, n_chars FROM documents ORDER BY doc_id LIMIT 500"),
    "project_modalities": (project_modalities, f"""WITH {V.GAMES_SQL} SELECT pos, text, image, video FROM games1 UNION ALL SELECT pos, text, image, video FROM games2"""),
    "union_sources": (
        union_sources,
        f"""WITH {V.GAMES_SQL} SELECT 1::BIGINT AS source_no, pos, md5(text) AS text_md5, image, video FROM games1
        UNION ALL SELECT 2, pos, md5(text), image, video FROM games2""",
    ),
    "text_objects": (
        text_objects,
        f"""WITH {V.GAMES_SQL}, both_ AS (SELECT 1 AS n, pos, text FROM games1 UNION ALL SELECT 2, pos, text FROM games2),
        numbered AS (SELECT *, row_number() OVER (ORDER BY n, pos) AS i FROM both_)
        SELECT 'temporal-landing/text_' || i || '.txt' AS key, strlen(text)::BIGINT AS size,
               'text/plain' AS content_type, md5(text) AS text_md5 FROM numbered WHERE text <> ''""",
    ),
    "explode_delimited": (
        explode_delimited,
        f"""WITH cut AS (SELECT doc_id AS key, list_filter(list_transform(string_split(text, ','),
              lambda x: {TRIM('x')}), lambda x: x <> '') AS parts FROM documents)
        SELECT key, unnest(range(len(parts))) AS part_no, unnest(parts) AS text FROM cut""",
    ),
    "explode_records": (
        explode_records,
        """SELECT event_id, r AS record_no,
                  CASE WHEN r = 1 THEN 'https://img.example.com/' || event_id || '.jpg' END AS image
           FROM events, range(3) AS t(r)""",
    ),
    "link_extension": (
        link_extension,
        f"WITH {LINKS_SQL} SELECT page_id, string_split(string_split(url, '.')[-1], '?')[1] AS extension FROM links",
    ),
    "media_objects": (
        media_objects,
        f"""WITH {LINKS_SQL}, n AS (SELECT url, row_number() OVER (ORDER BY page_id) AS i,
              string_split(string_split(url, '.')[-1], '?')[1] AS ext FROM links)
        SELECT 'temporal-landing/image_' || i || '.' || ext AS key, url, 'image/' || ext AS content_type FROM n WHERE url <> ''""",
    ),
    "fetch_outcomes": (
        fetch_outcomes,
        f"""WITH {LINKS_SQL} SELECT page_id, CASE WHEN url = '' THEN 'skipped_empty' ELSE
              CASE length(url) % 6 WHEN 0 THEN 'skipped_not_found' WHEN 1 THEN 'http_error' WHEN 2 THEN 'skipped_timeout'
              WHEN 4 THEN 'uploaded' ELSE 'failed' END END AS outcome FROM links""",
    ),
    "source_counts": (
        source_counts,
        " UNION ALL ".join(
            f"SELECT '{name}' AS source, count(*) AS n_rows, 'before' AS stage FROM {name} "
            f"UNION ALL SELECT '{name}', least(count(*), 500), 'after' FROM {name}"
            for name in ("documents", "pages", "events", "conversations")
        ),
    ),
    "list_objects": (
        list_objects,
        f"WITH {V.OBJECTS_SQL} SELECT key, size FROM objects WHERE key LIKE 'temporal-landing/video\\_%' ESCAPE '\\'",
    ),
    "drop_placeholders": (
        drop_placeholders,
        f"""WITH {V.OBJECTS_SQL} SELECT key, size, false AS strict_zero FROM objects WHERE NOT (size = 0 AND key LIKE '%/')
        UNION ALL SELECT key, size, true FROM objects WHERE size <> 0""",
    ),
    "classify_objects": (classify_objects, f"WITH {V.OBJECTS_SQL} SELECT key, {_CATEGORY} AS category FROM objects"),
    "persistent_keys": (
        persistent_keys,
        f"WITH {V.OBJECTS_SQL}, {_promoted_sql('objects')} SELECT key, dest_key FROM promoted",
    ),
    "promote_landing": (
        promote_landing,
        f"WITH {V.OBJECTS_SQL}, {_STAGED}, {_promoted_sql('staged')} SELECT key, dest_key, category FROM promoted",
    ),
    "promote_landing_stream": (
        promote_landing_stream_case,
        f"""WITH arriving AS (SELECT 'temporal-landing/text_' || doc_id || '.txt' AS key, 'text/plain' AS content_type
        FROM documents), {_promoted_sql('arriving')} SELECT key, dest_key, category FROM promoted""",
    ),
    "promote_once_stream": (
        promote_once_stream_case,
        "SELECT DISTINCT md5(text) AS text_md5, length(text) AS size, 'texts' AS category FROM documents",
    ),
    "replicate_zone": (
        replicate_zone,
        f"""WITH {V.ZONES_SQL}, copied AS (SELECT 'formatted-zone' AS bucket, substr(key, 20) AS key, size FROM zones
              WHERE bucket = 'landing-zone' AND NOT (size = 0 AND key LIKE '%/'))
        SELECT * FROM copied UNION ALL SELECT * FROM zones WHERE bucket = 'formatted-zone' AND key NOT IN (SELECT key FROM copied)""",
    ),
    "zone_counts": (
        zone_counts,
        f"""WITH {V.ZONES_SQL} SELECT bucket, count(*) FILTER (WHERE NOT (key LIKE '%/' OR key LIKE '\\_%' ESCAPE '\\'
        OR key LIKE '.%')) AS n_files FROM zones GROUP BY bucket""",
    ),
    "reconcile_zones": (
        reconcile_zones,
        f"""WITH {V.ZONES_SQL}, a AS (SELECT substr(key, 20) AS key FROM zones WHERE bucket = 'landing-zone' AND NOT (size = 0 AND key LIKE '%/')),
        b AS (SELECT key FROM zones WHERE bucket = 'formatted-zone')
        SELECT coalesce(a.key, b.key) AS key, CASE WHEN a.key IS NULL THEN 'extra' WHEN b.key IS NULL THEN 'missing' ELSE 'ok' END AS status
        FROM a FULL OUTER JOIN b ON a.key = b.key""",
    ),
    "reconcile_tree": (
        reconcile_tree,
        f"""WITH {V.ZONES_SQL}, a AS (SELECT substr(key, 20) AS key, size FROM zones WHERE bucket = 'landing-zone' AND NOT (size = 0 AND key LIKE '%/')),
        b AS (SELECT key, size FROM zones WHERE bucket = 'formatted-zone')
        SELECT coalesce(a.key, b.key) AS key, CASE WHEN a.key IS NULL THEN 'extra' WHEN b.key IS NULL THEN 'missing'
          WHEN a.size IS NOT DISTINCT FROM b.size THEN 'ok' ELSE 'changed' END AS status FROM a FULL OUTER JOIN b ON a.key = b.key""",
    ),
    "replace_extension": (
        replace_extension,
        f"""WITH {V.OBJECTS_SQL}, both_ AS (SELECT key FROM objects UNION ALL SELECT regexp_replace(url, '^https?://', '') FROM pages)
        SELECT key, {_NEW_KEY.format(ext='.png')} AS new_key FROM both_""",
    ),
    "conversion_plan": (
        conversion_plan,
        """WITH images AS (SELECT DISTINCT 'images/image_' || (vec_id // 3) || '.' || CASE WHEN vec_id % 2 = 0 THEN 'JPG' ELSE 'png' END AS key FROM embeddings),
        claims AS (SELECT key, regexp_replace(key, '[.](JPG|png)$', '.png') AS new_key FROM images),
        wins AS (SELECT *, count(*) OVER (PARTITION BY new_key) AS n, max(key) OVER (PARTITION BY new_key) AS w FROM claims)
        SELECT key AS old_key, new_key, 'image/png' AS content_type, n AS n_sources, key = w AS kept FROM wins WHERE key LIKE '%.JPG'""",
    ),
    "extract_dispatch": (
        extract_dispatch,
        f"""WITH {V.OBJECTS_SQL}, e AS (SELECT key, {_EXT} AS ext FROM objects), x AS (SELECT key, ext, CASE ext WHEN '.txt' THEN 'plain'
              WHEN '.docx' THEN 'docx' WHEN '.pdf' THEN 'pdf' WHEN '.epub' THEN 'archive' WHEN '.zip' THEN 'archive' WHEN '.html' THEN 'html'
              WHEN '.odt' THEN 'odt' WHEN '.rtf' THEN 'rtf' WHEN '.md' THEN 'markdown' END AS extractor FROM e)
        SELECT key, extractor, extractor IS NOT NULL AS supported,
               CASE WHEN extractor IS NOT NULL THEN {_NEW_KEY.format(ext='.txt')} ELSE key END AS new_key,
               extractor IS NOT NULL AND ext <> '.txt' AS delete_source FROM x""",
    ),
    "normalize_spacing": (
        normalize_spacing,
        "SELECT doc_id AS key, md5("
        + _squeeze(
            "regexp_replace(chr(8195) || chr(13) || chr(10) || replace(text, '. ', '.' || chr(13) || chr(10) || chr(13) || chr(10) || chr(13)), '\\r\\n?', chr(10), 'g')"
        )
        + ") AS text_md5 FROM documents",
    ),
    "html_to_text": (
        html_to_text,
        f"WITH {HTML_SQL} SELECT page_id, md5(text) AS text_md5, length(text) AS n_chars FROM html_texts",
    ),
    "markdown_strip_images": (markdown_strip_images, _markdown_sql()),
    "rtf_strip": (rtf_strip, _rtf_sql()),
    "archive_members_to_text": (
        archive_members_to_text,
        f"""WITH {HTML_SQL} SELECT page_id || '.epub' AS key,
        md5({_squeeze("'Cover ' || chr(8212) || ' one' || chr(10) || chr(10) || text")}) AS text_md5 FROM html_texts""",
    ),
    "extract_texts": (
        extract_texts,
        f"""WITH {HTML_SQL} SELECT 'd' || doc_id || '.txt' AS key, 'd' || doc_id || CASE doc_id % 3 WHEN 0 THEN '.txt' ELSE '.md' END AS source_key,
          md5(CASE doc_id % 3 WHEN 0 THEN text ELSE {TRIM('text')} END) AS text_md5,
          CASE doc_id % 3 WHEN 0 THEN 'plain' ELSE 'markdown' END AS extractor, CASE doc_id % 3 WHEN 0 THEN 'already_utf8' ELSE 'replaced' END AS outcome
        FROM documents WHERE doc_id % 3 < 2
        UNION ALL SELECT 'd' || doc_id || '.pdf', 'd' || doc_id || '.pdf', NULL, NULL, 'unsupported' FROM documents WHERE doc_id % 3 = 2
        UNION ALL SELECT 'p' || page_id || '.txt', 'p' || page_id || '.html', md5(text), 'html', 'replaced' FROM html_texts""",
    ),
    "paragraph_join": (
        paragraph_join,
        f"""SELECT doc_id AS key, md5(array_to_string(list_filter(list_transform(string_split(text, chr(10)),
        lambda x: {TRIM('x')}), lambda x: x <> ''), chr(10) || chr(10))) AS text_md5 FROM documents WHERE {TRIM('text')} <> ''""",
    ),
    "transcode_utf8": (
        transcode_utf8,
        r"""WITH e AS (SELECT doc_id AS key, text, CASE WHEN lang = 'fr' THEN 'utf-8-sig' WHEN lang = 'es' THEN 'utf-16'
              WHEN NOT regexp_matches(text, '[^\x00-\x7F]') THEN 'ascii'
              WHEN lang = 'de' THEN 'iso-8859-1' ELSE 'utf-8' END AS encoding FROM documents)
        SELECT key, encoding, CASE WHEN encoding IN ('ascii', 'utf-8') THEN 'already_utf8' ELSE 'replaced' END AS outcome,
               md5(text) AS text_md5 FROM e""",
    ),
    "conversion_report": (
        conversion_report,
        f"""WITH {V.OBJECTS_SQL}, {_STAGED}, c AS (SELECT {_CATEGORY} AS category, {_EXT} AS ext FROM staged)
        SELECT category, CASE WHEN (category, ext) IN (('texts', '.txt'), ('images', '.png'), ('videos', '.mp4')) THEN 'already_target'
               WHEN category IN ('images', 'videos') OR (category = 'texts' AND ext IN ('.docx', '.pdf', '.epub', '.zip', '.html', '.odt', '.rtf', '.md'))
               THEN 'replaced' ELSE 'unsupported' END AS outcome, count(*) AS n_objects FROM c GROUP BY 1, 2""",
    ),
}
