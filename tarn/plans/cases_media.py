"""Media profiles, frame selection, vectors and collections bound to the given tables."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarn.functions import encoders as E
from tarn.operators import collections as CO
from tarn.operators import embeddings as EM
from tarn.operators import media as M
from tarn.operators import profiles as P
from tarn.operators.images import frame_standardize as standardize_frames
from tarn.operators.images import image_standardize as standardize
from tarn.operators.ledger import NumberLedger
from tarn.plans import views as V
from tarn.plans.cases_text import _pieces
from tarn.session import work_path

# Colour types a generated header cycles through, by label.
_COLOURS = (0, 2, 3, 4, 6)


def _headers(spark: SparkSession, sf: str) -> DataFrame:
    """PNG headers whose size and colour follow from the row; every tenth label is no PNG."""

    def hexed(value, digits: int):
        return F.lpad(F.hex(value), digits, "0")

    colour = F.get(F.array(*(F.lit(c) for c in _COLOURS)), (F.col("label") % 5).cast("int"))
    header = F.concat(
        F.when(F.col("label") == 9, "FFD8FFE0000000000000000D49484452").otherwise(
            "89504E470D0A1A0A0000000D49484452"
        ),
        hexed(F.col("vec_id") + 1, 8),
        hexed(F.col("vec_id") % 7 * 64, 8),
        F.lit("08"),
        hexed(colour, 2),
        F.lit("000000"),
    )
    return V.table(spark, sf, "embeddings").select(
        F.concat(F.lit("images/image_"), "vec_id", F.lit(".png")).alias("key"),
        (F.col("label") * 512).alias("size"),
        F.unhex(header).alias("content"),
    )


def image_profile(spark: SparkSession, sf: str) -> DataFrame:
    return M.image_profile(_headers(spark, sf))


def _profiles(spark: SparkSession, sf: str) -> DataFrame:
    return M.media_profile(V.media_meta(spark, sf))


def media_profile(spark: SparkSession, sf: str) -> DataFrame:
    images = _profiles(spark, sf).withColumn("kind", F.lit("image"))
    videos = M.media_profile(V.media_meta(spark, sf), "video").withColumn("kind", F.lit("video"))
    return images.unionByName(videos)


TEXTS, NUMBERS = ("file_name", "mode"), ("file_size", "width", "height", "aspect_ratio", "channels")


def describe_all(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(M.describe_all(_profiles(spark, sf), TEXTS, NUMBERS))


def _shown(summary: DataFrame) -> DataFrame:
    """Statistics of numbers with six digits, as SQL writes them."""
    digits = F.col("number").cast("decimal(38,6)").cast("string")
    return summary.withColumn("value", F.when(F.col("column").isin(*NUMBERS), digits).otherwise(F.col("value"))).drop("number")


def before_after_profile(spark: SparkSession, sf: str) -> DataFrame:
    before = _profiles(spark, sf)
    after = before.filter("height > 0").select(
        "file_name",
        F.lit(512).alias("width"),
        F.lit(512).alias("height"),
        F.lit("RGB").alias("mode"),
        (F.col("file_size") / 2).alias("file_size"),
    )
    return _shown(M.before_after_profile(before, after, ("mode",), ("file_size", "width")))


PROFILED = ("l_quantity", "l_extendedprice", "l_partkey")
LABELLED = ("l_returnflag", "l_linestatus")
LEVELS = (0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0)


def merged_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Every line number a batch of its own, stored, read back and merged; estimates held against the exact path."""
    lines = V.table(spark, sf, "lineitem")
    path = work_path(spark, "profiles")
    P.batch_profile(lines, ["l_linenumber"], PROFILED, LABELLED).write.partitionBy("l_linenumber").parquet(path)
    P.store_profile(P.merged_profile(P.stored_profiles(spark, path)), f"{path}-zone", "all")
    report = P.profile_report(P.stored_profiles(spark, f"{path}-zone"), LEVELS, 3)
    level = F.get(F.array(*(F.lit(x) for x in LEVELS)), F.col("place"))
    slack = P.RANK_ERROR
    held = P.quantile_ranks(lines, report, PROFILED).groupBy("column").agg(
        F.bool_and(
            (F.col("below") <= (level + slack) * F.col("n")) & (F.col("upto") >= (level - slack) * F.col("n"))
        ).alias("quantiles_hold")
    )
    exact = lines.agg(*(F.countDistinct(c).alias(c) for c in (*PROFILED, *LABELLED))).select(
        F.inline(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).alias("exact")) for c in (*PROFILED, *LABELLED))))
    )
    written = F.concat_ws(",", F.transform("top", lambda t: F.concat(t["item"], F.lit(":"), t["count"])))
    near = F.abs(F.col("n_distinct") - F.col("exact")) <= P.DISTINCT_ERROR * F.col("exact")
    return report.join(F.broadcast(held), "column", "left").join(F.broadcast(exact), "column").select(
        "column", "rows", "nulls", "least", "greatest", "quantiles_hold", near.alias("distinct_holds"), written.alias("top")
    )


def _merged_profile_sql() -> str:
    numbers = (
        f"""SELECT '{c}' AS "column", count(*) AS rows, count(*) - count({c}) AS nulls, min({c})::DOUBLE AS least,
        max({c})::DOUBLE AS greatest, true AS quantiles_hold, true AS distinct_holds, '' AS top FROM lineitem"""
        for c in PROFILED
    )
    labels = (
        f"""SELECT '{c}', (SELECT count(*) FROM lineitem), (SELECT count(*) - count({c}) FROM lineitem), NULL, NULL, NULL, true,
        (SELECT string_agg({c} || ':' || n, ',' ORDER BY n DESC, {c}) FROM
          (SELECT {c}, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, 1 LIMIT 3))"""
        for c in LABELLED
    )
    return " UNION ALL ".join([*numbers, *labels])


def distinct_modes(spark: SparkSession, sf: str) -> DataFrame:
    return M.distinct_modes(_profiles(spark, sf))


def histogram(spark: SparkSession, sf: str) -> DataFrame:
    parts = [
        M.histogram(_profiles(spark, sf), column).withColumn("column", F.lit(column))
        for column in ("file_size", "aspect_ratio")
    ]
    return parts[0].unionByName(parts[1]).select(
        "column", "bin", F.round("lower", 6).alias("lower"), F.round("upper", 6).alias("upper"), "n"
    )


def density_2d(spark: SparkSession, sf: str) -> DataFrame:
    return M.density_2d(_profiles(spark, sf))


def purge_zero_size(spark: SparkSession, sf: str) -> DataFrame:
    return M.purge_zero_size(V.objects(spark, sf))


def _grey_images(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors drawn as 8 x 8 grey images."""
    pixel = F.transform("embedding", lambda x: F.lpad(F.hex(F.floor((x + 1) * 127).cast("int")), 2, "0"))
    return V.table(spark, sf, "embeddings").select(
        F.col("vec_id").cast("string").alias("origin"),
        F.concat(F.lit("video_"), "label").alias("video_id"),
        F.col("vec_id").alias("frame_no"),
        F.lit(8).alias("height"),
        F.lit(8).alias("width"),
        F.lit(1).alias("nChannels"),
        F.unhex(F.array_join(pixel, "")).alias("data"),
    )


def image_standardize(spark: SparkSession, sf: str) -> DataFrame:
    """All images at the target size; pixels are shown as a digest."""
    return standardize(_grey_images(spark, sf)).select(
        "origin", "height", "width", "nChannels", F.octet_length("data").alias("n_bytes"), F.md5("data").alias("md5")
    )


def frame_standardize(spark: SparkSession, sf: str) -> DataFrame:
    """All frames shrunk to 2 x 2: the mean of each quarter, so that SQL can follow."""
    shrunk = standardize_frames(_grey_images(spark, sf), (2, 2))
    return shrunk.select("video_id", "frame_no", F.hex("data").alias("pixels"))


def frame_decimate(spark: SparkSession, sf: str) -> DataFrame:
    frames = V.ticks(spark, sf).withColumn("frame_no", F.col("frame_no") + 1)
    return M.frame_decimate(frames).select("video_id", "event_id", "frame_no", "frame_skip")


def frame_sample(spark: SparkSession, sf: str) -> DataFrame:
    return M.frame_sample(V.ticks(spark, sf)).select("video_id", "event_id", "frame_no")


def l2_normalize(spark: SparkSession, sf: str) -> DataFrame:
    scaled = F.transform("embedding", lambda x: x.cast("double") * F.col("label"))
    return V.digest(EM.l2_normalize(V.vectors(spark, sf).withColumn("embedding", scaled)), ["id"])


def encode_batch(spark: SparkSession, sf: str) -> DataFrame:
    return V.digest(EM.encode_batch(V.docs(spark, sf), E.hash_encoder(64), "text"), ["key"])


def hash_encode(spark: SparkSession, sf: str) -> DataFrame:
    return V.digest(EM.hash_encode(V.docs(spark, sf)), ["key"])


def embed_paragraphs(spark: SparkSession, sf: str) -> DataFrame:
    return V.digest(EM.embed_paragraphs(V.docs(spark, sf), E.hash_encoder(64), "\n"), ["key"])


def mean_pool(spark: SparkSession, sf: str) -> DataFrame:
    pooled = EM.mean_pool(V.vectors(spark, sf), ["label", "modality"])
    return pooled.select("label", "modality", F.posexplode("embedding").alias("dim", "x")).select(
        "label", "modality", "dim", (F.round("x", 6) + 0.0).alias("x")
    )


def closed_form_weights(width_in: int = 64, width_out: int = 96) -> tuple[np.ndarray, np.ndarray]:
    """Weights both engines can work out from the indexes."""
    i, j = np.arange(width_out)[:, None], np.arange(width_in)[None, :]
    return ((i * 31 + j * 17) % 101 - 50) / 500.0, (np.arange(width_out) % 7 - 3) / 100.0


def project_linear(spark: SparkSession, sf: str) -> DataFrame:
    return V.digest(EM.project_linear(V.vectors(spark, sf), *closed_form_weights()), ["id"])


def embed_videos(spark: SparkSession, sf: str) -> DataFrame:
    return V.digest(EM.embed_videos(V.frames(spark, sf)), ["video_id"])


def numbered_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Documents numbered in two batches, even ids first; the second brings the first ones again."""
    ledger = NumberLedger(spark, work_path(spark, "ledger"))
    keys = V.docs(spark, sf).select("key")
    ledger.extend(keys.filter("key % 2 = 0"), "text").count()
    return ledger.extend(keys, "text").select("key", "id")


def assign_ids(spark: SparkSession, sf: str) -> DataFrame:
    texts = V.objects(spark, sf).filter(F.startswith("key", F.lit("temporal-landing/text_")))
    return EM.assign_ids(texts, "text").select("key", "id")


def _store(spark: SparkSession) -> CO.CollectionStore:
    return CO.CollectionStore(spark, work_path(spark, "collections"))


def _listing(store: CO.CollectionStore) -> DataFrame:
    from functools import reduce

    counted = [
        store.get_or_create(name).agg(
            F.lit(name).alias("collection"),
            F.count("*").alias("n"),
            F.max(F.size("embedding")).alias("width"),
        )
        for name in store.names()
    ]
    return reduce(DataFrame.unionByName, counted)


def get_or_create(spark: SparkSession, sf: str) -> DataFrame:
    """Creating a filled collection again leaves it as it is."""
    store = _store(spark)
    store.get_or_create("texts_images_videos")
    store.add("texts_images_videos", V.vectors(spark, sf))
    store.add("texts_images_videos", V.vectors(spark, sf))
    store.get_or_create("texts_images_videos")
    return _listing(store)


def collection_drop(spark: SparkSession, sf: str) -> DataFrame:
    store = _store(spark)
    for name, modality in (("texts", "text"), ("images", "image"), ("videos", "video")):
        store.add(name, V.vectors(spark, sf).filter(F.col("modality") == modality))
    store.drop("images")
    return _listing(store)


def _two_collections(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Texts and images; and all vectors, twice, under other documents."""
    vectors = V.vectors(spark, sf)
    renamed = vectors.withColumn("document", F.concat(F.lit("new/"), "document"))
    again = vectors.withColumn("document", F.concat(F.lit("newer/"), "document"))
    return vectors.filter("modality <> 'video'"), renamed.unionByName(again)


def collection_add(spark: SparkSession, sf: str) -> DataFrame:
    collection, rows = _two_collections(spark, sf)
    added = CO.collection_add(collection, rows).withColumn("mode", F.lit("add"))
    replaced = CO.collection_add(collection, rows, "upsert").withColumn("mode", F.lit("upsert"))
    return added.unionByName(replaced).select("mode", "id", "document", "modality")


def collection_merge(spark: SparkSession, sf: str) -> DataFrame:
    vectors = V.vectors(spark, sf)
    merged = CO.collection_merge(
        vectors.filter("modality = 'text'"), vectors.filter("modality <> 'text'")
    )
    return V.digest(merged, ["id", "document"])


def collection_peek(spark: SparkSession, sf: str) -> DataFrame:
    peeked = CO.collection_peek(V.vectors(spark, sf))
    return peeked.select(
        "id",
        "document",
        *((F.round(F.get("first_dims", F.lit(i)).cast("double"), 6) + 0.0).alias(f"d{i}") for i in range(5)),
    )


def modality_of(spark: SparkSession, sf: str) -> DataFrame:
    return CO.as_collection(V.vectors(spark, sf)).select("id", "document", "modality")


_CHANNELS = "CASE mode WHEN 'RGB' THEN 3 WHEN 'RGBA' THEN 4 WHEN 'L' THEN 1 WHEN 'CMYK' THEN 4 END"

_PROFILE = f"profile AS (SELECT file_name, file_size, width, height, aspect_ratio, mode, {_CHANNELS} AS channels FROM media)"


def _text_stats(source: str, column: str) -> str:
    counts = f"(SELECT {column} AS v, count(*) AS n FROM {source} WHERE {column} IS NOT NULL GROUP BY 1)"
    return f"""
    SELECT '{column}' AS "column", 'count' AS stat, count({column})::VARCHAR AS value FROM {source}
    UNION ALL SELECT '{column}', 'unique', count(DISTINCT {column})::VARCHAR FROM {source}
    UNION ALL SELECT '{column}', 'freq', max(n)::VARCHAR FROM {counts}
    UNION ALL SELECT '{column}', 'top', (SELECT v FROM {counts} ORDER BY n DESC, v LIMIT 1)"""


def _number_stats(source: str, column: str) -> str:
    stats = {
        "count": f"count({column})",
        "mean": f"avg({column})",
        "std": f"stddev_samp({column})",
        "min": f"min({column})",
        "25%": f"quantile_cont({column}::DOUBLE, 0.25)",
        "50%": f"quantile_cont({column}::DOUBLE, 0.5)",
        "75%": f"quantile_cont({column}::DOUBLE, 0.75)",
        "max": f"max({column})",
    }
    return " UNION ALL ".join(
        f"SELECT '{column}' AS \"column\", '{stat}' AS stat, ({call})::DECIMAL(38,6)::VARCHAR AS value FROM {source}"
        for stat, call in stats.items()
    )


def _describe_sql(source: str, texts, numbers) -> str:
    return " UNION ALL ".join(
        [_text_stats(source, c) for c in texts] + [_number_stats(source, c) for c in numbers]
    )


def _histogram_sql(column: str) -> str:
    return f"""
    SELECT '{column}' AS "column", b AS bin, round(lo + b * ((hi - lo) / 50), 6) AS lower,
           round(lo + (b + 1) * ((hi - lo) / 50), 6) AS upper,
           (SELECT count(*) FROM media m WHERE m.{column} IS NOT NULL AND least(floor((m.{column} - lo) / ((hi - lo) / 50)), 49) = b) AS n
    FROM (SELECT min({column}) AS lo, max({column}) AS hi FROM media), range(50) AS r(b)"""


HASHED_SQL = """
{name} AS (
  SELECT key, list_transform(list(n ORDER BY slot), lambda x: x::DOUBLE) AS raw FROM (
    SELECT k.key, s.slot, count(w.word) AS n
    FROM (SELECT DISTINCT key FROM {source}) k CROSS JOIN range({dim}) AS s(slot)
    LEFT JOIN (SELECT key, word, ('0x' || substr(md5(word), 1, 4))::INT % {dim} AS slot FROM
        (SELECT key, unnest(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')) AS word FROM {source})) w
      ON w.key = k.key AND w.slot = s.slot
    GROUP BY 1, 2) GROUP BY key)"""

_DOCS = "docs AS (SELECT doc_id AS key, text FROM documents)"
_DOC_VECTORS = (
    f"WITH {_DOCS}, {HASHED_SQL.format(name='hashed', source='docs', dim=64)}, "
    f"v AS (SELECT key, ({V.unit_sql('raw')})::FLOAT[] AS embedding FROM hashed)"
)

_PROJECT = """
w AS (SELECT i, list(((i * 31 + j * 17) % 101 - 50) / 500.0 ORDER BY j)::DOUBLE[] AS row_, (i % 7 - 3) / 100.0 AS b
      FROM range(96) AS a(i), range(64) AS c(j) GROUP BY i),
p AS (SELECT id, list(list_dot_product(embedding, row_) + b ORDER BY i) AS raw FROM vectors, w GROUP BY id)"""


def mean_sql(name: str, source: str, keys: str, column: str = "embedding") -> str:
    """CTE of element-wise means as a DOUBLE list per group."""
    return f"""{name} AS (
  SELECT {keys}, list(m ORDER BY d) AS raw FROM (
    SELECT {keys}, d, avg(x) AS m FROM (
      SELECT {keys}, unnest(range(len({column}))) AS d, unnest({column})::DOUBLE AS x FROM {source}) GROUP BY {keys}, d)
  GROUP BY {keys})"""


SAMPLED_SQL = """sampled AS (SELECT * FROM frames
  WHERE frame_no % greatest(1, total // 16) = 0 AND frame_no // greatest(1, total // 16) < 16)"""

VIDEOS_SQL = f"""{V.FRAMES_SQL}, {SAMPLED_SQL}, {mean_sql('pooled', 'sampled', 'video_id')},
video_vectors AS (SELECT video_id, ({V.unit_sql('raw')})::FLOAT[] AS embedding FROM pooled)"""

CASES = {
    "image_profile": (
        image_profile,
        f"""WITH h AS (SELECT 'images/image_' || vec_id || '.png' AS file_name, label * 512 / 1024.0::DOUBLE AS file_size,
              CASE WHEN label <> 9 THEN (vec_id + 1)::INT END AS width, CASE WHEN label <> 9 THEN (vec_id % 7 * 64)::INT END AS height,
              CASE WHEN label <> 9 THEN CASE label % 5 WHEN 0 THEN 'L' WHEN 1 THEN 'RGB' WHEN 2 THEN 'P' WHEN 3 THEN 'LA' ELSE 'RGBA' END END AS mode
              FROM embeddings)
        SELECT file_name, file_size, width, height,
               CASE WHEN height > 0 THEN {V.round_sql('width / nullif(height, 0)::DOUBLE')} END AS aspect_ratio,
               mode, {_CHANNELS} AS channels FROM h""",
    ),
    "media_profile": (
        media_profile,
        f"""WITH {V.MEDIA_SQL}, {_PROFILE} SELECT *, 'image' AS kind FROM profile
        UNION ALL SELECT file_name, file_size, width, height, aspect_ratio,
          CASE WHEN n_channels IS NULL THEN 'N/A' WHEN n_channels = 3 THEN 'BGR' ELSE 'GRAY' END, coalesce(n_channels, 0), 'video' FROM media""",
    ),
    "describe_all": (
        describe_all,
        f"WITH {V.MEDIA_SQL}, {_PROFILE} {_describe_sql('profile', TEXTS, NUMBERS)}",
    ),
    "before_after_profile": (
        before_after_profile,
        f"""WITH {V.MEDIA_SQL}, {_PROFILE}, after AS (SELECT 512 AS width, 'RGB' AS mode, file_size / 2 AS file_size FROM profile WHERE height > 0)
        SELECT *, 'before' AS stage FROM ({_describe_sql('profile', ('mode',), ('file_size', 'width'))})
        UNION ALL SELECT *, 'after' FROM ({_describe_sql('after', ('mode',), ('file_size', 'width'))})""",
    ),
    "distinct_modes": (distinct_modes, f"WITH {V.MEDIA_SQL} SELECT DISTINCT mode FROM media"),
    "merged_profile": (merged_profile, _merged_profile_sql()),
    "histogram": (
        histogram,
        f"WITH {V.MEDIA_SQL} {_histogram_sql('file_size')} UNION ALL {_histogram_sql('aspect_ratio')}",
    ),
    "density_2d": (density_2d, f"WITH {V.MEDIA_SQL} SELECT width, height, count(*) AS n FROM media GROUP BY 1, 2"),
    "purge_zero_size": (
        purge_zero_size,
        f"WITH {V.OBJECTS_SQL} SELECT key, size, size = 0 AS purge FROM objects WHERE NOT (size = 0 AND key LIKE '%/')",
    ),
    "image_standardize": (image_standardize, None),
    "frame_standardize": (
        frame_standardize,
        """WITH px AS (SELECT vec_id, label, unnest(range(64)) AS i, floor((unnest(embedding)::DOUBLE + 1) * 127) AS v FROM embeddings),
        across AS (SELECT vec_id, label, i // 8 AS y, i % 8 // 4 AS x, floor(avg(v) + 0.5) AS v FROM px GROUP BY ALL),
        down AS (SELECT vec_id, label, y // 4 AS y, x, floor(avg(v) + 0.5)::INT AS v FROM across GROUP BY ALL)
        SELECT 'video_' || label AS video_id, vec_id AS frame_no,
               string_agg(repeat(upper(lpad(to_hex(v), 2, '0')), 3), '' ORDER BY y, x) AS pixels FROM down GROUP BY vec_id, label""",
    ),
    "frame_decimate": (
        frame_decimate,
        f"""WITH {V.TICKS_SQL}, s AS (SELECT video_id, event_id, frame_no + 1 AS frame_no,
              greatest(round_even(fps / 30, 0), 1)::BIGINT AS frame_skip FROM ticks WHERE fps > 0)
        SELECT * FROM s WHERE frame_no % frame_skip = 0""",
    ),
    "frame_sample": (
        frame_sample,
        f"""WITH {V.TICKS_SQL} SELECT video_id, event_id, frame_no FROM ticks
        WHERE frame_no % greatest(1, total // 16) = 0 AND frame_no // greatest(1, total // 16) < 16""",
    ),
    "l2_normalize": (
        l2_normalize,
        f"""WITH s AS (SELECT vec_id::VARCHAR AS id, list_transform(embedding, lambda x: x::DOUBLE * label) AS raw FROM embeddings),
        v AS (SELECT id, {V.unit_sql('raw')} AS embedding FROM s) {V.digest_sql('id', 'v')}""",
    ),
    "encode_batch": (encode_batch, f"{_DOC_VECTORS} {V.digest_sql('key', 'v')}"),
    "hash_encode": (hash_encode, f"{_DOC_VECTORS} {V.digest_sql('key', 'v')}"),
    "embed_paragraphs": (
        embed_paragraphs,
        f"""WITH paras AS (SELECT doc_id, unnest({_pieces('text')}) AS text, generate_subscripts({_pieces('text')}, 1) AS n FROM documents),
        numbered AS (SELECT doc_id || '-' || n AS key, doc_id, text FROM paras),
        {HASHED_SQL.format(name='hashed', source='numbered', dim=64)},
        unit AS (SELECT split_part(key, '-', 1)::BIGINT AS key, {V.unit_sql('raw')} AS embedding FROM hashed),
        {mean_sql('pooled', 'unit', 'key')},
        v AS (SELECT d.doc_id AS key, coalesce(({V.unit_sql('raw')})::FLOAT[], list_transform(range(64), lambda x: 0::FLOAT)) AS embedding
              FROM documents d LEFT JOIN pooled ON pooled.key = d.doc_id)
        {V.digest_sql('key', 'v')}""",
    ),
    "mean_pool": (
        mean_pool,
        f"""WITH {V.VECTORS_SQL}, x AS (SELECT label, modality, unnest(range(64))::INT AS dim, unnest(embedding) AS x FROM vectors)
        SELECT label, modality, dim, round(avg(x), 6) + 0.0 AS x FROM x GROUP BY 1, 2, 3""",
    ),
    "project_linear": (
        project_linear,
        f"WITH {V.VECTORS_SQL}, {_PROJECT}, v AS (SELECT id, ({V.unit_sql('raw')})::FLOAT[] AS embedding FROM p) {V.digest_sql('id', 'v')}",
    ),
    "embed_videos": (embed_videos, f"WITH {VIDEOS_SQL} {V.digest_sql('video_id', 'video_vectors')}"),
    "numbered_batches": (
        numbered_batches,
        "SELECT doc_id AS key, 'text_' || row_number() OVER (ORDER BY doc_id % 2, doc_id) AS id FROM documents",
    ),
    "assign_ids": (
        assign_ids,
        """WITH k AS (SELECT 'temporal-landing/text_' || doc_id || '.txt' AS key FROM documents)
        SELECT key, 'text_' || row_number() OVER (ORDER BY key) AS id FROM k""",
    ),
    "get_or_create": (
        get_or_create,
        "SELECT 'texts_images_videos' AS collection, count(*) AS n, max(len(embedding))::INT AS width FROM embeddings",
    ),
    "collection_drop": (
        collection_drop,
        f"""WITH {V.VECTORS_SQL} SELECT modality || 's' AS collection, count(*) AS n, max(len(embedding))::INT AS width
        FROM vectors WHERE modality <> 'image' GROUP BY 1""",
    ),
    "collection_add": (
        collection_add,
        f"""WITH {V.VECTORS_SQL} SELECT 'add' AS mode, id, CASE WHEN modality = 'video' THEN 'new/' ELSE '' END || document AS document, modality FROM vectors
        UNION ALL SELECT 'upsert', id, 'new/' || document, modality FROM vectors""",
    ),
    "collection_merge": (collection_merge, f"WITH {V.VECTORS_SQL} {V.digest_sql('id, document', 'vectors')}"),
    "collection_peek": (
        collection_peek,
        f"WITH {V.VECTORS_SQL} SELECT id, document, "
        + ", ".join(f"round(embedding[{i + 1}], 6) + 0.0 AS d{i}" for i in range(5))
        + " FROM vectors",
    ),
    "modality_of": (
        modality_of,
        f"WITH {V.VECTORS_SQL} SELECT id, document, modality FROM vectors",
    ),
}
