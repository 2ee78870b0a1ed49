"""Retrieval operators bound to the given vectors and texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarn.functions import encoders as E
from tarn.functions import vectors as VE
from tarn.operators import cells as CE
from tarn.operators import embeddings as EM
from tarn.operators import retrieval as R
from tarn.plans import views as V
from tarn.plans.cases_media import HASHED_SQL, VIDEOS_SQL, mean_sql
from tarn.session import work_path


# The share of the axes' cells that the registered approximate search visits.
PROBED = 0.8


def _videos(spark: SparkSession, sf: str) -> DataFrame:
    """Query vectors: every label's frames pooled to one video."""
    return EM.embed_videos(V.frames(spark, sf)).withColumnRenamed("video_id", "query_id")


def _asked(spark: SparkSession, sf: str) -> DataFrame:
    """Query vectors: every stored vector whose id is divisible by 100."""
    rows = V.vectors(spark, sf).filter(F.col("id").cast("long") % 100 == 0)
    return rows.select(F.col("id").alias("query_id"), "embedding")


def _with_videos(spark: SparkSession, sf: str) -> DataFrame:
    """Query vectors: every label's video and every hundredth stored vector."""
    return _videos(spark, sf).unionByName(_asked(spark, sf))


def _with_pooled(spark: SparkSession, sf: str) -> DataFrame:
    """Query vectors: the normalised mean of each label's vectors of each modality, and every hundredth stored vector."""
    whole = V.vectors(spark, sf).filter("embedding IS NOT NULL AND NOT exists(embedding, x -> x IS NULL)")
    pooled = EM.l2_normalize(EM.mean_pool(whole, ["modality", "label"]))
    means = pooled.select(
        F.concat("modality", F.lit("-"), "label").alias("query_id"),
        F.col("embedding").cast("array<float>").alias("embedding"),
    )
    return means.unionByName(_asked(spark, sf))


def _shown(hits: DataFrame, *more: str) -> DataFrame:
    return hits.select("query_id", "rank", "id", "modality", F.round("distance", 6).alias("distance"), *more)


def knn(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(R.knn(_asked(spark, sf), V.vectors(spark, sf), 10))


def knn_metrics(spark: SparkSession, sf: str) -> DataFrame:
    parts = [
        _shown(R.knn(_with_videos(spark, sf), V.vectors(spark, sf), metric=metric)).withColumn(
            "metric", F.lit(metric)
        )
        for metric in ("cosine", "ip")
    ]
    return parts[0].unionByName(parts[1])


def distance(spark: SparkSession, sf: str) -> DataFrame:
    """Each vector against its own label's video, in all metrics."""
    videos = _videos(spark, sf).withColumnRenamed("embedding", "query_embedding")
    vectors = V.vectors(spark, sf).withColumn("query_id", F.concat(F.lit("video_"), "label"))
    pairs = vectors.join(videos, "query_id")
    apart = [
        F.round(VE.distance(F.col("embedding"), F.col("query_embedding"), m), 6).alias(m)
        for m in VE.METRICS
    ]
    return pairs.select("id", "query_id", *apart)


def similarity(spark: SparkSession, sf: str) -> DataFrame:
    hits = R.knn(_with_videos(spark, sf), V.vectors(spark, sf), 10)
    return hits.select(
        "query_id",
        "id",
        F.round("similarity", 6).alias("similarity"),
        F.round(R.cosine(), 6).alias("cosine"),
    )


def knn_pivots(spark: SparkSession, sf: str) -> DataFrame:
    """The exact search through a stored index with fitted pivots."""
    index = CE.CellIndex.build(V.vectors(spark, sf), work_path(spark, "cells"))
    return _shown(index.nearest(_asked(spark, sf), 10))


def knn_approx(spark: SparkSession, sf: str) -> DataFrame:
    """The nearest cells of an index whose centres are the axes, so that SQL can follow."""
    vectors = V.vectors(spark, sf)
    width = vectors.filter("embedding IS NOT NULL").select(F.size("embedding").alias("n")).first()
    return _shown(CE.knn_approx(_asked(spark, sf), vectors, 10, PROBED, CE.axis_centres(width["n"])))


def quota_topk(spark: SparkSession, sf: str) -> DataFrame:
    """Only texts and images are shown: a video query without the videos."""
    hits = R.knn(_asked(spark, sf), V.vectors(spark, sf), per_modality=True)
    return _shown(R.quota_topk(hits), "modality_rank")


def cross_modal_search(spark: SparkSession, sf: str) -> DataFrame:
    """Text, image and video queries against all three modalities."""
    hits = R.cross_modal_search(_with_pooled(spark, sf), V.vectors(spark, sf), videos=True)
    return _shown(hits, "modality_rank")


def text_search(spark: SparkSession, sf: str) -> DataFrame:
    """Every benchmark text as a query over all documents, by the hash encoder."""
    encoder = E.hash_encoder(64)
    queries = EM.encode_batch(V.table(spark, sf, "benchmark"), encoder, "text").select(
        F.concat(F.lit("q"), "item_id").alias("query_id"), "embedding"
    )
    documents = EM.encode_batch(V.docs(spark, sf), encoder, "text").select(
        F.col("key").cast("string").alias("id"),
        F.concat(F.lit("trusted-zone/texts/"), "key", F.lit(".txt")).alias("document"),
        F.lit("text").alias("modality"),
        "embedding",
    )
    return R.knn(queries, documents).select(
        "query_id", "rank", "id", F.round("distance", 6).alias("distance")
    )


def hydrate_hits(spark: SparkSession, sf: str) -> DataFrame:
    """The stored object of each text hit."""
    hits = R.cross_modal_search(_asked(spark, sf), V.vectors(spark, sf))
    documents = V.table(spark, sf, "documents").select(
        F.concat(F.lit("texts/"), "doc_id", F.lit(".txt")).alias("key"), "text"
    )
    return R.hydrate_hits(hits, documents).select(
        "query_id", "id", "key", F.md5("text").alias("text_md5")
    )


def exclude_self(spark: SparkSession, sf: str) -> DataFrame:
    """Stored videos and vectors as queries over the collection that holds them all."""
    videos = _videos(spark, sf)
    stored = V.vectors(spark, sf).select("id", "document", "modality", "embedding").unionByName(
        videos.select(
            F.col("query_id").alias("id"),
            F.concat(F.lit("trusted-zone/videos/"), "query_id", F.lit(".mp4")).alias("document"),
            F.lit("video").alias("modality"),
            "embedding",
        )
    )
    return _shown(R.exclude_self(R.knn(videos.unionByName(_asked(spark, sf)), stored, 11), 10))


_DIST = "list_sum(list_transform(list_zip(q.embedding::DOUBLE[], v.embedding::DOUBLE[]), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
_DOT = "list_dot_product(q.embedding::DOUBLE[], v.embedding::DOUBLE[])"
_COS = "list_cosine_similarity(q.embedding::DOUBLE[], v.embedding::DOUBLE[])"

_VIDEO_QUERIES = f"{VIDEOS_SQL}, queries AS (SELECT video_id AS query_id, embedding FROM video_vectors)"
_ASKED_ROWS = "SELECT id AS query_id, embedding FROM vectors WHERE id::BIGINT % 100 = 0"
_ASKED = f"queries AS ({_ASKED_ROWS})"
_WITH_VIDEOS = f"""{VIDEOS_SQL}, queries AS (SELECT video_id AS query_id, embedding::DOUBLE[] AS embedding FROM video_vectors
  UNION ALL {_ASKED_ROWS})"""
_WITH_POOLED = f"""{mean_sql('pooled', 'vectors', 'modality, label')},
queries AS (SELECT modality || '-' || label AS query_id, ({V.unit_sql('raw')})::FLOAT[]::DOUBLE[] AS embedding FROM pooled
  UNION ALL {_ASKED_ROWS})"""


def _ranked(k: int | None, distance_: str = _DIST, collection: str = "vectors") -> str:
    return f"""
pairs AS (SELECT q.query_id, v.id, v.document, v.modality, {distance_} AS distance FROM queries q, {collection} v),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS rank FROM pairs),
hits AS (SELECT * FROM ranked{f' WHERE rank <= {k}' if k else ''})"""


def _quota(modalities: str) -> str:
    return f"""
quota AS (SELECT * EXCLUDE (rank), row_number() OVER (PARTITION BY query_id, modality ORDER BY distance, id) AS modality_rank
          FROM hits WHERE modality IN ({modalities})),
shown AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS rank FROM quota WHERE modality_rank <= 5)"""


_COLUMNS = "query_id, rank::INT AS rank, id, modality, round(distance, 6) AS distance"

CASES = {
    "knn": (knn, f"WITH {V.VECTORS_SQL}, {_ASKED}, {_ranked(10)} SELECT {_COLUMNS} FROM hits"),
    "knn_metrics": (
        knn_metrics,
        f"""SELECT * FROM (WITH {V.VECTORS_SQL}, {_WITH_VIDEOS}, {_ranked(5, f'1 - {_COS}')} SELECT {_COLUMNS}, 'cosine' AS metric FROM hits)
        UNION ALL SELECT * FROM (WITH {V.VECTORS_SQL}, {_WITH_VIDEOS}, {_ranked(5, f'1 - {_DOT}')} SELECT {_COLUMNS}, 'ip' AS metric FROM hits)""",
    ),
    "distance": (
        distance,
        f"""WITH {V.VECTORS_SQL}, {_VIDEO_QUERIES} SELECT v.id, q.query_id, round({_DIST}, 6) AS l2,
        round(1 - {_COS}, 6) AS cosine, round(1 - {_DOT}, 6) AS ip FROM vectors v JOIN queries q ON q.query_id = 'video_' || v.label""",
    ),
    "similarity": (
        similarity,
        f"""WITH {V.VECTORS_SQL}, {_WITH_VIDEOS}, {_ranked(10)} SELECT query_id, id, round(1 - distance, 6) AS similarity,
        round(1 - distance / 2, 6) AS cosine FROM hits""",
    ),
    "knn_pivots": (knn_pivots, f"WITH {V.VECTORS_SQL}, {_ASKED}, {_ranked(10)} SELECT {_COLUMNS} FROM hits"),
    "knn_approx": (
        knn_approx,
        f"""WITH {V.VECTORS_SQL}, {_ASKED},
        axes AS (SELECT id, unnest(range(2 * len(embedding))) AS cell, embedding FROM vectors),
        placed AS (SELECT id, cell FROM axes
          QUALIFY row_number() OVER (PARTITION BY id ORDER BY CASE WHEN cell % 2 = 0 THEN -embedding[cell // 2 + 1] ELSE embedding[cell // 2 + 1] END, cell) = 1),
        sizes AS (SELECT cell, count(*) AS n FROM placed GROUP BY cell),
        near AS (SELECT q.query_id, s.cell, s.n, row_number() OVER (PARTITION BY q.query_id ORDER BY
            CASE WHEN s.cell % 2 = 0 THEN -q.embedding[s.cell // 2 + 1] ELSE q.embedding[s.cell // 2 + 1] END, s.cell) AS place FROM queries q, sizes s),
        running AS (SELECT *, sum(n) OVER (PARTITION BY query_id ORDER BY place) - n AS before FROM near),
        probed AS (SELECT query_id, cell FROM running WHERE place <= ceil({PROBED} * (SELECT count(*) FROM sizes)) OR before < 10),
        pairs AS (SELECT q.query_id, v.id, v.modality, {_DIST} AS distance FROM probed p JOIN queries q USING (query_id)
          JOIN placed c ON c.cell = p.cell JOIN vectors v ON v.id = c.id),
        hits AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS rank FROM pairs)
        SELECT {_COLUMNS} FROM hits WHERE rank <= 10""",
    ),
    "quota_topk": (
        quota_topk,
        f"""WITH {V.VECTORS_SQL}, {_ASKED}, {_ranked(None)}, {_quota("'text', 'image'")}
        SELECT {_COLUMNS}, modality_rank::INT AS modality_rank FROM shown""",
    ),
    "cross_modal_search": (
        cross_modal_search,
        f"""WITH {V.VECTORS_SQL}, {_WITH_POOLED}, {_ranked(None)}, {_quota("'text', 'image', 'video'")}
        SELECT {_COLUMNS}, modality_rank::INT AS modality_rank FROM shown""",
    ),
    "text_search": (
        text_search,
        f"""WITH items AS (SELECT 'q' || item_id AS key, text FROM benchmark), docs AS (SELECT doc_id::VARCHAR AS key, text FROM documents),
        {HASHED_SQL.format(name='hashed_items', source='items', dim=64)}, {HASHED_SQL.format(name='hashed_docs', source='docs', dim=64)},
        queries AS (SELECT key AS query_id, ({V.unit_sql('raw')})::FLOAT[] AS embedding FROM hashed_items),
        collection AS (SELECT key AS id, '' AS document, 'text' AS modality, ({V.unit_sql('raw')})::FLOAT[] AS embedding FROM hashed_docs),
        {_ranked(5, collection='collection')} SELECT query_id, rank::INT AS rank, id, round(distance, 6) AS distance FROM hits""",
    ),
    "hydrate_hits": (
        hydrate_hits,
        f"""WITH {V.VECTORS_SQL}, {_ASKED}, {_ranked(None)}, {_quota("'text', 'image'")}
        SELECT query_id, s.id, replace(s.document, 'trusted-zone/', '') AS key, md5(d.text) AS text_md5
        FROM shown s LEFT JOIN documents d ON replace(s.document, 'trusted-zone/', '') = 'texts/' || d.doc_id || '.txt'""",
    ),
    "exclude_self": (
        exclude_self,
        f"""WITH {V.VECTORS_SQL}, {_WITH_VIDEOS}, stored AS (SELECT id, document, modality, embedding FROM vectors
          UNION ALL SELECT video_id, '', 'video', embedding::DOUBLE[] FROM video_vectors),
        {_ranked(11, collection='stored')}, others AS (SELECT * EXCLUDE (rank), row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS rank
          FROM hits WHERE id <> query_id) SELECT {_COLUMNS} FROM others WHERE rank <= 10""",
    ),
}
