"""From trusted objects to stored vectors, and from queries to objects."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.functions import encoders as E
from tarn.functions import text as X
from tarn.operators import embeddings as EM
from tarn.operators import retrieval as R
from tarn.operators.collections import CollectionStore, collection_width

BUCKET = "trusted-zone"
# Id prefix of each modality.
PREFIXES = {"text": "text", "image": "img", "video": "vid"}


def _documents(df: DataFrame, bucket: str) -> DataFrame:
    return df.select("id", F.concat(F.lit(bucket + "/"), "key").alias("document"), "embedding")


def store_texts(
    store: CollectionStore, name: str, texts: DataFrame, factory: E.EncoderFactory, bucket: str = BUCKET, tokens: int = EM.MAX_TOKENS
) -> DataFrame:
    """Number, embed and store text objects ``(key, text)``: numbers run on from batch to batch, and a key keeps its own.

    Of every paragraph the model gets the first ``tokens`` tokens. A batch that is run again changes nothing.
    """
    numbered = store.ledger.extend(texts.select("key").distinct(), PREFIXES["text"])
    vectors = EM.embed_paragraphs(texts, factory, tokens=tokens).join(numbered, "key")
    return store.add(name, _documents(vectors, bucket))


def store_images(
    store: CollectionStore, name: str, images: DataFrame, factory: E.EncoderFactory, bucket: str = BUCKET
) -> DataFrame:
    """Number, embed and store image objects ``(key, payload)``."""
    numbered = store.ledger.extend(images.select("key").distinct(), PREFIXES["image"])
    vectors = EM.encode_batch(images, factory, "payload").join(numbered, "key")
    return store.add(name, _documents(vectors, bucket))


def store_videos(
    store: CollectionStore,
    name: str,
    objects: DataFrame,
    frames: DataFrame,
    factory: E.EncoderFactory | None = None,
    bucket: str = BUCKET,
) -> DataFrame:
    """Number all video objects ``(key)``, and store those whose frames ``(video_id = key, ...)`` give
    a vector."""
    numbered = store.ledger.extend(objects.select("key").distinct(), PREFIXES["video"])
    vectors = EM.embed_videos(frames, factory).withColumnRenamed("video_id", "key")
    return store.add(name, _documents(vectors.join(numbered, "key"), bucket))


def stored_projection(
    store: CollectionStore, width_in: int, width_out: int, seed: int = 0
) -> tuple[np.ndarray, np.ndarray]:
    """The affine weights kept beside the collections, made once: stored vectors and later queries must
    pass through the same ones. A model's weights are a small table, one row per output."""
    name = f"_projection_{width_in}_{width_out}"
    if not store.tables.exists(name):
        weights, bias = E.projection_weights(width_in, width_out, seed)
        rows = [(i, [float(w) for w in weights[i]], float(bias[i])) for i in range(width_out)]
        store.tables.write(name, store.spark.createDataFrame(rows, "i int, weights array<double>, bias double"))
    rows = store.tables.read(name).orderBy("i").limit(width_out).collect()
    return np.array([r["weights"] for r in rows]), np.array([r["bias"] for r in rows])


def merge_collections(
    store: CollectionStore, dest: str, sources: Sequence[str], width: int | None = None
) -> DataFrame:
    """Copy collections into one. Vectors of another width than ``width`` are projected to it."""
    for source in sources:
        rows = store.get_or_create(source)
        found = rows.select(F.size("embedding").alias("n")).first()
        if width is not None and found is not None and found["n"] != width:
            rows = EM.project_linear(rows, *stored_projection(store, found["n"], width))
        store.add(dest, rows)
    return store.get_or_create(dest)


def search(
    store: CollectionStore,
    name: str,
    queries: DataFrame,
    objects: DataFrame | None = None,
    k: int = R.NEIGHBOURS,
    candidates: int | None = None,
    videos: bool = False,
) -> DataFrame:
    """Quota of nearest objects per modality for query vectors, with their bodies if given."""
    hits = R.cross_modal_search(queries, store.get_or_create(name), k, candidates, videos)
    return hits if objects is None else R.hydrate_hits(hits, objects)


def ask(
    store: CollectionStore,
    name: str,
    inputs: DataFrame,
    factory: E.EncoderFactory,
    source: str = "text",
    k: int = R.NEIGHBOURS,
    tokens: int = EM.MAX_TOKENS,
    videos: bool = False,
) -> DataFrame:
    """Quota of nearest objects per modality for raw inputs ``(query_id, <source>)``: texts, images or frames.

    Inputs are encoded as stored objects are (texts up to ``tokens`` tokens; the frames ``(query_id, frame_no, <source>)`` of a video pooled), and
    vectors of another width than the collection's pass through the stored projection, as its vectors did.
    """
    if "frame_no" in inputs.columns:
        frames = inputs.withColumnsRenamed({"query_id": "video_id", source: "payload"})
        vectors = EM.embed_videos(frames, factory).withColumnRenamed("video_id", "query_id")
    else:
        given = F.array_join(X.truncate_tokens(F.col(source), tokens), " ") if source == "text" else F.col(source)
        vectors = EM.encode_batch(inputs.select("query_id", given.alias("_given")), factory, "_given").select("query_id", "embedding")
    width = collection_width(store.get_or_create(name))
    given_width = collection_width(vectors)
    if width is not None and given_width is not None and width != given_width:
        vectors = EM.project_linear(vectors, *stored_projection(store, given_width, width))
    return search(store, name, vectors, k=k, videos=videos)
