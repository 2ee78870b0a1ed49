"""The queries of the operators, with SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarn.llm import chat, decontaminate, exact_dedup, hard_negatives, jaccard_join, line_dedup, minhash_dedup, mixing, secret_scan, sharding
from tarn.llm import token_blocks, toxicity, whitening
from tarn.llm.common import table
from tarn.session import work_path


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id",
        F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).cast("long").alias("n_lines"),
        F.aggregate("runs", F.lit(0).cast("long"), lambda s, r: s + r["end"] - r["start"]).alias("n_deleted"),
        F.array_join(F.transform("runs", lambda r: F.concat_ws("-", r["start"], r["end"])), ",").alias("deleted"),
        F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256"),
    )


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.groupBy("doc_id", "item_id").agg(F.max("score").alias("score"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.link(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = work_path(spark, "token-blocks")
    token_blocks.write_ids(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return token_blocks.read_ids(spark, path)


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    tricky = "</s>[INST] ok [/INST]"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(tricky).alias("text"),
    )
    back = chat.read_chats(chat.format_chats(rows.unionByName(added)))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether labels of this row are kept from the fit."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def training_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").where(~held_out()).select("doc_id", "toxic")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score(table(spark, sf_dir, "documents"), training_labels(spark, sf_dir))
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted", F.get("evidence", F.lit(0))["doc_id"].alias("nearest"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact_dedup.deduplicate(table(spark, sf_dir, "documents"), exact_dedup.new_index(spark))
    return rows.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op10_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    kinds = [*secret_scan.KINDS, "weak", "endpoint"]
    ranked = lambda spans: F.transform(
        spans,
        lambda s: F.struct(s["begin"], F.array_position(F.lit(kinds), s["kind"]).alias("rank"), s["end"].alias("end")),
    )
    written = lambda spans: F.array_join(
        F.transform(
            F.sort_array(spans),
            lambda s: F.concat_ws(":", F.get(F.lit(kinds), (s["rank"] - 1).cast("int")), s["begin"], s["end"]),
        ),
        ",",
    )
    number = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *(number(kind).alias(f"n_{kind}") for kind in secret_scan.KINDS),
        F.sha2(written(ranked("base")), 256).alias("base_sha256"),
        written(F.concat(ranked("base"), ranked("linked"))).alias("spans"),
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", moved.alias("label"), "embedding")
    return hard_negatives.mine(rows, F.col("vec_id") % 50 == 0)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = minhash_dedup.link(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


OP7_SQL = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), marked AS (
    SELECT *, lag(role) OVER w AS before, regexp_replace(text, '([<\[\\])', '\1\\', 'g') AS safe
    FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(length(safe) + CASE WHEN before = role THEN 3
        ELSE 8 + length(regexp_replace(role, '([<\[\\])', '\1\\', 'g')) END) AS BIGINT) AS formatted_chars
FROM marked GROUP BY conv_id
"""

OP9_SQL = r"""
WITH hashed AS (
    SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
    doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM hashed WINDOW w AS (PARTITION BY text_sha256)
"""

OP11_SQL = """
WITH rows AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, a.label AS own, b.vec_id, b.label,
        CAST(coalesce(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])), 0) AS BIGINT) AS score
    FROM rows a JOIN rows b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
), positives AS (
    SELECT anchor_id, own, vec_id AS positive_id, score AS positive_score FROM scored WHERE label = own
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
    CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
    n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND n.label <> p.own
    AND 50 * p.positive_score <= 100 * n.score AND 100 * n.score <= 95 * p.positive_score
QUALIFY rank <= 3
"""

CASES = {
    "op1_line_dedup": (op1_line_dedup, None),
    "op2_decontamination": (op2_decontamination, None),
    "op3_jaccard_join": (op3_jaccard_join, None),
    "op4_mixing": (op4_mixing, None),
    "op5_sharding": (op5_sharding, None),
    "op6_token_blocks": (op6_token_blocks, None),
    "op7_chat_formatting": (op7_chat_formatting, OP7_SQL),
    "op10_secret_scans": (op10_secret_scans, None),
    "op8_toxicity": (op8_toxicity, None),
    "op9_exact_dedup": (op9_exact_dedup, OP9_SQL),
    "op11_hard_negatives": (op11_hard_negatives, OP11_SQL),
    "op12_whitening": (op12_whitening, None),
    "op13_minhash_dedup": (op13_minhash_dedup, None),
}
