"""The queries of this subpackage by name, and their check SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillsight.llm import (
    chat_format, chat_repair, embedding_dedup, filter_audit, html_extract, mixing, packing, piece_encode,
    secret_scan, simhash, substring_dedup, topk, toxicity,
)
from tillsight.llm.check_sql import CHAT_REPAIR_SQL, FILTER_AUDIT_SQL, MIXING_SQL
from tillsight.llm.common import spill

TOKENIZER, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: documents of which a score holds out the labels
FOLDS, HELD_OUT = 3, 1


def _read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def op1_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    found = html_extract.extract_pages(_read(spark, folder, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op2_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Every candidate of every document with its verdict."""
    documents = _read(spark, folder, "documents")
    model = secret_scan.fit(documents)
    found = secret_scan.scan(documents, model)
    return found.select("doc_id", F.explode("findings").alias("f")).select("doc_id", "f.*")


def op3_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_dedup.near_duplicates(_read(spark, folder, "embeddings"))


def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pack(_read(spark, folder, "documents"), public_tokenizers.path(TOKENIZER))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("tokens").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset",
    )


def op5_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path(PIECES)
    encoded = piece_encode.encode(_read(spark, folder, "documents").select("doc_id", "text"), path)
    decoded = piece_encode.decode(encoded.select("doc_id", "ids"), path)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    documents = _read(spark, folder, "documents").select("doc_id", "text")
    left = substring_dedup.remove_repeats(documents)
    words = F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " ")
    return left.select(
        "doc_id", "n_words", "n_removed", F.sha2(F.trim(words), 256).alias("kept_sha256")
    )


def op7_simhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(_read(spark, folder, "documents"))


def _fold(column: str):
    return F.crc32(F.col(column).cast("string").cast("binary")) % FOLDS


def toxicity_model(documents: DataFrame, labels: DataFrame) -> toxicity.Model:
    """Learned from the documents and labels that are not held out."""
    return toxicity.fit(
        documents.where(_fold("doc_id") != HELD_OUT), labels.where(_fold("doc_id") != HELD_OUT)
    )


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = _read(spark, folder, "documents").select("doc_id", "text")
    model = toxicity_model(documents, _read(spark, folder, "labels"))
    scored = toxicity.with_score(documents, model)
    return scored.select(
        "doc_id",
        F.coalesce(_fold("doc_id") == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op9_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """Transcripts made from the conversations, their recovered turns, and whether the roles and the
    contents are those that the conversation had, white space around a turn apart."""
    turns = chat_format.transcript_turns(_read(spark, folder, "conversations"))
    raw = chat_format.with_transcript(spill(turns, "transcripts"))
    model = chat_format.fit(raw)

    def told(turns: str, part: str):
        return F.transform(turns, lambda t: t[part])

    return chat_format.format_chats(raw, model).select(
        "conv_id", "segment",
        F.size("turns").cast("long").alias("n_turns"),
        (told("turns", "role") == told("lines", "role")).alias("roles_recovered"),
        (told("turns", "content") == told("lines", "content")).alias("content_recovered"),
        "chat",
    )


def op10_top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = _read(spark, folder, "embeddings")
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0))


def op11_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    counts = filter_audit.combinations(_read(spark, folder, "documents"), _read(spark, folder, "labels"))
    return filter_audit.audit(counts)


def op12_structure_repair(spark: SparkSession, folder: str) -> DataFrame:
    repaired = chat_repair.repair(chat_repair.damage(_read(spark, folder, "conversations")))
    told = chat_repair.digests(repaired.turns).select(
        F.col("conv_id").alias("_id"), F.col("sha256").alias("repaired_sha256")
    )
    rows = repaired.conversations
    return rows.join(told, rows["conv_id"].eqNullSafe(told["_id"])).drop("_id")


def op13_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.taken(mixing.mix(_read(spark, folder, "documents")))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_html_extraction, op2_secret_scan, op3_embedding_dedup, op4_packing, op5_sentencepiece,
        op6_substring_dedup, op7_simhash_dedup, op8_toxicity, op9_chat_format, op10_top_k,
        op11_filter_audit, op12_structure_repair, op13_source_mixing, pipeline,
    )
}

TOP_K_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id,
         CAST(list_dot_product(CAST(a.q AS DOUBLE[]), CAST(b.q AS DOUBLE[])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id
  WHERE a.vec_id % 50 = 0
),
r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s
)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 5
"""

_FOLLOWING = ", ".join(f"lead(word, {i}) OVER o" for i in range(1, 20))
SUBSTRING_DEDUP_SQL = rf"""
WITH w AS (
  SELECT doc_id, list_filter(
    regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents
),
p AS (SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS place FROM w),
k AS (
  SELECT doc_id, place, concat_ws(' ', word, {_FOLLOWING}) AS win, lead(word, 19) OVER o AS last
  FROM p WINDOW o AS (PARTITION BY doc_id ORDER BY place)
),
r AS (
  SELECT doc_id, place FROM (
    SELECT doc_id, place, row_number() OVER (PARTITION BY win ORDER BY doc_id, place) AS n
    FROM k WHERE last IS NOT NULL
  ) WHERE n > 1
),
gone AS (SELECT DISTINCT doc_id, unnest(range(place, place + 20)) AS place FROM r),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY place) AS text
  FROM p ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
  CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

EMBEDDING_DEDUP_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
u AS (SELECT *, sqrt(list_dot_product(e, e)) AS norm FROM v),
l AS (
  SELECT a.vec_id AS a, b.vec_id AS b
  FROM u a JOIN u b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.93
),
r AS (
  SELECT vec_id AS node, vec_id AS root FROM embeddings
  UNION
  SELECT l.b, r.root FROM r JOIN l ON l.a = r.node WHERE r.root < l.b
)
SELECT vec_id, (SELECT count(*) FROM l WHERE a = vec_id) AS n_links, component_id,
  vec_id = component_id AS kept
FROM embeddings
JOIN (SELECT node, min(root) AS component_id FROM r GROUP BY node) ON node = vec_id
"""

ORACLE_SQL: dict[str, str] = {
    "op3_embedding_dedup": EMBEDDING_DEDUP_SQL,
    "op6_substring_dedup": SUBSTRING_DEDUP_SQL,
    "op10_top_k": TOP_K_SQL,
    "op11_filter_audit": FILTER_AUDIT_SQL,
    "op12_structure_repair": CHAT_REPAIR_SQL,
    "op13_source_mixing": MIXING_SQL,
}
