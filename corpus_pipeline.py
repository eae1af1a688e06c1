"""The corpus pipeline: documents that are fit to train on, packed into token sequences."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillsight.llm import packing, queries, secret_scan, simhash, substring_dedup, toxicity
from tillsight.llm.common import discard, spill

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _documents(df: DataFrame) -> DataFrame:
    """The columns of documents, the length counted anew."""
    return df.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score stays below the threshold; texts are not changed."""
    model = queries.toxicity_model(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity.with_score(docs.select(*COLUMNS), model, out_col="__score")
    return scored.where(F.col("__score") < toxicity.THRESHOLD).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each SimHash group."""
    return simhash.keep_first(docs.select(*COLUMNS))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the windows of 20 words that occur earlier."""
    return _documents(substring_dedup.remove_repeats(docs.select(*COLUMNS)))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with secrets replaced by a mark."""
    docs = docs.select(*COLUMNS)
    return _documents(secret_scan.scan(docs, secret_scan.fit(docs), redact=True, out_col="__findings"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences; see :func:`tillsight.llm.packing.pack`."""
    return packing.pack(docs, public_tokenizers.path(queries.TOKENIZER))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("substring_dedup", cut_repeats),
    ("secret_scan", redact_secrets),
    ("packing", pack),
]

#: tokenizers, hashes and learned models are beyond SQL; a brute-force version stands in the tests
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each reading what the one before has written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES[:-1]):
        before, docs = docs, spill(stage(spark, docs, sf_dir), name)
        if i:
            discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)
