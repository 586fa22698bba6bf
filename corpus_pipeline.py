"""From raw documents to packed sequences: five stages, each over all that the one before kept.

Each stage's result is written as Parquet below the shared working folder and read again, so a lost
executor costs at most the stage that ran. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from papyra.llm import decontaminate, langid, near_dedup, packing, secret_scan
from papyra.session import scratch

LEAST_LANGUAGE_SCORE = 0.3


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents of no language: null texts, texts without letters, and unsure predictions."""
    network = langid.train(docs.where(~langid.held_out(F.col("doc_id"))))
    clashing = {c: f"__own_{c}" for c in docs.columns if c in ("lang_pred", "score")}
    guessed = langid.predict(docs.withColumnsRenamed(clashing), network)
    kept = (F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_LANGUAGE_SCORE)
    return guessed.where(kept).drop("lang_pred", "score").withColumnsRenamed({b: a for a, b in clashing.items()})


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: five words, a similarity of 0.8 or more."""
    return near_dedup.without_near_duplicates(docs)


def benchmark_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that contain a benchmark item."""
    return decontaminate.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace every secret by a mark; no document goes."""
    return secret_scan.redact(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 1,024 tokens."""
    return packing.pack_documents(docs).drop("cost")


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("benchmark_items", benchmark_items),
    ("secrets", secrets),
    ("sequences", sequences),
]

# The first stage is a trained network and the last a tokenizer: SQL can express neither.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = spark.read.parquet(f"{sf_dir}/documents.parquet"), scratch(spark, "pipeline")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{path}/{name}")
        docs = spark.read.parquet(f"{path}/{name}")
    return docs
