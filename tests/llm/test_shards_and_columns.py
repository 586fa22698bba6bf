"""Locations of token shards, attempts of a task, and clashing columns of the pipeline's first stage."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from papyra.llm import simple8b
from papyra.session import scratch


def test_locations_by_scheme(spark):
    assert simple8b.known_uri("s3a://bucket/a") == "s3://bucket/a" and simple8b.known_uri("/tmp/x") == "/tmp/x"
    assert simple8b.known_uri("file:/tmp/x") == "file:///tmp/x" and simple8b.known_uri("file:///tmp/x") == "file:///tmp/x"
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    with pytest.raises(ValueError, match="no file layer"):
        simple8b.write_tokens(docs, "oss://bucket/a")


def test_rows_of_one_id_are_spread_and_written_once(spark):
    docs = spark.range(4000).select(F.lit(7).alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"))
    path = scratch(spark, "one-id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else so few rows are put together again
    for _ in range(2):  # a second write leaves the first one's files, which the index no longer names
        index = simple8b.write_tokens(docs, path).collect()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    rows = simple8b.read_tokens(spark, path).collect()
    assert len(rows) == 4000 and {r.doc_id for r in rows} == {7} and len(index) > 1
    ends = sorted((r.start, r.start + r.n_tokens) for r in rows)
    assert ends[0][0] == 0 and all(a[1] == b[0] for a, b in zip(ends, ends[1:]))


def test_language_stage_keeps_clashing_columns(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").withColumns({"score": F.col("doc_id") * 2, "lang_pred": F.lit("own")})
    out = corpus_pipeline.language(spark, docs, small)
    assert out.columns == docs.columns and out.count() > 0
    assert out.where("score <> doc_id * 2 OR lang_pred <> 'own'").count() == 0
