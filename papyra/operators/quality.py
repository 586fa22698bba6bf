"""Data quality and run counters, as aggregates in one pass over the raw records.

Aggregates rather than accumulators or observed metrics: those may count a task twice when an
executor is lost and its shuffle output is computed again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papyra.functions import text

# Type problems that refuse a record before its fields are assessed.
UNASSESSED = ["malformed", "title_type", "abstract_type"]

# What the counters read of a record.
COLUMNS = ["id", "title", "abstract", "categories", "authors", "problem"]


def quality_counters(records: DataFrame) -> DataFrame:
    """One row: assessed records and how many of them miss a field.

    Records refused later for their versions are assessed all the same.
    """
    assessed = records.filter(
        F.col("id").isNotNull() & ~F.coalesce("problem", F.lit("")).isin(UNASSESSED)
    )
    return assessed.agg(
        F.count("*").alias("assessed"),
        F.count_if(text.clean_text(F.col("title")) == "").alias("titles"),
        F.count_if(text.clean_text(F.col("abstract")) == "").alias("abstracts"),
        F.count_if(F.col("categories") == "").alias("categories"),
        F.count_if(F.col("authors").isNull()).alias("authors"),
    )


def quality_report(records: DataFrame) -> DataFrame:
    """metric, missing, total, pct (null without records)."""
    metrics = ["titles", "abstracts", "categories", "authors"]
    long = quality_counters(records).unpivot(["assessed"], metrics, "metric", "missing")
    return long.select(
        F.concat(F.lit("missing_"), "metric").alias("metric"),
        "missing",
        F.col("assessed").alias("total"),
        F.try_divide(F.col("missing") * 100.0, "assessed").alias("pct"),
    )


def load_counts(outcome: DataFrame) -> DataFrame:
    """stage, input, output, failed of a load; malformed lines fail in the first stage."""
    malformed = F.count_if(F.col("reason") == "malformed")
    refused = F.count_if(F.col("reason").isNotNull())
    totals = outcome.agg(
        F.count("*").alias("lines"), malformed.alias("malformed"), refused.alias("refused")
    )
    stage = lambda name, given, failed: F.struct(
        F.lit(name).alias("stage"), given.alias("input"),
        (given - failed).alias("output"), failed.alias("failed"),
    )
    lines, bad, all_bad = F.col("lines"), F.col("malformed"), F.col("refused")
    return totals.select(F.inline(F.array(
        stage("extract", lines, bad), stage("transform", lines - bad, all_bad - bad)
    )))


def landing_counts(outcome: DataFrame) -> DataFrame:
    """stage, input, output, failed of an incremental load: lines in the first stage, ids in the
    second, where ids that wait for their other half are neither output nor failed."""
    one = F.col("reject").isNull()
    totals = outcome.agg(
        F.coalesce(F.sum("lines"), F.lit(0)).alias("lines"), F.count("reject").alias("rejected"),
        F.count_if(one).alias("ids"), F.count_if(one & F.col("reason").isNull()).alias("good"),
        F.count_if(one & (F.col("reason") == "waiting")).alias("waiting"),
    )
    stage = lambda name, given, done, failed: F.struct(
        F.lit(name).alias("stage"), given.alias("input"), done.alias("output"), failed.alias("failed"),
    )
    lines, rejected, ids, good, waiting = (
        F.col(c) for c in ("lines", "rejected", "ids", "good", "waiting"))
    return totals.select(F.inline(F.array(
        stage("extract", lines, lines - rejected, rejected),
        stage("transform", ids, good, ids - good - waiting),
    )))


def refused_by_reason(outcome: DataFrame) -> DataFrame:
    return outcome.filter("reason is not null").groupBy("reason").agg(F.count("*").alias("records"))
