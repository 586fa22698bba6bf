"""Raw records to papers: one projection, no shuffle, no Python.

The two loads share the column expressions and differ in the rules named in the two functions.
``*_outcome`` keeps every record and says in ``reason`` why one is refused; the plain functions
keep the good ones only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from papyra.functions import dates, people, text
from papyra.schema import PAPER, PAPER_COLUMNS, PARTITION_COLUMNS


def _with_times(records: DataFrame) -> DataFrame:
    """Adds first and last version time, their mean gap, and why they are unusable.

    All versions must be readable: one bad time refuses the record, and so does an empty list.

    The four values leave through a generator so that a filter on them is not pushed below, where
    it would read every time text again for each mention. Other columns pass by it and stay
    subject to pruning and pushdown.
    """
    times = F.transform("versions", lambda v: dates.version_time(v["created"]))
    reason = F.when(F.size("times") == 0, F.lit("versions_empty")).when(
        F.exists("times", lambda t: t.isNull()), F.lit("version_date")
    )
    summary = F.struct(
        F.array_min("times").alias("first_time"),
        F.array_max("times").alias("last_time"),
        dates.mean_gap_days(F.col("times")).alias("gap_days"),
        reason.alias("date_reason"),
    )
    timed = records.withColumn("times", times)
    return timed.select(*records.columns, F.inline(F.array(summary)))


def _shared(run_ts) -> dict[str, Column]:
    categories = text.words(F.col("categories"))
    published = text.is_set(F.col("journal_ref"))
    submitted = F.to_date("first_time")
    return {
        "paper_id": F.col("id"),
        "is_published": published,
        "title": text.clean_text(F.col("title")),
        "abstract": text.clean_text(F.col("abstract")),
        "doi": F.col("doi"),
        "journal_ref": F.col("journal_ref"),
        "categories": categories,
        "primary_category": text.first_or_empty(categories),
        "submitted_date": submitted,
        "published_date": F.when(published, F.to_date("last_time")),
        "versions": F.col("versions"),
        "update_frequency": F.col("gap_days"),
        "upload_db_time": F.lit(run_ts).cast("timestamp"),
    }


def _project(records: DataFrame, columns: dict[str, Column], extra: list[Column]) -> DataFrame:
    typed = [columns[f.name].cast(f.dataType).alias(f.name) for f in PAPER]
    return records.select(*typed, *extra)


def historical_outcome(
    records: DataFrame, as_of: str, run_ts: str, carry: list[str] | None = None
) -> DataFrame:
    """Snapshot rules. ``as_of`` is the submission day of papers delivered without versions."""
    columns = _shared(run_ts)
    as_of_day = F.lit(as_of).cast("date")
    submitted = F.coalesce(columns["submitted_date"], as_of_day)
    columns |= {
        "institution": people.institution_bare(F.col("submitter")),
        "authors": F.coalesce("authors", F.array().cast(PAPER["authors"].dataType)),
        "submitted_date": submitted,
        "update_date": F.coalesce(dates.iso_date(F.col("update_date")), submitted),
        "version_count": F.greatest(F.coalesce(F.size("versions"), F.lit(0)), F.lit(1)),
        "submission_to_publication": dates.days_between(submitted, columns["published_date"]),
    }
    reason = F.coalesce(
        F.when(F.col("problem") == "malformed", F.col("problem")),
        F.when(F.col("id").isNull(), F.lit("missing_id")),
        F.col("problem"),
        F.col("date_reason"),
    )
    return _project(
        _with_times(records), columns,
        [*dates.partition_fields(submitted), reason.alias("reason"), *map(F.col, carry or [])],
    )


def incremental_outcome(
    paired: DataFrame, run_ts: str, carry: list[str] | None = None
) -> DataFrame:
    """Rules for a pair of deliveries: versions are required, authors may stay unset."""
    columns = _shared(run_ts)
    columns |= {
        "institution": people.institution_bracketed(F.col("submitter")),
        "authors": F.col("authors"),
        "update_date": F.coalesce(
            *[dates.iso_date(F.col(c)) for c in ("update_date", "datestamp", "raw_datestamp")]
        ),
        "version_count": F.size("versions"),
        "submission_to_publication": dates.days_between(
            columns["submitted_date"], columns["published_date"]
        ),
    }
    reason = F.coalesce(
        F.when(F.col("id").isNull(), F.lit("missing_id")),
        F.col("problem"),
        F.when(F.col("versions").isNull(), F.lit("versions_absent")),
        F.col("date_reason"),
    )
    return _project(
        _with_times(paired), columns, [reason.alias("reason"), *map(F.col, carry or [])]
    )


def normalize_historical(records: DataFrame, as_of: str, run_ts: str) -> DataFrame:
    kept = historical_outcome(records, as_of, run_ts).filter("reason is null")
    return kept.select(*PAPER_COLUMNS, *PARTITION_COLUMNS)


def normalize_incremental(paired: DataFrame, run_ts: str) -> DataFrame:
    return incremental_outcome(paired, run_ts).filter("reason is null").select(*PAPER_COLUMNS)


def rejected(outcome: DataFrame) -> DataFrame:
    return outcome.filter("reason is not null").select("paper_id", "reason")
