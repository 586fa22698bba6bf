"""The nine lookups and reports over papers (state table, lake, or both)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papyra.functions import text


def paper_by_id(papers: DataFrame, paper_id: str) -> DataFrame:
    """On a state table this reads one bucket: see ``plans.state.read_paper``."""
    return papers.filter(F.col("paper_id") == paper_id)


def papers_by_category(papers: DataFrame, category: str, limit: int = 100) -> DataFrame:
    """Papers of a primary category, oldest update first."""
    found = papers.filter((F.col("primary_category") == category) & F.col("update_date").isNotNull())
    return found.orderBy("update_date", "paper_id").limit(limit)


def papers_by_date_range(
    papers: DataFrame, start: str, end: str, category: str | None = None,
    limit: int = 100, sort_by: str = "update_date",
) -> DataFrame:
    """Papers updated between two days, both included."""
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    found = papers.filter(F.col("update_date").between(first, last))
    if category:
        found = found.filter(F.col("primary_category") == category)
    return found.orderBy(sort_by, "paper_id").limit(limit)


def average_updates_by_category(papers: DataFrame) -> DataFrame:
    counted = papers.filter("primary_category <> '' and version_count <> 0")
    return counted.groupBy("primary_category").agg(
        F.avg("version_count").alias("average_updates"), F.count("*").alias("total_papers")
    )


def publication_delay(papers: DataFrame, category: str | None = None) -> DataFrame:
    """Mean days from submission to publication per primary category."""
    published = papers.filter(
        "is_published and submission_to_publication is not null and primary_category <> ''"
    )
    if category:
        published = published.filter(F.col("primary_category") == category)
    return published.groupBy("primary_category").agg(
        F.avg("submission_to_publication").alias("average_days"), F.count("*").alias("sample_size")
    )


def papers_by_author(papers: DataFrame, name: str, limit: int = 100) -> DataFrame:
    """Papers with an author whose first or last name contains the text, in any case."""
    named = F.exists(
        "authors",
        lambda a: text.contains_ignoring_case(a["last_name"], name)
        | text.contains_ignoring_case(a["first_name"], name),
    )
    return papers.filter(named).orderBy("paper_id").limit(limit)


def papers_by_update_frequency(
    papers: DataFrame, minimum: float | None = None, maximum: float | None = None, limit: int = 100
) -> DataFrame:
    found = papers.filter(F.col("update_frequency").isNotNull())
    if minimum is not None:
        found = found.filter(F.col("update_frequency") >= minimum)
    if maximum is not None:
        found = found.filter(F.col("update_frequency") <= maximum)
    return found.orderBy("paper_id").limit(limit)


def paper_versions(papers: DataFrame, paper_id: str) -> DataFrame:
    """One row per version; none for an unknown paper or one without versions."""
    return paper_by_id(papers, paper_id).select("paper_id", F.inline("versions"))


def institution_counts(papers: DataFrame, limit: int = 50) -> DataFrame:
    counts = papers.filter("institution <> ''").groupBy("institution").agg(
        F.count("*").alias("submissions")
    )
    return counts.orderBy(F.desc("submissions"), "institution").limit(limit)


def export_json(report: DataFrame, path: str) -> None:
    """Writes a report as JSON lines; an empty report leaves an empty folder behind."""
    report.write.mode("overwrite").json(path)
