"""Registered queries against their SQL, and the shape of their plans."""

import pytest

import __spark_entry__ as entry
import driver_oracle
import driver_queries
from papyra import fixtures as fx
from tests.compare import differences, duck

# the rest is compared with ``python tests/compare.py``, which takes some minutes
QUICK = [
    "clean_text", "categories_split", "institution_bracketed", "version_dates", "lenient_dates",
    "dropped_records", "average_updates_by_category", "publication_delay", "papers_by_category",
    "papers_by_author", "merge_versions", "merge_categories", "wh_authors", "wh_categories",
    "institution_rank", "trend_by_month", "coauthor_strength", "unpaired_records", "oai_arxiv",
    "quality_drift", "similar_papers", "coauthor_components", "coauthor_rank", "oai_counts", "oai_quarantine",
    "distribution_drift", "profile_bounds", "journal_impact_asof", "behaviour_sessions", "papers_by_author_indexed",
]

# found through random projections: tests/test_uses.py has its recall and its scores
NO_SQL = {"recommend_papers"}


def test_every_query_has_sql():
    own = set(driver_queries.registry())
    assert own - NO_SQL == set(driver_oracle.statements()) and own <= set(entry.queries())


def test_every_document_reaches_an_abstract(spark, small):
    papers = fx.snapshot(spark, small, ("text",)).where("abstract <> ''")
    assert papers.select("abstract").distinct().count() == (
        spark.read.parquet(f"{small}/documents.parquet").where("text <> ''").select("text").distinct().count())


@pytest.mark.parametrize("name", QUICK)
def test_equals_sql(spark, small, name):
    query, sql = entry.queries()[name], entry.oracle_sql()[name]
    problem, n = differences(spark, duck(small), small, query, sql)
    assert problem is None and n > 0


@pytest.mark.parametrize("name", ["average_updates_by_category", "papers_by_author", "merge_versions", "wh_authors"])
def test_plans_stay_on_the_jvm_without_cross_joins(spark, small, name):
    plan = entry.queries()[name](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Cartesian", "NestedLoop", "Python", "Arrow"))


def test_reports_read_only_their_columns(spark, small):
    plan = entry.queries()["institution_counts"](spark, small)._jdf.queryExecution().toString()
    assert "documents" not in plan and "supplier.parquet" not in plan


def test_entry(spark):
    assert entry.entry(spark).count() == 25
