"""Merge rules and the state table."""

import pathlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from papyra import fixtures as fx
from papyra.operators import merge, normalize
from papyra.plans import state
from papyra.schema import PAPER, PAPER_COLUMNS
from papyra.session import scratch

RUN_TS = "2024-01-31 00:00:00"


def papers(spark, *rows):
    return spark.createDataFrame([tuple(r.get(c) for c in PAPER_COLUMNS) for r in rows], PAPER)


def merged(spark, stored, update, **options):
    rows = papers(spark, *stored).withColumn("last_processed", F.lit(None).cast(T.TimestampType()))
    result = merge.merge_papers(rows, papers(spark, *update), RUN_TS, **options)
    return {r.paper_id: r for r in result.collect()}


def versions(*labels):
    return [(label.rstrip("'") or None, label) for label in labels]


def test_fields(spark):
    old = {"paper_id": "1", "title": "old", "doi": "d", "is_published": True, "journal_ref": "J",
           "categories": ["b", "a"], "authors": [("x", "y")], "update_frequency": 2.0}
    new = {"paper_id": "1", "title": "", "doi": None, "is_published": False, "journal_ref": "",
           "categories": ["c", "a"], "authors": []}
    row = merged(spark, [old], [new])["1"]
    assert (row.title, row.doi, row.journal_ref, row.update_frequency) == ("old", "d", "J", 2.0)
    assert row.is_published is False and row.categories == ["a", "b", "c"]
    assert [tuple(a) for a in row.authors] == [("x", "y")]
    assert row.outcome == "updated" and row.last_processed is not None


def test_new_and_kept(spark):
    rows = merged(spark, [{"paper_id": "k", "title": ""}], [{"paper_id": "n", "title": "", "categories": []}])
    assert (rows["k"].outcome, rows["n"].outcome) == ("kept", "new")
    assert rows["n"].title == "" and rows["n"].categories is None
    assert rows["k"].last_processed is None


@pytest.mark.parametrize("old, new, want", [
    (("v1", "v2"), ("v2'", "v3", ""), ["v1", "v2'", "v3"]),
    (("v1", "v2"), None, ["v1", "v2"]), (None, ("v2", ""), ["v2", ""]),
    (("v1", "v1'"), ("v3", "v3'"), ["v1'", "v3'"]), (("", ""), ("",), None),
    (("v1", "v2"), ("v10", "v1'"), ["v1'", "v2", "v10"]),
])
def test_versions(spark, old, new, want):
    side = lambda v: {"paper_id": "1", "versions": v and versions(*v), "version_count": v and 9 + len(v)}
    row = merged(spark, [side(old)], [side(new)])["1"]
    assert (row.versions and [v.created for v in row.versions]) == want
    assert row.version_count == 9 + len(new or old)
    if old and new and want:
        assert merged(spark, [side(old)], [side(new)], recount_versions=True)["1"].version_count == len(want)


@pytest.fixture
def table(spark):
    return state.StateTable(scratch(spark, "state"), 4)


def rows(frame):
    return sorted(map(str, frame.drop("bucket", "last_processed").collect()))


def test_upsert_is_idempotent_and_counts(spark, small, table):
    load = lambda f: normalize.normalize_historical(f, fx.AS_OF, fx.RUN_TS)
    records = fx.snapshot(spark, small, ("items", "place"))
    before, update = load(fx.stored_side(records)), load(fx.update_side(records))
    first = state.upsert(spark, table, before, RUN_TS)
    assert first == {"new_records": before.count(), "updated_records": 0}
    counts = state.upsert(spark, table, update, RUN_TS)
    assert sum(counts.values()) == update.count()
    once = rows(state.read_state(spark, table))
    again = state.upsert(spark, table, update, RUN_TS)
    assert again == {"new_records": 0, "updated_records": update.count()}
    assert rows(state.read_state(spark, table)) == once


def written(table):
    return {str(f) for f in pathlib.Path(table.root).rglob("*.parquet")}


def test_an_update_reads_and_writes_touched_buckets_only(spark, table):
    state.upsert(spark, table, papers(spark, *[{"paper_id": str(i)} for i in range(40)]), RUN_TS)
    before, update = written(table), papers(spark, {"paper_id": "3", "title": "t"})
    state.upsert(spark, table, update, RUN_TS)
    state.upsert(spark, table, papers(spark, {"paper_id": "3", "doi": "d"}), RUN_TS)
    fresh = written(table) - before
    own = update.select(state.bucket_of(F.col("paper_id"), 4)).first()[0]
    assert before < written(table) and fresh and all(f"bucket={own}/" in f for f in fresh)
    assert state.read_state(spark, table).count() == 40
    row = state.read_paper(spark, table, "3").collect()
    assert [(r.title, r.doi) for r in row] == [("t", "d")]


def scanned(frame):
    """Rows that the scans of a plan gave out, by the engine's own metrics."""
    plan = frame._jdf.queryExecution().executedPlan()
    plan.executeCollect()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_a_point_read_skips_files_by_bloom_filter(spark, table, monkeypatch):
    monkeypatch.setattr(state, "ROWS_PER_FILE", 50)
    state.upsert(spark, table, papers(spark, *[
        {"paper_id": f"{i:05}", "primary_category": f"c{i % 7}"} for i in range(4000)]), RUN_TS)
    found = state.read_paper(spark, table, "02222")
    assert found.count() == 1 and scanned(state.read_paper(spark, table, "02222")) < 200
    assert scanned(state.read_paper(spark, table, "99999")) < 100
    assert scanned(state.read_state(spark, table)) == 4000


@pytest.mark.parametrize("buckets", [4, 7])
def test_another_bucket_count_changes_no_row(spark, table, buckets):
    state.upsert(spark, table, papers(spark, *[{"paper_id": str(i)} for i in range(90)]), RUN_TS)
    state.upsert(spark, table, papers(spark, {"paper_id": "3", "title": "t"}, {"paper_id": "new"}), RUN_TS)
    once = rows(state.read_state(spark, table))
    new = state.rebucket(spark, table, buckets)
    assert rows(state.read_state(spark, new)) == once and len(once) == 91
    assert [r.title for r in state.read_paper(spark, new, "3").collect()] == ["t"]


def test_readers_see_old_or_new(spark, table):
    state.upsert(spark, table, papers(spark, *[{"paper_id": str(i)} for i in range(20)]), RUN_TS)
    opened = state.read_state(spark, table)
    # a run that died before it was marked as written
    lost = opened.withColumn("title", F.lit("lost"))
    lost.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").partitionBy("bucket").parquet(table.run(1))
    assert state.read_state(spark, table).filter("title = 'lost'").isEmpty()
    update = papers(spark, *[{"paper_id": str(i), "title": "new"} for i in range(20)])
    state.upsert(spark, table, update, RUN_TS)
    assert opened.filter("title is null").count() == 20
    assert state.read_state(spark, table).filter("title = 'new'").count() == 20


def test_what_no_reader_takes_can_go(spark, table):
    for i in range(4):
        state.upsert(spark, table, papers(spark, *[{"paper_id": str(j), "title": str(i)} for j in range(30)]), RUN_TS)
    once = rows(state.read_state(spark, table))
    assert state.remove_superseded(spark, table) == 0
    assert state.remove_superseded(spark, table, older_than_hours=0) == 3 * 4
    assert rows(state.read_state(spark, table)) == once
    assert state.upsert(spark, table, papers(spark, {"paper_id": "x"}), RUN_TS)["new_records"] == 1


def test_empty_batches(spark, table):
    assert state.read_paper(spark, table, "1").count() == 0
    assert state.upsert(spark, table, papers(spark), RUN_TS) == {"new_records": 0, "updated_records": 0}
    assert state.read_state(spark, table).count() == 0
    state.upsert(spark, table, papers(spark, {"paper_id": "1"}), RUN_TS)
    assert state.upsert(spark, table, papers(spark), RUN_TS) == {"new_records": 0, "updated_records": 0}
    assert state.read_state(spark, table).count() == 1


def test_large_buckets_have_several_files(spark, small, table, monkeypatch):
    monkeypatch.setattr(state, "ROWS_PER_FILE", 10)
    update = papers(spark, *[{"paper_id": str(i)} for i in range(200)])
    state.upsert(spark, table, update, RUN_TS)
    files_of = {}
    for f in written(table):
        files_of.setdefault(f.split("bucket=")[1][0], []).append(f)
    # 200 rows in 4 buckets of 5 parts each
    assert len(files_of) == 4 and all(len(f) == 5 for f in files_of.values())
