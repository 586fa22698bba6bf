"""What keeps the large columns out of shuffles and the written inputs small."""

from datetime import datetime

import pytest

import driver_queries
from papyra import fixtures as fx
from papyra.operators import drift, network
from papyra.plans import landing
from papyra.sources import lines


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Six orders, two of them without items, and three documents."""
    folder = str(tmp_path_factory.mktemp("tables"))
    day = datetime(1996, 1, 10)
    rows = {
        "orders": ("o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, "
                   "o_orderpriority string", [(i, i % 2, "F", 1.0, day, ("1-URGENT", "2-HIGH", "5-LOW")[i % 3]) for i in range(6)]),
        "customer": ("c_custkey long, c_name string, c_nationkey int, c_mktsegment string",
                     [(i, f"C{i}", 0, "BUILDING") for i in range(2)]),
        "nation": ("n_nationkey int, n_name string", [(0, "PERU")]),
        "documents": ("doc_id long, text string, lang string, source string",
                      [(i, f"Line {i}\nand more", "en", "web") for i in range(3)]),
        "lineitem": ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_shipdate timestamp",
                     [(i, 0, 0, n, day) for i in range(4) for n in (1, 2, 3)]),
        "supplier": ("s_suppkey long, s_name string", [(0, "S")]),
        "part": ("p_partkey long, p_brand string", [(0, "B")]),
    }
    for name, (schema, data) in rows.items():
        spark.createDataFrame(data, schema).write.parquet(f"{folder}/{name}.parquet")
    return folder


def _optimized(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString()


def test_no_join_follows_the_one_that_brings_the_text(spark, tables):
    records = fx.snapshot(spark, tables)
    last = next(line for line in _optimized(records).splitlines() if "Join" in line)
    assert "doc_id" in last and records.count() == 6
    assert {r.title for r in records.collect()} == {f"Line {i}\n  web  en" for i in range(3)}


def test_a_merge_reads_no_more_than_is_used(spark, tables):
    plan = _optimized(driver_queries.merge_stats(spark, tables))
    scans = [line for line in plan.splitlines() if "Relation" in line]
    assert scans and "regexp_replace(text" not in plan and "text AS abstract" not in plan
    assert driver_queries.merge_stats(spark, tables).first().asDict() == {"new_records": 2, "updated_records": 1}


def test_written_inputs_are_compressed(spark, tables, tmp_path):
    written = driver_queries._snapshot_lines(spark, tables)
    assert all(f.endswith(".txt.gz") for f in written.inputFiles()) and written.count() == 6
    root, sent = str(tmp_path), fx.deliveries(spark, tables)
    landing.land(spark, sent, root, "1996-01-01", "1996-02-01", compression="gzip")
    assert lines.read_landing(spark, root, "1996-01-01", "1996-02-01").count() == 0
    found = lines.landing_records(lines.read_landing(spark, root, "1996-01-01", "1996-02-01", glob="*.json.gz"))
    assert found.count() == sent.count() == 14 and all(f.endswith(".json.gz") for f in found.inputFiles())


def test_rounds_of_the_rank_shuffle_numbers_only(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(network, "scratch", lambda spark, name: f"{tmp_path}/{name}")
    rows = spark.createDataFrame(
        [("p", "1", "a"), ("p", "1", "b"), ("p", "1", "b"), ("p", "2", "c"), ("q", "1", "a"), (None, "3", "a"), ("p", None, "a")],
        "period string, paper_id string, author_id string")
    found = {(r.period, r.author_id): (r.papers, round(r["rank"], 9)) for r in network.rank(rows, 3).collect()}
    assert found == {("p", "a"): (1, 1.0), ("p", "b"): (1, 1.0), ("p", "c"): (1, 0.15), ("q", "a"): (1, 0.15)}
    rounds = [spark.read.parquet(str(f)).dtypes for f in sorted((tmp_path / "rank").iterdir())]
    assert len(rounds) == 8 and all(kind != "string" for r in rounds[4:] for _, kind in r)


@pytest.mark.parametrize("name", ["fk_check", "profile_bounds"])
def test_papers_that_are_read_often_are_made_once(spark, tables, name):
    frame = driver_queries.registry()[name](spark, tables)
    assert frame.count() > 0 and not any("orders.parquet" in f for f in frame.inputFiles())


def test_lengths_may_be_measured_before(spark):
    papers = spark.createDataFrame(
        [("r", [("a", "b")], "xy", 2), ("r", None, None, None)],
        "run string, authors array<struct<last_name string, first_name string>>, abstract string, n int")
    run = lambda *length: drift.estimates(drift.sketches(papers, papers["run"], *length)).collect()
    assert run(papers["n"]) == run()
