"""Loads in shares: of days into the landing zone, of state buckets into the state."""

import pytest
from pyspark.sql import functions as F

from papyra import fixtures as fx
from papyra.operators import pairing
from papyra.plans import incremental, landing, spread, state
from papyra.session import scratch
from papyra.sources import files, lines
from tests.test_uses import plan_of


@pytest.fixture
def landed(spark, small):
    root, days = scratch(spark, "raw"), fx.delivery_days(spark, small)
    landing.land(spark, fx.deliveries(spark, small), root, *days)
    for n, bad in enumerate(('{"id": ', '{"id": "", "title": "No id"}')):
        spark.range(3 + n).select(F.lit("arXiv").alias("format"), F.lit(days[0]).alias("ds"), F.lit(bad).alias("value")).write.mode(
            "append").partitionBy("format", "ds").text(root)
    return root, days


def test_a_record_is_made_once_for_all_its_deliveries(spark, small):
    assert plan_of(fx.deliveries(spark, small)).count("FileScan parquet [doc_id") == 1


def test_landing_is_written_in_shares(spark, small, monkeypatch):
    sent, root, days = fx.deliveries(spark, small), scratch(spark, "raw"), fx.delivery_days(spark, small)
    shares = []
    monkeypatch.setattr(spread, "SHARE_ROWS", 500)
    monkeypatch.setattr(landing.spread, "by_shares", lambda *a, f=spread.by_shares: shares.append(f(*a)) or shares[-1])
    landing.land(spark, sent, root, *days)
    assert len(shares[0]) > 2
    counts = lambda frame: {tuple(r) for r in frame.groupBy("format", "ds").count().collect()}
    assert counts(lines.read_landing(spark, root, *days, glob="*")) == counts(sent)


def loaded(spark, landed, buckets):
    table, bad, metrics = state.StateTable(scratch(spark, "state"), buckets), scratch(spark, "bad"), scratch(spark, "metrics")
    root, days = landed
    counts = incremental.load_days(spark, root, table, *days, fx.RUN_TS, glob="*", quarantine=bad, metrics=metrics)
    held = state.read_state(spark, table).drop("bucket", "upload_db_time", "last_processed")
    key = lambda frame: sorted(map(str, frame.collect()))
    refused = spark.read.parquet(bad).select("reason", "paper_id", "format", "ds", "value")
    return counts, key(held), key(refused), key(spark.read.parquet(metrics).select("stage", "input", "output", "failed", "files"))


def test_shares_of_lines_load_what_one_share_loads(spark, landed, monkeypatch):
    whole = loaded(spark, landed, 16)
    monkeypatch.setattr(spread, "SHARE_ROWS", 700)
    taken = []
    monkeypatch.setattr(incremental, "_shares", lambda *a, f=incremental._shares: (taken.append(1) or s for s in f(*a)))
    assert loaded(spark, landed, 16) == whole and whole[0]["failed_lines"] == 7
    assert len(taken) > 2


def test_lines_go_to_their_pairs_once(spark, landed):
    """The shuffle holds a line's text, and not its fields as well."""
    read = lines.read_landing(spark, landed[0], *landed[1], glob="*")
    plan = plan_of(incremental.full_outcome(read, fx.RUN_TS))
    shuffled = plan[plan.index("Exchange"):]
    assert "abstract" not in shuffled and "value" in shuffled


def test_refusals_need_no_texts(spark, landed):
    read = lines.read_landing(spark, landed[0], *landed[1], glob="*")
    reasons = lambda o: {tuple(r) for r in o.filter("reason is not null").select("paper_id", "reason").collect()}
    narrow = incremental.landing_outcome(read, fx.RUN_TS, ["versions", "problem"])
    assert reasons(narrow) == reasons(incremental.landing_outcome(read, fx.RUN_TS)) != set()
    assert narrow.columns == incremental.landing_outcome(read, fx.RUN_TS).columns


def test_an_update_of_many_shares_is_seen_when_it_is_whole(spark, small):
    from papyra.operators import normalize

    made = normalize.normalize_historical(fx.snapshot(spark, small, ("items",)), fx.AS_OF, fx.RUN_TS).filter("paper_id < '0000090'")
    table = state.StateTable(scratch(spark, "state"), 4)
    bucket = state.bucket_of(F.col("paper_id"), 4)
    halves = [made.filter(bucket < 2), made.filter(bucket >= 2)]

    def failing():
        yield halves[0]
        raise OSError("no more")

    with pytest.raises(OSError):
        state.upsert_shares(spark, table, failing(), fx.RUN_TS)
    assert state.read_state(spark, table).count() == 0
    assert state.upsert_shares(spark, table, iter(halves), fx.RUN_TS) == {"new_records": made.count(), "updated_records": 0}
    assert state.upsert(spark, table, made, fx.RUN_TS) == {"new_records": 0, "updated_records": made.count()}
    assert state.read_state(spark, table).count() == made.count()
    assert len(files.folders(spark, table.root)) == 2
    # a small update passes what it does not name by the merge, as a large one joins it
    one = made.filter("paper_id = '0000005'").withColumn("doi", F.lit("new"))
    assert state.upsert(spark, table, one, fx.RUN_TS) == {"new_records": 0, "updated_records": 1}
    assert {r.doi for r in state.read_paper(spark, table, "0000005").collect()} == {"new"}
    assert state.read_state(spark, table).count() == made.count()


def test_typed_sides_keep_what_landing_lines_give(spark, landed):
    read = lines.read_landing(spark, landed[0], *landed[1], glob="*")
    typed = pairing.side_by_side_with_lines(lines.landing_lines(read, keep=["value"]))
    late = pairing.typed_sides(pairing.side_by_side_with_lines(lines.landing_lines(read, keep=["value"], names=[]), [], []))
    carry = ["reject", "lines"]
    rows = lambda sides: sorted(map(str, pairing.combined(sides, carry).collect()))
    assert rows(late) == rows(typed)
