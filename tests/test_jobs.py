"""Landing, lake, harvest and stream jobs on small data."""

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from papyra import fixtures as fx
from papyra.operators import lookups, normalize, pairing, quality, reports
from papyra.plans import historical, incremental, lake, landing, spread, state
from papyra.session import scratch
from papyra.sources import lines, oai
from papyra.streaming import jobs


def ids(frame):
    return sorted(r[0] for r in frame.collect())


def landing_rows(spark, *rows):
    return spark.createDataFrame([tuple(r) for r in rows], "format string, ds string, id string")


def test_landing_replaces_a_range_of_days(spark):
    root = scratch(spark, "raw")
    first = landing_rows(spark, ("arXiv", "2024-01-01", "a"), ("arXiv", "2024-01-02", "b"),
                         ("arXivRaw", "2024-01-02", "b"), ("arXiv", "2024-01-03", "c"))
    landing.land(spark, first, root, "2024-01-01", "2024-01-04")
    again = landing_rows(spark, ("arXiv", "2024-01-01", "z"), ("arXiv", "2024-01-03", "late"))
    landing.land(spark, again, root, "2024-01-01", "2024-01-03")
    read = lambda a, b: lines.read_landing(spark, root, a, b)
    found = {(r.format, r.ds, r.value) for r in read("2024-01-01", "2024-01-05").collect()}
    assert found == {("arXiv", "2024-01-01", '{"id":"z"}'), ("arXiv", "2024-01-03", '{"id":"c"}')}
    assert read("2024-01-02", "2024-01-03").count() == 0
    assert [r.ds for r in read("2024-01-03", "2024-01-04").collect()] == ["2024-01-03"]
    with pytest.raises(ValueError):
        read("2024-01-02", "2024-01-02")


def test_landing_reads_plain_folder_names_and_keeps_line_order(spark, tmp_path):
    day = tmp_path / "raw" / "arXiv" / "2024-01-01"
    day.mkdir(parents=True)
    (day / "0001.json").write_text("\n".join('{"id": "a", "title": "%d"}' % i for i in range(500)))
    (day / "0002.json").write_text('{"id": "b", "title": "x"}\n\n{"id": \n{"id": "b", "title": "y"}')
    (day / "notes.txt").write_text('{"id": "c"}')
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        read = lines.read_landing(spark, str(tmp_path / "raw"), "2024-01-01", "2024-01-02")
        latest = pairing.last_wins(lines.landing_records(read), ["title"])
        assert {(r.id, r.title) for r in latest.collect()} == {("a", "499"), ("b", "y")}
        assert lines.malformed(read).count() == 1
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_window_counts(spark):
    rows = landing_rows(spark, ("arXiv", "2024-01-01", "a"), ("arXiv", "2023-01-01", "b"), ("arXiv", None, "c"))
    counts = landing.window_counts(rows, "2024-01-01", "2024-02-01").first()
    assert (counts.landed, counts.outside, counts.undated) == (1, 1, 1)


def test_lake_keeps_text_partitions_and_prunes(spark, small):
    papers = normalize.normalize_historical(
        fx.snapshot(spark, small, ("items",)), fx.AS_OF, fx.RUN_TS
    ).filter("year = '1996'")
    path = scratch(spark, "lake")
    lake.write_lake(papers, path)
    read = lake.read_lake(spark, path)
    assert read.filter("month = '04'").count() > 0
    found = lake.lake_between(read, "1996-04-03", "1996-05-02")
    assert ids(found) == ids(papers.filter("submitted_date between '1996-04-03' and '1996-05-02'"))
    assert "PartitionFilters: [(concat_ws" in found._jdf.queryExecution().toString()
    only = papers.filter("month = '04' and day = '03'").limit(1)
    before = read.count()
    lake.write_lake(only, path)
    gone = papers.filter("month = '04' and day = '03'").count() - 1
    assert lake.read_lake(spark, path).count() == before - gone
    lake.write_lake(papers.drop("year", "month", "day"), path, replace="all")
    assert lake.read_lake(spark, path).count() == before


def test_files_follow_the_rows_of_a_day(spark, small):
    """Whatever the session's partition sizes are; a hot day is cut."""
    papers = normalize.normalize_historical(fx.snapshot(spark, small, ("items",)), fx.AS_OF, fx.RUN_TS)
    hot = F.when(F.substring("paper_id", -1, 1) < "5", F.lit("1996-04-03").cast("date"))
    papers = papers.withColumn("submitted_date", F.coalesce(hot, "submitted_date")).drop("year", "month", "day")
    path = scratch(spark, "lake")
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4k")
    try:
        lake.write_lake(papers, path, max_records_per_file=100)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    read = lake.read_lake(spark, path)
    assert ids(read) == ids(papers)
    days = read.withColumn("file", F.input_file_name()).groupBy("year", "month", "day").agg(
        F.count("*").alias("n"), F.countDistinct("file").alias("files")).collect()
    assert len(days) > 100
    assert max(days, key=lambda r: r.n).files > 3
    for r in days:
        assert r.files <= r.n / 90 + 2 and (r.files == 1 or r.n > 90)


def test_days_may_be_unknown(spark):
    rows = spark.createDataFrame([("a", None), ("b", "x"), ("c", None)], "id string, ds string")
    assert ids(spread.by_folder(rows, ["ds"], 1).select(F.col("id").alias("paper_id"))) == ["a", "b", "c"]
    assert spread.by_folder(rows.limit(0), ["ds"], 1).count() == 0


def test_counters_read_no_other_columns(spark, small):
    source = scratch(spark, "in")
    fx.snapshot_lines(spark, small).limit(5).write.text(source)
    records = lines.snapshot_records(lines.read_snapshot(spark, source), names=quality.COLUMNS)
    plan = quality.quality_report(records)._jdf.queryExecution().optimizedPlan().toString()
    assert "update_date" not in plan and "journal" not in plan and "abstract" in plan
    reasons = lines.snapshot_records(lines.read_snapshot(spark, source), names=["problem"]).groupBy("problem").count()
    assert "authors" not in reasons._jdf.queryExecution().optimizedPlan().toString()


def test_landing_lines_parse_wanted_columns_only(spark):
    batch = placed(spark, ("arXiv", "2024-01-01", META % "a"))
    text = lines.landing_records(batch, ["title"])._jdf.queryExecution().optimizedPlan().toString()
    assert "title" in text and "abstract" not in text and "versions" not in text and "submitter" not in text
    assert lines.landing_records(batch, []).columns == ["format", "ds", "file", "block", "row", "id"]
    assert lines.landing_records(batch).select("id", "title").collect() == [("a", "t")]


def test_batch_and_stream_loads_agree(spark, small):
    source, batch, streamed, bad = (scratch(spark, n) for n in ("in", "batch", "stream", "bad"))
    cut = F.col("value").contains('"id":"00001')
    fx.snapshot_lines(spark, small).filter(cut).write.text(source)
    counts = {r.stage: r for r in historical.load_snapshot(
        spark, source, batch, fx.AS_OF, fx.RUN_TS, quarantine=bad).collect()}
    jobs.stream_historical(
        spark, source, streamed, scratch(spark, "ck"), fx.AS_OF, fx.RUN_TS
    ).awaitTermination()
    rows = lambda p: sorted(map(str, lake.read_lake(spark, p).collect()))
    assert rows(batch) == rows(streamed)
    done = counts["transform"]
    assert done.input == done.output + done.failed == 100
    assert spark.read.parquet(bad).count() == done.failed


def test_incremental_stream_and_batch_agree(spark, small):
    root = scratch(spark, "raw")
    sent = fx.deliveries(spark, small).filter("ds between '1996-01-01' and '1996-03-31'")
    landing.land(spark, sent, root, "1996-01-01", "1996-04-01")
    one, two = (state.StateTable(scratch(spark, n), 4) for n in ("one", "two"))
    counts = incremental.load_days(spark, root, one, "1996-01-01", "1996-04-01", fx.RUN_TS)
    assert counts["input_records"] == counts["output_records"] + counts["failed_records"]
    assert counts["new_records"] == counts["output_records"] > 0
    jobs.stream_incremental(spark, root, two, scratch(spark, "ck"), fx.RUN_TS).awaitTermination()
    rows = lambda t: sorted(map(str, state.read_state(spark, t).collect()))
    assert rows(one) == rows(two)


def placed(spark, *rows):
    """Landing lines from (format, day, text)."""
    given = [(text, f, ds, "f", 0, i) for i, (f, ds, text) in enumerate(rows)]
    return spark.createDataFrame(given, lines.LANDING)


META = '{"id": "%s", "title": "t", "abstract": "a", "categories": "c", "update_date": "2024-01-01"}'
HISTORY = '{"id": "%s", "submitter": "s", "versions": [{"version": "v1", "created": "Mon, 1 Jan 2024 00:00:00 GMT"}]}'


def test_every_landing_line_is_counted_and_refused_ones_are_kept(spark):
    batch = placed(
        spark, ("arXiv", "2024-01-01", META % "a"), ("arXivRaw", "2024-01-01", HISTORY % "a"),
        ("arXiv", "2024-01-01", META % "b"), ("arXiv", "2024-01-02", META % "b"),
        ("arXiv", "2024-01-01", '{"id": '), ("arXiv", "2024-01-01", '{"id": '), ("arXiv", "2024-01-01", " \t"),
        ("arXivRaw", "2024-01-01", '{"id": null}'), ("other", "2024-01-01", META % "c"),
    )
    table, bad = state.StateTable(scratch(spark, "t"), 4), scratch(spark, "bad")
    for _ in range(2):  # a repeated load leaves the same
        counts = incremental.merge_lines(spark, batch, table, fx.RUN_TS, quarantine=bad)
    assert counts == {
        "input_lines": 8, "failed_lines": 4, "input_records": 2, "output_records": 1,
        "failed_records": 1, "waiting_records": 0, "new_records": 0, "updated_records": 1,
    }
    kept = sorted((r.reason, r.ds, r.value) for r in spark.read.parquet(bad).collect())
    assert kept == sorted([
        ("malformed", "2024-01-01", '{"id": '), ("malformed", "2024-01-01", '{"id": '),
        ("missing_id", "2024-01-01", '{"id": null}'), ("unknown_format", "2024-01-01", META % "c"),
        ("unpaired", "2024-01-02", META % "b"),
    ])


def test_a_half_waits_for_the_other_one(spark):
    table, waiting = state.StateTable(scratch(spark, "t"), 4), scratch(spark, "waiting")
    run = lambda *rows, **more: incremental.merge_lines(
        spark, placed(spark, *rows), table, fx.RUN_TS, reoffer=waiting, **more)
    first = run(("arXiv", "2024-01-01", META % "a"), ("arXiv", "2024-01-01", META % "b"), generation=0)
    assert (first["waiting_records"], first["failed_records"], first["new_records"]) == (2, 0, 0)
    for _ in range(2):  # delivered again after a failure
        run(("arXivRaw", "2024-01-02", HISTORY % "a"), generation=1)
        assert ids(state.read_state(spark, table).select("paper_id")) == ["a"]
    last = run(("arXivRaw", "2024-01-03", HISTORY % "b"))
    assert (last["new_records"], last["waiting_records"]) == (1, 0)


def test_default_window_is_yesterday_in_utc():
    late = datetime.fromisoformat("2024-03-01T23:30:00-02:00")
    assert incremental.default_window(late) == ("2024-03-01", "2024-03-02")
    assert incremental.default_window(datetime(2024, 3, 1, 0, 0, tzinfo=timezone.utc)) == ("2024-02-29", "2024-03-01")


def test_a_repeated_stream_batch_adds_no_row(spark, small):
    source, target, bad = (scratch(spark, n) for n in ("in", "lake", "bad"))
    fx.snapshot_lines(spark, small).filter(F.col("value").contains('"id":"00001')).write.text(source)
    batch = spark.read.text(source)
    for name in ("s-0", "s-0", "s-1"):
        historical.load_lines(spark, batch, target, fx.AS_OF, fx.RUN_TS, name, quarantine=bad)
    once = batch.count() - spark.read.parquet(bad).filter("load = 's-0'").count()
    assert lake.read_lake(spark, target).count() == 2 * once


def test_journal_names_end_before_the_volume(spark):
    refs = ["Phys.Rev.D76:013009,2007", "Phys. Rev. D 81 (2010) 1", "J. Stat. Mech", "3D Res. 5, 12", "", None, "12:3"]
    papers = spark.createDataFrame([(i, r) for i, r in enumerate(refs)], "paper_id int, journal_ref string")
    journals = spark.createDataFrame(
        [("Phys.Rev.D", 4.0), ("phys rev d", 5.0), ("J Stat Mech", 2.0), ("3D Res", 1.0)], "journal string, impact double")
    out = {r.paper_id: r.impact for r in reports.enrich_with_journals(papers, journals).collect()}
    assert out == {0: 5.0, 1: 5.0, 2: 2.0, 3: 1.0, 4: None, 5: None, 6: None}


def test_behaviour_stream_appends_closed_windows(spark, small):
    events = spark.read.parquet(f"{small}/events.parquet")
    stream = spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet").parquet(small)
    out = scratch(spark, "windows")
    jobs.stream_behaviour(spark, stream, out, scratch(spark, "ck"), watermark="1 hour").awaitTermination()
    got = {tuple(r) for r in spark.read.parquet(out).collect()}
    want = {tuple(r) for r in reports.behaviour_windows(events).collect()}
    assert got and got <= want


RESPONSE = """<?xml version="1.0"?><OAI-PMH><ListRecords>
<record><header><identifier>oai:1</identifier><datestamp>2024-01-05</datestamp>
<setSpec>cs</setSpec><setSpec>math</setSpec></header><metadata><arXiv xmlns="http://example.org/a">
<id>0704.0010</id><updated>2024-01-04</updated><title>A
  title</title><categories>cs.AI math.CO</categories><abstract>Text &lt;b&gt;</abstract>
<authors><author><keyname>K1</keyname></author><author><keyname>K2</keyname><forenames>F2</forenames></author>
</authors><journal-ref>J 1</journal-ref></arXiv></metadata></record>
<record><header><identifier>oai:2</identifier><datestamp>2024-01-06</datestamp></header><metadata>
<arXivRaw xmlns="http://example.org/r"><id>0704.0010</id><submitter>Jo &lt;jo@cs.mit.edu&gt;</submitter>
<version version="v2"><date>Tue, 3 Apr 2007 12:00:00 GMT</date></version>
<version version="v10"><date>Wed, 4 Apr 2007 12:00:00 GMT</date></version>
<version version="v1"><date>Mon, 2 Apr 2007 00:00:00 GMT</date></version>
<authors>K1, F2 K2</authors></arXivRaw></metadata></record>
<record><header><identifier>oai:3</identifier><datestamp>2024-01-06</datestamp></header><metadata>
<other/></metadata></record></ListRecords></OAI-PMH>"""


def test_harvest_responses(spark, tmp_path):
    (tmp_path / "r.xml").write_text(RESPONSE)
    responses = oai.read_responses(spark, str(tmp_path))
    both = {r.format: r for r in oai.harvested(responses).collect()}
    a, raw = both["arXiv"], both["arXivRaw"]
    assert (a.id, a.update_date, a.doi, a.journal_ref) == ("0704.0010", "2024-01-04", None, "J 1")
    assert a.title.split() == ["A", "title"] and a.abstract == "Text <b>"
    assert (a.datestamp, a.ds, a.setSpecs) == ("2024-01-05", "2024-01-05", ["cs", "math"])
    assert a.authors_parsed == [["K1", "F2", ""]]
    paired = oai.metadata_records(responses, pair_within_author=True).first()
    assert paired.authors_parsed == [["K1", "", ""], ["K2", "F2", ""]]
    assert [v.version for v in raw.versions] == ["v1", "v10", "v2"]
    assert raw.submitter == "Jo <jo@cs.mit.edu>" and raw.setSpecs == [] and raw.authors == "K1, F2 K2"


def test_lookups_filter_before_they_limit(spark):
    frame = spark.createDataFrame(
        [(f"{i:03}", [("Curie" if i == 99 else "Bohr", None)], float(i) if i else None) for i in range(100)],
        "paper_id string, authors array<struct<last_name:string,first_name:string>>, update_frequency double",
    )
    assert ids(lookups.papers_by_author(frame, "cUR", limit=1)) == ["099"]
    assert len(ids(lookups.papers_by_author(frame, "", limit=1000))) == 100
    assert ids(lookups.papers_by_update_frequency(frame, 97, 98)) == ["097", "098"]
    assert len(ids(lookups.papers_by_update_frequency(frame, limit=200))) == 99
