"""The registered queries: every operator run over the supplied tables.

Each takes (spark, sf_dir). Dates leave as ISO text, doubles rounded to six places, lists joined to
text, and an abstract as the MD5 of the whole cleaned text; load times are left out.
Queries that write use a fresh folder per call.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from papyra import fixtures as fx
from papyra.functions import dates, people, text
from papyra.operators import (
    drift, lookups, merge, network, normalize, pairing, quality, recommend, reports, search_index,
)
from papyra.operators import warehouse as wh
from papyra.plans import historical, incremental, lake, landing, spread, state
from papyra.session import configure, freed_shuffles, scratch
from papyra.sources import lines, oai
from papyra.streaming import jobs
from papyra.streaming import pairing as stream_pairs

LOAD_TIMES = {"upload_db_time", "last_processed"}
BUCKETS = 16
LINES_PER_FILE = 100_000
LANDED = "*.json.gz"
EVERY_FILE = "*.{json.gz,json,txt}"
PROBE = "0000001"


# ---- output -------------------------------------------------------------------------------

def _flat(name: str, kind: T.DataType) -> Column:
    column = F.col(f"`{name}`")
    if name == "abstract":
        return F.md5(column).alias("abstract_md5")
    if isinstance(kind, T.DateType):
        return F.date_format(column, "yyyy-MM-dd").alias(name)
    if isinstance(kind, T.TimestampType):
        return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(name)
    if isinstance(kind, T.DoubleType):
        return F.round(column, 6).alias(name)
    if isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, T.StructType):
            names = kind.elementType.fieldNames()
            column = F.transform(column, lambda e: F.concat_ws("@", *[e[n] for n in names]))
        return F.array_join(column, "|").alias(name)
    return column.alias(name)


def _out(frame: DataFrame, *columns: str) -> DataFrame:
    if columns:
        frame = frame.select(*columns)
    return frame.select(
        *[_flat(f.name, f.dataType) for f in frame.schema if f.name not in LOAD_TIMES]
    )


# ---- inputs -------------------------------------------------------------------------------

def _papers(spark: SparkSession, sf_dir: str, *parts: str) -> DataFrame:
    """Papers from typed records; Catalyst prunes what a query does not use."""
    records = fx.snapshot(spark, sf_dir, parts or fx.ALL_PARTS)
    return normalize.normalize_historical(records, fx.AS_OF, fx.RUN_TS)


def _kept(frame: DataFrame, name: str) -> DataFrame:
    """A frame made once and written, as several reads follow."""
    spark, path = frame.sparkSession, scratch(frame.sparkSession, name)
    with freed_shuffles(spark):
        frame.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def _write_lines(records: DataFrame, path: str) -> None:
    """Compressed, in files that bounded numbers of lines keep small, as such a file is read by one task."""
    with freed_shuffles(records.sparkSession):
        records.write.option("compression", "gzip").option("maxRecordsPerFile", LINES_PER_FILE).text(path)


def _snapshot_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot lines, written as text and scanned again."""
    path = scratch(spark, "snapshot")
    _write_lines(fx.snapshot_lines(spark, sf_dir), path)
    return lines.read_snapshot(spark, path)


def _snapshot_with_cuts(spark: SparkSession, sf_dir: str) -> str:
    path = scratch(spark, "snapshot")
    _write_lines(fx.snapshot_lines(spark, sf_dir), path)
    fx.cut_lines(spark, sf_dir).write.mode("append").text(path)
    return path


def _landing(spark: SparkSession, sf_dir: str) -> tuple[str, str, str]:
    """A filled landing zone and the range of days it covers."""
    root = scratch(spark, "raw")
    first, end = fx.delivery_days(spark, sf_dir)
    landing.land(spark, fx.deliveries(spark, sf_dir), root, first, end, compression="gzip")
    return root, first, end


def _spoiled_landing(spark: SparkSession, sf_dir: str) -> tuple[str, str, str]:
    """A landing zone with cut-off lines and records without an id among the good ones."""
    root, first, end = _landing(spark, sf_dir)
    for bad in (fx.broken_lines(spark, sf_dir), fx.nameless_lines(spark, sf_dir)):
        bad.write.mode("append").partitionBy("format", "ds").text(root)
    return root, first, end


def _loaded(spark: SparkSession, sf_dir: str, output: str) -> DataFrame:
    """What an incremental load of a spoiled landing zone leaves in one of its output folders."""
    root, first, end = _spoiled_landing(spark, sf_dir)
    table, path = state.StateTable(scratch(spark, "state"), BUCKETS), scratch(spark, output)
    incremental.load_days(
        spark, root, table, first, end, fx.RUN_TS, glob=EVERY_FILE, **{output: path})
    return spark.read.parquet(path)


def _landing_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.read_landing(spark, *_landing(spark, sf_dir), glob=LANDED)


def _lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "lake")
    lake.write_lake(_papers(spark, sf_dir), path)
    return lake.read_lake(spark, path)


def _sides(spark: SparkSession, sf_dir: str, *parts: str) -> tuple[DataFrame, DataFrame]:
    records = fx.snapshot(spark, sf_dir, parts or fx.ALL_PARTS)
    load = lambda frame: normalize.normalize_historical(frame, fx.AS_OF, fx.RUN_TS)
    return load(fx.stored_side(records)), load(fx.update_side(records))


def _state(spark: SparkSession, sf_dir: str) -> tuple[state.StateTable, dict[str, int]]:
    """A state table after its first load and one update."""
    table = state.StateTable(scratch(spark, "state"), BUCKETS)
    before, update = _sides(spark, sf_dir)
    _upsert(spark, table, before, fx.RUN_TS)
    return table, _upsert(spark, table, update, fx.RUN_TS)


def _upsert(spark: SparkSession, table: state.StateTable, papers: DataFrame, run_ts: str) -> dict[str, int]:
    """Papers are made once and written, as the merge reads them for each of its shares."""
    with spread.staged(papers) as rows:
        return state.upsert(spark, table, rows, run_ts)


def _merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    before, update = _sides(spark, sf_dir)
    stored = merge.storage_form(before).withColumn("last_processed", F.lit(fx.RUN_TS).cast("timestamp"))
    return merge.merge_papers(stored, update, fx.RUN_TS)


def _responses(spark: SparkSession, sf_dir: str, damaged: bool = False) -> DataFrame:
    path = scratch(spark, "responses")
    writer = fx.responses(spark, sf_dir).write.format("xml")
    with freed_shuffles(spark):
        writer.option("rowTag", oai.RESPONSE_ROW).option("rootTag", oai.RESPONSE_ROOT).option(
            "compression", "gzip").option("maxRecordsPerFile", LINES_PER_FILE).save(path)
    if damaged:
        fx.damaged_responses(spark, sf_dir).write.mode("append").text(path)
    return oai.read_responses(spark, path)


# ---- cleaning -----------------------------------------------------------------------------

def normalize_historical(spark, sf_dir):
    records = lines.snapshot_records(_snapshot_lines(spark, sf_dir))
    return _out(normalize.normalize_historical(records, fx.AS_OF, fx.RUN_TS))


def normalize_incremental(spark, sf_dir):
    outcome = incremental.landing_outcome(_landing_lines(spark, sf_dir), fx.RUN_TS)
    return _out(outcome.filter("reason is null").drop("reason"))


def clean_text(spark, sf_dir):
    records = fx.snapshot(spark, sf_dir, ("text",))
    return _out(records.select(
        F.col("id").alias("paper_id"), text.clean_text(F.col("title")).alias("title"),
        text.clean_text(F.col("abstract")).alias("abstract"),
    ))


def categories_split(spark, sf_dir):
    records = fx.snapshot(spark, sf_dir, ("place",))
    parts = text.words(F.col("categories"))
    return _out(records.select(
        F.col("id").alias("paper_id"), text.first_or_empty(parts).alias("primary_category"),
        parts.alias("categories"),
    ))


def authors_parsed(spark, sf_dir):
    records = lines.snapshot_records(_snapshot_lines(spark, sf_dir))
    return records.select(F.col("id").alias("paper_id"), F.posexplode("authors").alias("pos", "a")).select(
        "paper_id", "pos", "a.last_name", "a.first_name"
    )


def _institution(rule):
    def query(spark, sf_dir):
        records = fx.snapshot(spark, sf_dir, ("place",))
        return records.select(F.col("id").alias("paper_id"), rule(F.col("submitter")).alias("institution"))
    return query


def version_dates(spark, sf_dir):
    return _out(_papers(spark, sf_dir, "items"), "paper_id", "submitted_date", "published_date")


def lenient_dates(spark, sf_dir):
    """Version times, with ISO and embedded day-month variants of the odd versions."""
    each = fx.snapshot(spark, sf_dir, ("items",)).select(
        F.col("id").alias("paper_id"), F.posexplode("versions").alias("pos", "v")
    )
    created = F.col("v.created")
    time = dates.version_time(created)
    variant = (
        F.when(F.col("pos") % 4 == 1, F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(F.col("pos") % 4 == 2, F.concat(F.lit("on "), F.date_format(time, "yyyy-MM-dd"), F.lit(".")))
        .when(F.col("pos") % 4 == 3, F.concat(F.lit("on "), F.date_format(time, "dd MMM yyyy"), F.lit(".")))
        .otherwise(created)
    )
    return _out(each.select(
        "paper_id", F.col("v.version").alias("version"),
        F.to_date(dates.lenient_time(variant)).alias("created_date"),
    ))


def update_date_chain(spark, sf_dir):
    return _out(_papers(spark, sf_dir, "items"), "paper_id", "update_date")


def update_frequency(spark, sf_dir):
    return _out(_papers(spark, sf_dir, "items"), "paper_id", "update_frequency")


def submission_to_publication(spark, sf_dir):
    days = F.col("submission_to_publication").alias("days")
    return _out(_papers(spark, sf_dir, "items").select("paper_id", days))


def dropped_records(spark, sf_dir):
    records = fx.snapshot(spark, sf_dir, ("items",))
    return normalize.rejected(normalize.historical_outcome(records, fx.AS_OF, fx.RUN_TS))


# ---- quality and counters -----------------------------------------------------------------

def quality_report(spark, sf_dir):
    return _out(quality.quality_report(
        lines.snapshot_records(_snapshot_lines(spark, sf_dir), names=quality.COLUMNS)))


def run_stats(spark, sf_dir):
    """With cut-off lines among the good ones."""
    every = lines.read_snapshot(spark, _snapshot_with_cuts(spark, sf_dir))
    return quality.load_counts(historical.snapshot_outcome(every, fx.AS_OF, fx.RUN_TS))


def malformed_lines(spark, sf_dir):
    """Cut-off lines landed among good ones."""
    root, first, end = _landing(spark, sf_dir)
    fx.broken_lines(spark, sf_dir).write.mode("append").partitionBy("format", "ds").text(root)
    found = lines.malformed(lines.read_landing(spark, root, first, end, glob=EVERY_FILE))
    return found.groupBy("format", "ds").agg(F.count("*").alias("bad_lines"))


# ---- lake ---------------------------------------------------------------------------------

def partition_fields(spark, sf_dir):
    papers = _papers(spark, sf_dir, "items")
    return papers.groupBy("year", "month", "day").agg(F.count("*").alias("papers"))


def lake_roundtrip(spark, sf_dir):
    return _lake(spark, sf_dir).groupBy("year", "month").agg(
        F.count("*").alias("papers"), F.sum(F.length("abstract")).alias("characters")
    )


def lake_date_range(spark, sf_dir):
    found = lake.lake_between(_lake(spark, sf_dir), "1996-03-15", "1997-02-10")
    return _out(found, "paper_id", "submitted_date")


# ---- landing and pairing ------------------------------------------------------------------

def landing_by_day(spark, sf_dir):
    return _landing_lines(spark, sf_dir).groupBy("format", "ds").agg(F.count("*").alias("records"))


def range_replace(spark, sf_dir):
    """The second delivery of 1996 only has version records, so other days of that year empty."""
    root, first, end = _landing(spark, sf_dir)
    again = fx.deliveries(spark, sf_dir).filter("format = 'arXivRaw' and versions is not null")
    landing.land(spark, again, root, "1996-01-01", "1997-01-01", compression="gzip")
    return lines.read_landing(spark, root, first, end, glob=LANDED).groupBy("format", "ds").agg(
        F.count("*").alias("records")
    )


def window_counts(spark, sf_dir):
    """Records of one year, of other years, and without a day."""
    undated = F.when(F.col("id").cast("long") % 97 != 0, F.col("ds"))
    sent = fx.deliveries(spark, sf_dir).withColumn("ds", undated)
    return landing.window_counts(sent, "1996-01-01", "1997-01-01")


def last_wins(spark, sf_dir):
    records = lines.landing_records(_landing_lines(spark, sf_dir), ["title", "datestamp"])
    latest = pairing.last_wins(records, ["title", "datestamp"])
    return latest.select("id", "format", F.md5("title").alias("title_md5"), "datestamp")


def unpaired_records(spark, sf_dir):
    records = lines.landing_records(_landing_lines(spark, sf_dir), [])
    return pairing.unpaired(pairing.side_by_side(records, ["id"], ["id"]))


def landing_rejects(spark, sf_dir):
    """Lines that are no record by reason, some under a format of their own."""
    root, first, end = _spoiled_landing(spark, sf_dir)
    foreign = fx.deliveries(spark, sf_dir).filter("format = 'arXiv'").withColumn("format", F.lit("other"))
    foreign.select("format", "ds", "id").write.mode("append").partitionBy("format", "ds").json(root)
    read = lines.read_landing(spark, root, first, end, formats=("arXiv", "arXivRaw", "other"), glob=EVERY_FILE)
    found = lines.landing_lines(read, names=[]).filter("reject is not null")
    return found.groupBy("reject", "format").agg(F.count("*").alias("lines"))


def incremental_refusals(spark, sf_dir):
    outcome = incremental.landing_outcome(_landing_lines(spark, sf_dir), fx.RUN_TS, ["versions", "problem"])
    return quality.refused_by_reason(outcome)


# ---- lookups ------------------------------------------------------------------------------

CARD = ("paper_id", "title", "primary_category", "update_date")


def paper_by_id(spark, sf_dir):
    return _out(lookups.paper_by_id(_papers(spark, sf_dir), PROBE))


def papers_by_category(spark, sf_dir):
    return _out(lookups.papers_by_category(_papers(spark, sf_dir, "text", "place", "items"), "building.1"), *CARD)


def papers_by_date_range(spark, sf_dir):
    papers = _papers(spark, sf_dir, "text", "place", "items")
    return _out(lookups.papers_by_date_range(papers, "1996-01-01", "1996-12-31"), *CARD)


def papers_by_date_range_category(spark, sf_dir):
    papers = _papers(spark, sf_dir, "text", "place", "items")
    found = lookups.papers_by_date_range(
        papers, "1995-01-01", "1997-12-31", "machinery.3", 50, "submitted_date"
    )
    return _out(found, *CARD, "submitted_date")


def average_updates_by_category(spark, sf_dir):
    return _out(lookups.average_updates_by_category(_papers(spark, sf_dir, "place", "items")))


def publication_delay(spark, sf_dir):
    return _out(lookups.publication_delay(_papers(spark, sf_dir, "place", "items")))


def papers_by_author(spark, sf_dir):
    papers = _papers(spark, sf_dir, "text", "place", "items", "people")
    return _out(lookups.papers_by_author(papers, "BRAND#13"), *CARD)


def papers_by_update_frequency(spark, sf_dir):
    papers = _papers(spark, sf_dir, "items")
    found = lookups.papers_by_update_frequency(papers, 100.0, 300.0)
    return _out(found, "paper_id", "update_frequency")


def paper_versions(spark, sf_dir):
    return lookups.paper_versions(_papers(spark, sf_dir, "items"), PROBE)


def institution_counts(spark, sf_dir):
    return lookups.institution_counts(_papers(spark, sf_dir, "place", "items"), 20)


def exported_json(spark, sf_dir):
    """A report written as JSON and read back."""
    path = scratch(spark, "export")
    report = lookups.institution_counts(_papers(spark, sf_dir, "place", "items"), 100)
    lookups.export_json(report, path)
    return spark.read.schema("institution string, submissions long").json(path)


# ---- state --------------------------------------------------------------------------------

def merge_state(spark, sf_dir):
    table, _ = _state(spark, sf_dir)
    return _out(state.read_state(spark, table).drop("bucket"))


def merge_stats(spark, sf_dir):
    return _merged(spark, sf_dir).agg(
        F.count_if(F.col("outcome") == "new").alias("new_records"),
        F.count_if(F.col("outcome") == "updated").alias("updated_records"),
    )


def state_point_read(spark, sf_dir):
    table, _ = _state(spark, sf_dir)
    return _out(state.read_paper(spark, table, PROBE), "paper_id", "title", "version_count")


def state_category_read(spark, sf_dir):
    table, _ = _state(spark, sf_dir)
    found = lookups.papers_by_category(state.read_state(spark, table), "building.1")
    return _out(found, *CARD)


def merge_versions(spark, sf_dir):
    merged = _merged(spark, sf_dir).select("paper_id", F.inline("versions"))
    return merged.select("paper_id", "version", "created")


def merge_categories(spark, sf_dir):
    return _out(_merged(spark, sf_dir), "paper_id", "categories")


def storage_normal_form(spark, sf_dir):
    stored = merge.storage_form(_papers(spark, sf_dir))
    columns = ["categories", "authors", "versions", "published_date", "update_frequency"]
    counts = stored.agg(*[F.count(c).alias(c) for c in columns])
    return counts.unpivot([], columns, "column_name", "non_null")


def incremental_load(spark, sf_dir):
    """Landing zone to state table, end to end."""
    table = state.StateTable(scratch(spark, "state"), BUCKETS)
    root, first, end = _landing(spark, sf_dir)
    incremental.load_days(spark, root, table, first, end, fx.RUN_TS, glob=LANDED)
    return _out(state.read_state(spark, table).drop("bucket"))


def incremental_load_counts(spark, sf_dir):
    """The counters that a load stores, with lines that are no record."""
    counts = _loaded(spark, sf_dir, "metrics")
    return counts.select("stage", "input", "output", "failed", (F.col("rows_per_second") > 0).alias("timed"))


def incremental_quarantine(spark, sf_dir):
    """Every line behind a refused row, with its reason."""
    return _loaded(spark, sf_dir, "quarantine").select(
        F.coalesce("paper_id", F.lit("")).alias("paper_id"), "reason", "format", "ds",
        F.when(F.col("paper_id").isNull() | (F.col("paper_id") == ""), F.col("value")).alias("line"),
    )


def incremental_replay(spark, sf_dir):
    """Quarantined landing lines, with the spoiled time repaired, through the rules again."""
    repaired = _loaded(spark, sf_dir, "quarantine").withColumn(
        "value", F.regexp_replace("value", "not a date", "Sat, 1 Jan 2000 00:00:00 GMT"))
    outcome = incremental.replay(repaired, fx.RUN_TS)
    return outcome.groupBy(F.coalesce("reason", F.lit("accepted")).alias("reason")).agg(
        F.count("*").alias("rows"), F.sum("lines").alias("lines"))


def historical_load_counts(spark, sf_dir):
    """The counters that a load stores, with cut-off lines, and the size of its quarantine."""
    target, bad, metrics = (scratch(spark, n) for n in ("lake", "quarantine", "metrics"))
    historical.load_snapshot(
        spark, _snapshot_with_cuts(spark, sf_dir), target, fx.AS_OF, fx.RUN_TS,
        quarantine=bad, metrics=metrics)
    refused = spark.read.parquet(bad).groupBy(F.when(
        F.col("reason") == "malformed", F.lit("extract")).otherwise(F.lit("transform")).alias("stage")
    ).agg(F.count("*").alias("quarantined"))
    return spark.read.parquet(metrics).join(refused, "stage", "left").select(
        "stage", "input", "output", "failed", "quarantined", (F.col("rows_per_second") > 0).alias("timed"))


def historical_load(spark, sf_dir):
    """Snapshot to lake, end to end."""
    source, target = scratch(spark, "snapshot"), scratch(spark, "lake")
    _write_lines(fx.snapshot_lines(spark, sf_dir), source)
    historical.load_snapshot(spark, source, target, fx.AS_OF, fx.RUN_TS)
    return _out(lake.read_lake(spark, target))


# ---- streams ------------------------------------------------------------------------------

def stream_historical(spark, sf_dir):
    source, target = scratch(spark, "snapshot"), scratch(spark, "lake")
    _write_lines(fx.snapshot_lines(spark, sf_dir), source)
    jobs.stream_historical(
        spark, source, target, scratch(spark, "checkpoint"), fx.AS_OF, fx.RUN_TS
    ).awaitTermination()
    return _out(lake.read_lake(spark, target))


def stream_incremental(spark, sf_dir):
    root, _, _ = _landing(spark, sf_dir)
    table = state.StateTable(scratch(spark, "state"), BUCKETS)
    jobs.stream_incremental(
        spark, root, table, scratch(spark, "checkpoint"), fx.RUN_TS, glob=LANDED
    ).awaitTermination()
    return _out(state.read_state(spark, table).drop("bucket"))


def stream_late_half(spark, sf_dir):
    """Each format in a batch of its own: with and without lines waiting for the next batch."""
    root, found = scratch(spark, "raw"), []
    first, end = fx.delivery_days(spark, sf_dir)
    sent = fx.deliveries(spark, sf_dir)
    landing.land(spark, sent.filter("format = 'arXiv'"), root, first, end, compression="gzip")
    runs = {
        held: (state.StateTable(scratch(spark, "state"), BUCKETS), scratch(spark, "checkpoint"),
               {"reoffer": scratch(spark, "waiting")} if held else {})
        for held in (False, True)
    }

    def stream():
        for table, checkpoint, outputs in runs.values():
            jobs.stream_incremental(
                spark, root, table, checkpoint, fx.RUN_TS, glob=LANDED, **outputs).awaitTermination()

    stream()
    sent.filter("format = 'arXivRaw'").write.mode("append").option("compression", "gzip").partitionBy("format", "ds").json(root)
    stream()
    for held, (table, _, _) in runs.items():
        found.append(_out(state.read_state(spark, table).drop("bucket").withColumn("reoffer", F.lit(held))))
    return found[0].unionByName(found[1])


def _streamed_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a spoiled landing zone; time is the delivery day, and a last line far behind ends all waiting."""
    root, _, end = _spoiled_landing(spark, sf_dir)
    last_day = F.date_format(F.date_add(F.lit(end).cast("date"), 90), "yyyy-MM-dd")
    spark.range(1).select(F.lit("arXiv").alias("format"), last_day.alias("ds"), F.lit("{").alias("value")).write.mode(
        "append").partitionBy("format", "ds").text(root)
    output = scratch(spark, "pairs")
    stream_pairs.stream_pairing(
        spark, root, output, scratch(spark, "checkpoint"), arrived=F.to_timestamp("ds"), glob=EVERY_FILE).awaitTermination()
    return stream_pairs.read_pairs(spark, output)


def stream_pairing(spark, sf_dir):
    """Papers from pairs that met in a stream-stream join."""
    outcome = stream_pairs.pairs_outcome(_streamed_pairs(spark, sf_dir), fx.RUN_TS)
    return _out(outcome.filter("reason is null").drop("reason"))


def stream_pairing_quarantine(spark, sf_dir):
    """Halves that waited in vain, and lines that are no record."""
    found = stream_pairs.quarantine(_streamed_pairs(spark, sf_dir))
    return found.groupBy("reason", "format", "ds").agg(F.count("*").alias("lines"), F.countDistinct("paper_id").alias("papers"))


def load_files(spark, sf_dir):
    """Files and failed files that each load counts: a file per order priority, one of cut-off lines and one that
    cannot be read, which a stream does not see; the spoiled landing zone has a file per format and day of each kind."""
    source, found = scratch(spark, "snapshot"), []
    prioritised = fx.snapshot_lines(spark, sf_dir, "o_orderpriority").repartition("o_orderpriority")
    prioritised.write.option("compression", "gzip").partitionBy("o_orderpriority").text(source)
    fx.cut_lines(spark, sf_dir).repartition(1).write.partitionBy().mode("append").text(f"{source}/o_orderpriority=none")
    fx.unreadable(spark, f"{source}/o_orderpriority=none/broken.txt.gz")
    for name in ("historical", "stream"):
        target, metrics = scratch(spark, "lake"), scratch(spark, "metrics")
        if name == "historical":
            historical.load_snapshot(
                spark, source, target, fx.AS_OF, fx.RUN_TS, metrics=metrics, skip_unreadable=True)
        else:
            jobs.stream_historical(
                spark, f"{source}/*", target, scratch(spark, "checkpoint"), fx.AS_OF, fx.RUN_TS, skip_unreadable=True,
                metrics=metrics).awaitTermination()
        found.append((name, spark.read.parquet(metrics)))
    found.append(("incremental", _loaded(spark, sf_dir, "metrics")))
    rows = [f.filter("stage = 'extract'").select(
        F.lit(n).alias("name"), "files", "failed_files", (F.col("seconds") > 0).alias("timed")) for n, f in found]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


def stream_then_batch_lake(spark, sf_dir):
    """One lake, the papers of odd orders streamed into it and the others loaded."""
    target, every = scratch(spark, "lake"), fx.snapshot_lines(spark, sf_dir)
    odd = F.get_json_object("value", "$.id").cast("long") % 2 == 1
    streamed, loaded = scratch(spark, "odd"), scratch(spark, "even")
    _write_lines(every.filter(odd), streamed)
    _write_lines(every.filter(~odd), loaded)
    jobs.stream_historical(
        spark, streamed, target, scratch(spark, "checkpoint"), fx.AS_OF, fx.RUN_TS
    ).awaitTermination()
    historical.load_snapshot(spark, loaded, target, fx.AS_OF, fx.RUN_TS)
    return _out(lake.read_lake(spark, target))


# ---- warehouse ----------------------------------------------------------------------------

def wh_papers(spark, sf_dir):
    return _out(wh.papers_table(_papers(spark, sf_dir, "text", "items")))


def wh_authors(spark, sf_dir):
    return wh.authors_table(_papers(spark, sf_dir, "place", "items", "people"))


def wh_paper_authors(spark, sf_dir):
    return wh.paper_authors_table(_papers(spark, sf_dir, "items", "people"))


def wh_categories(spark, sf_dir):
    return wh.categories_table(_papers(spark, sf_dir, "place", "items"))


def wh_paper_categories(spark, sf_dir):
    return wh.paper_categories_table(_papers(spark, sf_dir, "place", "items"))


def fk_check(spark, sf_dir):
    """Over tables that have lost some of the rows the others point to. Papers are written once, as ten reads follow."""
    path = scratch(spark, "papers")
    _papers(spark, sf_dir).drop("abstract").write.parquet(path)
    tables = wh.warehouse(spark.read.parquet(path))
    return wh.foreign_key_check(tables | {
        "papers": tables["papers"].filter("cast(paper_id as long) % 11 <> 0"),
        "authors": tables["authors"].filter("author_id not like 'a%'"),
        "categories": tables["categories"].filter("category_id not in ('building', 'france')"),
    })


# ---- harvest ------------------------------------------------------------------------------

def oai_arxiv(spark, sf_dir):
    found = oai.metadata_records(_responses(spark, sf_dir))
    return _out(found.select(
        "id", text.clean_text(F.col("title")).alias("title"),
        text.clean_text(F.col("abstract")).alias("abstract"), "update_date", "doi", "journal_ref",
        F.array_join(F.transform("authors_parsed", lambda a: F.array_join(a, ";")), "|").alias("authors_parsed"),
        "oai_identifier", "datestamp", "setSpecs", "ds",
    ))


def oai_arxiv_raw(spark, sf_dir):
    found = oai.version_records(_responses(spark, sf_dir))
    return _out(found, "id", "submitter", "versions", "oai_identifier", "datestamp", "ds")


def oai_landing(spark, sf_dir):
    """Harvest responses of both formats to the landing zone; records per day and field."""
    root = scratch(spark, "raw")
    first, end = fx.delivery_days(spark, sf_dir)
    landing.land(spark, oai.harvested(_responses(spark, sf_dir)), root, first, end, compression="gzip")
    records = lines.landing_records(lines.read_landing(spark, root, first, end, glob=LANDED), ["authors", "versions"])
    return records.groupBy("format", "ds").agg(
        F.count("*").alias("records"), F.count("authors").alias("with_authors"),
        F.count("versions").alias("with_versions"),
    )


def oai_quarantine(spark, sf_dir):
    """Damaged and foreign records among good ones: reason and whole text."""
    return oai.quarantine(_responses(spark, sf_dir, damaged=True))


def oai_counts(spark, sf_dir):
    return oai.harvest_counts(_responses(spark, sf_dir, damaged=True))


# ---- stated uses --------------------------------------------------------------------------

def trend_by_month(spark, sf_dir):
    return _out(reports.submission_trend(_papers(spark, sf_dir, "place", "items")))


def coauthor_strength(spark, sf_dir):
    return reports.coauthor_strength(_papers(spark, sf_dir, "items", "people"))


def coauthors_of(spark, sf_dir):
    papers = _papers(spark, sf_dir, "items", "people")
    return reports.coauthors_of(papers, "Supplier#000000001", "Brand#13")


def coauthor_components(spark, sf_dir):
    """Components of each month's network."""
    papers = _papers(spark, sf_dir, "items", "people")
    return network.components(network.incidence(papers, F.date_format("submitted_date", "yyyy-MM")))


def coauthor_rank(spark, sf_dir):
    """Ten rounds over the whole network."""
    ranked = network.rank(network.incidence(_papers(spark, sf_dir, "items", "people")))
    return ranked.select("author_id", "papers", F.round("rank", 6).alias("rank"))


def recommend_papers(spark, sf_dir):
    """Five neighbours for every paper whose id is divisible by 20, against all papers."""
    papers = _papers(spark, sf_dir, "text", "items")
    return recommend.recommend_papers(papers, F.col("paper_id").cast("long") % 20 == 0)


def institution_rank(spark, sf_dir):
    return _out(reports.institution_rank(_papers(spark, sf_dir, "place", "items")))


def similar_papers(spark, sf_dir):
    return _out(reports.similar_papers(_papers(spark, sf_dir, "text", "items"), PROBE))


def unified_view(spark, sf_dir):
    """The stored side as lake history, the update side as current state; both lie written, as a lake and a state do."""
    shown = ("paper_id", "version_count", "doi")
    before, update = _sides(spark, sf_dir, "text", "place", "items")
    history, current = _kept(before.select(*shown), "history"), _kept(update.select(*shown), "current")
    return _out(lake.unified_view(history, current))


def _quality_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing percentages per submission year as a run history."""
    papers = _papers(spark, sf_dir, "text", "place", "items", "people")
    by_year = papers.groupBy(F.col("year").alias("run")).agg(*[
        (F.count_if(rule) * 100.0 / F.count("*")).alias(name)
        for name, rule in {
            "missing_titles": F.col("title") == "",
            "missing_abstracts": F.col("abstract") == "",
            "missing_authors": F.size("authors") == 0,
        }.items()
    ])
    metrics = ["missing_titles", "missing_abstracts", "missing_authors"]
    return by_year.unpivot(["run"], metrics, "metric", "pct")


def quality_drift(spark, sf_dir):
    return _out(reports.quality_drift(_quality_history(spark, sf_dir), runs=3, tolerance=0.2))


def quality_alerts(spark, sf_dir):
    limits = {"missing_titles": 2.0, "missing_authors": 1.4}
    return _out(reports.threshold_alerts(_quality_history(spark, sf_dir), limits))


def replay_quarantine(spark, sf_dir):
    """Quarantined lines, with the spoiled time repaired, through the load again."""
    path = scratch(spark, "quarantine")
    source = _snapshot_lines(spark, sf_dir)
    historical.write_quarantine(historical.snapshot_outcome(source, fx.AS_OF, fx.RUN_TS), path)
    repaired = spark.read.parquet(path).select(
        F.regexp_replace("value", "not a date", "Sat, 1 Jan 2000 00:00:00 GMT").alias("value")
    )
    outcome = historical.replay(repaired, fx.AS_OF, fx.RUN_TS)
    return _out(outcome, "paper_id", "submitted_date", "reason")


def journal_enrich(spark, sf_dir):
    """Impact per journal: the mean order price behind it, standing in for an outside table."""
    journals = fx.table(spark, sf_dir, "orders").groupBy(
        F.concat(F.lit("j.  "), F.lower(F.split_part("o_orderpriority", F.lit("-"), F.lit(2)))).alias("journal")
    ).agg(F.round(F.avg("o_totalprice"), 2).alias("impact"))
    papers = _papers(spark, sf_dir, "items")
    return _out(reports.enrich_with_journals(papers, journals), "paper_id", "journal_ref", "impact")


def behaviour_windows(spark, sf_dir):
    return _out(reports.behaviour_windows(fx.table(spark, sf_dir, "events")))


def journal_impact_asof(spark, sf_dir):
    """Impact as of the publication: a yearly figure per journal, with years left out."""
    day = F.make_date(F.year("o_orderdate"), F.lit(1), F.lit(1))
    yearly = fx.table(spark, sf_dir, "orders").groupBy(
        F.concat(F.lit("j.  "), F.lower(F.split_part("o_orderpriority", F.lit("-"), F.lit(2)))).alias("journal"), day.alias("day")
    ).agg(F.round(F.avg("o_totalprice"), 2).alias("impact")).filter("year(day) not in (1992, 1995, 1996)")
    papers = _papers(spark, sf_dir, "items")
    found = reports.enrich_with_journals_asof(papers, yearly, F.col("published_date"), rows_per_task=1000)
    return _out(found, "paper_id", "journal_ref", "published_date", "impact", "impact_day")


def behaviour_sessions(spark, sf_dir):
    """Events, every third of which is delivered twice."""
    events = fx.table(spark, sf_dir, "events")
    return _out(reports.behaviour_sessions(events.unionAll(events.filter("event_id % 3 = 0")), "6 hours"))


def stream_sessions(spark, sf_dir):
    """The same as a stream; a last event far behind closes all sessions."""
    source, output = scratch(spark, "events"), scratch(spark, "sessions")
    events = fx.table(spark, sf_dir, "events")
    events.write.parquet(source)
    events.filter("event_id % 3 = 0").write.mode("append").parquet(source)
    last = events.groupBy().agg((F.max("ts") + F.expr("interval 9 days")).alias("ts")).select(
        F.lit(-1).cast("long").alias("event_id"), "ts", F.lit(-1).cast("long").alias("user_id"),
        F.lit("end").alias("event_type"), F.lit(0.0).alias("value"), F.lit("").alias("props"))
    last.write.mode("append").parquet(source)
    stream = spark.readStream.schema(events.schema).parquet(source)
    jobs.stream_sessions(spark, stream, output, scratch(spark, "checkpoint"), "6 hours", "7 days").awaitTermination()
    return _out(spark.read.parquet(output).filter("user_id >= 0"))


def distribution_drift(spark, sf_dir):
    """Shares of categories per submission year against the year before."""
    counts = drift.category_counts(_papers(spark, sf_dir, "place", "items"), F.date_format("submitted_date", "yyyy"))
    return _out(drift.share_drift(counts, 0.03))


def profile_bounds(spark, sf_dir):
    """Monthly sketches, stored and merged to years, against exact figures; all of them from papers whose texts are
    measured once."""
    measured, path = scratch(spark, "measured"), scratch(spark, "profiles")
    _papers(spark, sf_dir, "text", "items", "people").select(
        "paper_id", "submitted_date", "authors", F.length("abstract").alias("length")).write.parquet(measured)
    papers = spark.read.parquet(measured)
    drift.sketches(papers, F.date_format("submitted_date", "yyyy-MM"), F.col("length")).write.parquet(path)
    told = drift.estimates(drift.merged(spark.read.parquet(path), F.substring("run", 1, 4)))
    year = F.date_format("submitted_date", "yyyy").alias("run")
    exact = network.incidence(papers, year).groupBy(F.col("period").alias("run")).agg(F.countDistinct("author_id").alias("exact"))
    median = papers.select(year, "length").join(told.select("run", "median"), "run").groupBy("run").agg(
        F.avg((F.col("length") < F.col("median")).cast("double")).alias("below"),
        F.avg((F.col("length") <= F.col("median")).cast("double")).alias("upto"))
    near = F.abs(F.col("authors") - F.col("exact")) <= 0.08 * F.col("exact")
    return told.join(exact, "run", "left").join(median, "run").select(
        "run", "papers", "exact", F.coalesce(near, F.lit(True)).alias("authors_near"),
        ((F.col("below") <= 0.55) & (F.col("upto") >= 0.45)).alias("median_near"))


def papers_by_author_indexed(spark, sf_dir):
    """Papers are made once: index and search read their cards and authors."""
    papers, path = _kept(_papers(spark, sf_dir).select(*CARD, "authors"), "cards"), scratch(spark, "grams")
    search_index.write_index(papers, path, parts=16)
    return _out(search_index.search(papers, path, "BRAND#13", parts=16), *CARD)


def state_last_processed(spark, sf_dir):
    """When each stored paper was last merged: the update runs a day after the first load."""
    table = state.StateTable(scratch(spark, "state"), BUCKETS)
    before, update = _sides(spark, sf_dir)
    _upsert(spark, table, before, fx.RUN_TS)
    _upsert(spark, table, update, "2024-02-01 00:00:00")
    processed = F.date_format("last_processed", "yyyy-MM-dd HH:mm:ss").alias("processed")
    return state.read_state(spark, table).select("paper_id", processed)


def merge_recounted(spark, sf_dir):
    """Version counts of the merged lists instead of the update's own."""
    before, update = _sides(spark, sf_dir)
    stored = merge.storage_form(before).withColumn("last_processed", F.lit(fx.RUN_TS).cast("timestamp"))
    return merge.merge_papers(stored, update, fx.RUN_TS, recount_versions=True).select("paper_id", "version_count")


def run_metrics(spark, sf_dir):
    outcome = historical.snapshot_outcome(_snapshot_lines(spark, sf_dir), fx.AS_OF, fx.RUN_TS)
    return _out(reports.run_metrics(quality.load_counts(outcome), "r1"))


ALL = [
    normalize_historical, normalize_incremental, clean_text, categories_split, authors_parsed,
    version_dates, lenient_dates, update_date_chain, update_frequency, submission_to_publication,
    dropped_records, quality_report, run_stats, malformed_lines, partition_fields, lake_roundtrip,
    lake_date_range, landing_by_day, range_replace, last_wins, unpaired_records,
    incremental_refusals, paper_by_id, papers_by_category, papers_by_date_range,
    papers_by_date_range_category, average_updates_by_category, publication_delay,
    papers_by_author, papers_by_update_frequency, paper_versions, institution_counts,
    exported_json, merge_state, merge_stats, state_point_read, state_category_read,
    merge_versions, merge_categories, storage_normal_form, incremental_load, historical_load,
    stream_historical, stream_incremental, wh_papers, wh_authors, wh_paper_authors, wh_categories,
    wh_paper_categories, fk_check, oai_arxiv, oai_arxiv_raw, oai_landing, trend_by_month,
    coauthor_strength, coauthors_of, institution_rank, similar_papers, unified_view,
    quality_drift, quality_alerts, replay_quarantine, journal_enrich, behaviour_windows, run_metrics,
    incremental_load_counts, incremental_quarantine, incremental_replay, historical_load_counts,
    stream_late_half, stream_then_batch_lake, window_counts, oai_quarantine, oai_counts, stream_pairing,
    stream_pairing_quarantine, load_files, coauthor_components, coauthor_rank, recommend_papers,
    journal_impact_asof, behaviour_sessions, stream_sessions, distribution_drift, profile_bounds,
    papers_by_author_indexed, state_last_processed, merge_recounted, landing_rejects,
]


def _configured(query):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(configure(spark), sf_dir)
    return run


def registry():
    named = {q.__name__: q for q in ALL}
    named["institution_bracketed"] = _institution(people.institution_bracketed)
    named["institution_bare"] = _institution(people.institution_bare)
    return {name: _configured(q) for name, q in named.items()}
