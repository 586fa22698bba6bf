"""Reports for the stated uses: trends, co-authorship, rankings, recommendation, monitoring."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from papyra.functions import text
from papyra.operators.warehouse import author_id


def submission_trend(papers: DataFrame) -> DataFrame:
    """Submissions per primary category and month, with the change to the month before it that
    has any. The window runs over monthly counts, not over papers."""
    month = F.trunc("submitted_date", "month").alias("month")
    monthly = papers.filter("primary_category <> ''").groupBy("primary_category", month).agg(
        F.count("*").alias("submissions")
    )
    before = F.lag("submissions").over(Window.partitionBy("primary_category").orderBy("month"))
    return monthly.withColumn("change", F.col("submissions") - before)


def coauthor_strength(papers: DataFrame) -> DataFrame:
    """Weighted degree of each author in the co-authorship network: the number of
    (paper, co-author) links. A paper with n authors gives each of them n - 1 links, so no pair
    has to be formed."""
    ids = papers.filter(F.size("authors") > 0).select(
        F.array_distinct(F.transform("authors", author_id)).alias("ids")
    )
    credits = ids.select(F.explode("ids").alias("author_id"), (F.size("ids") - 1).alias("links"))
    return credits.groupBy("author_id").agg(
        F.count("*").alias("papers"), F.sum("links").alias("coauthor_links")
    )


def coauthors_of(papers: DataFrame, last_name: str, first_name: str) -> DataFrame:
    """Neighbours of one author in the network, with the number of joint papers."""
    probe = author_id(F.struct(F.lit(last_name).alias("last_name"), F.lit(first_name).alias("first_name")))
    ids = F.array_distinct(F.transform("authors", author_id))
    joint = papers.select(ids.alias("ids")).filter(F.array_contains("ids", probe))
    others = joint.select(F.explode("ids").alias("author_id")).filter(F.col("author_id") != probe)
    return others.groupBy("author_id").agg(F.count("*").alias("joint_papers"))


def institution_rank(papers: DataFrame) -> DataFrame:
    """Institutions per primary category, by number of papers, then by the published share."""
    totals = papers.filter("primary_category <> '' and institution <> ''").groupBy(
        "primary_category", "institution"
    ).agg(
        F.count("*").alias("papers"),
        (F.count_if("is_published") / F.count("*")).alias("published_share"),
    )
    order = Window.partitionBy("primary_category").orderBy(F.desc("papers"), F.desc("published_share"))
    return totals.withColumn("position", F.rank().over(order))


def _shares_of(probe: frozenset[str]):
    """Batches of paper_id and text to paper_id and score, for papers that share a word with the probe."""
    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, found = [], []
            for paper, told in zip(*(batch.column(i).to_pylist() for i in range(2))):
                # white space is the same as in ``text.words``
                words = set(told.split())
                shared = len(words & probe)
                if shared:
                    ids.append(paper)
                    found.append(shared / (len(words) + len(probe) - shared))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(found, pa.float64())], ["paper_id", "score"])

    return scores


def similar_papers(papers: DataFrame, paper_id: str, limit: int = 10) -> DataFrame:
    """Papers nearest to one paper by shared words of title and abstract (Jaccard share).

    One scan: the word set of the probe, a single row, is read first and sent around. The words of a paper are counted
    in the scan's own tasks. Ties go to the smaller id.
    """
    told = papers.select("paper_id", F.lower(F.concat_ws(" ", "title", "abstract")).alias("told"))
    terms = F.array_distinct(text.words(F.col("told")))
    probe = told.filter(F.col("paper_id") == paper_id).select(F.max(terms)).first()[0]
    scored = told.filter(F.col("paper_id") != paper_id).mapInArrow(
        _shares_of(frozenset(probe or ())), "paper_id string, score double")
    return scored.orderBy(F.desc("score"), "paper_id").limit(limit)


def quality_drift(history: DataFrame, runs: int = 3, tolerance: float = 5.0) -> DataFrame:
    """Alerts on missing percentages: columns run, metric, pct in; a run is flagged when it is
    more than ``tolerance`` points above the mean of the ``runs`` runs before it."""
    before = Window.partitionBy("metric").orderBy("run").rowsBetween(-runs, -1)
    usual = F.avg("pct").over(before)
    return history.select(
        "run", "metric", "pct", usual.alias("usual_pct"),
        F.coalesce(F.col("pct") - usual > tolerance, F.lit(False)).alias("alert"),
    )


def threshold_alerts(history: DataFrame, limits: dict[str, float]) -> DataFrame:
    """Alerts on missing percentages: columns run, metric, pct in; a run is flagged when a metric
    is above its own limit. Metrics without a limit raise none."""
    limit = F.lit(None).cast("double")
    for metric, most in limits.items():
        limit = F.when(F.col("metric") == metric, F.lit(float(most))).otherwise(limit)
    return history.select(
        "run", "metric", "pct", limit.alias("limit_pct"),
        F.coalesce(F.col("pct") > limit, F.lit(False)).alias("alert"),
    )


def _journal_key(name: Column) -> Column:
    """The letters of the name in lower case. A reference goes on with volume, pages and year: the
    name ends before the first digit that follows a letter."""
    name = F.regexp_extract(F.lower(text.clean_text(name)), r"^[^\p{L}]*\p{L}\D*", 0)
    return F.regexp_replace(name, r"[^\p{L}]+", "")


def enrich_with_journals(papers: DataFrame, journals: DataFrame) -> DataFrame:
    """Adds ``impact`` of the journal (columns journal, impact; the highest of equal names).

    No broadcast is forced: the optimizer picks one when the journal table is small enough.
    """
    keyed = journals.groupBy(_journal_key(F.col("journal")).alias("journal_key")).agg(
        F.max("impact").alias("impact")
    )
    key = F.nullif(_journal_key(F.col("journal_ref")), F.lit(""))
    return papers.withColumn("journal_key", key).join(keyed, "journal_key", "left").drop("journal_key")


def enrich_with_journals_asof(
    papers: DataFrame, journals: DataFrame, day: Column, rows_per_task: int = 1_000_000
) -> DataFrame:
    """Adds ``impact`` and ``impact_day``: the journal's last figure at or before the paper's ``day``.

    ``journals`` has journal, day and impact; of two figures of one day the higher counts. Papers and figures are
    ordered in one window by journal, so no range join is needed. The papers of a large journal are dealt to
    several windows, each with all figures of that journal. Papers without journal or day have none.
    """
    key = F.nullif(_journal_key(F.col("journal_ref")), F.lit(""))
    keyed = papers.withColumn("_key", key).withColumn("_day", day)
    datable, rest = keyed.filter("_key IS NOT NULL AND _day IS NOT NULL"), keyed.filter("_key IS NULL OR _day IS NULL")
    figures = journals.groupBy(_journal_key(F.col("journal")).alias("_key"), F.col("day").alias("_day")).agg(
        F.max("impact").alias("_impact")).filter("_key <> '' AND _day IS NOT NULL")
    salts = datable.groupBy("_key").agg(F.ceil(F.count("*") / rows_per_task).cast("int").alias("_salts"))
    salted = datable.join(salts, "_key").withColumn("_salt", F.pmod(F.xxhash64("paper_id"), F.col("_salts")).cast("int"))
    spread = figures.join(salts, "_key").select(
        "_key", "_day", F.struct("_impact", F.col("_day").alias("_at")).alias("_figure"),
        F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)).alias("_salt"))
    both = salted.drop("_salts").withColumn("_paper", F.lit(1)).unionByName(spread.withColumn("_paper", F.lit(0)), True)
    upto = Window.partitionBy("_key", "_salt").orderBy("_day", "_paper").rowsBetween(Window.unboundedPreceding, 0)
    filled = both.withColumn("_last", F.last("_figure", ignorenulls=True).over(upto)).filter("_paper = 1")
    none = F.lit(None).cast(filled.schema["_last"].dataType)
    columns = [*papers.columns, F.col("_last._impact").alias("impact"), F.col("_last._at").alias("impact_day")]
    return filled.select(*columns).unionAll(rest.withColumn("_last", none).select(*columns))


def behaviour_sessions(events: DataFrame, gap: str = "30 minutes", watermark: str | None = None) -> DataFrame:
    """user_id, session_start, session_end (last event plus the gap), events and kinds: events of a user with no more
    than ``gap`` between neighbours are one session.

    An event that is delivered again counts once, by its event_id. With a ``watermark`` the same call works on a stream, where
    the engine keeps ids and open sessions in its state until the watermark has passed them.
    """
    timed = events.withColumn("ts", F.col("ts").cast("timestamp"))
    if watermark:
        once = timed.withWatermark("ts", watermark).dropDuplicatesWithinWatermark(["event_id"])
    else:
        once = timed.dropDuplicates(["event_id"])
    sessions = once.groupBy(F.session_window("ts", gap).alias("session"), "user_id").agg(
        F.count("*").alias("events"), F.array_join(F.array_sort(F.collect_set("event_type")), ",").alias("kinds"))
    return sessions.select(
        "user_id", F.col("session.start").alias("session_start"), F.col("session.end").alias("session_end"), "events", "kinds")


def behaviour_windows(events: DataFrame, window: str = "1 hour", watermark: str = "1 day") -> DataFrame:
    """Events per user, kind and tumbling window; the same call on a batch and on a stream, where
    the watermark bounds the state."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp"))
    grouped = timed.withWatermark("ts", watermark).groupBy(
        F.window("ts", window).alias("window"), "user_id", "event_type"
    ).agg(F.count("*").alias("events"))
    return grouped.select(
        F.col("window.start").alias("window_start"), "user_id", "event_type", "events"
    )


def run_metrics(counts: DataFrame, run: str, seconds: float | None = None) -> DataFrame:
    """Stage counters of a run as rows for the dashboard table."""
    rate = F.lit(None).cast("double") if seconds is None else F.col("output") / F.lit(seconds)
    return counts.select(
        F.lit(run).alias("run"), "stage", "input", "output", "failed",
        F.try_divide(F.col("failed") * 100.0, "input").alias("failed_pct"),
        rate.alias("rows_per_second"),
    )
