"""Rule tables: one literal record per rule, expected values worked out by hand."""

import json

import pytest
from pyspark.sql import functions as F

from papyra.functions import dates, people, text
from papyra.operators import normalize, pairing, quality
from papyra.sources import lines

GOOD = [{"version": "v1", "created": "Mon, 2 Apr 2007 19:18:42 GMT"}]
AS_OF, RUN_TS = "2024-01-31", "2024-01-31 00:00:00"


def as_lines(spark, *records):
    values = [(r if isinstance(r, str) else json.dumps(r),) for r in records]
    return spark.createDataFrame(values, "value string")


def snapshot(spark, *records):
    return normalize.historical_outcome(
        lines.snapshot_records(as_lines(spark, *records)), AS_OF, RUN_TS
    )


def one(spark, **fields):
    record = {"id": "1", "title": "t", "versions": GOOD} | fields
    return snapshot(spark, {k: v for k, v in record.items() if v is not ...}).first()


def landed(spark, metadata, history):
    """Outcome of one pair of deliveries, or of several given as lists."""
    rows, n = [], 0
    for name, given in (("arXiv", metadata), ("arXivRaw", history)):
        for record in given if isinstance(given, list) else [given]:
            if record is not None:
                n += 1
                rows.append((json.dumps({"id": "1"} | record), name, "2024-01-01", "f", 0, n))
    frame = spark.createDataFrame(
        rows, "value string, format string, ds string, file string, block long, row long"
    )
    sides = pairing.side_by_side(lines.landing_records(frame))
    return normalize.incremental_outcome(pairing.combined(sides), RUN_TS).first()


@pytest.mark.parametrize("raw, clean", [
    ("  a \n b\t\tc ", "a b c"), ("", ""), (None, ""), (" \n ", ""),
    ("a b　c\u0085d\x1ce\x1ff g", "a b c d e f g"), ("a​b", "a​b"),
])
def test_clean_text_like_unicode_split(spark, raw, clean):
    frame = spark.createDataFrame([(raw,)], "t string")
    row = frame.select(text.clean_text(F.col("t")).alias("c"), text.words(F.col("t")).alias("w")).first()
    assert row.c == clean == " ".join((raw or "").split())
    assert row.w == (raw or "").split()


@pytest.mark.parametrize("submitter, bare, bracketed", [
    ("jo@mit.edu", "mit", ""), ("Jo <jo@cs.mit.edu>", "cs", "cs"), ("a@b <foo>", "b <foo>", ""),
    ("J <a@mit>", "mit>", "mit"), ("Jo", "", ""), ("", "", ""), (None, "", ""), ("a@", "", ""),
    ("<a@x.y", "x", "x"),
])
def test_institution(spark, submitter, bare, bracketed):
    frame = spark.createDataFrame([(submitter,)], "s string")
    row = frame.select(
        people.institution_bare(F.col("s")), people.institution_bracketed(F.col("s"))
    ).first()
    assert tuple(row) == (bare, bracketed)


@pytest.mark.parametrize("given, day", [
    ("Mon, 2 Apr 2007 19:18:42 GMT", "2007-04-02"), ("Mon, 02 Apr 2007 19:18:42 UTC", "2007-04-02"),
    ("2 Apr 2007 19:18:42 GMT", None), ("Mon, 2 Apr 2007 19:18:42 EST", None),
    ("Mon, 32 Apr 2007 19:18:42 GMT", None), ("not a date", None), ("", None), (None, None),
])
def test_version_time_is_strict(spark, given, day):
    frame = spark.createDataFrame([(given,)], "c string")
    found = frame.select(F.to_date(dates.version_time(F.col("c")))).first()[0]
    assert (found and found.isoformat()) == day


@pytest.mark.parametrize("given, day", [
    ("2007-04-02", "2007-04-02"), ("2007-04-02T10:00:00Z", "2007-04-02"),
    ("Mon, 2 Apr 2007 19:18:42 GMT", "2007-04-02"), ("seen 2007-04-02.", "2007-04-02"),
    ("seen 02 Apr 2007!", "2007-04-02"), ("seen 2007-13-45", None), ("12:30", None), ("soon", None),
])
def test_lenient_time(spark, given, day):
    frame = spark.createDataFrame([(given,)], "c string")
    found = frame.select(F.to_date(dates.lenient_time(F.col("c")))).first()[0]
    assert (found and found.isoformat()) == day


@pytest.mark.parametrize("versions, reason", [
    ([], "versions_empty"), (None, "versions_null"), ("v1", "versions_type"), ({}, "versions_type"),
    (7, "versions_type"), (GOOD + [{"version": "v2", "created": "bad"}] + GOOD, "version_date"),
    (GOOD + [{"version": "v2"}], "version_date"), (GOOD + ["v2"], "version_date"), (GOOD, None),
])
def test_versions_rules(spark, versions, reason):
    assert one(spark, versions=versions).reason == reason


def test_absent_versions_are_submitted_as_of(spark):
    row = one(spark, versions=...)
    assert (row.reason, row.submitted_date.isoformat(), row.version_count) == (None, AS_OF, 1)
    assert (row.year, row.month, row.day) == ("2024", "01", "31")
    assert row.update_date == row.submitted_date and row.update_frequency is None


@pytest.mark.parametrize("value, reason", [
    ("", "missing_id"), (None, "missing_id"), (..., "missing_id"), (0, "missing_id"),
    ([], "missing_id"), (False, "missing_id"), ("0", None), (704.0001, None),
])
def test_id_rule(spark, value, reason):
    assert one(spark, id=value).reason == reason


def test_wrong_types(spark):
    assert one(spark, title=5).reason == "title_type"
    assert one(spark, abstract=["a"]).reason == "abstract_type"
    assert one(spark, title=None).title == one(spark, title=0).title == ""
    odd = one(spark, categories=["cs.AI"])
    assert (odd.reason, odd.categories, odd.primary_category) == (None, [], "")


def test_fields(spark):
    row = one(
        spark, **{"journal-ref": "  "}, doi=None, categories=" cs.AI  math.CO ",
        submitter=None, update_date="2008-01-02",
        authors_parsed=[["a", "b", ""], ["c"], "z", ["Q", None]],
    )
    assert row.is_published and row.doi is None and row.journal_ref == "  "
    assert row.categories == ["cs.AI", "math.CO"] and row.primary_category == "cs.AI"
    assert [tuple(a) for a in row.authors] == [("a", "b"), ("Q", None)]
    assert row.institution == "" and row.update_date.isoformat() == "2008-01-02"
    assert row.submission_to_publication == 0.0 and row.update_frequency is None
    assert one(spark, doi=...).doi == "" and one(spark, authors_parsed="x").authors == []
    assert one(spark, submitter=5).institution == ""


def test_update_frequency_in_fractional_days(spark):
    two = [
        {"version": "v2", "created": "Tue, 3 Apr 2007 12:00:00 GMT"},
        {"version": "v1", "created": "Mon, 2 Apr 2007 00:00:00 GMT"},
    ]
    row = one(spark, versions=two)
    assert row.update_frequency == 1.5 and row.submitted_date.isoformat() == "2007-04-02"


def test_malformed_lines_and_duplicate_keys(spark):
    good = '{"id": "old", "id": "new", "versions": [{"created": "Mon, 2 Apr 2007 19:18:42 GMT"}]}'
    given = as_lines(spark, good, "", "  ", '{"id": ', "[1]", "5", '"x"')
    assert lines.malformed(given).count() == 4
    outcome = normalize.historical_outcome(lines.snapshot_records(given), AS_OF, RUN_TS)
    assert {(r.paper_id, r.reason) for r in outcome.collect()} == {("new", None), (None, "malformed")}
    stages = {r.stage: tuple(r)[1:] for r in quality.load_counts(outcome).collect()}
    assert stages == {"extract": (5, 1, 4), "transform": (1, 1, 0)}


def test_quality_counts_rows_dropped_later(spark):
    records = lines.snapshot_records(as_lines(
        spark,
        {"id": "1", "title": None, "versions": [{"created": "bad"}], "authors_parsed": []},
        {"id": "2", "title": 5}, {"title": "no id"},
        {"id": "3", "title": "t", "abstract": "a", "categories": 5, "versions": GOOD},
    ))
    counts = {r.metric: (r.missing, r.total, r.pct) for r in quality.quality_report(records).collect()}
    assert counts == {
        "missing_titles": (1, 2, 50.0), "missing_abstracts": (1, 2, 50.0),
        "missing_categories": (1, 2, 50.0), "missing_authors": (1, 2, 50.0),
    }


def test_incremental_rules(spark):
    history = {"submitter": "Jo <jo@cs.mit.edu>", "versions": GOOD, "datestamp": "2024-03-01"}
    row = landed(spark, {"title": "t", "update_date": "", "datestamp": "2024-02-01"}, history)
    assert (row.reason, row.institution, row.authors) == (None, "cs", None)
    assert row.update_date.isoformat() == "2024-02-01"
    assert landed(spark, {"update_date": "2020-05-05"}, history).update_date.isoformat() == "2020-05-05"
    assert landed(spark, {}, history).update_date.isoformat() == "2024-03-01"
    reason = lambda m, h: landed(spark, m, h).reason
    assert reason({}, history | {"submitter": None}) == "submitter_null"
    assert reason({}, {"versions": GOOD}) is None
    assert reason({"categories": 5}, history) == "categories_type"
    assert reason({}, {"submitter": "x"}) == "versions_absent"
    assert reason({}, history | {"versions": None}) == "versions_null"
    assert reason({}, history | {"versions": []}) == "versions_empty"
    assert reason({}, None) == reason(None, history) == "unpaired"
    assert landed(spark, {"journal_ref": "J", "journal-ref": ""}, history).is_published


def test_last_record_wins(spark):
    history = {"versions": GOOD}
    row = landed(spark, [{"title": "first"}, {"title": "last"}, {"doi": "d"}], history)
    assert (row.title, row.doi) == ("", "d")


@pytest.mark.parametrize("given, day", [
    ("2007-04-02", "2007-04-02"), ("2007-04-02T10:20:30Z", "2007-04-02"), (" 20070402 ", "2007-04-02"),
    ("2007-04-02 junk", None), ("2007-04-02Tfoo", None), ("2007", None), ("", None), (None, None),
])
def test_iso_date_takes_whole_texts_only(spark, given, day):
    frame = spark.createDataFrame([(given,)], "t string")
    got = frame.select(dates.iso_date(F.col("t"))).first()[0]
    assert (str(got) if got else None) == day


@pytest.mark.parametrize("line", ["", "  ", "\t", "\r"])
def test_blank_lines_are_skipped(spark, line):
    assert lines.malformed(spark.createDataFrame([(line,)], "value string")).count() == 0
