"""JSON-lines sources: snapshot files and the date-partitioned landing zone.

A line is parsed once into VARIANT and typed in the same pass. The typed columns leave through a
generator (``inline`` of a one-row array): Catalyst pushes filters below projections by copying
their expressions, which would parse every line again for each copy, but not below a generator.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from papyra.functions import raw, text
from papyra.schema import FORMATS, METADATA, TEXT, struct
from papyra.sources import files

# Fixed value: where a landing file sits, with or without Hive-style names.
LANDING_PATH = r"/(?:format=)?(\w+)/(?:ds=)?(\d{4}-\d{2}-\d{2})/[^/]+$"

LANDING = struct(
    value=TEXT, format=TEXT, ds=TEXT, file=TEXT, block=T.LongType(), row=T.LongType()
)


def read_snapshot(spark: SparkSession, path: str, skip_unreadable: bool = False) -> DataFrame:
    """Lines of a snapshot file or folder on any file system Spark can read, with the file they are in.

    With ``skip_unreadable`` a file that cannot be read does not end the job: what was read before the damage
    counts, and a file that gave no record is counted as failed by the loads.
    """
    return _with_file(spark.read.option("ignoreCorruptFiles", skip_unreadable).text(path))


def stream_snapshot(spark: SparkSession, path: str, skip_unreadable: bool = False) -> DataFrame:
    return _with_file(spark.readStream.option("ignoreCorruptFiles", skip_unreadable).text(path))


def _with_file(lines: DataFrame) -> DataFrame:
    return lines.select("value", F.col("_metadata.file_path").alias("file"))


def _placed(lines: DataFrame, *more: Column) -> DataFrame:
    """Format and day from the path of each line, and where in which file it was."""
    path = F.col("_metadata.file_path")
    return lines.select(
        *more,
        "value",
        F.regexp_extract(path, LANDING_PATH, 1).alias("format"),
        F.regexp_extract(path, LANDING_PATH, 2).alias("ds"),
        path.alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )


def in_reading_order(placed: DataFrame) -> DataFrame:
    """Adds ``row``, which orders the lines of one block; file and block order the rest.

    The number is compared inside a block only, so it does not depend on how blocks meet tasks.
    """
    return placed.withColumn("row", F.monotonically_increasing_id())


def check_range(from_date: str, to_date: str) -> list[str]:
    """Days of ``[from, to)``; an empty or reversed range is an error."""
    first, end = date.fromisoformat(from_date), date.fromisoformat(to_date)
    if first >= end:
        raise ValueError("from_date must be earlier than to_date")
    return [(first + timedelta(n)).isoformat() for n in range((end - first).days)]


def day_folders(
    spark: SparkSession, root: str, from_date: str, to_date: str, formats=FORMATS
) -> list[str]:
    """Existing day folders of ``[from, to)``, under plain or Hive-style names."""
    wanted = set(check_range(from_date, to_date))
    return [
        f"{parent}/{name}"
        for f in formats
        for parent in (f"{root}/{f}", f"{root}/format={f}")
        for name in files.folders(spark, parent)
        if name.removeprefix("ds=") in wanted
    ]


def read_landing(
    spark: SparkSession, root: str, from_date: str, to_date: str,
    formats=FORMATS, glob: str = "*.json", skip_unreadable: bool = False,
) -> DataFrame:
    """Landing lines of the days in ``[from, to)``; files of other days are never listed.

    A range without any day folder gives an empty frame. ``skip_unreadable`` is as in ``read_snapshot``.
    """
    folders = day_folders(spark, root, from_date, to_date, formats)
    if not folders:
        return spark.createDataFrame([], LANDING)
    reader = spark.read.option("pathGlobFilter", glob).option("ignoreCorruptFiles", skip_unreadable)
    return in_reading_order(_placed(reader.text(folders)))


def stream_landing(spark: SparkSession, root: str, glob: str = "*.json", arrival: bool = False) -> DataFrame:
    """Without the row number, which a stream cannot give: add it batch by batch.

    ``arrival`` adds ``arrived``, the time at which the line's file was written.
    """
    lines = spark.readStream.option("pathGlobFilter", glob).text(f"{root}/*/*")
    return _placed(lines, *([F.col("_metadata.file_modification_time").alias("arrived")] if arrival else []))


def parse(lines: DataFrame) -> DataFrame:
    """Adds ``record``: null for blank lines, malformed JSON and JSON that is no object."""
    record = F.expr("try_parse_json(value)")
    return lines.filter(F.col("value").rlike(r"\S")).withColumn("record", record)


def malformed(lines: DataFrame) -> DataFrame:
    return parse(lines).filter(~raw.is_object(F.col("record"))).drop("record")


def _emit(parsed: DataFrame, keep: list[str], columns: dict[str, Column]) -> DataFrame:
    typed = parsed.select(*keep, *[c.alias(name) for name, c in columns.items()])
    return typed.select(*keep, F.inline(F.array(F.struct(*columns))))


def _text_problem(record: Column, *names: str) -> list[Column]:
    return [
        F.when(raw.text_or_empty(record, n).isNull(), F.lit(f"{n}_type")) for n in names
    ]


def snapshot_records(
    lines: DataFrame, keep: list[str] | None = None, names: list[str] | None = None
) -> DataFrame:
    """Typed snapshot records; malformed lines come out with problem ``malformed``.

    ``names`` are the typed columns to read, all unless given: the generator that keeps a line from
    being parsed again also keeps Catalyst from pruning them.

    A journal reference has the hyphenated key here.
    """
    r = F.col("record")
    columns = {
        "id": raw.identifier(r),
        "title": raw.text_or_empty(r, "title"),
        "abstract": raw.text_or_empty(r, "abstract"),
        "doi": raw.text_if_given(r, "doi"),
        "categories": raw.text_or_empty(r, "categories"),
        "journal_ref": _journal(r, "journal-ref"),
        "authors": raw.author_list(r),
        "submitter": F.when(raw.json_type(r, "submitter") == "STRING", raw.text(r, "submitter")),
        "versions": raw.version_list(r),
        "update_date": raw.text(r, "update_date"),
        "problem": F.coalesce(
            F.when(~raw.is_object(r), F.lit("malformed")),
            *_text_problem(r, "title", "abstract"),
            raw.versions_problem(r),
        ),
    }
    return _emit(parse(lines), keep or [], {n: columns[n] for n in names or columns})


def _journal(record: Column, name: str) -> Column:
    empty_value = raw.is_empty(record, name) & (raw.json_type(record, name) != "VOID")
    return F.when(empty_value, F.lit("")).otherwise(raw.text_if_given(record, name))


def landing_columns(r: Column, format_name: Column) -> dict[str, Column]:
    """The typed columns of a parsed landing line, as ``landing_lines`` gives them."""
    is_metadata = format_name == METADATA
    categories = raw.text_or_empty(r, "categories")
    submitter_type = raw.json_type(r, "submitter")
    return {
        "id": raw.identifier(r),
        "title": raw.text_or_empty(r, "title"),
        "abstract": raw.text_or_empty(r, "abstract"),
        "doi": raw.text_if_given(r, "doi"),
        "categories": categories,
        "journal_ref": _journal(r, "journal_ref"),
        "authors": raw.author_list(r),
        "submitter": F.when(submitter_type == "STRING", raw.text(r, "submitter")).otherwise(""),
        "versions": raw.version_list(r),
        "update_date": raw.text(r, "update_date"),
        "datestamp": raw.text(r, "datestamp"),
        "reject": F.coalesce(
            F.when(~raw.is_object(r), F.lit("malformed")),
            F.when(~format_name.isin(*FORMATS), F.lit("unknown_format")),
            F.when(~F.coalesce(text.is_set(raw.identifier(r)), F.lit(False)), F.lit("missing_id")),
        ),
        "problem": F.when(
            is_metadata,
            F.coalesce(*_text_problem(r, "title", "abstract", "categories")),
        ).otherwise(
            F.coalesce(
                F.when(submitter_type == "VOID", F.lit("submitter_null")),
                F.when(
                    submitter_type.isNotNull()
                    & (submitter_type != "STRING")
                    & ~submitter_type.startswith("ARRAY"),
                    F.lit("submitter_type"),
                ),
                raw.versions_problem(r),
            )
        ),
    }


def landing_lines(
    lines: DataFrame, keep: list[str] | None = None, names: list[str] | None = None
) -> DataFrame:
    """Every landing line, typed, with its reading order.

    Each format fills its own fields and its own problems. ``reject`` says why a line is no record
    at all (malformed, unknown_format, missing_id) and is null for a record. ``names`` are the typed columns
    to read besides ``id`` and ``reject``, all unless given, as in ``snapshot_records``.
    """
    columns = landing_columns(F.col("record"), F.col("format"))
    wanted = columns if names is None else ["id", *[n for n in names if n != "id"], "reject"]
    return _emit(
        parse(lines), ["format", "ds", "file", "block", "row", *(keep or [])], {n: columns[n] for n in wanted})


def landing_records(lines: DataFrame, names: list[str] | None = None) -> DataFrame:
    """The typed records alone: lines that are none are left out, see ``landing_lines``."""
    return landing_lines(lines, names=names).filter("reject is null").drop("reject")
