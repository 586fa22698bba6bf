"""Landing zone writes: JSON lines by format and day, replacing a range of days."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from papyra.plans import spread
from papyra.schema import FORMATS
from papyra.session import freed_shuffles
from papyra.sources import files
from papyra.sources.lines import check_range, day_folders


def in_window(records: DataFrame, from_date: str, to_date: str) -> DataFrame:
    check_range(from_date, to_date)
    return records.filter((F.col("ds") >= from_date) & (F.col("ds") < to_date))


def window_counts(records: DataFrame, from_date: str, to_date: str) -> DataFrame:
    """Landed, outside (skipped) and undated (failed) records per format."""
    inside = (F.col("ds") >= from_date) & (F.col("ds") < to_date)
    return records.groupBy("format").agg(
        F.count_if(inside).alias("landed"),
        F.count_if(~inside).alias("outside"),
        F.count_if(F.col("ds").isNull()).alias("undated"),
    )


def clear_days(spark: SparkSession, root: str, from_date: str, to_date: str) -> int:
    """Removes every day of ``[from, to)`` for both formats, in either folder naming."""
    return sum(
        files.remove(spark, folder)
        for folder in day_folders(spark, root, from_date, to_date, FORMATS)
    )


def land(
    spark: SparkSession, records: DataFrame, root: str, from_date: str, to_date: str,
    max_records_per_file: int = 10_000, compression: str = "none",
) -> None:
    """Replaces the days of ``[from, to)`` by the records that fall into them.

    Days without new rows end up empty, which dynamic partition overwrite alone would not do.
    Clearing and writing can be repeated after a failure. Null fields are left out of the JSON.
    Files are sized as in the lake; ``records`` is computed once and staged, and its days are written in several shares, whose
    shuffle files go one after the other. With ``compression`` a file's name
    says so ("x.json.gz"), and readers need a ``glob`` that takes it.
    """
    with spread.staged(in_window(records, from_date, to_date)) as rows:
        clear_days(spark, root, from_date, to_date)
        for share in spread.by_shares(rows, ["format", "ds"], max(1, max_records_per_file * 9 // 10)):
            with freed_shuffles(spark):
                (
                    share.write.mode("append")
                    .option("maxRecordsPerFile", max_records_per_file)
                    .option("compression", compression)
                    .partitionBy("format", "ds")
                    .json(root)
                )
