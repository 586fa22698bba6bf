"""How rows are dealt to the tasks that write them into many folders."""

from __future__ import annotations

import math
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from papyra.session import freed_shuffles, scratch
from papyra.sources import files as folders_of

SHARES, SHARE_ROWS = 8, 250_000


def by_folder(rows: DataFrame, keys: list[str], records: int) -> DataFrame:
    """Rows dealt so that a folder of n rows gets about ``n / records`` files, and at least one.

    One pass counts the rows per folder; one row per folder reaches the driver. Folders lie side
    by side in the order of their keys, and each task takes a stretch of about equal length: small
    folders share a task and are written by it alone, a hot one is cut into parts by a hash of
    its rows, which only such rows are hashed for. ``rows`` is read twice, so pass a written table (``staged``)
    rather than a long lineage.
    """
    sizes = _sizes(rows, keys)
    return _dealt(rows, keys, records, sizes, "left") if sizes else rows


def by_shares(rows: DataFrame, keys: list[str], records: int) -> list[DataFrame]:
    """The same in up to ``SHARES`` frames of whole folders and about equally many rows, at least ``SHARE_ROWS`` to a frame:
    who writes one after the other has only one frame's shuffle on disk. Every frame reads ``rows`` again, without
    a shuffle before its own. A folder is in one frame, however large it is.
    """
    sizes = _sizes(rows, keys)
    shares = shares_of(sizes, sum(r.n for r in sizes))
    if len(shares) < 2:
        return [_dealt(rows, keys, records, sizes, "left") if sizes else rows]
    return [_dealt(rows, keys, records, own, "inner") for own in shares]


def shares_of(sizes: list, rows: int) -> list[list]:
    """Keys with their numbers of rows (last in each), side by side in up to ``SHARES`` lists of about equal length, at least
    ``SHARE_ROWS`` of the ``rows`` behind them to a list."""
    total, at, shares = sum(s[-1] for s in sizes), 0, {}
    wanted = min(SHARES, math.ceil(rows / SHARE_ROWS))
    for s in sizes:
        shares.setdefault(at * wanted // total, []).append(s)
        at += s[-1]
    return list(shares.values())


def _sizes(rows: DataFrame, keys: list[str]) -> list[Row]:
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).orderBy(*keys).collect()


def _dealt(rows: DataFrame, keys: list[str], records: int, sizes: list[Row], how: str) -> DataFrame:
    spark = rows.sparkSession
    total, folders, at = sum(r.n for r in sizes), [], 0
    for r in sizes:
        folders.append((*r[:-1], at, r.n, math.ceil(r.n / records)))
        at += r.n
    files = sum(f[-1] for f in folders)
    least = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    tasks = min(files, max(2 * least, math.ceil(total / records)))
    own = [f"__{k}" for k in keys]
    types = ", ".join(f"{o} {rows.schema[k].dataType.simpleString()}" for o, k in zip(own, keys))
    placed = spark.createDataFrame(folders, f"{types}, __at long, __n long, __parts long")
    # keys may be null, as a folder name may
    same = [F.col(k).eqNullSafe(F.col(o)) for k, o in zip(keys, own)]
    part = F.when(F.col("__parts") > 1, F.pmod(F.xxhash64(*rows.columns), F.col("__parts"))).otherwise(0)
    start = F.col("__at") + F.floor(part * F.col("__n") / F.col("__parts"))
    task = F.least(F.floor(start * tasks / total), F.lit(tasks - 1)).cast("int")
    # one row per folder, as the driver holds it already
    return rows.join(F.broadcast(placed), same, how).repartitionById(tasks, task).select(*rows.columns)


@contextmanager
def staged(rows: DataFrame):
    """The rows written to the shared working folder, so that reading them twice computes them once."""
    path = scratch(rows.sparkSession, "staged")
    with freed_shuffles(rows.sparkSession):
        rows.write.option("compression", "zstd").parquet(path)
    yield rows.sparkSession.read.schema(rows.schema).parquet(path)
    folders_of.remove(rows.sparkSession, path)
