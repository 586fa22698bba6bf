"""Substring search on author names with an index: every three letters of a name and the papers that have them.

The postings are written in folders by a hash of the gram and sorted by it. A search reads the folders of its own
grams, and of these only row groups that may hold them; papers that have all grams are candidates, and their names decide.
A needle of fewer than three characters has no gram: it scans the names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from papyra.operators.lookups import papers_by_author
from papyra.session import freed_shuffles

GRAM = 3
SCHEMA = "gram string, paper_id string, part int"


def _part(gram: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(parts)).cast("int")


def _grams(name: Column) -> Column:
    starts = F.sequence(F.lit(1), F.length(name) - (GRAM - 1))
    return F.when(F.length(name) >= GRAM, F.array_distinct(F.transform(starts, lambda i: F.substr(name, i, F.lit(GRAM)))))


def postings(papers: DataFrame, parts: int = 64) -> DataFrame:
    """gram, paper_id and part: one row per paper and different gram of its author names, in order in each task.

    The grams of a paper are made different within its row, and one shuffle, by part and a slice of the paper ids, brings
    what is left together: the same posting of a paper that comes again, and all that a file holds. A part has as many
    slices as tasks are left for it, so a gram that very many papers share is spread over several tasks.
    """
    slices = max(1, int(papers.sparkSession.conf.get("spark.sql.shuffle.partitions")) // parts)
    names = F.filter(F.array_distinct(F.flatten(F.transform(
        "authors", lambda a: F.array(F.lower(a["last_name"]), F.lower(a["first_name"]))))), F.isnotnull)
    grams = F.array_distinct(F.flatten(F.filter(F.transform(names, _grams), F.isnotnull)))
    every = papers.select("paper_id", F.explode(grams).alias("gram")).select(
        "gram", "paper_id", _part(F.col("gram"), parts).alias("part"),
        F.pmod(F.xxhash64("paper_id"), F.lit(slices)).alias("slice"))
    once = every.repartition("part", "slice").dropDuplicates(["part", "slice", "gram", "paper_id"])
    return once.select("gram", "paper_id", "part").sortWithinPartitions("part", "gram", "paper_id")


def write_index(papers: DataFrame, path: str, parts: int = 64) -> None:
    """The postings in folders by part."""
    with freed_shuffles(papers.sparkSession):
        postings(papers, parts).write.mode("overwrite").option("compression", "zstd").partitionBy("part").parquet(
            f"{path}/parts={parts}")


def candidates(spark: SparkSession, path: str, needle: str, parts: int = 64) -> DataFrame | None:
    """paper_id of the papers that have every gram of the needle; None if it has no gram."""
    needle = needle.lower()
    grams = sorted({needle[i : i + GRAM] for i in range(len(needle) - GRAM + 1)})
    if not grams:
        return None
    own = spark.createDataFrame([(g,) for g in grams], "gram string").select(_part(F.col("gram"), parts).alias("part"))
    folders = sorted({r.part for r in own.collect()})
    found = spark.read.schema(SCHEMA).parquet(f"{path}/parts={parts}").filter(
        F.col("part").isin(folders) & F.col("gram").isin(grams))
    return found.groupBy("paper_id").agg(F.count("*").alias("n")).filter(F.col("n") == len(grams)).select("paper_id")


def search(papers: DataFrame, path: str, needle: str, limit: int = 100, parts: int = 64) -> DataFrame:
    """The same rows as ``papers_by_author``."""
    found = candidates(papers.sparkSession, path, needle, parts)
    if found is not None:
        papers = papers.join(found, "paper_id", "left_semi")
    return papers_by_author(papers, needle, limit)
