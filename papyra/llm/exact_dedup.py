"""Exact duplicates by progressive refinement, in DataFrame functions alone.

1. Rows are grouped by the length of their text. Lengths that only one row has are done.
2. Rows of shared lengths are grouped by length and a hash of the first ``PREFIX`` characters.
3. Only rows that share both have their whole text hashed (SHA-256); those hashes give the groups.

Which rows go on is told by a bit table of at most ``WORDS`` rows of 64 bits, so it can be broadcast
whatever the input's size. Once it fills up, it lets rows through that share nothing; they are
hashed in vain and end up alone, so the result does not depend on it. The texts are read twice and
never shuffled: what moves is a hash, an id and what the caller wants to carry.

A group that holds a thousandth of all rows or more is attached to its rows by a broadcast (there are
a thousand such groups at most), smaller ones by a shuffle on the hash.

Texts are equal when they are identical after lower-casing A-Z; null counts as empty, and all empty texts are
one group. The row with the largest doc_id stays; rows that share that doc_id and the text are one
document and all stay. A row without doc_id stays only if no row of its group has one. An empty
table gives no rows. Columns other than doc_id and text are not read, unless carried.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from papyra.session import scratch

PREFIX = 256
WORDS = 1 << 20
HOT_SHARE = 1000


def normalised(text: Column) -> Column:
    """The text as it is compared: A-Z as a-z, null as empty."""
    return F.translate(F.coalesce(text.cast("string"), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def _length(text: Column) -> Column:
    # lower-casing A-Z leaves the number of bytes as it is
    return F.coalesce(F.octet_length(text.cast("string")), F.lit(0)).cast("long")


def _prefix(text: Column) -> Column:
    return F.xxhash64(normalised(F.substring(text.cast("string"), 1, PREFIX)))


def _word(key: Column) -> Column:
    return F.pmod(F.shiftright(key, 6), F.lit(WORDS)).cast("int")


def _bit(key: Column) -> Column:
    return key.bitwiseAND(F.lit(63)).cast("int")


def _bit_table(keys: DataFrame) -> DataFrame:
    """One bit per key (column ``key``, a long): word and bits, ``WORDS`` rows at most."""
    # shiftleft counts modulo 64, so the low six bits of the key choose the bit
    bit = F.expr("shiftleft(1L, cast(key & 63 as int))")
    return keys.select(_word(F.col("key")).alias("word"), bit.alias("bit")).groupBy("word").agg(
        F.bit_or("bit").alias("bits"))


def _marked(rows: DataFrame, key: Column, table: DataFrame, name: str) -> DataFrame:
    """Rows with a boolean ``name``: false only if the row's key is surely not in the table."""
    joined = rows.withColumn("_key", key).withColumn("_word", _word(F.col("_key")))
    joined = joined.join(F.broadcast(table), F.col("_word") == F.col("word"), "left")
    bits = F.coalesce("bits", F.lit(0).cast("long"))
    return joined.withColumn(name, F.getbit(bits, _bit(F.col("_key"))) == 1).drop("_key", "_word", "word", "bits")


def exact_duplicates(docs: DataFrame, carry: dict[str, Column] | None = None) -> DataFrame:
    """doc_id, keep_id, group_size and kept for every row, and the columns of ``carry``, made from docs."""
    spark, path = docs.sparkSession, scratch(docs.sparkSession, "exact-dedup")

    def keep(frame: DataFrame, name: str) -> DataFrame:
        frame.write.parquet(f"{path}/{name}")
        return spark.read.schema(frame.schema).parquet(f"{path}/{name}")

    text = F.col("text")
    short = keep(docs.select(_length(text).alias("n_bytes"), _prefix(text).alias("prefix")), "prefixes")
    shared = short.groupBy("n_bytes").agg(F.count("*").alias("rows")).where("rows > 1")
    of_length = _marked(short, F.col("n_bytes"), _bit_table(shared.select(F.col("n_bytes").alias("key"))), "go_on")
    shared = of_length.where("go_on").groupBy("n_bytes", "prefix").agg(F.count("*").alias("rows")).where("rows > 1")
    table = keep(_bit_table(shared.select(F.xxhash64("n_bytes", "prefix").alias("key"))), "survivors")

    carried = carry or {}
    rows = docs.select(
        F.col("doc_id").alias("doc_id"), text.cast("string").alias("_text"),
        *(column.alias(f"_carried_{i}") for i, column in enumerate(carried.values())))
    rows = _marked(rows, F.xxhash64(_length(F.col("_text")), _prefix(F.col("_text"))), table, "go_on")
    full = F.when(F.col("go_on"), F.unhex(F.sha2(normalised(F.col("_text")), 256)))
    hashed = keep(rows.select("doc_id", full.alias("full"), *(f"_carried_{i}" for i in range(len(carried)))), "hashes")

    alone, several = hashed.where("full IS NULL"), hashed.where("full IS NOT NULL")
    groups = keep(several.groupBy("full").agg(
        F.count("*").alias("group_size"), F.max("doc_id").alias("keep_id")).where("group_size > 1"), "groups")
    is_hot = F.col("group_size") * HOT_SHARE >= short.count()
    hot = F.broadcast(groups.where(is_hot))
    warm = several.join(hot.select("full"), "full", "left_anti").join(groups.where(~is_hot), "full", "left")

    def result(frame: DataFrame) -> DataFrame:
        size = F.coalesce("group_size", F.lit(1).cast("long"))
        keep_id = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
        return frame.select(
            "doc_id", keep_id.alias("keep_id"), size.alias("group_size"), F.col("doc_id").eqNullSafe(keep_id).alias("kept"),
            *(F.col(f"_carried_{i}").alias(name) for i, name in enumerate(carried)))

    none = [F.lit(None).cast("long").alias("group_size"), F.col("doc_id").alias("keep_id")]
    return result(alone.select("*", *none)).unionAll(result(several.join(hot, "full"))).unionAll(result(warm))
