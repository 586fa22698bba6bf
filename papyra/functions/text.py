"""Text rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: runs of Unicode white space plus the four ASCII separators 0x1C-0x1F.
BLANKS = r"(?U)[\s\x1c-\x1f]+"


def clean_text(text: Column) -> Column:
    """White space runs become one blank, ends trimmed, null becomes the empty string."""
    return F.coalesce(F.trim(F.regexp_replace(text, BLANKS, " ")), F.lit(""))


def words(text: Column) -> Column:
    """White space separated parts; no parts for blank or missing text."""
    flat = clean_text(text)
    return F.when(flat == "", F.array().cast("array<string>")).otherwise(F.split(flat, " "))


def first_or_empty(values: Column) -> Column:
    return F.coalesce(F.get(values, F.lit(0)), F.lit(""))


def is_set(text: Column) -> Column:
    """True for any text but null and the empty string; blanks count."""
    return F.coalesce(text, F.lit("")) != ""


def empty_to_null(values: Column) -> Column:
    """Arrays without elements are stored as null."""
    return F.when(F.size(values) > 0, values)


def contains_ignoring_case(text: Column, needle: str) -> Column:
    return F.contains(F.lower(F.coalesce(text, F.lit(""))), F.lower(F.lit(needle)))


def zip_shorter(left: Column, right: Column, pair) -> Column:
    """Element-wise pairs, cut to the shorter side (``zip_with`` alone pads with nulls)."""
    n = F.least(F.size(left), F.size(right))
    return F.zip_with(F.slice(left, F.lit(1), n), F.slice(right, F.lit(1), n), pair)
