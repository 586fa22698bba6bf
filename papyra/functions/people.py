"""Submitter rules. ``split_part`` yields the empty string when a part is missing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _part(text: Column, mark: str, number: int) -> Column:
    return F.split_part(text, F.lit(mark), F.lit(number))


def institution_bare(submitter: Column) -> Column:
    """First domain label after the first ``@`` of the submitter text."""
    return F.coalesce(_part(_part(submitter, "@", 2), ".", 1), F.lit(""))


def institution_bracketed(submitter: Column) -> Column:
    """First domain label of the address between the first ``<`` and the next ``>``."""
    address = _part(_part(submitter, "<", 2), ">", 1)
    return institution_bare(address)
