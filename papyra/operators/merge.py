"""Merge of paper updates into stored papers: one full outer join, no Python."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from papyra.functions import text
from papyra.schema import PAPER, PAPER_COLUMNS

ARRAYS = [f.name for f in PAPER if isinstance(f.dataType, T.ArrayType)]


def storage_form(papers: DataFrame) -> DataFrame:
    """Empty lists become null, so that "is stored" is the same as "is not null"."""
    return papers.withColumns({c: text.empty_to_null(F.col(c)) for c in ARRAYS})


def merge_versions(stored: Column, update: Column) -> Column:
    """Union by label: the update wins, stored positions stay, new labels follow, versions
    without a label are dropped. The last entry of a repeated label counts.

    Arrays rather than maps, because a repeated key is an error in a map.
    """
    labels = F.filter(
        F.array_distinct(F.concat(stored["version"], update["version"])), text.is_set
    )
    last = lambda side, label: F.try_element_at(
        F.filter(side, lambda v: v["version"] == label), F.lit(-1)
    )
    return F.transform(labels, lambda l: F.coalesce(last(update, l), last(stored, l)))


def _merged_field(name: str, kind: T.DataType) -> Column:
    stored, update = F.col(f"stored_{name}"), F.col(f"update_{name}")
    both = stored.isNotNull() & update.isNotNull()
    if name == "versions":
        return F.when(both, merge_versions(stored, update)).otherwise(F.coalesce(update, stored))
    if name == "categories":
        union = F.array_sort(F.array_union(stored, update))
        return F.when(both, union).otherwise(F.coalesce(update, stored))
    if name == "authors":
        return F.coalesce(text.empty_to_null(update), stored)
    if isinstance(kind, T.StringType):
        # an empty text never replaces a stored one, but is stored with a new paper
        fresh = F.when(F.col("is_stored").isNull(), update).otherwise(F.nullif(update, F.lit("")))
        return F.coalesce(fresh, stored)
    return F.coalesce(update, stored)


def merge_papers(
    stored: DataFrame, updates: DataFrame, run_ts: str, keys: list[str] | None = None,
    recount_versions: bool = False, changed_only: bool = False,
) -> DataFrame:
    """Stored papers with the updates applied, plus ``outcome``: new, updated or kept.

    Both sides hold one row per paper. ``version_count`` is the one the update carries unless
    ``recount_versions`` asks for the length of the merged list. ``keys`` may add a column that
    both sides carry. ``changed_only`` leaves out the kept ones.
    """
    keys = keys or ["paper_id"]
    # plain columns and no structs, so that those a caller does not use are pruned below the join
    side = lambda frame, name, extra: frame.select(
        *keys, F.lit(True).alias(f"is_{name}"), *[F.col(c).alias(f"{name}_{c}") for c in [*PAPER_COLUMNS[1:], *extra]]
    )
    joined = side(stored, "stored", ["last_processed"]).join(
        side(updates, "update", []), keys, "right_outer" if changed_only else "full_outer"
    )
    outcome = (
        F.when(F.col("is_update").isNull(), F.lit("kept"))
        .when(F.col("is_stored").isNull(), F.lit("new"))
        .otherwise(F.lit("updated"))
    )
    merged = {f.name: _merged_field(f.name, f.dataType) for f in PAPER if f.name != "paper_id"}
    if recount_versions:
        merged["version_count"] = F.when(
            outcome == "updated", F.size(merged["versions"])
        ).otherwise(merged["version_count"])
    processed = F.when(F.col("is_update").isNull(), F.col("stored_last_processed")).otherwise(
        F.lit(run_ts).cast("timestamp")
    )
    columns = [F.col("paper_id"), *[merged[c].alias(c) for c in PAPER_COLUMNS[1:]]]
    rest = [F.col(k) for k in keys if k != "paper_id"]
    return storage_form(
        joined.select(*columns, processed.alias("last_processed"), *rest, outcome.alias("outcome"))
    )
