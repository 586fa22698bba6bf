"""Typed access to a VARIANT record, keeping absent, null and wrong type apart.

``schema_of_variant`` names the JSON type: null for an absent key, ``VOID`` for a JSON null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from papyra.schema import VERSIONS_TYPE


def _path(name: str) -> str:
    return f"$['{name}']"


def json_type(record: Column, name: str) -> Column:
    return F.schema_of_variant(F.try_variant_get(record, _path(name), "variant"))


def text(record: Column, name: str) -> Column:
    return F.try_variant_get(record, _path(name), "string")


def is_object(record: Column) -> Column:
    return F.coalesce(F.schema_of_variant(record).startswith("OBJECT"), F.lit(False))


def is_empty(record: Column, name: str) -> Column:
    """True for what counts as no value: absent, null, "", 0, false, [] and {}."""
    kind, value = json_type(record, name), text(record, name)
    zero = value.isin("false", "[]", "{}") | F.coalesce(value.try_cast("double") == 0, F.lit(False))
    return F.coalesce(
        kind.isNull() | (kind == "VOID") | (value == "") | ((kind != "STRING") & zero),
        F.lit(False),
    )


def text_or_empty(record: Column, name: str) -> Column:
    """The text, the empty string for no value, null for a value that is not text."""
    return F.when(is_empty(record, name), F.lit("")).when(
        json_type(record, name) == "STRING", text(record, name)
    )


def text_if_given(record: Column, name: str) -> Column:
    """The empty string when the key is absent; a JSON null stays null."""
    return F.when(json_type(record, name).isNull(), F.lit("")).otherwise(text(record, name))


def identifier(record: Column) -> Column:
    return F.when(~is_empty(record, "id"), text(record, "id"))


def author_list(record: Column) -> Column:
    """Pairs from ``[last, first, ...]`` lists; other elements are skipped, null names kept.

    Null when no list was delivered.
    """
    parts = F.try_variant_get(record, _path("authors_parsed"), "array<variant>")
    is_pair = lambda a: F.coalesce(
        F.size(F.try_variant_get(a, "$", "array<variant>")) >= 2, F.lit(False)
    )
    return F.transform(
        F.filter(parts, is_pair),
        lambda a: F.struct(
            F.try_variant_get(a, "$[0]", "string").alias("last_name"),
            F.try_variant_get(a, "$[1]", "string").alias("first_name"),
        ),
    )


def version_list(record: Column) -> Column:
    """Elements that are no objects become null, which later fails the date rule."""
    return F.try_variant_get(record, _path("versions"), VERSIONS_TYPE.simpleString())


def versions_problem(record: Column) -> Column:
    kind = json_type(record, "versions")
    return F.when(kind == "VOID", F.lit("versions_null")).when(
        ~kind.startswith("ARRAY"), F.lit("versions_type")
    )
