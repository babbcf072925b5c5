"""JSON of unknown shape as VARIANT: texts that were encoded twice, lists that were wrapped, and the way back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_NESTED = ("array", "struct", "map")


def kind(v: Column) -> Column:
    """STRING, BIGINT, BOOLEAN, ... or ARRAY, OBJECT and VOID; null of no value."""
    return F.regexp_extract(F.schema_of_variant(v), r"^(\w+)", 1)


def _decoded(v: Column) -> Column:
    return F.when(kind(v) == "STRING", F.coalesce(F.try_parse_json(F.variant_get(v, "$", "string")), v)).otherwise(v)


def unwrapped(c: Column, levels: int = 2) -> Column:
    """The value of a JSON text: a string that is JSON itself is read again, ``levels`` times, and ``{"array": [...]}`` is its
    list. What can't be read is null; a string that is no JSON stays a string; what stands behind a first value is ignored,
    as Spark's parser does."""
    v = F.try_parse_json(c)
    for _ in range(levels):
        v = _decoded(v)
    inner = F.try_variant_get(v, "$.array", "variant")
    return F.when((kind(v) == "OBJECT") & (kind(inner) == "ARRAY"), inner).otherwise(v)


def elements(v: Column) -> Column:
    """The elements of a list, or the value alone; JSON null and null have none."""
    whole = F.when(kind(v) == "ARRAY", F.try_variant_get(v, "$", "array<variant>")).otherwise(F.array(v))
    return F.when(v.isNull() | (kind(v) == "VOID"), F.array().cast("array<variant>")).otherwise(whole)


def json_safe(df: DataFrame) -> DataFrame:
    """Nested and VARIANT columns as JSON texts, the others as they are; null stays null."""
    kinds = dict(df.dtypes)
    return df.withColumns({c: F.to_json(c) for c in df.columns if kinds[c].startswith((*_NESTED, "variant"))})
