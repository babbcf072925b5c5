"""Data-quality tables: what is missing, invalid or unresolved."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from actaspark.functions import dates, ids


def is_blank(name: str, kind: str) -> Column:
    c = F.col(name)
    if kind.startswith(("array", "map")):
        return c.isNull() | (F.size(c) == 0)
    return c.isNull() | (F.trim(c) == "") if kind == "string" else c.isNull()


def missing_fields(df: DataFrame, columns: list[str], out: str = "missing") -> DataFrame:
    """``df`` with the names of those columns that are null or empty, in order."""
    kinds = dict(df.dtypes)
    return df.withColumn(out, F.filter(F.array(*[F.when(is_blank(c, kinds[c]), F.lit(c)) for c in columns]), lambda x: x.isNotNull()))


def invalid_numbers(df: DataFrame, key: str, array: str) -> DataFrame:
    """(key, raw, reason) of numbers with a wrong form or a wrong checksum."""
    rows = df.select(key, F.explode(array).alias("raw"))
    reason = F.when(ids.enterprise_number(F.col("raw")).isNull(), "format").when(~ids.is_valid_number(ids.enterprise_number(F.col("raw"))), "checksum")
    return rows.withColumn("reason", reason).filter("reason is not null")


def bad_dates(df: DataFrame, key: str, column: str) -> DataFrame:
    return df.filter(~dates.is_valid_date(F.col(column))).select(key, column)


def unresolved(decisions: DataFrame) -> DataFrame:
    """(id, bce) of listed numbers that got neither a name nor an address: the next work queue."""
    rows = decisions.select("id", F.explode("TVA").alias("raw"), "denoms_by_bce", "adresses_by_bce").withColumn("bce", ids.format_number(F.col("raw")))
    known = lambda c: F.coalesce(F.exists(c, lambda x: x["bce"] == F.col("bce")), F.lit(False))
    return rows.filter(~known("denoms_by_bce") & ~known("adresses_by_bce")).select("id", "bce")
