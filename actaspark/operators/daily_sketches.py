"""Approximate aggregates that are kept by day and merged to any period: a row for each day and group, whatever the day's rows.

Distinct values are counted by HyperLogLog sketches of 2**12 registers (standard error 1.6 %), quantiles are those of KLL
sketches (a rank is off by 1.7 % at most in 99 of 100 cases). A late or repeated day is built again by itself."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REGISTERS, DISTINCT_ERROR, RANK_ERROR = 12, 0.05, 0.025


def by_day(rows: DataFrame, time: str, keys: list[str], item: str, value: str) -> DataFrame:
    """(day, keys, n, items, values): counts and sketches of each day."""
    return rows.groupBy(F.to_date(time).alias("day"), *keys).agg(
        F.count(F.lit(1)).alias("n"), F.hll_sketch_agg(item, REGISTERS).alias("items"), F.kll_sketch_agg_double(F.col(value).cast("double")).alias("values")
    )


def merged(days: DataFrame, keys: list[str], when: Column | None = None) -> DataFrame:
    """(keys, n, items, values) of the days that meet ``when``."""
    days = days if when is None else days.filter(when)
    return days.groupBy(*keys).agg(F.sum("n").alias("n"), F.hll_union_agg("items").alias("items"), F.kll_merge_agg_double("values").alias("values"))


def distinct_of(items: Column) -> Column:
    return F.hll_sketch_estimate(items)


def quantile_of(values: Column, q: float) -> Column:
    return F.kll_sketch_get_quantile_double(values, F.lit(q))
