"""Joins on time: the last row at or before a time, and the intervals that a time lies in. No nested loop, no hot key in a task.

As-of: both sides are one table, and a window carries the last row forward; a key's time is cut into pieces of ``width``
seconds, so a key with a third of all rows is many windows, and what is carried from piece to piece is a row for each.
Intervals: each is put into at most two cells of a grid as wide as it is long, so a long interval isn't repeated for every
cell of a fine grid; times look into a cell of each grid that has intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _micros(c: Column) -> Column:
    return F.unix_micros(c.cast("timestamp"))


def as_of(left: DataFrame, right: DataFrame, by: list[str], left_time: str, right_time: str, columns: list[str], width: float = 86_400.0) -> DataFrame:
    """``left`` with ``columns`` of the last row of ``right`` with the same keys at or before ``left_time``; of rows of one time
    the greatest by ``columns``. Null where there is none, or a key or time is null. Column names must not clash."""
    step = int(width * 1_000_000)
    payload = F.struct(*[F.col(c) for c in columns])
    known = right.filter(F.col(right_time).isNotNull())
    for k in by:
        known = known.filter(F.col(k).isNotNull())
    r = known.select(*by, _micros(F.col(right_time)).alias("_t"), F.lit(0).alias("_side"), payload.alias("_r"))
    rest = [c for c in left.columns if c not in by]
    own = left.select(*by, F.struct(*rest).alias("_l"), _micros(F.col(left_time)).alias("_t"), F.lit(1).alias("_side"))
    rows = own.unionByName(r, allowMissingColumns=True).withColumn("_piece", F.floor(F.col("_t") / step))
    inside = Window.partitionBy(*by, "_piece").orderBy("_t", "_side", "_r").rowsBetween(Window.unboundedPreceding, 0)
    here = rows.withColumn("_here", F.last("_r", ignorenulls=True).over(inside)).filter("_side = 1")
    lasts = rows.groupBy(*by, "_piece").agg(F.max_by("_r", F.when(F.col("_side") == 0, F.struct("_t", "_r"))).alias("_last"))
    before = Window.partitionBy(*by).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    carried = lasts.filter("_piece is not null").withColumn("_carried", F.last("_last", ignorenulls=True).over(before)).filter("_carried is not null")
    carried = carried.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(by)], F.col("_piece").alias("_p"), "_carried")
    same = F.col("_piece") == F.col("_p")
    for i, k in enumerate(by):
        same = same & (F.col(k) == F.col(f"_k{i}"))
    found = F.coalesce("_here", "_carried")
    joined = here.join(carried, same, "left")
    return joined.select(*[F.col(c) if c in by else F.col(f"_l.{c}").alias(c) for c in left.columns], *[F.when(F.col("_t").isNotNull(), found[c]).alias(c) for c in columns])


def within(points: DataFrame, time: str, intervals: DataFrame, start: str, end: str, by: list[str] | None = None, width: float = 60.0) -> DataFrame:
    """Pairs of rows of ``points`` and ``intervals`` with start <= time <= end and equal ``by`` columns, which stand once.
    ``width`` is that of the finest grid, in seconds; empty intervals and nulls are in no pair. Column names must not clash."""
    by, step = by or [], int(width * 1_000_000)
    a, b, t = _micros(F.col(start)), _micros(F.col(end)), _micros(F.col(time))
    level = F.greatest(F.ceil(F.log2((b - a + 1) / step)), F.lit(0)).cast("int")
    cells = intervals.filter(a <= b).withColumn("_level", level)
    size = (F.lit(step) * F.pow(F.lit(2.0), F.col("_level"))).cast("long")
    cells = cells.withColumn("_cell", F.explode(F.array_distinct(F.array(a - F.pmod(a, size), b - F.pmod(b, size)))))
    levels = [r["_level"] for r in cells.select("_level").distinct().collect()]  # 50 at most: powers of two in 300,000 years
    looks = points.filter(t.isNotNull()).withColumn("_level", F.explode(F.array(*[F.lit(x) for x in levels]).cast("array<int>")))
    looks = looks.withColumn("_cell", t - F.pmod(t, size))
    return looks.join(cells, [*by, "_level", "_cell"]).filter((a <= t) & (t <= b)).drop("_level", "_cell")
