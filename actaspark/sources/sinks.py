"""Where results go: partitioned tables, exports, dead letters, name lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actaspark.plans.pipeline import flat_export


def write_decisions(decisions: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Parquet by month of publication, sorted by number within files, so look-ups prune both ways."""
    rows = decisions.withColumn("month", F.date_format("date_doc", "yyyy-MM"))
    rows.repartition("month", F.pmod(F.xxhash64("id"), F.lit(16))).sortWithinPartitions(F.try_element_at("TVA", F.lit(1))).write.mode(mode).partitionBy("month").parquet(path)


def write_lookup(decisions: DataFrame, array: str, path: str, mode: str = "overwrite") -> None:
    """(value, id) of an array column, sorted by value: containment on arrays isn't pushed to files, equality is."""
    decisions.select(F.explode(array).alias("value"), "id").repartitionByRange("value").sortWithinPartitions("value").write.mode(mode).parquet(path)


def write_csv(decisions: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One row for each decision and number."""
    flat_export(decisions).write.mode(mode).option("header", True).option("escape", '"').csv(path)


def write_json(decisions: DataFrame, path: str, mode: str = "overwrite") -> None:
    decisions.write.mode(mode).option("ignoreNullFields", False).json(path)


def append_dead_letters(rows: DataFrame, path: str, as_of) -> None:
    """Failed pages with the day of the run."""
    rows.withColumn("as_of", F.lit(as_of).cast("date")).write.mode("append").partitionBy("as_of").parquet(path)


def add_names(listed: DataFrame, more: DataFrame) -> DataFrame:
    """A name list with further names, each once, in order."""
    return listed.select("nom").union(more.select("nom")).filter(F.trim("nom") != "").distinct().orderBy("nom")


def remove_names(listed: DataFrame, gone: DataFrame) -> DataFrame:
    return listed.select("nom").distinct().join(gone.select("nom"), "nom", "left_anti").orderBy("nom")


def notifications(events: DataFrame, watches: DataFrame) -> DataFrame:
    """One row for each user with new events; sending is not the engine's business."""
    rows = events.join(watches.select("watch_id", "user"), "watch_id")
    return rows.groupBy("user").agg(F.count(F.lit(1)).alias("n_events"), F.array_sort(F.collect_set("watch_id")).alias("watches"))
