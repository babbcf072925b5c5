"""Watches over a stream of decisions, and windows over a stream of events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from actaspark.operators.merge import insert_if_absent

KEY = ["watch_id", "numero_tva", "type", "date_publication", "source"]


def unique_stream(stream: DataFrame, key: str, time: str, lateness: str = "1 day") -> DataFrame:
    """Each key once, as long as its copies come within the lateness; the state is bounded by it."""
    return stream.withWatermark(time, lateness).dropDuplicatesWithinWatermark([key])


def append_new(path: str):
    """A foreachBatch function that adds events to the table at ``path`` unless their natural key is there,
    so a replayed batch adds nothing."""

    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        there = folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)
        old = spark.read.schema(batch.schema).parquet(path) if there else batch.limit(0)
        insert_if_absent(old, batch, KEY).write.mode("append").parquet(path)

    return write


def watch_events(decisions: DataFrame, watch_company: DataFrame) -> DataFrame:
    """Events of watched numbers in a stream of decisions (url, date_doc, TVA): a stream-static equi join."""
    rows = decisions.select("url", "date_doc", "time", F.explode("TVA").alias("numero_tva"))
    hits = rows.join(watch_company, "numero_tva")
    return hits.select("watch_id", "numero_tva", F.lit("DECISION").alias("type"), F.col("date_doc").alias("date_publication"), F.col("url").alias("source"))


def start_watch(decisions: DataFrame, watch_company: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    events = watch_events(unique_stream(decisions, "url", "time"), watch_company)
    writer = events.writeStream.foreachBatch(append_new(path)).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def windowed_counts(events: DataFrame, time: str, kind: str, size: str = "6 hours", lateness: str = "1 hour") -> DataFrame:
    """Counts by tumbling window and kind; late rows beyond the watermark are left out."""
    return events.withWatermark(time, lateness).groupBy(F.window(time, size).alias("w"), kind).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), kind, "n")


def replay(spark: SparkSession, folder: str, schema, files_per_trigger: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)
