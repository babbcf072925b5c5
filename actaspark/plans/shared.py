"""The folder that driver and executors share, tables in it, and rows dealt to all cores."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local: dict[str, str] = {}


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``; only in local mode, as in tests, a temporary folder may stand in."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        app = spark.sparkContext.applicationId
        root = _local.setdefault(app, f"file://{tempfile.mkdtemp(prefix='actaspark-')}")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def spread(rows: DataFrame, key: str) -> DataFrame:
    """``rows`` dealt by ``key`` to as many tasks as the session deals: a table of few bytes is one task when read, however
    dear its rows are, and tasks of a shuffle without a number are put together again by their bytes."""
    spark = rows.sparkSession
    return rows.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism), key)
