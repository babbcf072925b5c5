"""Make this package importable in the executors' Python workers."""

from __future__ import annotations

import tempfile
import zipfile
from functools import wraps
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package's sources to the executors, once for each application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    _shipped.add(app)
    root = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="actaspark-ship-")) / f"{root.name}.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(target))


def shipped(query):
    """A query (spark, sf_dir) that ships the package first."""

    @wraps(query)
    def run(spark: SparkSession, sf_dir: str):
        ship(spark)
        return query(spark, sf_dir)

    return run
