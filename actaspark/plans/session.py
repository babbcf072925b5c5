"""Session settings the engine relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def builder(app: str = "actaspark") -> SparkSession.Builder:
    """UTC, ANSI and adaptive execution; everything about size is left to the cluster's own settings."""
    return (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
