"""Session settings the library is written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split skewed join partitions even where that costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def build(app: str = "evenkeel", settings: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for name, value in {**SETTINGS, **(settings or {})}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
