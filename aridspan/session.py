"""The Spark session that the engine expects."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(name: str = "aridspan", **conf: str) -> SparkSession:
    """A session with UTC times and adaptive execution; conf: further settings, with _ for each dot."""
    builder = (
        SparkSession.builder.appName(name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()
