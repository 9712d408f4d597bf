"""Spark session settings the library relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Windows, dates and hours are defined in UTC, whatever the host says.
TIME_ZONE = "UTC"


def build_session(app_name: str = "floorline", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and the UTC clock.

    ``conf`` entries use ``__`` for dots, e.g. ``spark__sql__shuffle__partitions="64"``.
    Without ``master`` the one given to ``spark-submit`` is used.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": TIME_ZONE,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Recording the call site of every column expression dominates plan building.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **{key.replace("__", "."): value for key, value in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_clock(spark: SparkSession) -> SparkSession:
    """Set the UTC clock on a session somebody else built."""
    spark.conf.set("spark.sql.session.timeZone", TIME_ZONE)
    return spark
