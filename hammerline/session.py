"""Session defaults: UTC, ANSI arithmetic, adaptive execution."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, name: str = "hammerline", **conf: str) -> SparkSession:
    """A session with the defaults; keyword names have dots as double underscores."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    settings = DEFAULTS | {k.replace("__", "."): v for k, v in conf.items()}
    return builder.config(map=settings).getOrCreate()
