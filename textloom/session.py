"""Session defaults."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app: str = "textloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; conf names use underscores for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true"}
    settings |= {k.replace("_", "."): v for k, v in conf.items()}
    return builder.config(map=settings).getOrCreate()
