"""A session with the settings the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(app: str = "fathom", master: str | None = None, **conf: str) -> SparkSession:
    """Adaptive execution with skew handling, UTC, and a cluster's own settings for everything else."""
    build = SparkSession.builder.appName(app)
    if master:
        build = build.master(master)
    own = {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true", "spark.sql.execution.arrow.pyspark.enabled": "true"}
    for k, v in {**own, **conf}.items():
        build = build.config(k, v)
    return build.getOrCreate()
