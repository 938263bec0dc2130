"""Session settings."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def session(app: str = "chronoloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; on a cluster the master comes from spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master or "spark.master" not in os.environ.get("PYSPARK_SUBMIT_ARGS", ""):
        builder = builder.master(master or "local[*]")
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    for k, v in settings.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
