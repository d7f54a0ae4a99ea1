"""Session settings the library is tuned for; a cluster brings its own session."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cores: str | int = "*", name: str = "strophe", **conf: str) -> SparkSession:
    """A local session for tests and the bench."""
    width = os.cpu_count() if cores == "*" else int(cores)
    settings = {
        "spark.sql.shuffle.partitions": str(width),
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    } | conf
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
