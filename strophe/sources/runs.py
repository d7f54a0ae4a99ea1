"""A table of training runs: one appended row per run."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

RUNS = "name string, started timestamp, params map<string,string>, metrics map<string,double>"


def log_run(spark: SparkSession, path: str, name: str, params: Mapping, metrics: Mapping) -> None:
    row = (name, datetime.now(timezone.utc), {k: str(v) for k, v in params.items()},
           {k: float(v) for k, v in metrics.items()})
    spark.createDataFrame([row], RUNS).coalesce(1).write.mode("append").parquet(path)


def run_summary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUNS).parquet(path).orderBy("started", "name")
