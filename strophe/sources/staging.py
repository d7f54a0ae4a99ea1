"""Intermediate tables in the folder the cluster shares.

A staged table cuts lineage, survives lost executors and has an exactly known
row count, so later joins can check a size instead of guessing it.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; only a local session gets a temporary one."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="strophe-")
        context.setCheckpointDir(folder)
    return folder


def stage(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder, a folder for each value of ``by``, and read it back."""
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/strophe/{uuid.uuid4().hex}"
    (df.write.partitionBy(*by) if by else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Deal rows out when a table is read in fewer tasks than the session has cores.

    Tasks read up to ``spark.sql.files.maxPartitionBytes``, so what is shuffled here is
    at most that much per core, and a table with more bytes is left as it is.
    """
    width = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(width) if df.rdd.getNumPartitions() < width else df
