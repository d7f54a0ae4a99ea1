"""Joins against lookup tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..sources.staging import stage

BROADCAST_BYTES = 64 << 20
SALTS = 32
HOT_ROWS = 4096  # a key with fewer facts is not worth dividing


def lookup_join(
    facts: DataFrame, table: DataFrame, on: Sequence[str], how: str = "inner",
    broadcast_bytes: int = BROADCAST_BYTES, salts: int = SALTS,
) -> DataFrame:
    """Join many rows to a narrow table with unique keys.

    The table's bytes are added up, so pass a staged one.  Up to ``broadcast_bytes`` it is
    broadcast.  Beyond that the join shuffles, and each hot key is spread over
    ``salts`` tasks: a fact row goes to one of them, the table row to all, so a
    key that holds a third of the facts is still divided.  Other keys, most of a
    table, are sent once.
    """
    on = list(on)
    if data_bytes(table) <= broadcast_bytes:
        return facts.join(F.broadcast(table), on, how)
    return salted_join(facts, table, on, how, salts)


def data_bytes(df: DataFrame) -> int:
    """Bytes of the values of ``df``: 8 for a number, the length of texts and of other values as text."""
    size = F.lit(0)
    for f in df.schema:
        if f.dataType.typeName() in ("string", "binary"):
            size += F.coalesce(F.octet_length(f.name), F.lit(0))
        elif f.dataType.typeName() in ("array", "map", "struct"):
            size += F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f.name)))), F.lit(0))
        else:
            size += F.lit(8)
    return df.agg(F.sum(size.cast("long"))).first()[0] or 0


def hot_keys(facts: DataFrame, on: Sequence[str], salts: int = SALTS) -> DataFrame:
    """The keys with more facts than the ``salts``-th part of an even task, staged; fewer than ``salts`` for each task of a shuffle."""
    tasks = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = stage(facts.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > HOT_ROWS))
    total = F.col("_n") > F.lit((facts.count() if not counts.isEmpty() else 0) // (tasks * salts))
    return stage(counts.where(total).select(*on, F.lit(True).alias("_hot")))


def salted_join(facts: DataFrame, table: DataFrame, on: Sequence[str], how: str = "inner",
                salts: int = SALTS) -> DataFrame:
    """Rows without a key find nothing, so they are spread as well."""
    hot = F.broadcast(hot_keys(facts, on, salts))
    spread = F.col("_hot")
    for key in on:
        spread = spread | F.col(key).isNull()
    # Derived from the row and its partition, so a repeated task salts alike.
    salt = F.pmod(F.xxhash64(F.spark_partition_id(), *hashable(facts)), F.lit(salts)).cast("int")
    salted = facts.join(hot, on, "left").withColumn("_salt", F.when(spread, salt).otherwise(0)).drop("_hot")
    return salted.join(_copies(table, hot, on, salts), [*on, "_salt"], how).drop("_salt")


def _copies(table: DataFrame, hot: DataFrame, on: Sequence[str], salts: int) -> DataFrame:
    """A row for each salt of a hot key, one row of any other."""
    every = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    return table.join(hot, on, "left").withColumn("_salt", F.explode(every)).drop("_hot")


def hashable(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if "map<" not in f.dataType.simpleString()]
