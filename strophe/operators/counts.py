"""Counts, shares, histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.text import format_share


def class_counts(df: DataFrame, label: str, counted: str | None = None) -> DataFrame:
    """Rows per class, largest first; with ``counted`` only rows where it is not null."""
    n = F.count(counted if counted else F.lit(1)).alias("n")
    return df.where(F.col(label).isNotNull()).groupBy(label).agg(n).orderBy(F.desc("n"), label)


def class_share(df: DataFrame, label: str, counted: str | None = None) -> DataFrame:
    """``class_counts`` with the share in percent and a report text."""
    counts = class_counts(df, label, counted)
    percent = F.lit(100.0) * F.col("n") / F.sum("n").over(Window.partitionBy())  # one row per class
    return (counts.withColumn("percent", percent)
            .withColumn("text", format_share(F.col(label).cast("string"), F.col("percent")))
            .orderBy(F.desc("n"), label))


def smallest_class(df: DataFrame, label: str) -> DataFrame:
    return class_counts(df, label).agg(F.min("n").alias("n"))


def flag_counts(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(f)).alias(f"n_{f}") for f in flags])


def right_closed_bin(value: Column, width: float, bins: int) -> Column:
    """0-based bin of edges 0, width, 2*width, ..., infinity, each bin closed on the right."""
    place = F.least(F.ceil(value / width) - 1, F.lit(bins - 1)).cast("int")
    return F.when(value > 0, place)


def histogram(df: DataFrame, col: str, width: float, bins: int) -> DataFrame:
    """Rows per right-closed bin, empty bins included; the last bin is open, values up to 0 are in none."""
    filled = (df.select(right_closed_bin(F.col(col), width, bins).alias("bin")).where("bin is not null")
              .groupBy("bin").agg(F.count(F.lit(1)).alias("n")))
    every = df.sparkSession.range(0, bins, 1, 1).select(F.col("id").cast("int").alias("bin"))
    return every.join(filled, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n")).orderBy("bin")


def max_row(df: DataFrame, id_col: str, value: str) -> DataFrame:
    """The id with the largest value (smallest id among equals)."""
    return df.agg(F.max(F.struct(F.col(value), -F.col(id_col))).alias("m")).select(
        (-F.col("m.col2")).alias(id_col), F.col(f"m.{value}").alias(value))


def row_slice(df: DataFrame, id_col: str, start: int, stop: int) -> DataFrame:
    """Rows of a half-open range of row ids; a range filter reaches the scan, an offset does not."""
    return df.where((F.col(id_col) >= start) & (F.col(id_col) < stop))
