"""Running totals and row numbers of groups that may be too large for one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sources.staging import stage


def running_totals(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], totals: Mapping[str, Column],
    slices: int | None = None,
) -> DataFrame:
    """Add inclusive running sums in ``order`` (unique within a group), per ``keys``.

    Rows are range-partitioned by key and order, so a large group spans several
    slices.  Sums run within a slice; what the earlier slices of the group add up
    to is joined on.  Only a group that crosses a slice edge needs such an offset,
    hence that table has fewer rows than there are slices.
    """
    keys, order = list(keys), [F.col(o) if isinstance(o, str) else o for o in order]
    slices = slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    valued = df.withColumns({f"_v_{name}": value for name, value in totals.items()})
    sliced = stage(valued.repartitionByRange(slices, *[F.col(k) for k in keys], *order)
                   .withColumn("_slice", F.spark_partition_id()))

    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sliced.groupBy(*keys, "_slice").agg(*[F.sum(f"_v_{n}").alias(f"_s_{n}") for n in totals])
        .select(F.col("_slice").alias("_at"), *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
                F.count(F.lit(1)).over(before).alias("_earlier"),
                *[F.sum(f"_s_{n}").over(before).alias(f"_o_{n}") for n in totals])
        .where("_earlier > 0").drop("_earlier")
    )
    inside = (Window.partitionBy(*keys, "_slice").orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    summed = sliced.withColumns({f"_r_{n}": F.sum(f"_v_{n}").over(inside) for n in totals})
    same = F.col("_slice") == F.col("_at")
    for i, k in enumerate(keys):
        same &= F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return summed.join(F.broadcast(offsets), same, "left").select(
        *df.columns,
        *[(F.col(f"_r_{n}") + F.coalesce(f"_o_{n}", F.lit(0))).alias(n) for n in totals])


def numbered(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], out: str,
             start: int = 0, slices: int | None = None) -> DataFrame:
    """Row numbers from ``start`` per ``keys`` in ``order``."""
    counted = running_totals(df, keys, order, {out: F.lit(1).cast("long")}, slices)
    return counted.withColumn(out, F.col(out) + (start - 1))


def cumcount(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], out: str = "n") -> DataFrame:
    """0-based position of a row within its group."""
    return numbered(df, keys, order, out)


def with_row_id(df: DataFrame, order: Sequence[Column | str], out: str = "id") -> DataFrame:
    """0-based position of a row in the whole table."""
    return numbered(df, [], order, out)
