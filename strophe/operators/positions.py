"""Heads, tails and slices by position, for tables that no task could sort as a whole.

The rows are filed once in slices of their order, a folder for each; a table of one row per
slice says how many rows stand before it.  A range of positions then reads only the folders
it touches, keeps the ones inside it as they are and sorts no more than the two at its ends.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sources.staging import stage

ROWS_PER_SLICE = 1_000_000


@dataclass(frozen=True)
class Positions:
    """A filed table.  ``order`` should tell rows apart: equal ones stand in any order, in one slice.

    Nulls come where ``order`` puts them (first, unless a column says otherwise).  Ranges are read as
    in Python: the end is left out, negative places count from the end, places outside are cut.
    """

    filed: DataFrame
    before: DataFrame
    total: int
    order: tuple[Column, ...]
    slice_col: str

    @staticmethod
    def of(df: DataFrame, order: Sequence[Column | str], slices: int | None = None) -> Positions:
        """File ``df``, which is read three times (count, bounds, rows): stage it first if it is costly."""
        order = tuple(F.col(o) if isinstance(o, str) else o for o in order)
        name, taken = "_slice", {c.lower() for c in df.columns}
        while name in taken:
            name += "_"
        if slices is None:
            slices = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // ROWS_PER_SLICE))
        filed = stage(df.repartitionByRange(slices, *order).withColumn(name, F.spark_partition_id()), by=[name])
        sizes = filed.groupBy(name).agg(F.count(F.lit(1)).alias("n"))
        upto = F.sum("n").over(Window.orderBy(name))  # one row per slice
        before = stage(sizes.select(name, "n", (upto - F.col("n")).alias("before")))
        return Positions(filed, before, before.agg(F.sum("n")).first()[0] or 0, order, name)

    def between(self, start: int | None = None, stop: int | None = None, out: str | None = None) -> DataFrame:
        """Rows of the places from ``start`` up to ``stop``, in no set order; ``out`` names a column for the 0-based place."""
        columns = [c for c in self.filed.columns if c != self.slice_col]
        if out is not None and out.lower() in (c.lower() for c in columns):
            raise ValueError(f"the table has a column {out} already")
        first, end, _ = slice(start, stop).indices(self.total)
        own = F.col(self.slice_col)
        touched = self.before.where((F.col("before") < end) & (F.col("before") + F.col("n") > first)) if first < end else self.before.where("false")
        low, high = touched.agg(F.min(self.slice_col), F.max(self.slice_col)).first()
        if low is None:
            none = self.filed.where("false").select(*columns)
            return none if out is None else none.withColumn(out, F.lit(None).cast("long"))
        inside = Window.partitionBy(self.slice_col).orderBy(*self.order)
        # A folder that is wholly inside needs no places if none are asked for.
        sorted_ = own.between(low, high) if out is not None else own.isin(low, high)
        ranked = self.filed.where(sorted_).withColumn("_place_in_slice", F.row_number().over(inside).cast("long"))
        starts = touched.select(F.col(self.slice_col).alias("_at_slice"), F.col("before").alias("_rows_before"))
        placed = ranked.join(F.broadcast(starts), own == F.col("_at_slice"))  # a row per million rows
        place = F.col("_rows_before") + F.col("_place_in_slice") - 1
        kept = placed.where((place >= first) & (place < end))
        if out is not None:
            return kept.select(*columns, place.alias(out))
        whole = self.filed.where((own > low) & (own < high))
        return kept.select(*columns).unionByName(whole.select(*columns))

    def head(self, n: int, out: str | None = None) -> DataFrame:
        return self.between(0, max(n, 0), out)

    def tail(self, n: int, out: str | None = None) -> DataFrame:
        return self.between(max(self.total - max(n, 0), 0), None, out)
