"""Connected components of a link table, by repeated star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..sources.staging import stage


def components(links: DataFrame) -> DataFrame:
    """``(id, root)`` of every id in ``links(a, b)``; the root is the smallest id that can be reached.

    Large-star and small-star steps alternate: the neighbours of an id are hung onto
    the smallest of them.  Links stay in Spark; the driver sees one count and one
    checksum per round.  Groups are only ever reduced to a minimum, so a component
    that holds most ids needs no task of its own.
    """
    edges = stage(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    seen = None
    while True:
        mark = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("root")).union(
                edges.select(F.col("v").alias("id"), F.col("v").alias("root"))).distinct()
        seen = mark
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(lowest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stage(small.union(lowest.select("u", F.col("m").alias("v"))).distinct())
