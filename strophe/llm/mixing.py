"""Mixing sources to target weights: whole copies of documents by pivotal rounding.

Each source gets a target in words.  A document of a source is wanted
``target / source size`` times; the whole part is certain, the fractional part is a
probability that pivotal rounding turns into 0 or 1.  Two fractional documents are
paired and words are moved from one to the other, in a random direction chosen so that
neither expectation changes, until one of them is whole; the other meets the next
document.  The words a group takes never change by a step, so one fractional document
per group is all that is left over.

Groups hold about ``group`` documents of one source, chosen by a hash of the id.  Their
residuals go up a tree, ``fan`` groups to a node, until one document per source is left;
that one is rounded to the nearer end.  A source's words therefore miss its target by at
most half of one document, and no task sees more than one group, however large a source.

The random numbers are hashes of seed, level and ids: a rerun, or a task that runs again
on another executor, makes the same choices.

Nulls: a null text has size 0 and is taken 0 words; null sources form one source, the
last.  A row with a null id counts like any other.  Rows that repeat an id are rounded
one by one.  An empty table gives an empty mix.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..sources.staging import stage
from .base import WORD, query, table

MASK = (1 << 64) - 1


def source_targets(sizes: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """``(source, source_size, n_docs, target)`` of ``sizes(source, size)``.

    Sources in code point order, null last, weigh ``weights`` in turn and divide ``share``
    of all words.  A target stops at ``most`` times its source's size; what is over goes to
    the others by weight until none is above.  That is the level at which sources, in order
    of size per weight, stop being full, so running sums over one row per source give it.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    at = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    per = per.withColumn("_w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (at % len(weights) + 1).cast("int")))
    per = per.withColumn("_cap", F.col("source_size") * F.lit(float(most)))
    whole = Window.partitionBy()
    before = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    level = ((F.sum("source_size").over(whole) * share - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
             / (F.sum("_w").over(whole) - F.coalesce(F.sum("_w").over(before), F.lit(0.0))))
    per = per.withColumn("_full", F.col("_cap") <= level * F.col("_w"))
    left = (F.sum("source_size").over(whole) * share
            - F.coalesce(F.sum(F.when(F.col("_full"), F.col("_cap"))).over(whole), F.lit(0.0)))
    free = F.sum(F.when(~F.col("_full"), F.col("_w"))).over(whole)
    target = F.when(F.col("_full"), F.col("_cap")).otherwise(left * F.col("_w") / free)
    return per.select("source", "source_size", "n_docs", target.alias("target"))


def _uniform(*parts: int) -> float:
    """A number in [0, 1) that only the arguments decide."""
    x = 0
    for part in parts:
        x = (x ^ (part & MASK)) * 0x9E3779B97F4A7C15 & MASK
        x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & MASK
        x = (x ^ x >> 27) * 0x94D049BB133111EB & MASK
        x ^= x >> 31
    return (x >> 11) / (1 << 53)


def meet(size_a: int, p_a: float, size_b: int, p_b: float, u: float) -> tuple[float, float]:
    """Move words between two fractional documents until one is whole; expectations stay."""
    up = min(size_a * (1 - p_a), size_b * p_b)
    down = min(size_a * p_a, size_b * (1 - p_b))
    if u * (up + down) < down:
        return (1.0, p_b - up / size_b) if size_a * (1 - p_a) <= size_b * p_b else (p_a + up / size_a, 0.0)
    return (0.0, p_b + down / size_b) if size_a * p_a <= size_b * (1 - p_b) else (p_a - down / size_a, 1.0)


@dataclass(frozen=True)
class Mix:
    """Parameters of a mix; see the functions above."""

    weights: tuple[float, ...] = (3, 1, 2)
    share: float = 1.5
    most: float = 2.0
    group: int = 4096
    fan: int = 64
    seed: int = 1

    def rounded(self, docs: DataFrame, level: int) -> DataFrame:
        """One level of the tree: within each ``(source, node)`` at most one document stays fractional."""
        seed = self.seed

        def walk(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            carry = None  # the fractional row of the group that the last frame broke off in
            for frame in frames:
                frame = frame if carry is None else pd.concat([carry, frame])
                frame = frame.reset_index(drop=True)
                group = frame.groupby(["source", "node"], dropna=False, sort=False).ngroup().to_numpy()
                size, p = frame["size"].to_numpy(), frame["p"].to_numpy().copy()
                ids, held = frame["id"].fillna(-1).astype("int64").to_numpy(), -1
                for i in np.flatnonzero((p > 0) & (p < 1)):
                    if held < 0 or group[held] != group[i]:
                        held = i
                        continue
                    u = _uniform(seed, level, int(ids[held]), int(ids[i]))
                    p[held], p[i] = meet(size[held], p[held], size[i], p[i], u)
                    held = i if 0 < p[i] < 1 else held if 0 < p[held] < 1 else -1
                frame["p"] = p
                carry = frame.iloc[[held]] if held >= 0 else None
                yield frame if held < 0 else frame.drop(index=held)
            if carry is not None:
                yield carry

        dealt = docs.repartition("source", "node").sortWithinPartitions("source", "node", F.desc("size"), "id")
        return dealt.mapInPandas(walk, docs.schema)

    def copies(self, docs: DataFrame, id_col: str = "doc_id", size: Column | None = None, source_col: str = "source",
               text_col: str = "text", row: Column | None = None) -> DataFrame:
        """``(id, row, source, size, source_size, target, copies)``: how often each row of ``docs`` is taken.

        The size of a row defaults to the number of words of its text.
        """
        size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)) if size is None else size
        sizes = stage(docs.select(F.col(id_col).cast("long").alias("id"), (F.lit(1) if row is None else row).cast("int").alias("row"),
                                  F.col(source_col).alias("source"), size.cast("long").alias("size")))
        targets = stage(source_targets(sizes, self.weights, self.share, self.most))
        wanted = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
        nodes = F.ceil(F.col("n_docs") / self.group)
        planned = (sizes.withColumnRenamed("source", "_s").join(targets, F.col("_s").eqNullSafe(F.col("source"))).drop("_s")
                   .withColumn("whole", F.floor(wanted)).withColumn("p", F.when(F.col("size") > 0, wanted - F.col("whole")).otherwise(0.0))
                   .withColumn("node", F.pmod(F.xxhash64(F.lit(self.seed), "id", "row"), nodes))
                   .drop("n_docs"))
        levels, widest = 1, (targets.agg(F.max("n_docs")).first()[0] or 1) / self.group
        while widest > 1:
            levels, widest = levels + 1, widest / self.fan
        done = []
        for level in range(levels):
            planned = stage(self.rounded(planned, level))
            done.append(planned.where("p = 0 or p = 1"))
            planned = planned.where("p > 0 and p < 1").withColumn("node", F.floor(F.col("node") / self.fan))
        done.append(planned.withColumn("p", F.round("p")))
        everything = done[0]
        for part in done[1:]:
            everything = everything.unionByName(part)
        return everything.select("id", "row", "source", "size", "source_size", "target",
                                 (F.col("whole") + F.col("p")).cast("int").alias("copies"))


def mixed(docs: DataFrame, mix: Mix, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``docs`` with each row as often as the mix takes it."""
    rows = docs.select(F.struct("*").alias("_row"), F.col(id_col).alias("_doc"), F.col(source_col).alias("_source"),
                       F.col(text_col).alias("_text"))
    same = Window.partitionBy("_doc").orderBy("_source", F.xxhash64("_text"))
    rows = rows.withColumn("_number", F.row_number().over(same))
    taken = mix.copies(rows, "_doc", source_col="_source", text_col="_text", row=F.col("_number")).where("copies > 0")
    met = rows.join(taken, F.col("_doc").cast("long").eqNullSafe(F.col("id")) & (F.col("_number") == F.col("row")))
    return met.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("_row.*")


@query()
def op9_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    mix = Mix().copies(table(spark, folder, "documents"))
    return mix.select(F.col("id").alias("doc_id"), "size", "source_size", "target",
                      (F.col("copies") * F.col("size")).alias("taken"))
