"""The training curve of a forest from a single fit.

A forest's prediction is the class with the largest sum of its trees' class shares, so the first
n trees are a forest too.  Each row keeps the running sum of its trees' shares and notes the
prediction after every tree; accuracies of all sizes are then one aggregate.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.arrays import argmax_vector, bind
from ..wordlists import EMOTIONS
from .features import unnamed
from .models import INDEX, with_index


def running_votes(shares: Column, classes: int) -> Column:
    """The 0-based class ahead after each of an array of class shares (the earlier one among equals)."""
    start = F.struct(F.array_repeat(F.lit(0.0), classes).alias("sum"), F.array().cast("array<int>").alias("ahead"))

    def add(acc: Column, share: Column) -> Column:
        return bind(F.zip_with(acc["sum"], share, lambda a, b: a + b), lambda s: F.struct(
            s.alias("sum"), F.concat(acc["ahead"], F.array(argmax_vector(s))).alias("ahead")))

    return F.aggregate(shares, start, add)["ahead"]


def prefix_predictions(model: PipelineModel, df: DataFrame, keep: Sequence[str], trees: int | None = None, out: str = "ahead") -> DataFrame:
    """``keep`` and the class ahead after each of the first ``trees`` trees of a fitted forest, in one pass over ``df``."""
    at = next(i for i, stage in enumerate(model.stages) if hasattr(stage, "trees"))
    forest = model.stages[at]
    scored = PipelineModel(model.stages[:at]).transform(df).select(*keep, unnamed(forest.getFeaturesCol()))
    names = []
    for i, tree in enumerate(forest.trees[:trees]):
        names.append(f"_share_{i}")
        tree = tree.setFeaturesCol(forest.getFeaturesCol()).setRawPredictionCol("").setPredictionCol("").setProbabilityCol(names[-1])
        scored = tree.transform(scored)
    shares = F.array(*[vector_to_array(n) for n in names])
    return scored.select(*keep, running_votes(shares, forest.numClasses).alias(out))


def forest_curve(model: PipelineModel, parts: Mapping[str, DataFrame], steps: Sequence[int], label: str = "label",
                 classes: Sequence[str] = EMOTIONS) -> DataFrame:
    """``(round, <part>_rows, <part>_accuracy, ...)`` for forests of the first ``steps`` trees of one fit."""
    whole = None
    for name, part in parts.items():
        rows = prefix_predictions(model, with_index(part, label, classes), [INDEX], max(steps)).withColumn("part", F.lit(name))
        whole = rows if whole is None else whole.unionByName(rows)
    wanted = F.array(*[F.struct(F.lit(n).alias("round"), (F.get("ahead", F.lit(n - 1)) == F.col(INDEX)).cast("double").alias("hit"))
                       for n in steps])
    points = whole.where(F.col(INDEX).isNotNull()).select("part", F.inline(wanted))
    return points.groupBy("round").agg(*[
        c for name in parts for c in (F.count_if(F.col("part") == name).alias(f"{name}_rows"),
                                      F.avg(F.when(F.col("part") == name, F.col("hit"))).alias(f"{name}_accuracy"))])
