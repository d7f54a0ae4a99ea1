"""Multiclass evaluation as aggregates over ``(label, prediction)`` or class probabilities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .ordered import running_totals
from .unnest import unnest_structs


def _class_table(df: DataFrame, label: str, prediction: str) -> DataFrame:
    both = df.select(F.col(label).alias("class")).union(df.select(F.col(prediction)))
    return both.where("class is not null").distinct()


def confusion_counts(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Filled cells ``(label, prediction, n)``."""
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n"))


def confusion_matrix(df: DataFrame, classes: Sequence[str], label: str = "label",
                     prediction: str = "prediction") -> DataFrame:
    """All cells of the given classes, empty ones as 0."""
    names = F.array(*map(F.lit, classes))
    cells = (df.sparkSession.range(0, 1, 1, 1).select(F.explode(names).alias("label"))
             .select("label", F.explode(names).alias("prediction")))
    return cells.join(confusion_counts(df, label, prediction), ["label", "prediction"], "left").select(
        "label", "prediction", F.coalesce("n", F.lit(0)).alias("n"))


def confusion_wide(df: DataFrame, classes: Sequence[str], label: str = "label",
                   prediction: str = "prediction") -> DataFrame:
    """One row per true class, one column per predicted class."""
    cells = confusion_matrix(df, classes, label, prediction)
    return cells.groupBy("label").pivot("prediction", list(classes)).agg(F.sum("n"))


def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.agg(F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("accuracy"))


def class_scores(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """``(class, precision, recall, f1, support)``; undefined ratios are 0."""
    cells = confusion_counts(df, label, prediction)
    sides = cells.select(F.explode(F.array(
        F.struct(F.col("label").alias("class"), F.col("n").alias("true"), F.lit(0).cast("long").alias("said"),
                 F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).alias("hit")),
        F.struct(F.col("prediction").alias("class"), F.lit(0).cast("long").alias("true"), F.col("n").alias("said"),
                 F.lit(0).cast("long").alias("hit")))).alias("s")).select("s.*").where("class is not null")
    sums = sides.groupBy("class").agg(*[F.sum(c).alias(c) for c in ("true", "said", "hit")])
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    precision, recall = ratio(F.col("hit"), F.col("said")), ratio(F.col("hit"), F.col("true"))
    f1 = ratio(2 * F.col("hit"), F.col("said") + F.col("true"))
    return sums.select("class", precision.alias("precision"), recall.alias("recall"), f1.alias("f1"),
                       F.col("true").alias("support"))


def classification_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """``class_scores`` plus the rows ``macro avg`` and ``weighted avg``, in one pass over ``df``."""
    cols = ("precision", "recall", "f1")
    totals = class_scores(df, label, prediction).rollup("class").agg(
        F.grouping("class").alias("_all"), F.sum("support").alias("support"),
        *[F.avg(c).alias(c) for c in cols],
        *[F.try_divide(F.sum(F.col(c) * F.col("support")), F.sum("support")).alias(f"_{c}") for c in cols])

    def row(name, prefix: str = ""):
        return F.struct(name.cast("string").alias("class"), *[F.col(prefix + c).alias(c) for c in cols], "support")

    averages = F.array(row(F.lit("macro avg")), row(F.lit("weighted avg"), "_"))
    one = F.array(row(F.col("class")))
    return totals.select(F.inline(F.when(F.col("_all") == 1, averages).otherwise(one)))


def class_accuracy(df: DataFrame, classes: Sequence[str], label: str = "label",
                   prediction: str = "prediction") -> DataFrame:
    """Share of hits per true class, 0 for a class without rows."""
    every = df.sparkSession.range(0, 1, 1, 1).select(
        F.explode(F.array(*map(F.lit, classes))).alias("class"))
    hits = df.groupBy(F.col(label).alias("class")).agg(
        F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("accuracy"))
    return every.join(hits, "class", "left").select("class", F.coalesce("accuracy", F.lit(0.0)).alias("accuracy"))


def one_vs_rest(df: DataFrame, label: str, probabilities: Column, classes: Sequence[str]) -> DataFrame:
    """``(class, hit, score)``: each row once per class, with the score of that class."""
    pairs = F.transform(F.array(*map(F.lit, classes)), lambda c, i: F.struct(
        c.alias("class"), (F.col(label) == c).alias("hit"), F.get(probabilities, i).alias("score")))
    return unnest_structs(df, [], pairs, "class")


def _score_steps(scored: DataFrame) -> DataFrame:
    """Running positives and negatives per class by falling score, equal scores as one step."""
    steps = scored.groupBy("class", "score").agg(
        F.count_if("hit").alias("pos"), F.count_if(~F.col("hit")).alias("neg"))
    return running_totals(steps, ["class"], [F.desc("score")], {"tp": F.col("pos"), "fp": F.col("neg")})


def _totals(steps: DataFrame) -> DataFrame:
    return steps.groupBy("class").agg(F.sum("pos").alias("all_pos"), F.sum("neg").alias("all_neg"))


def roc_points(scored: DataFrame) -> DataFrame:
    """``(class, threshold, fpr, tpr)`` from ``(class, hit, score)``; the origin has a null threshold."""
    steps = _score_steps(scored)
    totals = _totals(steps)
    points = steps.join(totals, "class").select(
        "class", F.col("score").alias("threshold"), (F.col("fp") / F.nullif("all_neg", F.lit(0))).alias("fpr"),
        (F.col("tp") / F.nullif("all_pos", F.lit(0))).alias("tpr"))
    origin = totals.select("class", F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"),
                           F.lit(0.0).alias("tpr"))
    return points.unionByName(origin)


def auc_ovr(scored: DataFrame) -> DataFrame:
    """``(class, auc)``: trapezoids under the curve, so a tie counts one half."""
    steps = _score_steps(scored)
    # Products of counts pass the range of a long on a large table, so they are taken in doubles.
    area = F.sum(F.col("neg").cast("double") * (F.col("tp") - F.col("pos") / 2))
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return steps.groupBy("class").agg((area / F.nullif(pairs, F.lit(0.0))).alias("auc"))


def topk_accuracy(df: DataFrame, label_index: str, probabilities: str, k: int = 2) -> DataFrame:
    """Share of rows whose class is among the ``k`` most probable (earlier class first among equals)."""
    probs = F.col(probabilities)
    mine = F.get(probs, F.col(label_index))
    ahead = F.size(F.filter(probs, lambda p, i: (p > mine) | ((p == mine) & (i < F.col(label_index)))))
    return df.agg(F.avg((ahead < k).cast("double")).alias("accuracy"))


def log_loss(df: DataFrame, label_index: str, probabilities: str) -> DataFrame:
    """Mean categorical cross-entropy; probabilities are clipped at 1e-7."""
    p = F.get(F.col(probabilities), F.col(label_index))
    return df.agg(F.avg(-F.log(F.least(F.greatest(p, F.lit(1e-7)), F.lit(1 - 1e-7)))).alias("log_loss"))
