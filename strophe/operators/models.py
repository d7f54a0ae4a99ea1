"""Training, tuning, saving and applying classifiers of string labels."""

from __future__ import annotations

import random
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from itertools import combinations

from pyspark.ml import Model, PipelineModel
from pyspark.ml.classification import (
    LinearSVC, LinearSVCModel, MultilayerPerceptronClassifier, OneVsRest, RandomForestClassifier,
)
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.arrays import argmax_vector
from ..sources.staging import stage
from ..wordlists import EMOTIONS
from .features import FeatureSpec, fit_features, helper_columns, unnamed
from .forests import fit_sparse_forest
from .metrics import accuracy
from .rows import decode_label, encode_label, union_tables
from .sampling import kfold

INDEX = "_label_index"
TASK_BYTES = 128 << 20
MAX_TREE_DEPTH = 30  # the deepest tree of the library; ``None`` asks for it


def random_forest(trees: int = 100, depth: int | None = None, min_leaf: int = 1, bootstrap: bool = True,
                  impurity: str = "gini", max_features: str = "sqrt", weight: str | None = None,
                  seed: int = 42) -> RandomForestClassifier:
    if depth is not None and depth > MAX_TREE_DEPTH:
        raise ValueError(f"trees can have at most {MAX_TREE_DEPTH} levels, not {depth}")
    forest = RandomForestClassifier(
        featuresCol="features", labelCol=INDEX, numTrees=trees,
        maxDepth=depth or MAX_TREE_DEPTH, minInstancesPerNode=min_leaf, bootstrap=bootstrap,
        impurity=impurity, featureSubsetStrategy=max_features, seed=seed)
    return forest.setWeightCol(weight) if weight else forest


def linear_svm(c: float, n: int, tol: float = 0.1, max_iter: int = 100, weight: str | None = None) -> LinearSVC:
    """A linear SVM whose cost ``c`` per row is turned into Spark's penalty ``1 / (c * n)``."""
    svm = LinearSVC(featuresCol="features", labelCol=INDEX, regParam=1.0 / (c * max(n, 1)), tol=tol, maxIter=max_iter)
    return svm.setWeightCol(weight) if weight else svm


def svm_one_vs_rest(c: float, n: int, parallelism: int = 4, weight: str | None = None, **options) -> OneVsRest:
    many = OneVsRest(featuresCol="features", labelCol=INDEX, classifier=linear_svm(c, n, **options), parallelism=parallelism)
    return many.setWeightCol(weight) if weight else many


def perceptron(inputs: int, classes: int = len(EMOTIONS), hidden: Sequence[int] = (32, 32), max_iter: int = 100,
               seed: int = 42) -> MultilayerPerceptronClassifier:
    """Dense layers over assembled features with a softmax output."""
    return MultilayerPerceptronClassifier(
        featuresCol="features", labelCol=INDEX, layers=[inputs, *hidden, classes], maxIter=max_iter, seed=seed)


def with_index(df: DataFrame, label: str = "label", classes: Sequence[str] = EMOTIONS) -> DataFrame:
    return df.withColumn(INDEX, encode_label(F.col(label), classes).cast("double"))


def _decoder(classes: Sequence[str]) -> SQLTransformer:
    """Name the predicted index and keep probabilities (or scores) as an array."""
    names = ", ".join("'" + c.replace("'", "\\'") + "'" for c in classes)
    return SQLTransformer(
        statement=f"SELECT *, element_at(array({names}), CAST(prediction AS INT) + 1) AS predicted FROM __THIS__")


Trainer = Callable[[DataFrame], object]


def fit_classifier(train: DataFrame, make: Trainer, spec: FeatureSpec = FeatureSpec(), label: str = "label",
                   classes: Sequence[str] = EMOTIONS) -> PipelineModel:
    """Features and classifier fitted on ``train``; ``make(assembled)`` builds the estimator.

    The result adds ``prediction`` (index) and ``predicted`` (label) to any table
    with the feature columns, and is saved and loaded as one model.
    """
    train = with_index(train, label, classes).where(F.col(INDEX).isNotNull())
    features = fit_features(train, spec)
    ready = stage(features.transform(train).select(
        unnamed(spec.out), INDEX, *[c for c in train.columns if c == "weight"]))
    learner = make(ready)
    return PipelineModel([*features.stages, fitted(learner, ready), _decoder(classes)])


def fitted(learner, ready: DataFrame) -> Model:
    """``learner`` over staged rows; forests are grown over sparse rows."""
    return fit_sparse_forest(ready, learner) if isinstance(learner, RandomForestClassifier) else learner.fit(ready)


def dealt(ready: DataFrame, vector: str = "features", task_bytes: int = TASK_BYTES) -> DataFrame:
    """Staged rows in tasks of at most about ``task_bytes`` as the tree learner holds them, with four bytes for every feature.

    A sparse row takes a few hundred bytes in a file and many kilobytes there, so tasks of a file's size are too large.
    """
    first = ready.select(vector).first()
    tasks = 0 if first is None else -(-ready.count() * len(first[0]) * 4 // task_bytes)
    return ready.repartition(tasks) if tasks > ready.rdd.getNumPartitions() else ready


def predict(model: Model, df: DataFrame, keep: Sequence[str] | None = None) -> DataFrame:
    """``df`` with ``predicted`` and, where the model has them, ``probabilities``."""
    scored = model.transform(df)
    if "probability" in scored.columns:
        scored = scored.withColumn("probabilities", vector_to_array("probability"))
    wanted = list(keep if keep is not None else df.columns) + [
        c for c in ("predicted", "probabilities") if c in scored.columns]
    return scored.select(*wanted)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


# One-vs-one -----------------------------------------------------------------------------------------------------

class PairwiseSVM:
    """A linear SVM per pair of classes; most votes win, summed margins break ties."""

    def __init__(self, features: PipelineModel, pairs: Mapping[tuple[int, int], LinearSVCModel],
                 classes: Sequence[str]):
        self.features, self.pairs, self.classes = features, dict(pairs), list(classes)

    def save(self, path: str) -> None:
        """Features, one model per pair, and the classes, below ``path``."""
        self.features.write().overwrite().save(f"{path}/features")
        for (a, b), model in self.pairs.items():
            model.write().overwrite().save(f"{path}/pair-{a}-{b}")
        spark = SparkSession.active()
        spark.createDataFrame([(self.classes, [list(p) for p in self.pairs])], "classes array<string>, pairs array<array<int>>").write.mode(
            "overwrite").parquet(f"{path}/classes")

    @staticmethod
    def load(path: str) -> PairwiseSVM:
        row = SparkSession.active().read.parquet(f"{path}/classes").first()
        pairs = {(a, b): LinearSVCModel.load(f"{path}/pair-{a}-{b}") for a, b in row.pairs}
        return PairwiseSVM(PipelineModel.load(f"{path}/features"), pairs, list(row.classes))

    def transform(self, df: DataFrame) -> DataFrame:
        scored = self.features.transform(df)
        margins = []
        for (a, b), model in self.pairs.items():
            margin = f"_margin_{a}_{b}"
            scored = (model.setRawPredictionCol("_raw").setPredictionCol("_side").transform(scored)
                      .withColumn(margin, F.get(vector_to_array("_raw"), F.lit(1))).drop("_raw", "_side"))
            margins.append((a, b, F.col(margin)))
        scores = []
        for k in range(len(self.classes)):
            votes, trust = F.lit(0.0), F.lit(0.0)
            for a, b, margin in margins:
                if k in (a, b):
                    wins = margin > 0 if k == b else margin <= 0
                    votes += wins.cast("double")
                    trust += margin if k == b else -margin
            scores.append(votes + trust / (3 * (F.abs(trust) + 1)))
        best = argmax_vector(F.col("decision"))
        scored = scored.withColumn("decision", F.array(*scores)).withColumn("predicted", decode_label(best, self.classes))
        return scored.drop(*helper_columns(scored), "features")


def fit_one_vs_one(train: DataFrame, c: float = 0.9, tol: float = 0.1, max_iter: int = 100,
                   spec: FeatureSpec = FeatureSpec(), label: str = "label",
                   classes: Sequence[str] = EMOTIONS, parallelism: int = 4) -> PairwiseSVM:
    """One fit per pair of classes that occur, ``parallelism`` of them at a time."""
    train = with_index(train, label, classes).where(F.col(INDEX).isNotNull())
    features = fit_features(train, spec)
    ready = stage(features.transform(train).select(unnamed(spec.out), INDEX))
    sizes = {int(r[0]): r[1] for r in ready.groupBy(INDEX).count().collect()}  # one row per class

    def fit(pair: tuple[int, int]) -> LinearSVCModel:
        a, b = pair
        two = ready.where(F.col(INDEX).isin(a, b)).withColumn(INDEX, (F.col(INDEX) == b).cast("double"))
        return linear_svm(c, sizes[a] + sizes[b], tol=tol, max_iter=max_iter).fit(two)

    pairs = list(combinations(sorted(sizes), 2))
    with ThreadPoolExecutor(parallelism) as pool:  # waits on Spark jobs, as CrossValidator does
        return PairwiseSVM(features, dict(zip(pairs, pool.map(fit, pairs))), classes)


# Random search --------------------------------------------------------------------------------------------------

def draw_parameters(grid: Mapping[str, Sequence], n: int, seed: int = 42) -> list[dict]:
    """``n`` distinct draws from the grid (all points if it has fewer), repeatable."""
    names = sorted(grid)
    total = 1
    for name in names:
        total *= len(grid[name])
    picks = random.Random(seed).sample(range(total), min(n, total))
    draws = []
    for at in picks:
        point = {}
        for name in names:
            at, i = divmod(at, len(grid[name]))
            point[name] = grid[name][i]
        draws.append(point)
    return draws


def random_search(train: DataFrame, fit: Callable[[DataFrame, dict], Model], grid: Mapping[str, Sequence],
                  n_iter: int = 20, k: int = 5, id_col: str = "id", label: str = "label", seed: int = 42
                  ) -> tuple[dict, DataFrame]:
    """Mean held-out accuracy over stratified folds for random grid points.

    ``fit(train, params)`` fits features and classifier, so nothing leaks from the
    held-out fold.  Returns the best parameters and a table of all draws.
    """
    folded = stage(kfold(train, k, label, id_col, seed))
    results = []
    for params in draw_parameters(grid, n_iter, seed):
        scores = []
        for fold in range(k):
            model = fit(folded.where(F.col("fold") != fold), params)
            held = predict(model, folded.where(F.col("fold") == fold), keep=[label])
            scores.append(accuracy(held, label, "predicted").first()[0])
        results.append((params, sum(scores) / k))
    best = max(results, key=lambda r: r[1])
    table = train.sparkSession.createDataFrame(
        [({p: str(v) for p, v in params.items()}, score) for params, score in results],
        "params map<string,string>, accuracy double")
    return best[0], table


# Self-training --------------------------------------------------------------------------------------------------

def self_train(labelled: DataFrame, unlabelled: DataFrame, fit: Callable[[DataFrame], Model],
               label: str = "label") -> Model:
    """Fit, label the unlabelled rows with the prediction, refit features and model on both.

    Each fit starts from fresh weights.
    """
    first = fit(labelled)
    cols = [c for c in labelled.columns if c != label]
    pseudo = predict(first, unlabelled.select(*cols), keep=cols).select(*cols, F.col("predicted").alias(label))
    return fit(stage(union_tables([labelled.select(*cols, label), pseudo])))


def training_curve(train: DataFrame, val: DataFrame, steps: Sequence[int], fit: Callable[[DataFrame, int], Model],
                   label: str = "label") -> DataFrame:
    """Accuracy on training and validation rows after each number of training rounds."""
    points = []
    for n in steps:
        model = fit(train, n)
        points.append((n, *[accuracy(predict(model, part, [label]), label, "predicted").first()[0]
                            for part in (train, val)]))
    return train.sparkSession.createDataFrame(points, "round int, train_accuracy double, val_accuracy double")

