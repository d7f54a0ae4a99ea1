"""Random search on a store of prepared folds.

What depends on a fold and on how texts become features is fitted once, applied to all rows and
staged; every draw that shares these settings reads the same table.  Draws run at the same time,
each in a scheduler pool of its own, and the accuracies of all folds of a draw are one aggregate.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import Future, ThreadPoolExecutor
from threading import Lock

from pyspark.sql import DataFrame, functions as F

from ..sources.staging import stage
from ..wordlists import EMOTIONS
from .features import FeatureSpec, fit_features, unnamed
from .models import INDEX, draw_parameters, fitted, with_index
from .sampling import Key, class_weights, kfold

WEIGHT = "weight"


class FoldStore:
    """Tables ``(features, label index, weight, held)`` by fold and features, made when first asked for."""

    def __init__(self, train: DataFrame, k: int, spec: Callable[[dict], FeatureSpec], label: str = "label",
                 classes: Sequence[str] = EMOTIONS, id_col: Key = "id", seed: int = 42):
        indexed = with_index(train, label, classes).where(F.col(INDEX).isNotNull())
        self.rows = stage(kfold(indexed, k, label, id_col, seed))
        self.k, self.spec, self.label = k, spec, label
        self.tables: dict[tuple, Future] = {}
        self.lock = Lock()

    def table(self, shape: Mapping, fold: int) -> DataFrame:
        key = (fold, *sorted((k, str(v)) for k, v in shape.items()))
        with self.lock:
            mine = key not in self.tables
            if mine:
                self.tables[key] = Future()
        slot = self.tables[key]
        if mine:
            try:
                slot.set_result(self._made(dict(shape), fold))
            except BaseException as error:
                slot.set_exception(error)
        return slot.result()

    def _made(self, shape: dict, fold: int) -> DataFrame:
        train = self.rows.where(F.col("fold") != fold)
        spec = self.spec(shape)
        features = fit_features(train, spec)
        weights = class_weights(train, self.label).select(self.label, F.col("weight").alias(WEIGHT))  # one row per class
        rows = features.transform(self.rows).select(unnamed(spec.out), INDEX, self.label, (F.col("fold") == fold).alias("held"))
        return stage(rows.join(F.broadcast(weights), self.label, "left").drop(self.label))


def search(train: DataFrame, spec: Callable[[dict], FeatureSpec], make: Callable[[dict, int], object], grid: Mapping[str, Sequence],
           shape: Sequence[str] = ("max_features", "ngram"), n_iter: int = 20, k: int = 5, label: str = "label",
           classes: Sequence[str] = EMOTIONS, id_col: Key = "id", seed: int = 42, parallelism: int = 4,
           tasks: int | None = None) -> tuple[dict, DataFrame]:
    """The best of ``n_iter`` random grid points by mean accuracy over ``k`` folds, and ``(draw, params, accuracy, folds)`` of all.

    ``spec(shape)`` describes features by the grid's ``shape`` names; ``make(params, rows)`` builds
    an estimator from the others.  ``tasks`` is the number of tasks of a training pass, for tables known to be small.
    """
    store = FoldStore(train, k, spec, label, classes, id_col, seed)
    draws = draw_parameters(grid, n_iter, seed)
    context = train.sparkSession.sparkContext

    def score(job: tuple[int, dict]) -> list[tuple]:
        number, params = job
        context.setLocalProperty("spark.scheduler.pool", f"draw-{number}")
        of_text = {p: v for p, v in params.items() if p in shape}
        rest = {p: v for p, v in params.items() if p not in shape}
        every = None
        for fold in range(k):
            ready = store.table(of_text, fold)
            part = ready.where("not held").drop("held")
            part = part if tasks is None else part.coalesce(tasks)
            model = fitted(make(rest, part.count()), part)
            hits = model.transform(ready.where("held")).select(F.lit(fold).alias("fold"), (F.col("prediction") == F.col(INDEX)).alias("hit"))
            every = hits if every is None else every.union(hits)
        return every.groupBy("fold").agg(F.avg(F.col("hit").cast("double"))).collect()  # k rows

    with ThreadPoolExecutor(parallelism) as pool:  # waits on Spark jobs, as CrossValidator does
        scores = list(pool.map(score, enumerate(draws)))
    results = [(i, {p: str(v) for p, v in params.items()}, sum(s for _, s in found) / len(found), len(found))
               for i, (params, found) in enumerate(zip(draws, scores))]
    best = max(results, key=lambda r: (r[2], -r[0]))[0]
    return draws[best], train.sparkSession.createDataFrame(results, "draw int, params map<string,string>, accuracy double, folds int")
