"""Topics: non-negative factorisation V ~ W H of a document-term matrix.

W is never stored.  Given H, each row of W is its own small least-squares problem
with non-negative unknowns, solved inside the task that holds the document; one
pass over the documents yields the sums W'V and W'W (topics x terms and topics x
topics), which are all that H needs.  The vocabulary is capped, so H is small.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.staging import stage

MAX_TERMS = 20_000
_EPS = 1e-12


def _row_weights(v_ht: np.ndarray, hht: np.ndarray, sweeps: int) -> np.ndarray:
    """Cyclic coordinate descent for min ||v - w H||, w >= 0, for a batch of rows at once."""
    w = np.maximum(v_ht / (np.trace(hht) + _EPS), 0.0)
    for _ in range(sweeps):
        moved = 0.0
        for k in range(hht.shape[0]):
            if hht[k, k] <= _EPS:
                w[:, k] = 0.0
                continue
            new = np.maximum(w[:, k] + (v_ht[:, k] - w @ hht[:, k]) / hht[k, k], 0.0)
            moved = max(moved, float(np.max(np.abs(new - w[:, k]), initial=0.0)))
            w[:, k] = new
        if moved < 1e-9:
            break
    return w


def _times(pdf: pd.DataFrame, h: np.ndarray) -> np.ndarray:
    """V H' of a batch of sparse rows."""
    sizes = pdf["idx"].map(len).to_numpy()
    out = np.zeros((len(pdf), h.shape[0]))
    if sizes.sum():
        cols = np.concatenate(pdf["idx"].to_numpy()).astype(int)
        vals = np.concatenate(pdf["val"].to_numpy())
        np.add.at(out, np.repeat(np.arange(len(pdf)), sizes), vals[:, None] * h[:, cols].T)
    return out


@dataclass(frozen=True)
class TopicModel:
    """``terms`` in column order and the topics x terms matrix."""

    terms: tuple[str, ...]
    h: np.ndarray
    losses: tuple[float, ...] = ()
    sweeps: int = 50

    def topics(self, spark) -> DataFrame:
        rows = [(k, t, float(self.h[k, j])) for k in range(self.h.shape[0]) for j, t in enumerate(self.terms)]
        return spark.createDataFrame(rows, "topic int, term string, weight double")

    def save(self, spark: SparkSession, path: str) -> None:
        """One row per term with its column of the matrix."""
        rows = [(j, t, self.h[:, j].tolist()) for j, t in enumerate(self.terms)]
        spark.createDataFrame(rows, "at int, term string, weights array<double>").write.mode("overwrite").parquet(f"{path}/terms")
        spark.createDataFrame([(self.h.shape[0], self.sweeps, list(self.losses))], "topics int, sweeps int, losses array<double>").write.mode(
            "overwrite").parquet(f"{path}/fit")

    @staticmethod
    def load(spark: SparkSession, path: str) -> TopicModel:
        fit = spark.read.parquet(f"{path}/fit").first()
        rows = spark.read.parquet(f"{path}/terms").orderBy("at").collect()  # a vocabulary of at most MAX_TERMS
        h = np.array([r.weights for r in rows], float).reshape(len(rows), fit.topics).T
        return TopicModel(tuple(r.term for r in rows), h, tuple(fit.losses), fit.sweeps)

    def transform(self, weights: DataFrame, docs: DataFrame, doc: str, out: str = "topics") -> DataFrame:
        """``(doc, topics)`` for all ``docs``; documents without known terms get zeros."""
        h, hht, sweeps = self.h, self.h @ self.h.T, self.sweeps
        rows = _sparse_rows(weights, doc, self.terms)
        kind = rows.schema[doc].dataType.simpleString()

        def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                yield pd.DataFrame({doc: pdf[doc], out: list(_row_weights(_times(pdf, h), hht, sweeps))})

        solved = rows.mapInPandas(solve, f"`{doc}` {kind}, `{out}` array<double>")
        zeros = F.array_repeat(F.lit(0.0), h.shape[0])
        return docs.select(doc).join(solved, doc, "left").select(doc, F.coalesce(out, zeros).alias(out))


def _sparse_rows(weights: DataFrame, doc: str, terms: tuple[str, ...]) -> DataFrame:
    """``(doc, idx[], val[])`` over a vocabulary of checked size."""
    if len(terms) > MAX_TERMS:
        raise ValueError(f"cap the vocabulary at {MAX_TERMS} terms")
    index = weights.sparkSession.createDataFrame(list(enumerate(terms)), "idx int, term string")
    placed = weights.join(F.broadcast(index), "term")
    cells = placed.groupBy(doc).agg(F.sort_array(F.collect_list(F.struct("idx", "weight"))).alias("_c"))
    return cells.select(doc, F.col("_c.idx").alias("idx"), F.col("_c.weight").alias("val"))


def nmf_fit(weights: DataFrame, doc: str, k: int = 8, iterations: int = 200, seed: int = 42, tol: float = 1e-4,
            max_terms: int = MAX_TERMS, sweeps: int = 50) -> TopicModel:
    """Alternating least squares with non-negative factors on ``(doc, term, weight)``."""
    found = weights.select("term").distinct().orderBy("term").limit(max_terms + 1).collect()
    if len(found) > max_terms:
        raise ValueError(f"more than {max_terms} terms: cap the vocabulary before the factorisation")
    terms = tuple(r[0] for r in found)
    rows = stage(_sparse_rows(weights, doc, terms).select("idx", "val"))
    m = len(terms)
    norm = rows.agg(F.sum(F.aggregate("val", F.lit(0.0), lambda a, x: a + x * x))).first()[0] or 0.0
    h = np.random.RandomState(seed).rand(k, m) + 0.01
    losses: list[float] = []

    for _ in range(iterations):
        hht = h @ h.T

        def sums(batches: Iterator[pd.DataFrame], h=h, hht=hht) -> Iterator[pd.DataFrame]:
            wtv, wtw = np.zeros((k, m)), np.zeros((k, k))
            for pdf in batches:
                w = _row_weights(_times(pdf, h), hht, sweeps)
                wtw += w.T @ w
                sizes = pdf["idx"].map(len).to_numpy()
                cols = np.concatenate(pdf["idx"].to_numpy()).astype(int)
                vals = np.concatenate(pdf["val"].to_numpy())
                np.add.at(wtv.T, cols, vals[:, None] * np.repeat(w, sizes, axis=0))
            full = np.hstack([wtv, wtw])
            at = np.nonzero(full)
            yield pd.DataFrame({"i": at[0], "j": at[1], "v": full[at]})

        summed = (rows.mapInPandas(sums, "i long, j long, v double")
                  .groupBy("i", "j").agg(F.sum("v").alias("v")).toPandas())  # k x (m + k) numbers at most
        full = np.zeros((k, m + k))
        full[summed["i"], summed["j"]] = summed["v"]
        wtv, wtw = full[:, :m], full[:, m:]
        losses.append(float(norm - 2 * np.sum(wtv * h) + np.sum(wtw * hht)))
        h = _update_topics(h, wtv, wtw)
        if len(losses) > 1 and losses[-2] - losses[-1] <= tol * losses[0]:
            break
    return TopicModel(terms, h, tuple(losses), sweeps)


def _update_topics(h: np.ndarray, wtv: np.ndarray, wtw: np.ndarray) -> np.ndarray:
    h = h.copy()
    for _ in range(5):
        for k in range(h.shape[0]):
            if wtw[k, k] > _EPS:
                h[k] = np.maximum(h[k] + (wtv[k] - wtw[k] @ h) / wtw[k, k], 0.0)
    return h
