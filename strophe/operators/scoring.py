"""Labelling sections: by a word lexicon or by a plugged-in batch scorer."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.arrays import argmax_vector
from ..wordlists import EMOTIONS
from ..sources.staging import stage
from .dictionary import dictionary
from .joins import BROADCAST_BYTES, lookup_join
from .terms import postings


def lexicon_scores(df: DataFrame, keys: Sequence[str], tokens: str | Column, lexicon: DataFrame,
                   labels: Sequence[str] = EMOTIONS, out: str = "scores", broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Add ``scores``: per label the summed lexicon weight of a text's tokens.

    ``lexicon(term, label, weight)`` is folded to one row per term first.  A lexicon of checked
    size is looked up inside the row; a larger one is joined, which adds no rows, and sums are
    combined per text before the shuffle.
    """
    names = [f"_w{i}" for i in range(len(labels))]
    wide = lexicon.groupBy("term").agg(*[
        F.sum(F.when(F.col("label") == label, F.col("weight"))).alias(n) for label, n in zip(labels, names)])
    tokens = F.col(tokens) if isinstance(tokens, str) else tokens
    keys, wide = list(keys), stage(wide)
    weights = F.array(*[F.coalesce(n, F.lit(0.0)).cast("double") for n in names])
    known = dictionary(wide.select("term", weights.alias("weights")), "term", "weights", broadcast_bytes)
    if known is not None:
        return df.withColumn(out, known.summed(tokens, len(names)))
    found = lookup_join(postings(df, keys[-1], tokens, keys[:-1]), wide, ["term"])
    sums = found.groupBy(*keys).agg(*[F.sum(F.col("tf") * F.col(n)).alias(n) for n in names])
    scores = F.array(*[F.coalesce(n, F.lit(0.0)).cast("double") for n in names])
    return df.join(sums, keys, "left").select(*df.columns, scores.alias(out))


def lexicon_label(df: DataFrame, keys: Sequence[str], tokens: str | Column, lexicon: DataFrame,
                  labels: Sequence[str] = EMOTIONS, out: str = "label", default: str | None = None,
                  digits: int | None = None) -> DataFrame:
    """Add ``label`` and ``scores``: the best label, the earlier one among equals, ``default`` without any hit.

    With ``digits`` scores are rounded first, so that the order of a sum does not decide ties.
    """
    scored = lexicon_scores(df, keys, tokens, lexicon, labels)
    if digits is not None:
        scored = scored.withColumn("scores", F.transform("scores", lambda s: F.round(s, digits)))
    best = F.get(F.array(*map(F.lit, labels)), argmax_vector(F.col("scores")))
    label = F.when(F.array_max("scores") > 0, best).otherwise(F.lit(default))
    return scored.withColumn(out, label)


def score_shares(scores: Column) -> Column:
    """Scores as probabilities; uniform when all are zero."""
    total = F.aggregate(scores, F.lit(0.0), lambda a, x: a + x)
    return F.transform(scores, lambda x: F.when(total > 0, x / total).otherwise(F.lit(1.0) / F.size(scores)))


def score_batches(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """Run an external model on batches of rows: ``fn`` maps one pandas frame to one of ``schema``."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield fn(pdf)

    return df.mapInPandas(run, schema)
