"""A lexicon of label words, induced from a corpus by association with seed words.

A text that holds a seed of a label speaks for that label.  A term's weight for a label is the
smoothed pointwise mutual information of the two over all texts.  Seeds are a short list, so a
text is marked in its row; all co-occurrences are then one count per term with one column per
label, combined before the shuffle.  There is no pair of terms anywhere.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..sources.staging import stage
from ..wordlists import EMOTIONS
from .terms import SCORE_DIGITS, top_per_group
from .unnest import unnest

SEED_LIMIT = 1000


def seed_terms(df: DataFrame, tokens: str | Column, labels: Sequence[str] = EMOTIONS, per_label: int = 5,
               max_df: float = 0.2) -> dict[str, list[str]]:
    """Stand-in for hand-picked seeds: the most frequent terms of at most ``max_df`` of the texts, dealt to the labels in turn."""
    df = df.select(F.array_distinct(F.col(tokens) if isinstance(tokens, str) else tokens).alias("_t"))
    n = df.count()
    counts = unnest(df, [], "_t", "term").groupBy("term").agg(F.count(F.lit(1)).alias("df")).where(F.col("df") <= max_df * n)
    best = top_per_group(counts, [], F.col("df"), per_label * len(labels), rank="rank").collect()
    out: dict[str, list[str]] = {label: [] for label in labels}
    for row in best:
        out[labels[(row["rank"] - 1) % len(labels)]].append(row["term"])
    return out


def spoken_for(tokens: Column, seeds: Mapping[str, Sequence[str]], labels: Sequence[str]) -> list[Column]:
    """Per label whether a text holds one of its seeds."""
    return [F.arrays_overlap(tokens, F.array(*map(F.lit, words))) if (words := list(seeds.get(label, ()))) else F.lit(False)
            for label in labels]


def associations(df: DataFrame, tokens: str | Column, seeds: Mapping[str, Sequence[str]], labels: Sequence[str] = EMOTIONS,
                 min_df: int = 5, smooth: float = 1.0) -> DataFrame:
    """``(term, label, df, together, pmi)`` of every term of at least ``min_df`` texts.

    With n texts, df of them with the term, m with a seed of the label and ``together`` with either, the
    weight is ``ln((together + s) * (n + s) / ((df + s) * (m + s)))``.  Texts without tokens count in n.
    """
    if sum(map(len, seeds.values())) > SEED_LIMIT:
        raise ValueError(f"more than {SEED_LIMIT} seed words")
    tokens = F.array_distinct(F.coalesce(F.col(tokens) if isinstance(tokens, str) else tokens, F.array().cast("array<string>")))
    marks = [f"_m{i}" for i in range(len(labels))]
    marked = stage(df.select(tokens.alias("_t")).select("_t", *[m.alias(c) for m, c in zip(spoken_for(F.col("_t"), seeds, labels), marks)]))
    n, *sizes = marked.agg(F.count(F.lit(1)), *[F.count_if(c) for c in marks]).first()
    counts = unnest(marked, marks, "_t", "term").groupBy("term").agg(
        F.count(F.lit(1)).alias("df"), *[F.count_if(c).alias(c) for c in marks]).where(F.col("df") >= min_df)
    cells = F.array(*[F.struct(F.lit(label).alias("label"), F.col(c).alias("together"), F.lit(size).cast("long").alias("size"))
                      for label, c, size in zip(labels, marks, sizes)])
    long_ = counts.select("term", "df", F.inline(cells))
    pmi = F.log((F.col("together") + smooth) * (F.lit(n) + smooth) / ((F.col("df") + smooth) * (F.col("size") + smooth)))
    return long_.select("term", "label", "df", "together", pmi.alias("pmi"))


def induced_lexicon(df: DataFrame, tokens: str | Column, seeds: Mapping[str, Sequence[str]], labels: Sequence[str] = EMOTIONS,
                    k: int = 200, min_df: int = 5, smooth: float = 1.0) -> DataFrame:
    """``(term, label, weight)``: per label the ``k`` terms of the largest positive association, staged."""
    found = associations(df, tokens, seeds, labels, min_df, smooth)
    weight = F.round("pmi", SCORE_DIGITS)
    best = top_per_group(found.select("term", "label", weight.alias("weight")).where("weight > 0"), ["label"], F.col("weight"), k)
    return stage(best)
