"""Feature columns for Spark ML, as stages that can be saved with the model.

The weights follow the smoothed IDF ``ln((1+n)/(1+df)) + 1`` and the population
standard deviation.  Spark's ``IDF`` lacks the ``+ 1`` and its ``StandardScaler``
uses the sample deviation, so both are fitted as tables and written into plain
rescaling stages.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark import SparkContext
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import (
    CountVectorizerModel, ElementwiseProduct, NGram, Normalizer, RegexTokenizer, SQLTransformer, StopWordsRemover,
    VectorAssembler,
)
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.arrays import term_counts
from ..functions.text import ANALYZER_TOKEN, analyze
from ..wordlists import GENRES
from .terms import fit_scaling, fit_terms
from .unnest import unnest_structs

VOCABULARY = 1 << 22
_MARK = "\x01"
BOOLEANS = [*[f"is_{g}" for g in GENRES], "is_chorus"]


@dataclass(frozen=True)
class TextColumn:
    """How one text column becomes a TF-IDF block."""

    name: str
    max_features: int | None = None
    ngram: tuple[int, int] = (1, 1)
    stop: Sequence[str] = ()
    min_df: int | float = 1
    max_df: int | float = 1.0
    terms: DataFrame | None = None  # a table (term, idf) chosen beforehand


@dataclass(frozen=True)
class FeatureSpec:
    texts: Sequence[TextColumn] = field(default_factory=lambda: [TextColumn("text_str"), TextColumn("title")])
    scaled: Sequence[str] = ("stanza_number",)
    booleans: Sequence[str] = tuple(BOOLEANS)
    vectors: Sequence[str] = ()  # ready-made vector columns
    out: str = "features"


def _analyzer(col: TextColumn, tokens: str) -> list[Transformer]:
    words = f"_{col.name}_words"
    stages: list[Transformer] = [RegexTokenizer(
        inputCol=col.name, outputCol=words, pattern=ANALYZER_TOKEN, gaps=False, toLowercase=True)]
    if col.stop:
        kept = f"_{col.name}_kept"
        stages.append(StopWordsRemover(inputCol=words, outputCol=kept, stopWords=list(col.stop)))
        words = kept
    low, high = col.ngram
    parts = [words] if low == 1 else []
    for n in range(max(low, 2), high + 1):
        stages.append(NGram(n=n, inputCol=words, outputCol=f"_{col.name}_{n}"))
        parts.append(f"_{col.name}_{n}")
    stages.append(SQLTransformer(statement=f"SELECT *, concat({', '.join(parts)}) AS {tokens} FROM __THIS__"))
    return stages


def _counter(words: list[str], tokens: str, counts: str) -> CountVectorizerModel:
    """``from_vocabulary``, which sends the driver's JVM one word at a time, with one message for all words."""
    if not words or any(_MARK in w for w in words):
        return CountVectorizerModel.from_vocabulary(words, inputCol=tokens, outputCol=counts)
    java = SparkContext._active_spark_context._jvm.java.util.regex.Pattern.compile(_MARK).split(_MARK.join(words), -1)
    counter = CountVectorizerModel._create_from_java_class("org.apache.spark.ml.feature.CountVectorizerModel", java)
    counter.setInputCol(tokens).setOutputCol(counts)
    return counter._set(vocabSize=len(words))


def fit_text(df: DataFrame, col: TextColumn) -> list[Transformer]:
    """Stages from a text column to a vector of unit length, ``_<name>_tfidf``.

    The vocabulary is counted as a distributed term table and only then taken to
    the driver, as a column, since the model keeps it there.  Its share is bounded: a
    vocabulary that was not capped and is larger than ``VOCABULARY`` is refused, not cut.
    """
    tokens, counts, raw, out = (f"_{col.name}_{s}" for s in ("tokens", "counts", "raw", "tfidf"))
    terms = col.terms
    if terms is None:
        posted = unnest_structs(df, [], term_counts(analyze(F.col(col.name), col.ngram, col.stop)), "term")
        terms = fit_terms(posted, df, (), col.min_df, col.max_df, col.max_features)
    size = terms.count()
    if size > VOCABULARY:
        raise ValueError(f"{col.name} has {size} terms; set max_features to {VOCABULARY} or less")
    chosen = terms.select("term", "idf").orderBy("term").toArrow()
    counter = _counter(chosen["term"].to_pylist(), tokens, counts)
    return [*_analyzer(col, tokens), counter,
            ElementwiseProduct(inputCol=counts, outputCol=raw, scalingVec=Vectors.dense(chosen["idf"].to_numpy())),
            Normalizer(inputCol=raw, outputCol=out, p=2.0)]


def fit_features(df: DataFrame, spec: FeatureSpec = FeatureSpec()) -> PipelineModel:
    """Text blocks, scaled numbers and 0/1 flags assembled into one vector; fitted on ``df`` only."""
    stages: list[Transformer] = []
    parts: list[str] = []
    for col in spec.texts:
        stages += fit_text(df, col)
        parts.append(f"_{col.name}_tfidf")
    for name in spec.scaled:
        scaling = fit_scaling(df, name)
        stages.append(SQLTransformer(
            statement=f"SELECT *, ({name} - {scaling.mean!r}D) / {scaling.std!r}D AS _{name}_scaled FROM __THIS__"))
        parts.append(f"_{name}_scaled")
    if spec.booleans:
        casts = ", ".join(f"CAST({b} AS INT) AS _{b}_int" for b in spec.booleans)
        stages.append(SQLTransformer(statement=f"SELECT *, {casts} FROM __THIS__"))
        parts += [f"_{b}_int" for b in spec.booleans]
    parts += list(spec.vectors)
    stages.append(VectorAssembler(inputCols=parts, outputCol=spec.out))
    return PipelineModel(stages)


def stored_values(vector: Column) -> Column:
    """The values that a vector holds, in order: of a sparse one without the zeros between, so a row costs what it holds, not its width."""
    return F.unwrap_udt(vector)["values"]


def unnamed(vector: str) -> Column:
    """A vector column without the names of its features, which every task of a fit would read again, thousands of times."""
    return F.col(vector).alias(vector, metadata={"ml_attr": {}})


def helper_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith("_")]
