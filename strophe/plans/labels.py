"""Labels for stanzas, and what the labels look like."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.text import analyze, remove_stopwords, strip_noise, tokenize
from ..operators.counts import class_share
from ..operators.rows import union_tables
from ..operators.terms import key_terms
from ..wordlists import KEY_TERM_STOPWORDS

STANZA_KEY = ["id", "stanza_number"]


def merge_labels(lemmatized: DataFrame, labelled: Sequence[DataFrame]) -> DataFrame:
    """Union the labelled tables and join their labels on; several labels for one stanza give several rows."""
    labels = union_tables([t.select(*STANZA_KEY, "label") for t in labelled])
    return lemmatized.join(labels, STANZA_KEY)


def label_distribution(df: DataFrame, label: str = "label", counted: str | None = None) -> DataFrame:
    return class_share(df, label, counted)


def clean_tokens(df: DataFrame, text: str, out: str = "tokens", stop: Sequence[str] = KEY_TERM_STOPWORDS) -> DataFrame:
    return df.withColumn(out, remove_stopwords(tokenize(strip_noise(F.col(text))), stop))


def label_key_terms(df: DataFrame, doc: str, text: str, label: str, k: int = 5, min_df: int | float = 0.02,
                    max_df: int | float = 0.8, stop: Sequence[str] = KEY_TERM_STOPWORDS) -> DataFrame:
    """The most typical terms of each label: noise and stop words out, TF-IDF per label, mean, best ``k``."""
    cleaned = clean_tokens(df, text, "_tokens", stop).select(
        label, doc, analyze(F.array_join("_tokens", " ")).alias("_terms"))
    return key_terms(cleaned, doc, "_terms", [label], k, min_df, max_df)
