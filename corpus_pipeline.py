"""A training-data pipeline: documents in, token ids of a clean and balanced corpus out.

``STAGES`` run in order on the table ``documents``.  Each stage reads what the stage before
has written and returns the columns of ``documents``, the last one the encoded texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from strophe.llm import minhash, mixing, pieces, quality, units
from strophe.sources.staging import stage

NEAR = minhash.NearDuplicates(width=5, percent=80, bands=32, rows=4)


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass all quality rules."""
    return quality.good_documents(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Near-duplicates (five-word shingles, similarity 0.8): the smallest id of each group stays."""
    return minhash.drop_near_duplicates(docs, NEAR)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sentences of ten words or more stay where they come first; a document of which nothing is left goes.

    The row travels as one column, so columns named like those of the operator keep their values.
    """
    new = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    packed = docs.select("doc_id", "text", F.struct(*[c for c in docs.columns if c not in new]).alias("_document"))
    cut = units.remove_repeated(packed, "sentence")
    left = cut.where((F.col("n_removed") == 0) | F.rlike("kept_text", F.lit(r"[^\x20\x09-\x0D]")))
    return left.select(*[new.get(c, F.col("_document")[c]).alias(c) for c in docs.columns])


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the weights of the sources take it."""
    return mixing.mixed(docs, mixing.Mix())


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``(doc_id, n_ids, ids)`` of each row."""
    coded = pieces.encode(docs, pieces.public_pieces())
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_ids"), "ids")


STAGES = [
    ("quality rules", good_documents),
    ("near-duplicates", one_of_each_group),
    ("repeated sentences", without_repeats),
    ("source mix", mixed_sources),
    ("token ids", encoded),
]

# Hashing, random rounding and merges have no SQL; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
