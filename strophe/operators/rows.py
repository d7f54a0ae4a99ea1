"""Row and column operators: flags, encodings, filters, unions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..wordlists import EMOTIONS, GENRES
from .unnest import unnest

MODEL_COLUMNS = ["title", "stanza_number", *[f"is_{g}" for g in GENRES], "is_chorus"]


def argmax_columns(cols: Sequence[str], names: Sequence[str] | None = None) -> Column:
    """Name of the largest column of a row; ties and all-equal rows give the first."""
    values = [F.coalesce(F.col(c).cast("double"), F.lit(float("-inf"))) for c in cols]
    best = F.greatest(*values)
    return F.coalesce(*[F.when(v == best, F.lit(n)) for v, n in zip(values, names or cols)])


def exclude_value(df: DataFrame, col: str, value) -> DataFrame:
    """Rows whose ``col`` is not ``value``; null is kept."""
    return df.where(~F.col(col).eqNullSafe(F.lit(value)))


def one_hot(df: DataFrame, col: str, prefix: str, categories: Sequence | None = None,
            max_columns: int = 1000) -> DataFrame:
    """Replace ``col`` by one boolean column per category.

    Categories found in the data become columns, so there may be ``max_columns`` at most.
    """
    if categories is None:
        found = df.select(col).where(F.col(col).isNotNull()).distinct().limit(max_columns + 1).collect()
        if len(found) > max_columns:
            raise ValueError(f"{col} has more than {max_columns} values; give the categories")
        categories = sorted(r[0] for r in found)
    flags = {f"{prefix}_{c}": F.coalesce(F.col(col) == F.lit(c), F.lit(False)) for c in categories}
    return df.withColumns(flags).drop(col)


def bools_to_int(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("int") for c in cols})


def select_features(df: DataFrame, text: str = "text_str", extra: Sequence[str] = ()) -> DataFrame:
    return df.select(text, *MODEL_COLUMNS, *extra)


def select_class(df: DataFrame, label: str, value: str, tokens: str, out: str = "text") -> DataFrame:
    return df.where(F.col(label) == value).select("*", F.array_join(tokens, " ").alias(out))


def unsplit(text: str = "lyrics") -> Column:
    """True for a text with neither a blank line nor a bracket pair on one line."""
    col = F.col(text)
    return ~F.contains(col, F.lit("\n\n")) & ~col.rlike(r"\[[^\n]*\]")


def no_marker(text: str = "lyrics") -> Column:
    col = F.col(text)
    return ~(F.contains(col, F.lit("Verse")) | F.contains(col, F.lit("verse")) | F.contains(col, F.lit("\n\n")))


def no_marker_stats(df: DataFrame, id_col: str, text: str) -> DataFrame:
    return df.where(no_marker(text)).agg(F.count(F.lit(1)).alias("n"), F.min(id_col).alias("first_id"))


def encode_label(label: Column, labels: Sequence[str] = EMOTIONS) -> Column:
    """Class index of a label, null when unknown; one fixed order serves both directions."""
    chain = F.when(label == labels[0], F.lit(0))
    for i, name in enumerate(labels[1:], 1):
        chain = chain.when(label == name, F.lit(i))
    return chain


def decode_label(index: Column, labels: Sequence[str] = EMOTIONS) -> Column:
    return F.get(F.array(*map(F.lit, labels)), index.cast("int"))


def union_tables(tables: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, tables)


def name_universe(df: DataFrame, name: str, names: str) -> DataFrame:
    """Distinct non-empty values of a column and of an array column together."""
    single = df.select(F.col(name).alias("name"))
    return single.union(unnest(df, [], names, "name")).where("name <> ''").distinct()


def duplicate_count(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """How many rows repeat an earlier one."""
    sizes = df.groupBy(*(cols or df.columns)).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("duplicates"))
