"""From one row per text to one row per section."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.arrays import bind, repeated_items
from ..functions.text import is_chorus_header
from .joins import lookup_join
from ..sources.staging import stage


def explode_stanzas(df: DataFrame, sections: str, out: str = "stanzas", number: str = "stanza_number",
                    chorus: str | None = None) -> DataFrame:
    """One row per section with its 0-based position; an empty list keeps one null row.

    With ``chorus`` a flag is added for sections that are named as chorus or occur
    again in the same text.  A text is one row here, so repeats are found in it
    and nothing is shuffled.
    """
    def described(repeats: Column) -> Column:
        return F.transform(F.col(sections), lambda x, i: F.struct(
            x.alias(out), i.alias(number), (is_chorus_header(x) | F.array_contains(repeats, x)).alias("chorus")))

    rest = [c for c in df.columns if c != sections]
    if chorus is None:
        return df.select(*rest, F.posexplode_outer(sections).alias(number, out)).withColumn(
            number, F.coalesce(number, F.lit(0)))
    rows = df.select(*rest, F.explode_outer(bind(repeated_items(F.col(sections)), described)).alias("_row"))
    return rows.select(*rest, F.col(f"_row.{out}").alias(out),
                       F.coalesce(f"_row.{number}", F.lit(0)).alias(number),
                       F.coalesce("_row.chorus", F.lit(False)).alias(chorus))


def repeated_in_group(df: DataFrame, keys: Sequence[str], col: str, out: str = "repeated") -> DataFrame:
    """Flag rows whose value occurs more than once in their group (null counts as a value).

    Counts are combined before they are shuffled, and only repeated values are joined back.
    """
    repeats = (df.groupBy(*keys, col).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
               .select(*keys, F.coalesce(col, F.lit("")).alias("_value"), F.col(col).isNull().alias("_null"),
                       F.lit(True).alias(out)))
    keyed = df.withColumns({"_value": F.coalesce(col, F.lit("")), "_null": F.col(col).isNull()})
    flagged = lookup_join(keyed, stage(repeats), [*keys, "_value", "_null"], "left")
    return flagged.select(*df.columns, F.coalesce(out, F.lit(False)).alias(out))


def flag_chorus(df: DataFrame, keys: Sequence[str], col: str = "stanzas", out: str = "is_chorus") -> DataFrame:
    """``explode_stanzas(chorus=...)`` for a table that has one row per section already."""
    flagged = repeated_in_group(df, keys, col, "_repeated")
    return flagged.withColumn(out, is_chorus_header(F.col(col)) | F.col("_repeated")).drop("_repeated")


def dedup_keep_first(df: DataFrame, cols: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row in ``order`` of each combination of ``cols``; nulls are equal.

    A filter on the first row number lets Spark reduce each group to one row per
    task before the shuffle, so many copies of one row do not meet in one task.
    """
    first = Window.partitionBy(*cols).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(first)).where("_rn = 1").drop("_rn")
