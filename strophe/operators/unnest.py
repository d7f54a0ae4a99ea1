"""Array elements as rows.

Spark adds a filter on the array's size below an inner ``explode``, pushes it to
the scan and so computes a derived array (tokens, term counts) again.  The outer
form with a filter on the position has no such copy.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def unnest(df: DataFrame, keep: Sequence[str], items: Column | str, value: str, pos: str | None = None) -> DataFrame:
    """One row per element with the columns ``keep``; empty and null arrays give none."""
    at = pos or "_at"
    rows = df.select(*keep, F.posexplode_outer(items).alias(at, value)).where(F.col(at).isNotNull())
    return rows if pos else rows.drop(at)


def unnest_structs(df: DataFrame, keep: Sequence[str], items: Column, field: str) -> DataFrame:
    """One row per struct, its fields as columns; ``field`` is one that is never null."""
    return df.select(*keep, F.inline_outer(items)).where(F.col(field).isNotNull())
