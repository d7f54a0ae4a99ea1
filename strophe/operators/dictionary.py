"""Looking tokens up inside the row.

A dictionary of checked size goes to the tasks.  For each batch of rows the tokens are
looked up and the results are put back by position in Arrow, so the wide row is neither
taken apart nor shuffled, and no token becomes an object of Python.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from .joins import BROADCAST_BYTES, data_bytes

PART = 1 << 18  # tokens looked up at a time, so that what is made of a batch of long texts does not grow with it


class Dictionary:
    """Look-ups in a table of few bytes, by key."""

    def __init__(self, rows: Sequence[tuple]):
        self.rows = dict(rows)

    def replace(self, tokens: Column) -> Column:
        """Each token by its value, itself where it has none; null arrays and null tokens stay."""
        keys, values, size = pa.array(self.rows.keys(), pa.string()), pa.array(self.rows.values(), pa.string()), PART

        def run(lists: pa.Array) -> pa.Array:
            words = [pa.array([], pa.string())]
            for at in range(0, len(lists.values), size):
                part = lists.values.slice(at, size).cast(pa.string())
                words.append(pc.coalesce(values.take(pc.index_in(part, keys)), part))
            offsets = pa.array(lists.offsets.to_numpy())
            return pa.ListArray.from_arrays(offsets, pa.concat_arrays(words),
                                            mask=lists.is_null() if lists.null_count else None)

        run.__annotations__ = {"lists": pa.Array, "return": pa.Array}
        return arrow_udf(run, "array<string>")(tokens)

    def summed(self, tokens: Column, width: int) -> Column:
        """The sum of the values (arrays of ``width`` numbers) of all tokens; zeros without any."""
        keys, values, size = pa.array(self.rows.keys(), pa.string()), np.array([*self.rows.values()], np.float64).reshape(-1, width), PART

        def run(lists: pa.Array) -> pa.Array:
            offsets = lists.offsets.to_numpy()
            sums, end = np.zeros((len(lists), width)), int(offsets[-1])
            for at in range(int(offsets[0]), end, size):
                part = lists.values.slice(at, min(size, end - at)).cast(pa.string())
                found = pc.fill_null(pc.index_in(part, keys), -1).to_numpy(zero_copy_only=False)
                hit = np.flatnonzero(found >= 0)
                np.add.at(sums, np.searchsorted(offsets, hit + at, "right") - 1, values[found[hit]])
            return pa.ListArray.from_arrays(pa.array(np.arange(len(lists) + 1, dtype=np.int32) * width), pa.array(sums.ravel()))

        run.__annotations__ = {"lists": pa.Array, "return": pa.Array}
        return arrow_udf(run, "array<double>")(F.coalesce(tokens, F.array().cast("array<string>")))


def dictionary(table: DataFrame, key: str, value: str, broadcast_bytes: int = BROADCAST_BYTES) -> Dictionary | None:
    """The table (staged; of a repeated key the smallest value), or ``None`` if its bytes add up to more than ``broadcast_bytes``."""
    narrow = table.where(F.col(key).isNotNull() & F.col(value).isNotNull()).groupBy(key).agg(F.min(value).alias(value))
    if data_bytes(table.select(key, value)) > broadcast_bytes:
        return None
    found = narrow.toArrow()
    return Dictionary(list(zip(found.column(0).to_pylist(), found.column(1).to_pylist())))
