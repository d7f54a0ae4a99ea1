"""Array columns: binding, counting, padding, arg-max."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often ``body`` uses it.

    Without this a higher-order function evaluates an expression captured by its
    lambda again for each element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def term_counts(tokens: Column) -> Column:
    """``array<struct<term,tf>>`` with one entry per distinct token, in term order.

    Counting inside the row needs no shuffle: a text and its tokens are one row.
    """
    def runs(s: Column) -> Column:
        starts = F.filter(
            F.sequence(F.lit(0), F.size(s) - 1),
            lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)),
        )
        return bind(starts, lambda p: F.transform(p, lambda at, j: F.struct(
            F.get(s, at).alias("term"),
            (F.coalesce(F.get(p, j + 1), F.size(s)) - at).cast("long").alias("tf"),
        )))

    none = F.array().cast("array<struct<term:string,tf:bigint>>")
    return bind(F.sort_array(tokens), lambda s: F.when(F.size(s) > 0, runs(s)).otherwise(none))


def repeated_items(items: Column) -> Column:
    """The distinct elements that occur more than once."""
    def dups(s: Column) -> Column:
        return F.array_distinct(F.transform(
            F.filter(F.sequence(F.lit(1), F.greatest(F.size(s) - 1, F.lit(1))),
                     lambda i: F.get(s, i) == F.get(s, i - 1)),
            lambda i: F.get(s, i)))

    return bind(F.sort_array(items), dups)


def pad_sequence(seq: Column, length: int, value: int = 0) -> Column:
    """Cut or fill to ``length``, both at the end."""
    return F.slice(F.concat(seq, F.array_repeat(F.lit(value), length)), 1, length)


def argmax_vector(values: Column) -> Column:
    """0-based position of the first largest element of an array."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def one_hot_vector(index: Column, length: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(length - 1)), lambda i: (i == index).cast("int"))


def join_tokens(tokens: Column, sep: str = " ") -> Column:
    return F.array_join(tokens, sep)
