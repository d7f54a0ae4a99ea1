"""Exact, repeatable sampling and splitting.

The random order of a row is ``md5(seed:key)``, then the key, so a sample does not
depend on partitioning.  Its size is exact.  A key is one column or several (song and
stanza number) and must be unique: rows that share one would be taken together, so a
key that repeats among the rows ranked here is refused.  No group is ever sorted as a whole:
the first four hex digits of the hash divide each group into 65,536 even buckets;
bucket counts tell in which bucket the n-th row lies, and only the rows of that
bucket are ranked.  The id and hash of the n-th row are then a plain filter.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sources.staging import stage
from .joins import lookup_join

BUCKET_DIGITS = 4


Key = str | Sequence[str]


def key_columns(key: Key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def hash_key(id_col: Key, seed: int = 42) -> Column:
    parts = [F.col(c).cast("string") for c in key_columns(id_col)]
    return F.md5(F.concat(F.lit(f"{seed}:"), F.concat_ws(":", *parts) if len(parts) > 1 else parts[0]))


def _id(id_col: Key) -> Column:
    """The key as one value that can be compared."""
    columns = key_columns(id_col)
    return F.col(columns[0]) if len(columns) == 1 else F.struct(*columns)


def _keyed(df: DataFrame, id_col: Key, by: Sequence[str], seed: int) -> DataFrame:
    keyed = df.select(*by, _id(id_col).alias("_id"), hash_key(id_col, seed).alias("_hash"))
    for col in by:
        keyed = keyed.where(F.col(col).isNotNull())
    return keyed.withColumn("_bucket", F.conv(F.substring("_hash", 1, BUCKET_DIGITS), 16, 10).cast("int"))


def _bucket_table(keyed: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows per bucket, rows up to and with it, and rows of the whole group."""
    group = Window.partitionBy(*by)
    return keyed.groupBy(*by, "_bucket").agg(F.count(F.lit(1)).alias("_rows")).select(
        *by, "_bucket", "_rows",
        F.sum("_rows").over(group.orderBy("_bucket")).alias("_upto"), F.sum("_rows").over(group).alias("_total"))


def _cuts(df: DataFrame, id_col: Key, takes: Mapping[str, Callable[[Column], Column]], by: Sequence[str],
          seed: int) -> DataFrame:
    """Per group one column per name with hash and id of the row whose rank is ``takes[name](group size)``."""
    keyed = _keyed(df, id_col, by, seed)
    wanted = F.explode(F.array(*[
        F.struct(F.lit(name).alias("name"), take(F.col("_total")).cast("long").alias("take"))
        for name, take in takes.items()]))
    marks = stage(
        _bucket_table(keyed, by).select("*", wanted.alias("_w"))
        .where("_w.take > _upto - _rows and _w.take <= _upto")
        .groupBy(*by, "_bucket")
        .agg(F.collect_list(F.struct(F.col("_w.name").alias("name"),
                                     (F.col("_w.take") - _offset()).alias("nth"))).alias("_marks")))
    inside = Window.partitionBy(*by, "_bucket").orderBy("_hash", "_id")
    ranked = lookup_join(keyed, marks, [*by, "_bucket"]).withColumn("_nth", F.row_number().over(inside))
    ranked = ranked.withColumn("_again", F.coalesce(F.lag("_id").over(inside) == F.col("_id"), F.lit(False)))
    hits = ranked.select("*", F.explode("_marks").alias("_m")).where("_m.nth = _nth or _again")
    return hits.groupBy(*by).agg(F.max("_again").alias("_again"), *[
        F.max(F.when((F.col("_m.name") == name) & (F.col("_m.nth") == F.col("_nth")), F.struct("_hash", "_id"))).alias(f"_cut_{name}")
        for name in takes])


def _offset() -> Column:
    return F.col("_upto") - F.col("_rows")


def take_first(df: DataFrame, id_col: Key, takes: Mapping[str, Callable[[Column], Column]],
               by: Sequence[str] = (), seed: int = 42, rest: str | None = None, out: str = "split") -> DataFrame:
    """Name each row by the first of the ``takes`` whose rank range it falls in.

    ``takes`` maps a name to a cumulative row count as a function of the group size.
    Rows beyond all of them are named ``rest``.  The rows themselves are not shuffled.
    """
    by = list(by)
    me = F.struct(hash_key(id_col, seed).alias("_hash"), _id(id_col).alias("_id"))
    cuts = stage(_cuts(df, id_col, takes, by, seed))
    if not cuts.where("_again").isEmpty():
        raise ValueError(f"the key {key_columns(id_col)} repeats: name all columns that tell rows apart")
    if by:
        named = lookup_join(df, cuts.drop("_again"), by, "left")
        bounds = {name: F.col(f"_cut_{name}") for name in takes}
    else:
        named, found = df, cuts.first()  # one row
        bounds = {}
        for name in takes:
            cut = found[f"_cut_{name}"]
            bounds[name] = (F.lit(None) if cut is None else F.struct(
                F.lit(cut[0]).alias("_hash"), _literal_id(df, id_col, cut[1]).alias("_id")))
    chain = F.lit(rest)
    for name in reversed(list(takes)):
        chain = F.when(F.coalesce(me <= bounds[name], F.lit(False)), F.lit(name)).otherwise(chain)
    return named.select(*df.columns, chain.alias(out))


def _literal_id(df: DataFrame, id_col: Key, value) -> Column:
    columns = key_columns(id_col)
    typed = [F.lit(v).cast(df.schema[c].dataType).alias(c) for c, v in zip(columns, [value] if len(columns) == 1 else value)]
    return typed[0] if len(columns) == 1 else F.struct(*typed)


def _taken(df: DataFrame, id_col: Key, take: Callable[[Column], Column], by: Sequence[str], seed: int) -> DataFrame:
    return take_first(df, id_col, {"in": take}, by, seed, out="_split").where("_split = 'in'").drop("_split")


def stratified_sample(df: DataFrame, by: str, frac: float, id_col: Key = "id", seed: int = 42) -> DataFrame:
    """``frac`` of each group, its size rounded half to even."""
    return _taken(df, id_col, lambda n: F.bround(n * F.lit(float(frac))), [by], seed)


def downsample(df: DataFrame, by: str = "label", id_col: Key = "id", seed: int = 42) -> DataFrame:
    """As many rows of each class as the smallest class has."""
    sizes = df.where(F.col(by).isNotNull()).groupBy(by).count()
    smallest = sizes.agg(F.min("count")).first()[0] or 0
    return _taken(df, id_col, lambda n: F.lit(smallest), [by], seed)


def sample_n(df: DataFrame, n: int, id_col: Key = "id", seed: int = 42) -> DataFrame:
    return _taken(df, id_col, lambda total: F.least(total, F.lit(n)), [], seed)


def not_sampled(df: DataFrame, sample: DataFrame, id_col: Key = "id") -> DataFrame:
    """Rows of ``df`` that the sample left out."""
    keys = key_columns(id_col)
    return df.join(sample.select(*keys), keys, "left_anti")


def _ceil(share: float) -> Callable[[Column], Column]:
    # 0.3 * n in doubles can end just above a whole number (0.3 * 10 does not, 0.07 * 100 does).
    return lambda n: F.ceil(F.round(n * F.lit(float(share)), 9))


def random_split(df: DataFrame, test: float, id_col: Key = "id", by: Sequence[str] = (), seed: int = 42,
                 out: str = "split") -> DataFrame:
    """``test`` holds ``ceil(test * n)`` rows, overall or per class; the rest is ``train``.

    To keep the rows of one song together use ``split_groups`` instead.
    """
    return take_first(df, id_col, {"test": _ceil(test)}, by, seed, rest="train", out=out)


def split_groups(df: DataFrame, test: float, group_col: str, seed: int = 42, out: str = "split") -> DataFrame:
    """Split whole groups, so that rows of one song stay together."""
    groups = random_split(stage(df.select(group_col).distinct()), test, group_col, seed=seed, out=out)
    return lookup_join(df, stage(groups), [group_col])


def train_val_test(df: DataFrame, by: str = "label", id_col: Key = "id", test: float = 0.3, val: float = 0.3,
                   seed: int = 42, out: str = "split") -> DataFrame:
    """``ceil(test*n)`` rows per class to test, ``ceil(val*rest)`` to val, the rest to train."""
    n_test = _ceil(test)
    return take_first(df, id_col, {
        "test": n_test,
        "val": lambda n: n_test(n) + _ceil(val)(n - n_test(n)),
    }, [by], seed, rest="train", out=out)


def hash_rank(df: DataFrame, id_col: Key, by: Sequence[str] = (), seed: int = 42, out: str = "rank") -> DataFrame:
    """0-based rank of each row of its group in hash order, by bucket offset and rank inside the bucket; null without a group."""
    by = list(by)
    keyed = df.withColumn("_id", _id(id_col)).withColumn("_hash", hash_key(id_col, seed)).withColumn(
        "_bucket", F.conv(F.substring("_hash", 1, BUCKET_DIGITS), 16, 10).cast("int"))
    offsets = stage(_bucket_table(_keyed(df, id_col, by, seed), by).select(
        *by, "_bucket", _offset().alias("_offset")))
    inside = Window.partitionBy(*by, "_bucket").orderBy("_hash", "_id")
    ranked = lookup_join(keyed, offsets, [*by, "_bucket"], "left")
    return ranked.select(*df.columns, (F.col("_offset") + F.row_number().over(inside) - 1).alias(out))


def kfold(df: DataFrame, k: int, by: str = "label", id_col: Key = "id", seed: int = 42,
          out: str = "fold") -> DataFrame:
    """Stratified folds: hash rank within the class, modulo ``k``; rows without a class are in none."""
    ranked = hash_rank(df, id_col, [by], seed, "_rank")
    return ranked.withColumn(out, (F.col("_rank") % k).cast("int")).drop("_rank")


def class_weights(df: DataFrame, by: str = "label") -> DataFrame:
    """Balanced weight ``n / (k * n_class)`` per class."""
    sizes = df.where(F.col(by).isNotNull()).groupBy(by).agg(F.count(F.lit(1)).alias("n"))
    every = Window.partitionBy()  # one row per class
    balanced = F.sum("n").over(every) * F.lit(1.0) / (F.count(F.lit(1)).over(every) * F.col("n"))
    return sizes.select(by, "n", balanced.alias("weight"))


def with_class_weight(df: DataFrame, by: str = "label", out: str = "weight") -> DataFrame:
    weights = stage(class_weights(df, by).select(by, F.col("weight").alias(out)))
    return lookup_join(df, weights, [by])
