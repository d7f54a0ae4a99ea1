"""Exact samples and splits; the order of a row is md5('42:' || id), then the id."""

from __future__ import annotations

from ..operators import sampling as S
from .base import query, table


def _ranked(source: str, key: str, by: str | None = None, cols: str | None = None) -> str:
    over = f"PARTITION BY {by} " if by else ""
    size = f"count(*) OVER ({over.strip()})"
    return (f"SELECT {cols or '*'}, row_number() OVER ({over}ORDER BY md5('42:' || {key}), {key}) AS r, "
            f"{size} AS n FROM {source}")


def _docs(spark, folder):
    return table(spark, folder, "documents").select("doc_id", "lang")


def _orders(spark, folder):
    return table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")


@query(f"""SELECT o_orderkey, o_orderpriority FROM ({_ranked('orders', 'o_orderkey', 'o_orderpriority')})
    WHERE r <= round_even(n * 0.05::DOUBLE, 0)""")
def stratified_sample(spark, folder):
    return S.stratified_sample(_orders(spark, folder), "o_orderpriority", 0.05, "o_orderkey")


@query(f"""WITH q AS ({_ranked('documents', 'doc_id', 'lang')})
    SELECT doc_id, lang FROM q WHERE r <= (SELECT min(n) FROM q)""")
def downsample(spark, folder):
    return S.downsample(_docs(spark, folder), "lang", "doc_id")


@query(f"""WITH q AS ({_ranked('documents', 'doc_id', 'lang')})
    SELECT doc_id, lang FROM q WHERE r > (SELECT min(n) FROM q)""")
def downsample_rest(spark, folder):
    docs = _docs(spark, folder)
    return S.not_sampled(docs, S.downsample(docs, "lang", "doc_id"), "doc_id")


def _split_sql(share: str, source: str, key: str, by: str | None = None, over: str | None = "by") -> str:
    """``by`` is kept and, unless ``over`` is None, splits are per value of it."""
    test = f"ceil(round(n * {share}::DOUBLE, 9))"
    cols = f"{key}, {by}" if by else key
    return (f"SELECT {cols}, CASE WHEN r <= {test} THEN 'test' ELSE 'train' END AS split "
            f"FROM ({_ranked(source, key, by if over else None)})")


@query(_split_sql("0.4", "orders", "o_orderkey"))
def split_60_40(spark, folder):
    return S.random_split(_orders(spark, folder).select("o_orderkey"), 0.4, "o_orderkey")


@query(_split_sql("0.3", "documents", "doc_id"))
def split_70_30(spark, folder):
    return S.random_split(_docs(spark, folder).select("doc_id"), 0.3, "doc_id")


@query(_split_sql("0.2", "documents", "doc_id", "lang"))
def split_stratified(spark, folder):
    return S.random_split(_docs(spark, folder), 0.2, "doc_id", ["lang"])


@query(f"""WITH g AS ({_split_sql('0.3', '(SELECT DISTINCT l_orderkey FROM lineitem)', 'l_orderkey')})
    SELECT l.l_orderkey, l.l_linenumber, g.split FROM lineitem l JOIN g ON l.l_orderkey = g.l_orderkey""")
def split_by_group(spark, folder):
    rows = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber")
    return S.split_groups(rows, 0.3, "l_orderkey")


@query(f"""WITH q AS ({_ranked('documents', 'doc_id', 'lang')}),
    s AS (SELECT *, ceil(round(n * 0.3::DOUBLE, 9)) AS t FROM q)
    SELECT doc_id, lang, CASE WHEN r <= t THEN 'test' WHEN r <= t + ceil(round((n - t) * 0.3::DOUBLE, 9)) THEN 'val'
      ELSE 'train' END AS split FROM s""")
def train_val_test(spark, folder):
    return S.train_val_test(_docs(spark, folder), "lang", "doc_id")


@query(f"SELECT o_orderkey FROM ({_ranked('orders', 'o_orderkey')}) WHERE r <= n // 2")
def sample_n(spark, folder):
    orders = _orders(spark, folder).select("o_orderkey")
    return S.sample_n(orders, orders.count() // 2, "o_orderkey")


@query(f"SELECT doc_id, lang, CAST((r - 1) % 5 AS INTEGER) AS fold FROM ({_ranked('documents', 'doc_id', 'lang')})")
def kfold_assign(spark, folder):
    return S.kfold(_docs(spark, folder), 5, "lang", "doc_id").select("doc_id", "lang", "fold")
