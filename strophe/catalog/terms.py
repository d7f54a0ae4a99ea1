"""Term tables and vectorising."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import text as T
from ..operators import terms as K
from ..operators.sampling import random_split
from ..operators.topics import nmf_fit
from ..plans.labels import label_key_terms
from ..plans.training import title_stopwords
from ..sources.staging import stage
from ..wordlists import ENGLISH_STOPWORDS
from .base import (
    ENGLISH_SQL, SONGS_SQL, STOP_SQL, documents, noise_sql, query, songs, table, tokens_sql, words_sql,
)
from .samples import _split_sql


def _docs(spark, folder, *cols: str, stop=()) -> DataFrame:
    return documents(spark, folder, "doc_id", "text", *cols).select(
        "doc_id", *cols, T.analyze(F.col("text"), stop=stop).alias("tokens"))


def tf_sql(source: str = "documents", key: str = "doc_id", text: str = "text", by: str = "", where: str = "") -> str:
    """``(by, key, term, tf)``."""
    cols = f"{by}, {key}" if by else key
    return (f"SELECT {cols}, term, count(*) AS tf FROM (SELECT {cols}, unnest({words_sql(text)}) AS term FROM {source}) "
            f"{where} GROUP BY ALL")


def weights_sql(tf: str, docs: str, key: str, by: str = "", fit: str | None = None, limit: str = "true",
                cap: int | None = None) -> str:
    """CTEs from ``tf`` to ``weights(by, key, term, weight)``; ``fit`` names the postings the IDF comes from."""
    b = f"{by}, " if by else ""
    on = f"USING ({b}term)"
    size = (f"sizes AS (SELECT {by}, count(*) AS n FROM {docs} GROUP BY {by})" if by
            else f"sizes AS (SELECT count(*) AS n FROM {docs})")
    joined = f"st JOIN sizes USING ({by})" if by else "st, sizes"
    top = f" QUALIFY row_number() OVER (ORDER BY cf DESC, term) <= {cap}" if cap else ""
    return f"""{size},
    st AS (SELECT {b}term, count(*) AS df, sum(tf) AS cf FROM {fit or tf} GROUP BY ALL),
    idf AS (SELECT {b}term, n, ln((1 + n)::DOUBLE / (1 + df)) + 1 AS idf FROM {joined} WHERE {limit}{top}),
    raw AS (SELECT {b}{key}, term, tf * idf AS w FROM {tf} JOIN idf {on}),
    weights AS (SELECT {b}{key}, term, w / sqrt(sum(w * w) OVER (PARTITION BY {b}{key})) AS weight FROM raw)"""


@query(f"WITH tf AS ({tf_sql(by='lang')}) SELECT lang, term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM tf GROUP BY ALL")
def term_stats(spark, folder):
    return K.term_stats(K.postings(_docs(spark, folder, "lang"), "doc_id", "tokens", ["lang"]), ["lang"])


_KEY_TOKENS = f"list_filter({tokens_sql(noise_sql('text'))}, lambda t: t NOT IN ({STOP_SQL}))"
KEY_TF = f"""SELECT lang, doc_id, term, count(*) AS tf FROM (SELECT lang, doc_id,
    unnest(regexp_extract_all(array_to_string({_KEY_TOKENS}, ' '), '[\\p{{L}}\\p{{N}}_]{{2,}}')) AS term FROM documents) GROUP BY ALL"""


@query(f"""WITH tf AS ({KEY_TF}),
    {weights_sql('tf', 'documents', 'doc_id', 'lang', limit='df >= 0.02::DOUBLE * n AND df <= 0.8::DOUBLE * n')},
    m AS (SELECT lang, term, sum(weight) / n AS weight FROM weights JOIN idf USING (lang, term) GROUP BY lang, term, n)
    SELECT lang, term, round(weight, 6) AS weight,
      CAST(row_number() OVER (PARTITION BY lang ORDER BY round(weight, 9) DESC, term) AS INTEGER) AS rank
    FROM m QUALIFY rank <= 5""")
def tfidf_top_terms(spark, folder):
    docs = documents(spark, folder, "lang", "doc_id", "text")
    return label_key_terms(docs, "doc_id", "text", "lang").withColumn("weight", F.round("weight", 6))


@query(f"""WITH tf AS ({tf_sql()}), {weights_sql('tf', 'documents', 'doc_id')}
    SELECT doc_id, term, round(weight, 6) AS weight FROM weights""")
def tfidf(spark, folder):
    return K.tfidf(_docs(spark, folder), "doc_id", "tokens").withColumn("weight", F.round("weight", 6))


@query(f"""WITH tf AS ({tf_sql()}),
    parts AS ({_split_sql('0.3', 'documents', 'doc_id')}), train AS (SELECT doc_id FROM parts WHERE split = 'train'),
    fitted AS (SELECT * FROM tf WHERE doc_id IN (SELECT doc_id FROM train)),
    fresh AS (SELECT * FROM tf WHERE doc_id NOT IN (SELECT doc_id FROM train)), {weights_sql('fresh', 'train', 'doc_id', fit='fitted')}
    SELECT doc_id, term, round(weight, 6) AS weight FROM weights""")
def tfidf_transform(spark, folder):
    docs = random_split(_docs(spark, folder), 0.3, "doc_id")
    train = docs.where("split = 'train'")
    posted = stage(K.postings(docs, "doc_id", "tokens", ["split"]))
    terms = K.fit_terms(posted.where("split = 'train'"), train)
    return K.tfidf_transform(posted.where("split = 'test'"), terms, "doc_id").withColumn("weight", F.round("weight", 6))


@query(f"""WITH {SONGS_SQL}, tf AS ({tf_sql('songs', 'id', 'title', where=f'WHERE term NOT IN ({ENGLISH_SQL})')}),
    {weights_sql('tf', 'songs', 'id', cap=1000)}
    SELECT id, term, round(weight, 6) AS weight FROM weights""")
def title_tfidf(spark, folder):
    rows = songs(spark, folder).select("id", T.analyze(F.col("title"), stop=ENGLISH_STOPWORDS).alias("tokens"))
    return K.tfidf(rows, "id", "tokens", max_features=1000).withColumn("weight", F.round("weight", 6))


@query(f"""WITH tf AS ({tf_sql()}), ok AS (SELECT term FROM tf GROUP BY term
      HAVING count(*) >= 2 AND count(*) <= 0.8::DOUBLE * (SELECT count(*) FROM documents))
    SELECT doc_id, term, tf FROM tf WHERE term IN (SELECT term FROM ok)""")
def count_vectors(spark, folder):
    docs = _docs(spark, folder)
    posted = stage(K.postings(docs, "doc_id", "tokens"))
    terms = K.fit_terms(posted, docs, min_df=2, max_df=0.8)
    return K.lookup_join(posted, terms.select("term"), ["term"]).select("doc_id", "term", "tf")


_CHI2 = f"""tf AS ({tf_sql(by='lang')}), share AS (SELECT lang, count(*)::DOUBLE / (SELECT count(*) FROM documents) AS p
      FROM documents GROUP BY lang),
    o AS (SELECT lang, term, CAST(sum(tf) AS BIGINT) AS o, count(*) AS df FROM tf GROUP BY ALL),
    chi AS (SELECT term, sum(df) AS df, CAST(sum(o) AS BIGINT) AS cf, sum(o * o / p) / sum(o) - sum(o) AS chi2
      FROM o JOIN share USING (lang) GROUP BY term),
    best AS (SELECT * FROM chi WHERE df >= 2 AND df <= 0.8::DOUBLE * (SELECT count(*) FROM documents)
      ORDER BY round(chi2, 9) DESC, term DESC LIMIT 5000)"""


def _chi2(spark, folder):
    docs = _docs(spark, folder, "lang")
    posted = stage(K.postings(docs, "doc_id", "tokens", ["lang"]))
    return posted, K.chi2_select(posted, docs, "lang", 5000)


@query(f"WITH {_CHI2} SELECT term, CAST(df AS BIGINT) AS df, cf, round(chi2, 6) AS chi2 FROM best")
def chi2_top(spark, folder):
    return _chi2(spark, folder)[1].select("term", "df", "cf", F.round("chi2", 6).alias("chi2"))


@query(f"""WITH {_CHI2}, raw AS (SELECT doc_id, term, tf * (ln((1 + (SELECT count(*) FROM documents))::DOUBLE / (1 + b.df)) + 1) AS w
      FROM tf JOIN best b USING (term))
    SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM raw""")
def chi2_tfidf(spark, folder):
    posted, best = _chi2(spark, folder)
    return K.tfidf_transform(posted, best, "doc_id").withColumn("weight", F.round("weight", 6))


@query(f"""WITH tf AS ({tf_sql()}), d AS (SELECT term, min(doc_id) AS f FROM tf GROUP BY term),
    ids AS (SELECT term, row_number() OVER (ORDER BY f, term) - 1 AS term_id FROM d)
    SELECT doc_id, term_id, tf FROM tf JOIN ids USING (term)""")
def bag_of_words(spark, folder):
    posted = stage(K.postings(_docs(spark, folder), "doc_id", "tokens"))
    return K.bag_of_words(posted, "doc_id", stage(K.dictionary(posted, "doc_id")))


@query(f"""WITH tf AS ({tf_sql()}) SELECT term, CAST(sum(tf) AS BIGINT) AS cf FROM tf GROUP BY term
    ORDER BY cf DESC, term LIMIT 1000""")
def vocab_topn(spark, folder):
    stats = K.term_stats(K.postings(_docs(spark, folder), "doc_id", "tokens"))
    return K.top_per_group(stats.select("term", "cf"), [], F.col("cf"), 1000)


VOCAB_SQL = """w AS (SELECT doc_id, unnest(range(len(l))) AS pos, unnest(l) AS term FROM src),
    v AS (SELECT term, count(*) AS cf, min(doc_id * 4294967296 + pos) AS seen FROM w GROUP BY term),
    vocab AS (SELECT term, cf, CAST(row_number() OVER (ORDER BY cf DESC, seen) + 1 AS INTEGER) AS idx FROM v
      QUALIFY idx < {max})"""
_SRC = f"src AS (SELECT doc_id, {words_sql('text')} AS l FROM documents)"


@query(f"WITH {_SRC}, {VOCAB_SQL.format(max=20000)} SELECT term, cf, idx FROM vocab")
def vocab_index(spark, folder):
    return K.fit_vocab(_docs(spark, folder), "doc_id", "tokens", 20000)


@query(f"""WITH {_SRC}, {VOCAB_SQL.format(max=20000)}
    SELECT doc_id, CAST(pos AS INTEGER) AS pos, coalesce(idx, 1) AS idx FROM w LEFT JOIN vocab USING (term)""")
def token_sequences(spark, folder):
    docs = stage(_docs(spark, folder))
    seqs = K.to_sequences(docs, "doc_id", "tokens", K.fit_vocab(docs, "doc_id", "tokens", 20000))
    return seqs.select("doc_id", F.posexplode("sequence").alias("pos", "idx"))


@query(f"""WITH {_SRC}, {VOCAB_SQL.format(max=20000)}, grid AS (SELECT doc_id, unnest(range(150)) AS pos FROM documents),
    s AS (SELECT doc_id, pos, coalesce(idx, 1) AS idx FROM w LEFT JOIN vocab USING (term))
    SELECT doc_id, CAST(pos AS INTEGER) AS pos, coalesce(idx, 0) AS idx FROM grid LEFT JOIN s USING (doc_id, pos)""")
def pad_sequences(spark, folder):
    docs = stage(_docs(spark, folder))
    seqs = K.to_sequences(docs, "doc_id", "tokens", K.fit_vocab(docs, "doc_id", "tokens", 20000), 150)
    return seqs.select("doc_id", F.posexplode("sequence").alias("pos", "idx"))


@query(f"""WITH parts AS ({_split_sql('0.3', 'orders', 'o_orderkey', 'o_totalprice', over=None)})
    SELECT o_orderkey, split, round((o_totalprice - m) / s, 6) AS scaled FROM parts,
      (SELECT avg(o_totalprice) AS m, stddev_pop(o_totalprice) AS s FROM parts WHERE split = 'train')""")
def standardize(spark, folder):
    rows = random_split(table(spark, folder, "orders").select("o_orderkey", "o_totalprice"), 0.3, "o_orderkey")
    scaling = K.fit_scaling(rows.where("split = 'train'"), "o_totalprice")
    return rows.select("o_orderkey", "split", F.round(scaling.apply(F.col("o_totalprice")), 6).alias("scaled"))


@query("SELECT doc_id AS id, true AS topics_fit FROM documents")
def nmf_topics(spark, folder):
    """Eight topics of each title, none negative; all are zero exactly where the title has no known term."""
    rows = songs(spark, folder).select("id", T.analyze(F.col("title"), stop=title_stopwords()).alias("tokens"))
    weights = stage(K.tfidf(rows, "id", "tokens", max_features=1000))
    model = nmf_fit(weights, "id", 8)
    known = weights.groupBy("id").agg(F.lit(True).alias("known"))
    some = F.exists("topics", lambda t: t > 0) == F.coalesce("known", F.lit(False))
    fits = (F.size("topics") == 8) & F.forall("topics", lambda t: t >= 0) & some
    return model.transform(weights, rows, "id").join(known, "id", "left").select("id", fits.alias("topics_fit"))
