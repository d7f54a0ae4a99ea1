"""Evaluation of a deterministic prediction: the language by a vote of a few frequent words."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.arrays import argmax_vector
from ..functions.text import analyze
from ..operators import metrics as M
from ..operators.rows import encode_label
from ..operators.scoring import lexicon_label as label_by_words, score_shares
from ..sources.staging import stage
from .base import documents, query, words_sql

LANGS = ["de", "en", "es", "fr"]
LEXICON = [
    ("der", "de", 2.0), ("und", "de", 1.0), ("das", "de", 1.0), ("la", "fr", 1.0), ("le", "fr", 1.0),
    ("un", "fr", 1.0), ("des", "fr", 1.0), ("the", "en", 1.0), ("of", "en", 1.0), ("is", "en", 1.0),
    ("la", "es", 1.0), ("el", "es", 2.0), ("un", "es", 1.0), ("que", "es", 1.0), ("que", "fr", 0.5),
]
_VALUES = ", ".join(f"('{t}', '{l}', {w})" for t, l, w in LEXICON)
_SUMS = ", ".join(f"coalesce(sum(weight) FILTER (WHERE label = '{l}'), 0)::DOUBLE AS s{i}" for i, l in enumerate(LANGS))
_SCORES = "[" + ", ".join(f"coalesce(s{i}, 0)" for i in range(4)) + "]"

SCORED_SQL = f"""lexicon AS (SELECT * FROM (VALUES {_VALUES}) l(term, label, weight)),
    hits AS (SELECT doc_id, {_SUMS} FROM (SELECT doc_id, unnest({words_sql('text')}) AS term FROM documents)
      JOIN lexicon USING (term) GROUP BY doc_id),
    scored AS (SELECT d.doc_id, d.lang AS label, {_SCORES} AS scores FROM documents d LEFT JOIN hits h ON d.doc_id = h.doc_id),
    pred AS (SELECT doc_id, label, list_transform(scores, lambda x: CASE WHEN list_sum(scores) > 0
        THEN x / list_sum(scores) ELSE 0.25 END) AS p,
      CASE WHEN list_max(scores) > 0 THEN (['de', 'en', 'es', 'fr'])[list_position(scores, list_max(scores))] END
        AS guess, list_position(['de', 'en', 'es', 'fr'], label) AS y FROM scored),
    predictions AS (SELECT *, coalesce(guess, 'en') AS prediction FROM pred)"""


def _lexicon(spark) -> DataFrame:
    return spark.createDataFrame(LEXICON, "term string, label string, weight double")


def _predictions(spark, folder) -> DataFrame:
    docs = documents(spark, folder, "doc_id", "lang", "text")
    found = label_by_words(docs, ["doc_id"], analyze(F.col("text")), _lexicon(spark), LANGS, "prediction", "en")
    return stage(found.select("doc_id", F.col("lang").alias("label"), "prediction",
                              score_shares(F.col("scores")).alias("p"), encode_label(F.col("lang"), LANGS).alias("y")))


@query(f"""WITH {SCORED_SQL} SELECT doc_id, guess AS label, unnest(['de', 'en', 'es', 'fr']) AS class,
    round(unnest(p), 6) AS share FROM predictions""")
def lexicon_label(spark, folder):
    docs = documents(spark, folder, "doc_id", "text")
    found = label_by_words(docs, ["doc_id"], analyze(F.col("text")), _lexicon(spark), LANGS)
    shares = F.arrays_zip(F.array(*map(F.lit, LANGS)).alias("class"), score_shares(F.col("scores")).alias("share"))
    return found.select("doc_id", "label", F.inline(shares)).withColumn("share", F.round("share", 6))


@query(f"""WITH {SCORED_SQL}, cells AS (SELECT a.c AS label, b.c AS prediction FROM
      (SELECT unnest(['de', 'en', 'es', 'fr']) AS c) a, (SELECT unnest(['de', 'en', 'es', 'fr']) AS c) b)
    SELECT label, prediction, count(doc_id) AS n FROM cells LEFT JOIN predictions USING (label, prediction) GROUP BY ALL""")
def confusion_matrix(spark, folder):
    return M.confusion_matrix(_predictions(spark, folder), LANGS)


@query(f"""WITH {SCORED_SQL} SELECT label, {', '.join(f"CAST(count_if(prediction = '{l}') AS BIGINT) AS {l}" for l in LANGS)}
    FROM predictions GROUP BY label""")
def confusion_wide(spark, folder):
    return M.confusion_wide(_predictions(spark, folder), LANGS)


@query(f"WITH {SCORED_SQL} SELECT round(avg((label = prediction)::INT), 6) AS accuracy FROM predictions")
def accuracy(spark, folder):
    return M.accuracy(_predictions(spark, folder)).withColumn("accuracy", F.round("accuracy", 6))


@query(f"""WITH {SCORED_SQL}, s AS (SELECT c AS class, count_if(label = c) AS t, count_if(prediction = c) AS s,
      count_if(label = c AND prediction = c) AS h FROM predictions, (SELECT unnest(['de', 'en', 'es', 'fr']) AS c) GROUP BY c),
    r AS (SELECT class, CASE WHEN s > 0 THEN h / s ELSE 0 END AS precision, CASE WHEN t > 0 THEN h / t ELSE 0 END AS recall,
      CASE WHEN s + t > 0 THEN 2 * h / (s + t) ELSE 0 END AS f1, t AS support FROM s WHERE t + s > 0),
    a AS (SELECT * FROM r UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM r
      UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
        sum(f1 * support) / sum(support), sum(support) FROM r)
    SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
      CAST(support AS BIGINT) AS support FROM a""")
def classification_report(spark, folder):
    return M.classification_report(_predictions(spark, folder)).withColumns(
        {c: F.round(c, 6) for c in ("precision", "recall", "f1")})


@query(f"""WITH {SCORED_SQL} SELECT c AS class, round(coalesce(avg((prediction = c)::INT) FILTER (WHERE label = c), 0), 6)
    AS accuracy FROM predictions, (SELECT unnest(['de', 'en', 'es', 'fr', 'it']) AS c) GROUP BY c""")
def class_accuracy(spark, folder):
    return M.class_accuracy(_predictions(spark, folder), [*LANGS, "it"]).withColumn("accuracy", F.round("accuracy", 6))


_STEPS = f"""{SCORED_SQL}, o AS (SELECT unnest(['de', 'en', 'es', 'fr']) AS class, label, unnest(p) AS score FROM predictions),
    g AS (SELECT class, score, count_if(label = class) AS pos, count_if(label <> class) AS neg FROM o GROUP BY ALL),
    steps AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp FROM g WINDOW w AS (PARTITION BY class ORDER BY score DESC)),
    totals AS (SELECT class, sum(pos) AS np, sum(neg) AS nn FROM g GROUP BY class)"""


def _scored(spark, folder) -> DataFrame:
    return M.one_vs_rest(_predictions(spark, folder), "label", F.col("p"), LANGS)


@query(f"""WITH {_STEPS} SELECT class, round(score, 6) AS threshold, round(fp / nn, 6) AS fpr, round(tp / np, 6) AS tpr
    FROM steps JOIN totals USING (class) UNION ALL SELECT class, NULL, 0.0, 0.0 FROM totals""")
def roc_points(spark, folder):
    return M.roc_points(_scored(spark, folder)).withColumns(
        {c: F.round(c, 6) for c in ("threshold", "fpr", "tpr")})


@query(f"""WITH {_STEPS} SELECT class, round(sum(neg * (tp - pos / 2)) / (sum(pos) * sum(neg)), 6) AS auc
    FROM steps GROUP BY class""")
def auc_ovr(spark, folder):
    return M.auc_ovr(_scored(spark, folder)).withColumn("auc", F.round("auc", 6))


@query(f"""WITH {SCORED_SQL}, r AS (SELECT doc_id, y, p, unnest(p) AS q, unnest([1, 2, 3, 4]) AS i FROM predictions),
    a AS (SELECT doc_id, count_if(q > p[y] OR (q = p[y] AND i < y)) AS ahead FROM r GROUP BY doc_id)
    SELECT round(avg((ahead < 2)::INT), 6) AS accuracy FROM a""")
def topk_accuracy(spark, folder):
    return M.topk_accuracy(_predictions(spark, folder), "y", "p", 2).withColumn("accuracy", F.round("accuracy", 6))


@query(f"""WITH {SCORED_SQL} SELECT round(avg(-ln(least(greatest(p[y], 1e-7), 1 - 1e-7))), 6) AS log_loss FROM predictions""")
def log_loss(spark, folder):
    return M.log_loss(_predictions(spark, folder), "y", "p").withColumn("log_loss", F.round("log_loss", 6))


@query(f"""WITH {SCORED_SQL} SELECT doc_id, CAST(list_position(p, list_max(p)) - 1 AS INTEGER) AS idx FROM predictions""")
def argmax_probability(spark, folder):
    return _predictions(spark, folder).select("doc_id", argmax_vector(F.col("p")).alias("idx"))
