"""Fitted models over whole tables.  Training has no SQL equivalent, so these are checked by rows only."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.arrays import join_tokens
from ..functions.text import analyze
from ..operators import models as M
from ..operators.curves import forest_curve
from ..operators.features import BOOLEANS, fit_features, stored_values
from ..operators.sampling import random_split, train_val_test
from ..operators.scoring import score_batches
from ..plans import training as P
from ..sources.runs import run_summary
from ..sources.staging import shared_folder, stage
from ..wordlists import GENRES
from .base import _TITLE, documents, query, words_sql
from .terms import VOCAB_SQL, tf_sql, weights_sql

LANGS = ["de", "en", "es", "fr"]
TERMS = 1000  # a tree learner of the library holds one bin per row and term in memory, so the terms of a forest are bounded
_FLAGS = {f"is_{g}": f"(n_chars % {i} = 0)" for i, g in enumerate(GENRES, 2)} | {"is_chorus": "(contains(text, ','))"}


def stanzas(spark, folder) -> DataFrame:
    """Documents as labelled stanzas: the language is the class, the flags come from sizes and marks."""
    rows = documents(spark, folder, "doc_id", "text", "lang", "source", "n_chars")
    return rows.select(
        F.col("doc_id").alias("id"), F.col("lang").alias("label"), analyze(F.col("text")).alias("lemmatized_stanzas"),
        F.expr(_TITLE["spark"]).alias("title"), (F.col("n_chars") % 10).cast("int").alias("stanza_number"),
        *[F.expr(e).alias(n) for n, e in _FLAGS.items()])


def model_rows(spark, folder) -> DataFrame:
    return stage(stanzas(spark, folder).withColumn("text_str", join_tokens(F.col("lemmatized_stanzas"))).drop(
        "lemmatized_stanzas"))


def _supports(run: P.Evaluation) -> DataFrame:
    """What SQL can tell of a report: the held-out rows of each class, and that a class's f1 is above the share of the largest one."""
    report = run.report().where(F.col("class").isin(LANGS))
    every = Window.partitionBy()  # one row per class
    largest = F.max("support").over(every) / F.sum("support").over(every)
    return report.select("class", "support", F.coalesce(F.col("f1") > largest, F.lit(False)).alias("scored"))


def _held_out(n: str, by: str = "", rows: str = "documents") -> str:
    """The held-out rows of each class: the first by hash, overall or of the class."""
    over = f"PARTITION BY {by} " if by else ""
    return f"""SELECT lang AS class, CAST(count(*) AS BIGINT) AS support, true AS scored FROM (
        SELECT lang, row_number() OVER ({over}ORDER BY md5('42:' || doc_id), doc_id) AS r,
          count(*) OVER ({over}) AS n FROM {rows}) WHERE r <= ceil(round(n * {n}::DOUBLE, 9)) GROUP BY lang"""


_CLASSES_SQL = "SELECT unnest([" + ", ".join(f"'{x}'" for x in LANGS) + "]) AS class, true AS scored"


def _forest(train: DataFrame):
    return P.fit_forest(train, {"trees": 100, "max_features": TERMS}, LANGS)


_MIX_SRC = f"""mix AS (SELECT doc_id AS id, text, {_TITLE['sql']} AS title, n_chars % 10 AS number,
    {' + '.join(f'{e}::INT' for e in _FLAGS.values())} AS flags FROM documents)"""


@query(f"""WITH {_MIX_SRC},
    text_block AS (WITH tf AS ({tf_sql('mix', 'id')}), {weights_sql('tf', 'mix', 'id', cap=TERMS)}
      SELECT id, count(*) AS n, sum(weight) AS s FROM weights GROUP BY id),
    title_block AS (WITH tf AS ({tf_sql('mix', 'id', 'title')}), {weights_sql('tf', 'mix', 'id')}
      SELECT id, count(*) AS n, sum(weight) AS s FROM weights GROUP BY id),
    scaled AS (SELECT id, flags, (number - (SELECT avg(number) FROM mix)) / (SELECT stddev_pop(number) FROM mix) AS z FROM mix)
    SELECT m.id, coalesce(a.n, 0) + coalesce(b.n, 0) + m.flags + (m.z <> 0)::INT AS filled,
      round(coalesce(a.s, 0) + coalesce(b.s, 0) + m.flags + m.z, 6) AS total
    FROM scaled m LEFT JOIN text_block a USING (id) LEFT JOIN title_block b USING (id)""")
def mixed_features(spark, folder):
    """Filled cells and their sum in the assembled vector of text, title, number and flags."""
    rows = model_rows(spark, folder)
    vectors = fit_features(rows, P.mixed_spec(TERMS)).transform(rows).select("id", stored_values(F.col("features")).alias("v"))
    filled = F.aggregate("v", F.lit(0).cast("long"), lambda a, x: a + (x != 0).cast("long"))
    return vectors.select("id", filled.alias("filled"), F.round(F.aggregate(
        "v", F.lit(0.0), lambda a, x: a + x), 6).alias("total"))


@query(_held_out("0.3"))
def forest_report(spark, folder):
    """Hold-out report of a random forest on mixed features."""
    return _supports(P.train_and_evaluate(model_rows(spark, folder), _forest, id_col="id", classes=LANGS))


@query(_CLASSES_SQL)
def forest_auc(spark, folder):
    """A row of the class ranks above one of another class in nine of ten pairs at least."""
    auc = P.train_and_evaluate(model_rows(spark, folder), _forest, id_col="id", classes=LANGS).auc()
    return auc.select("class", F.coalesce(F.col("auc").between(0.9, 1), F.lit(False)).alias("scored"))


@query(_held_out("0.2", "lang"))
def text_forest_report(spark, folder):
    """Stratified hold-out, TF-IDF of the text as the only feature."""
    parts = stage(random_split(model_rows(spark, folder), 0.2, "id", ["label"]))
    model = P.fit_forest(parts.where("split = 'train'"), {"trees": 100}, LANGS,
                         P.text_spec(max_features=TERMS))
    return _supports(P.evaluate(model, parts.where("split = 'test'"), LANGS))


@query(_held_out("0.3"))
def svm_report(spark, folder):
    """Linear SVM, one against the rest."""
    fit = lambda train: P.fit_svm(train, {"c": 0.9, "max_features": TERMS, "max_iter": 5000}, LANGS)
    return _supports(P.train_and_evaluate(model_rows(spark, folder), fit, id_col="id", classes=LANGS))


@query(_held_out("0.3"))
def svm_pairs_report(spark, folder):
    """Linear SVM, one against one."""
    fit = lambda train: M.fit_one_vs_one(
        train, c=0.9, max_iter=5000, spec=P.mixed_spec(TERMS), classes=LANGS)
    return _supports(P.train_and_evaluate(model_rows(spark, folder), fit, id_col="id", classes=LANGS))


@query(_held_out("0.3"))
def chi2_forest_report(spark, folder):
    """Counts, chi-squared selection, TF-IDF, forest."""
    fit = lambda train: P.fit_chi2_forest(train, k=5000, classes=LANGS, trees=100)
    return _supports(P.train_and_evaluate(model_rows(spark, folder), fit, id_col="id", classes=LANGS))


_SPLIT_SQL = """SELECT doc_id, CASE WHEN r <= t THEN 'test' WHEN r <= t + ceil(round((n - t) * 0.3::DOUBLE, 9)) THEN 'val' ELSE 'train' END AS split
    FROM (SELECT *, ceil(round(n * 0.3::DOUBLE, 9)) AS t FROM (
      SELECT doc_id, row_number() OVER (PARTITION BY lang ORDER BY md5('42:' || doc_id), doc_id) AS r,
        count(*) OVER (PARTITION BY lang) AS n FROM documents))"""


_LARGEST = "(SELECT max(n) / sum(n) FROM (SELECT count(*) AS n FROM documents GROUP BY lang))"


@query(f"SELECT unnest(range(20))::INT AS draw, 5 AS folds, true AS scored FROM (SELECT {_LARGEST})")
def forest_search(spark, folder):
    """Random search with 20 draws and 5 folds on all rows; no draw is worse than the largest class's share."""
    rows = model_rows(spark, folder)
    _, draws = P.search_forest(rows, classes=LANGS)
    largest = rows.groupBy("label").count().agg(F.max("count") / F.sum("count")).scalar()
    return draws.select("draw", "folds", (F.col("accuracy").between(largest, 1)).alias("scored"))


@query(f"""WITH parts AS (SELECT doc_id, lang, split FROM ({{split}}) JOIN documents USING (doc_id))
    SELECT unnest(range(1, 101))::INT AS round, CAST(count_if(split = 'train') AS BIGINT) AS train_rows, CAST(count_if(split = 'val') AS BIGINT) AS val_rows, true AS scored
    FROM parts""".replace("{split}", _SPLIT_SQL))
def training_curve(spark, folder):
    """Accuracy on training and validation rows for each number of trees of one forest, always above the share of the largest class."""
    parts = stage(train_val_test(model_rows(spark, folder), "label"))
    train = parts.where("split = 'train'")
    curve = forest_curve(_forest(train), {"train": train, "val": parts.where("split = 'val'")}, range(1, 101), classes=LANGS)
    largest = parts.groupBy("label").count().agg(F.max("count") / F.sum("count")).scalar()
    good = (F.col("train_accuracy") > largest) & (F.col("val_accuracy") > largest)
    return curve.select("round", "train_rows", "val_rows", F.when(F.col("round") >= 10, good).otherwise(F.col("val_accuracy") > 0.5).alias("scored"))


@query("SELECT doc_id AS id, true AS labelled, 'forest' AS run FROM documents")
def saved_model_labels(spark, folder):
    """Train, save, load, label every row as the model in memory does, and log the run."""
    rows = model_rows(spark, folder)
    path = f"{shared_folder(spark).rstrip('/')}/strophe/{uuid.uuid4().hex}"
    run = P.training_run(rows, _forest, balance=True, id_col="id", classes=LANGS, save_to=f"{path}/model", runs=f"{path}/runs",
                         name="forest")
    runs = run_summary(spark, f"{path}/runs")
    loaded = P.classify(rows, f"{path}/model", "id")
    both = loaded.join(M.predict(run.model, rows, ["id"]), "id")
    return both.select("id", (F.col("label").isin(LANGS) & (F.col("label") == F.col("predicted"))).alias("labelled"),
                       runs.select("name").scalar().alias("run"))


@query(_held_out("0.3", "lang", "(FROM documents SEMI JOIN labels USING (doc_id))"))
def self_training(spark, folder):
    """Pseudo-labels for the documents without a quality label, refit, evaluate."""
    rows = model_rows(spark, folder)
    rated = spark.read.parquet(f"{folder}/labels.parquet").select(F.col("doc_id").alias("id"))
    run = P.training_run(rows.join(rated, "id", "left_semi"), _forest, rows.join(rated, "id", "left_anti"),
                         id_col="id", classes=LANGS)
    return _supports(run)


def _topics_fit() -> Column:
    return ((F.size("topics") == 8) & F.forall("topics", lambda t: t >= 0)).alias("topics_fit")


@query(f"""WITH parts AS (SELECT doc_id, split FROM ({_SPLIT_SQL})), toks AS (SELECT doc_id, {words_sql('text')} AS l FROM documents),
    src AS (SELECT doc_id, l FROM toks JOIN parts USING (doc_id) WHERE split = 'train'), {VOCAB_SQL.format(max=20000)},
    words AS (SELECT doc_id, unnest(range(len(l))) AS pos, unnest(l) AS term FROM toks),
    seqs AS (SELECT doc_id, string_agg(coalesce(idx, 1), ' ' ORDER BY pos) AS seq, count(*) AS len
      FROM words LEFT JOIN vocab USING (term) WHERE pos < 150 GROUP BY doc_id),
    numbers AS (SELECT avg(n_chars % 10) AS m, stddev_pop(n_chars % 10) AS s FROM documents JOIN parts USING (doc_id) WHERE split = 'train')
    SELECT doc_id AS row_id, split, true AS topics_fit, CAST(list_position(['de', 'en', 'es', 'fr'], lang) - 1 AS INTEGER) AS y,
      trim(coalesce(seq, '') || repeat(' 0', CAST(150 - coalesce(len, 0) AS INTEGER))) AS sequence,
      round((n_chars % 10 - m) / s, 6) AS scaled, CAST(({' + '.join(f'{e}::INT' for e in _FLAGS.values())}) AS INTEGER) AS flags
    FROM documents JOIN parts USING (doc_id) LEFT JOIN seqs USING (doc_id), numbers""")
def nn_prepared(spark, folder):
    """Split, padded sequences, title topics, scaled number, sum of the flags and target of every row."""
    rows = stanzas(spark, folder).withColumnRenamed("id", "row_id")
    _, prepared = P.prepare(stage(rows), classes=LANGS)
    flags = F.lit(0)
    for name in BOOLEANS:
        flags += F.col(name)
    return prepared.select(
        "row_id", "split", _topics_fit(), (F.array_position("y", 1) - 1).cast("int").alias("y"),
        F.array_join(F.transform("padded_sequence", lambda i: i.cast("string")), " ").alias("sequence"),
        F.round("stanza_number", 6).alias("scaled"), flags.alias("flags"))


@query("SELECT doc_id AS row_id, true AS same FROM documents")
def prepared_from_disk(spark, folder):
    """Fit the preparation, save it, load it, and apply both to every row."""
    rows = stage(stanzas(spark, folder).withColumnRenamed("id", "row_id"))
    path = f"{shared_folder(spark).rstrip('/')}/strophe/{uuid.uuid4().hex}"
    fitted = P.fit_preparation(rows)
    fitted.save(path)
    one, two = fitted.apply(rows), P.Preparation.load(spark, path).apply(rows)
    columns = ("padded_sequence", "topics", "stanza_number")
    both = one.select("row_id", F.struct(*columns).alias("a")).join(two.select("row_id", F.struct(*columns).alias("b")), "row_id")
    return both.select("row_id", (F.col("a") == F.col("b")).alias("same"))


@query(_held_out("0.3", "lang"))
def softmax_report(spark, folder):
    """Dense layers over topics, number, flags and text."""
    rows = stage(stanzas(spark, folder).withColumnRenamed("id", "row_id"))
    fitted, prepared = P.prepare(rows, classes=LANGS)
    ready = stage(P.with_text(prepared).drop("lemmatized_stanzas", "padded_sequence").withColumn(
        "topic_vector", P.topic_vector(F.col("topics"))))
    model = P.fit_perceptron(ready.where("split = 'train'"), P.dense_spec(TERMS), LANGS)
    return _supports(P.evaluate(model, ready.where("split = 'test'"), LANGS))


@query(f"SELECT doc_id AS id, len({words_sql('text')}) AS n FROM documents")
def batch_scorer(spark, folder):
    """The plug-in for an external model; here it counts words."""
    def count(pdf):
        return pdf.assign(n=pdf["text_str"].str.split().str.len().fillna(0).astype("int64"))[["id", "n"]]

    return score_batches(model_rows(spark, folder).select("id", "text_str"), count, "id bigint, n bigint")
