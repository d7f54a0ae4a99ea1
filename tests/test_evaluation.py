"""Metrics, topics, models, sources."""


import numpy as np
import pytest
from pyspark.sql import functions as F

from strophe.operators import metrics as M, models as L, topics as T
from strophe.operators.features import FeatureSpec, TextColumn
from strophe.operators.scoring import lexicon_label, score_batches
from strophe.plans import training as P
from strophe.sources.runs import log_run, run_summary
from strophe.sources.tables import read_table, write_table


@pytest.fixture(scope="module")
def predicted(spark):
    return spark.createDataFrame(list(zip("aabbc", "abbba")), "label string, prediction string")


def test_report(predicted):
    got = {r["class"]: tuple(round(v, 6) for v in r[1:]) for r in M.classification_report(predicted).collect()}
    assert got["a"] == (.5, .5, .5, 2)
    assert got["b"] == (.666667, 1.0, .8, 2)
    assert got["c"] == (0.0, 0.0, 0.0, 1)
    assert got["macro avg"][2] == .433333 and got["weighted avg"][2] == .52
    assert M.accuracy(predicted).first()[0] == pytest.approx(.6)


def test_confusion(predicted):
    cells = {(r["label"], r["prediction"]): r["n"] for r in M.confusion_matrix(predicted, "abc").collect()}
    assert len(cells) == 9 and sum(cells.values()) == 5 and cells["b", "b"] == 2 and cells["c", "c"] == 0
    wide = {r["label"]: (r["a"], r["b"], r["c"]) for r in M.confusion_wide(predicted, "abc").collect()}
    assert wide == {"a": (1, 1, 0), "b": (0, 2, 0), "c": (1, 0, 0)}
    hits = {r["class"]: r["accuracy"] for r in M.class_accuracy(predicted, "abcd").collect()}
    assert hits == {"a": .5, "b": 1.0, "c": 0.0, "d": 0.0}


def test_auc_and_roc(spark):
    scored = spark.createDataFrame(
        [("x", True, .8), ("x", True, .5), ("x", False, .5), ("x", False, .2)], "class string, hit boolean, score double")
    assert M.auc_ovr(scored).first()["auc"] == .875
    points = sorted((r["fpr"], r["tpr"]) for r in M.roc_points(scored).collect())
    assert points == [(0.0, 0.0), (0.0, .5), (.5, 1.0), (1.0, 1.0)]


def test_log_loss_and_topk(spark):
    df = spark.createDataFrame([(0, [.5, .3, .2]), (1, [.7, .25, .05])], "y int, p array<double>")
    assert M.log_loss(df, "y", "p").first()[0] == pytest.approx(1.039721, abs=1e-6)
    assert M.topk_accuracy(df, "y", "p", 1).first()[0] == .5
    assert M.topk_accuracy(df, "y", "p", 2).first()[0] == 1.0


def test_topics_fall_in_loss_and_stay_positive(spark):
    rng = np.random.RandomState(0)
    data = [(d, f"t{(d % 3) * 4 + j}", float(1 + rng.rand())) for d in range(60) for j in range(4)]
    weights = spark.createDataFrame(data, "doc bigint, term string, weight double")
    model = T.nmf_fit(weights, "doc", k=3, iterations=15, tol=0)
    assert all(a >= b - 1e-9 for a, b in zip(model.losses, model.losses[1:]))
    assert model.losses[-1] < 0.1 * sum(w * w for _, _, w in data)
    assert (model.h >= 0).all()
    docs = spark.range(61).withColumnRenamed("id", "doc")
    out = {r["doc"]: r["topics"] for r in model.transform(weights, docs, "doc").collect()}
    assert len(out) == 61 and all(x >= 0 for t in out.values() for x in t) and out[60] == [0.0] * 3
    best = {d: int(np.argmax(t)) for d, t in out.items() if d < 60}
    assert all(len({best[d] for d in range(s, 60, 3)}) == 1 for s in range(3))
    assert model.topics(spark).count() == 36


WORDS = {"joy": "sun happy smile", "fear": "dark night scream", "anger": "fight burn hate"}
CLASSES = ["anger", "fear", "joy"]


@pytest.fixture(scope="module")
def stanzas(spark):
    data = []
    for i in range(90):
        label = CLASSES[i % 3]
        words = WORDS[label].split()
        tokens = [words[i % 3], words[(i + 1) % 3], f"word{i % 5}", "the"]
        data.append((i, label, tokens, f"my {words[0]} song", i % 4, *[i % (k + 2) == 0 for k in range(6)]))
    flags = ", ".join(f"is_{g} boolean" for g in ("country", "pop", "rap", "rb", "rock", "chorus"))
    return P.with_text(spark.createDataFrame(
        data, f"id bigint, label string, lemmatized_stanzas array<string>, title string, stanza_number int, {flags}"))


def accuracy(model, df):
    return M.accuracy(L.predict(model, df, ["label"]), "label", "predicted").first()[0]


def test_forest_saved_and_loaded(spark, stanzas, tmp_path):
    out = P.train_and_evaluate(stanzas, lambda t: P.fit_forest(t, {"trees": 10, "depth": 5}, CLASSES),
                               classes=CLASSES, save_to=str(tmp_path / "m"))
    assert out.report().where("class = 'weighted avg'").first()["f1"] > .8
    assert out.confusion().agg(F.sum("n")).first()[0] == 27
    assert out.auc().agg(F.min("auc")).first()[0] > .8
    again = L.load_model(str(tmp_path / "m"))
    same = L.predict(again, stanzas, ["id"]).join(
        L.predict(out.model, stanzas, ["id"]).withColumnRenamed("predicted", "p"), "id")
    assert same.where("predicted <> p").count() == 0


def test_svms(stanzas):
    assert accuracy(P.fit_svm(stanzas, {"max_iter": 5}, CLASSES), stanzas) > .9
    assert accuracy(L.fit_one_vs_one(stanzas, max_iter=5, spec=P.mixed_spec(), classes=CLASSES), stanzas) > .9


def test_perceptron(stanzas):
    spec = FeatureSpec(texts=[TextColumn("text_str")], booleans=())
    assert accuracy(P.fit_perceptron(stanzas, spec, CLASSES, max_iter=40, hidden=(8,)), stanzas) > .9


def test_chi2_forest(stanzas):
    assert accuracy(P.fit_chi2_forest(stanzas, k=9, classes=CLASSES, trees=10), stanzas) > .9


@pytest.mark.parametrize("fit,params", [(P.fit_forest, {"trees": 5, "depth": 2}), (P.fit_svm, {"c": 0.01})])
def test_balanced_weights_find_the_rare_class(spark, fit, params):
    # One row in ten is of the rare class, and half of the rows that look like it are not.
    rows = [(i, 1, "a" if i % 10 else "b", "dull words" if i % 10 > 1 else "rare sign", f"t{i % 3}", 2, 1) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, stanza_number int, label string, text_str string, title string, n_lines int, weight int")
    spec = FeatureSpec(texts=[TextColumn("text_str")], scaled=(), booleans=())

    def found(**more):
        model = fit(df, params | more, ["a", "b"], spec)
        return L.predict(model, df, ["label"]).where("label = 'b' and predicted = 'b'").count()

    assert found(class_weight="balanced") == 20 > found(class_weight=None)
    with pytest.raises(ValueError):
        fit(df, {"class_weight": "heavy"}, ["a", "b"], spec)


def test_search_is_repeatable(stanzas):
    grid = {"trees": [2, 4, 6], "depth": [2, 3], "ngram": [(1, 1), (1, 2)]}
    assert L.draw_parameters(grid, 5) == L.draw_parameters(grid, 5)
    assert len({str(p) for p in L.draw_parameters(grid, 99)}) == 12
    best, draws = P.search_forest(stanzas, n_iter=2, k=2, grid=grid, classes=CLASSES)
    assert set(best) == set(grid) and draws.count() == 2


def test_search_prepares_each_fold_and_text_setting_once(stanzas, monkeypatch):
    """Many draws share the tables of a fold; the best draw is one of them; class weights may be part of the grid."""
    from strophe.operators import search as Q

    made = []
    original = Q.FoldStore._made
    monkeypatch.setattr(Q.FoldStore, "_made", lambda self, shape, fold: made.append((str(shape), fold)) or original(self, shape, fold))
    grid = {"trees": [2, 3, 4], "depth": [2, 3], "max_features": [5, None], "class_weight": [None, "balanced"]}
    best, draws = P.search_forest(stanzas, n_iter=8, k=3, grid=grid, classes=CLASSES, id_col=["id", "stanza_number"])
    rows = draws.collect()
    shapes = {r.params["max_features"] for r in rows}
    assert len(made) == len(set(made)) == 3 * len(shapes)
    assert len(rows) == 8 and all(r.folds == 3 and 0 <= r.accuracy <= 1 for r in rows)
    assert {p: str(v) for p, v in best.items()} == max(rows, key=lambda r: (r.accuracy, -r.draw)).params
    _, svms = P.search_svm(stanzas, n_iter=2, k=2, grid={"c": [0.1, 1.0], "class_weight": ["balanced"], "max_features": [9]},
                           classes=CLASSES, id_col=["id", "stanza_number"])
    assert svms.count() == 2


def test_curve_equals_truncated_forests(stanzas):
    """The running votes of one fit are those of its first n trees, and the last are the forest's own."""
    import numpy as np
    from strophe.operators.curves import forest_curve, prefix_predictions

    model = P.fit_forest(stanzas, {"trees": 7, "depth": 3}, CLASSES)
    got = {(r.id, r.stanza_number): r.ahead for r in prefix_predictions(model, stanzas, ["id", "stanza_number"]).collect()}
    forest = model.stages[-2]
    ready = model.transform(stanzas).select("id", "stanza_number", "features", "prediction").collect()
    for r in ready[:25]:
        votes = np.zeros(forest.numClasses)
        for n, tree in enumerate(forest.trees):
            votes += tree.predictProbability(r.features).toArray()
            assert got[(r.id, r.stanza_number)][n] == int(np.argmax(votes))
        assert got[(r.id, r.stanza_number)][-1] == int(r[3])
    curve = {r["round"]: r for r in forest_curve(model, {"train": stanzas, "val": stanzas.limit(20)}, [1, 3, 7], classes=CLASSES).collect()}
    assert set(curve) == {1, 3, 7} and curve[7].train_accuracy == pytest.approx(accuracy_of(model, stanzas)) and curve[7].val_rows == 20


def accuracy_of(model, rows):
    scored = L.predict(model, rows, ["label"]).collect()
    return sum(r.label == r.predicted for r in scored) / len(scored)


def test_self_training(spark, stanzas, tmp_path):
    run = P.training_run(stanzas.where("id < 60"), lambda t: P.fit_forest(t, {"trees": 5, "depth": 5}, CLASSES),
                         stanzas.where("id >= 60").drop("label"), pseudo_share=.5, balance=True, classes=CLASSES,
                         save_to=str(tmp_path / "m"), runs=str(tmp_path / "runs"))
    assert run.report().where("class = 'weighted avg'").first()["f1"] > .6
    assert run_summary(spark, str(tmp_path / "runs")).first()["params"]["self_training"] == "True"
    legacy = stanzas.drop("text_str").withColumn(
        "lemmatized_stanzas", F.concat(F.lit("['"), F.array_join("lemmatized_stanzas", "', '"), F.lit("']")))
    assert P.classify(legacy, str(tmp_path / "m")).join(stanzas.select("id", F.col("label").alias("y")), "id").agg(
        F.avg((F.col("label") == F.col("y")).cast("int"))).first()[0] > .6


def test_preparation(stanzas):
    fitted, out = P.prepare(stanzas.withColumnRenamed("id", "row_id"), iterations=4)
    row = out.where("row_id = 2").first()
    assert len(row["padded_sequence"]) == 150 and len(row["topics"]) == 8 and sum(row["y"]) == 1
    train = out.where("split = 'train'")
    assert train.agg(F.avg("stanza_number")).first()[0] == pytest.approx(0, abs=1e-9)
    assert out.count() == 90
    fresh = fitted.apply(stanzas.withColumnRenamed("id", "row_id").where("row_id < 5"))
    assert fresh.count() == 5


def test_lexicon_and_batches(spark):
    lexicon = spark.createDataFrame([("sun", "joy", 1.0), ("dark", "fear", 1.0), ("sun", "anger", .5)],
                                    "term string, label string, weight double")
    df = spark.createDataFrame([(1, ["sun", "sun"]), (2, ["sun", "dark"]), (3, ["x"])], "id int, tokens array<string>")
    got = {r["id"]: r["label"] for r in lexicon_label(df, ["id"], "tokens", lexicon).collect()}
    assert got == {1: "joy", 2: "fear", 3: None}
    sized = score_batches(df.select("id"), lambda pdf: pdf.assign(n=pdf["id"] * 2)[["id", "n"]], "id int, n int")
    assert sorted(map(tuple, sized.collect())) == [(1, 2), (2, 4), (3, 6)]


def test_csv_round_trip(spark, tmp_path):
    schema = "id bigint, lyrics string, tag string"
    df = spark.createDataFrame([(1, 'line "one"\nline, two', "pop"), (2, None, "rap")], schema)
    write_table(df, str(tmp_path / "a.csv"), "csv")
    assert sorted(map(tuple, read_table(spark, str(tmp_path / "a.csv"), schema).collect())) == sorted(map(tuple, df.collect()))
    (tmp_path / "b.csv").write_text('id,lyrics,tag\n1, "a, b", pop\n')
    assert tuple(read_table(spark, str(tmp_path / "b.csv"), schema, skip_initial_space=True).first()) == (1, "a, b", "pop")
    with pytest.raises(ValueError):
        read_table(spark, str(tmp_path / "b.csv"))
    write_table(df, str(tmp_path / "p"))
    assert read_table(spark, str(tmp_path / "p")).count() == 2


def test_run_log(spark, tmp_path):
    log_run(spark, str(tmp_path / "runs"), "first", {"trees": 3}, {"accuracy": .5})
    log_run(spark, str(tmp_path / "runs"), "second", {"reset": True}, {})
    rows = run_summary(spark, str(tmp_path / "runs")).collect()
    assert [r["name"] for r in rows] == ["first", "second"] and rows[0]["params"] == {"trees": "3"}


def test_counts_beyond_a_long_product(spark):
    """Counts of four thousand million per class: their product does not fit into a long."""
    from strophe.operators import metrics, terms

    n = 4_000_000_000
    steps = spark.createDataFrame([("a", 0.9, n, 0), ("a", 0.5, n, n), ("a", 0.1, 0, n)], "class string, score double, pos long, neg long")
    summed = steps.withColumn("tp", F.lit(n) * F.when(F.col("score") > 0.6, 1).otherwise(2)).withColumn("fp", F.lit(0))
    original, metrics._score_steps = metrics._score_steps, lambda scored: summed
    try:
        assert metrics.auc_ovr(None).first().auc == pytest.approx(0.875)
    finally:
        metrics._score_steps = original

    posted = spark.createDataFrame([("x", 1, "t", n), ("y", 2, "t", n), (None, 3, "t", n)], "label string, doc int, term string, tf long")
    docs = spark.createDataFrame([("x", 1), ("y", 2), (None, 3)], "label string, doc int")
    row = terms.chi2_scores(posted, docs, "label").first()
    assert (row.df, row.cf, row.chi2) == (2, 2 * n, pytest.approx(0.0))


def test_depth_is_not_cut(spark):
    from strophe.operators.models import random_forest

    assert random_forest(depth=None).getMaxDepth() == 30
    with pytest.raises(ValueError):
        random_forest(depth=60)


def test_topics_refuse_and_survive_the_disk(spark, tmp_path):
    from strophe.operators.topics import TopicModel, nmf_fit

    weights = spark.createDataFrame([(d, f"t{d % 5}", 1.0) for d in range(20)], "doc int, term string, weight double")
    with pytest.raises(ValueError):
        nmf_fit(weights, "doc", 2, max_terms=4)
    model = nmf_fit(weights, "doc", 2)
    model.save(spark, str(tmp_path / "topics"))
    again = TopicModel.load(spark, str(tmp_path / "topics"))
    assert again.terms == model.terms and (again.h == model.h).all() and again.sweeps == model.sweeps


def test_pairwise_svm_from_disk(spark, stanzas, tmp_path):
    from strophe.operators.models import PairwiseSVM, fit_one_vs_one, predict

    model = fit_one_vs_one(stanzas, spec=P.text_spec(), classes=CLASSES)
    model.save(str(tmp_path / "svm"))
    again = PairwiseSVM.load(str(tmp_path / "svm"))
    keys = ["id", "stanza_number"] if "stanza_number" in stanzas.columns else ["id"]
    assert sorted(map(tuple, predict(again, stanzas, keys).collect())) == sorted(map(tuple, predict(model, stanzas, keys).collect()))


def test_values_of_a_vector_are_those_it_holds(spark):
    """A wide vector is not filled up with zeros."""
    from pyspark.ml.linalg import Vectors
    from strophe.operators.features import stored_values
    rows = [(1, Vectors.sparse(1_000_000, [3, 70], [0.5, -2.0])), (2, Vectors.dense([0.0, 4.0])), (3, Vectors.sparse(5, [], []))]
    df = spark.createDataFrame(rows, ["id", "v"])
    assert [r.v for r in df.select("id", stored_values(F.col("v")).alias("v")).orderBy("id").collect()] == [[0.5, -2.0], [0.0, 4.0], []]


def test_rows_are_dealt_by_their_size_in_the_learner(spark):
    from pyspark.ml.linalg import Vectors
    from strophe.sources.staging import stage
    rows = stage(spark.createDataFrame([(Vectors.sparse(10_000, [i], [1.0]), float(i % 2)) for i in range(100)], ["features", L.INDEX]).coalesce(1))
    parts = L.dealt(rows, task_bytes=1_000_000).rdd.glom().map(len).collect()
    assert len(parts) == 4 and sum(parts) == 100 and max(parts) <= 40
    assert L.dealt(rows).rdd.getNumPartitions() == 1 and L.dealt(rows.where("false")).count() == 0


def test_a_vocabulary_of_more_than_262144_terms(spark):
    """The titles of a few million rows have more; they were refused."""
    from strophe.operators.features import fit_features

    words = spark.range(400).selectExpr("id", "concat_ws(' ', 'both', 'both', transform(sequence(1, 700), i -> concat('w', id * 700 + i))) AS title")
    model = fit_features(words, FeatureSpec(texts=[TextColumn("title")], scaled=(), booleans=()))
    row = model.transform(words).where("id = 3").first()
    idf = np.log(401 / 2) + 1
    length = np.sqrt(4 + 700 * idf ** 2)
    assert len(row.features) == 280_001 and row.features.numNonzeros() == 701
    assert row.features[0] == pytest.approx(2 / length) and np.allclose(row.features.values[1:], idf / length)


def test_a_vocabulary_sent_at_once_is_the_librarys(spark):
    """Words in their order, with any letters in them."""
    from pyspark.ml.feature import CountVectorizerModel
    from strophe.operators.features import _counter

    for words in (["a b", "\\n", "\n", "été", "\U00010400x", "$^|."], ["one\x01two", "x"]):
        ours, theirs = _counter(words, "t", "c"), CountVectorizerModel.from_vocabulary(words, "t", "c")
        assert ours.vocabulary == theirs.vocabulary == words
        assert (ours.getInputCol(), ours.getOutputCol(), ours.getVocabSize()) == ("t", "c", len(words))
        df = spark.createDataFrame([([words[-1], words[0], words[0]],)], ["t"])
        assert ours.transform(df).first()["c"] == theirs.transform(df).first()["c"]
