"""Forests over sparse rows."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from strophe.operators import forests as G
from strophe.operators.models import INDEX, fitted, random_forest
from strophe.sources.staging import stage


def table(spark, rows):
    return stage(spark.createDataFrame([(v, float(y), float(w)) for v, y, w in rows], ["features", INDEX, "weight"]))


def mixed(n, width=40, seed=1):
    """Sparse rows of three classes; feature 0 has negative values, the last one none at all."""
    draw = np.random.default_rng(seed)
    for i in range(n):
        y = i % 3
        at = np.unique(np.append(draw.integers(0, width - 1, 6), y + 1 if draw.random() < .8 else 5))
        yield Vectors.sparse(width, [(int(j), float(round(draw.normal(), 2)) if j == 0 else float(1 + j % 4)) for j in at]), y, 1 + i % 2


def nodes(tree):
    return [line.strip() for line in tree.toDebugString.splitlines()[1:]]


@pytest.mark.parametrize("options", [{}, {"weight": "weight", "min_leaf": 4}, {"impurity": "entropy", "max_features": "all"}])
def test_levels_by_jobs_give_the_trees_grown_in_one_task(spark, monkeypatch, options):
    """Counts of many blocks add up to those of one; without bags nothing else depends on the blocks."""
    ready = table(spark, mixed(300))
    learner = random_forest(trees=6, depth=6, bootstrap=False, **options)
    one = fitted(learner, ready)
    monkeypatch.setattr(G, "BLOCK", 32)
    monkeypatch.setattr(G, "PAIRS", 64)
    many = fitted(learner, ready)
    assert [nodes(t) for t in one.trees] == [nodes(t) for t in many.trees]
    assert one.totalNumNodes > 6 * 9


def test_a_tree_of_all_features_is_the_librarys(spark):
    """Few distinct values, so both have the same cuts; predictions and counts at the leaves are equal."""
    ready = table(spark, mixed(400))
    learner = random_forest(trees=1, depth=5, bootstrap=False, max_features="all")
    ours, theirs = fitted(learner, ready), learner.fit(ready)
    assert ours.totalNumNodes == theirs.totalNumNodes
    raw = [[list(r[0]) for r in m.transform(ready).select("rawPrediction").collect()] for m in (ours, theirs)]
    assert np.allclose(*raw)
    assert np.allclose(ours.featureImportances.toArray(), theirs.featureImportances.toArray())


@pytest.mark.parametrize("block", [G.BLOCK, 500])
def test_wide_rows_cost_what_they_hold(spark, monkeypatch, block):
    """3,000 rows of 2,000,000 features are 24 GB as a bin for each feature of each row, more than a session here has."""
    monkeypatch.setattr(G, "BLOCK", block)
    width = 2_000_000
    draw = np.random.default_rng(3)
    rows = [(Vectors.sparse(width, {int(j): 1.0 for j in [i % 2, *draw.integers(2, width, 20)]}), i % 2, 1) for i in range(3000)]
    ready = table(spark, rows)
    model = fitted(random_forest(trees=2, depth=2, max_features="all"), ready)
    assert model.numFeatures == width and [t.numNodes for t in model.trees] == [3, 3]
    assert model.transform(ready).where(f"prediction != {INDEX}").count() == 0


def test_a_feature_outside_the_sample_can_be_split(spark, monkeypatch):
    """Thresholds come from a sample, but every feature has one at zero."""
    monkeypatch.setattr(G, "SAMPLE", 1)
    rows = [(Vectors.sparse(3, {1: 2.0} if i < 5 else {2: 1.0}), int(i < 5), 1) for i in range(2000)]
    model = fitted(random_forest(trees=1, depth=1, bootstrap=False, max_features="all"), table(spark, rows))
    assert model.totalNumNodes == 3 and model.trees[0].transform(table(spark, rows)).where(f"prediction != {INDEX}").count() == 0


def test_small_forests(spark):
    """One class, no values at all, no rows."""
    empty = table(spark, [(Vectors.sparse(2, {}), y, 1) for y in (0, 1, 1)])
    model = fitted(random_forest(trees=3, depth=3, bootstrap=False), empty)
    assert model.totalNumNodes == 3 and model.predict(Vectors.dense([1.0, 2.0])) == 1
    assert fitted(random_forest(trees=2, depth=3), table(spark, [(Vectors.dense([1.0]), 0, 1), (Vectors.dense([2.0]), 0, 1)])).numClasses == 1
    with pytest.raises(ValueError):
        fitted(random_forest(trees=2), empty.where("false"))


def test_staged_rows_carry_no_names_of_features(spark, monkeypatch):
    """The names of all terms are in the schema of an assembled vector; every task of every pass of a fit would read them."""
    from strophe.operators import models as M
    from strophe.operators.features import FeatureSpec, TextColumn

    seen = []
    monkeypatch.setattr(M, "stage", lambda df: seen.append(stage(df)) or seen[-1])
    rows = spark.createDataFrame([(f"word{i} {'left' if i % 2 else 'right'}", "ab"[i % 2]) for i in range(200)], ["t", "label"])
    spec = FeatureSpec(texts=[TextColumn("t")], scaled=(), booleans=())
    svm = lambda ready: M.svm_one_vs_rest(0.9, ready.count(), max_iter=5)
    models = [M.fit_classifier(rows, svm, spec, classes=["a", "b"]), M.fit_one_vs_one(rows, spec=spec, classes=["a", "b"], max_iter=5)]
    assert len(seen) == 2 and all(len(df.schema["features"].json()) < 1000 for df in seen)
    for model in models:
        assert M.predict(model, rows, ["label"]).where("label != predicted").count() == 0


def test_the_forest_search_reads_all_rows(spark, monkeypatch, tmp_path):
    """It fitted about 2,000 rows by the hash of the id."""
    from strophe.catalog import QUERIES
    from strophe.plans import training as P

    rows = [(i, f"word{i % 7} text", ["de", "en", "es", "fr"][i % 4], "src1", 10 + i) for i in range(2600)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    seen = []

    def search(train, **options):
        seen.append((train.count(), options.get("tasks")))
        return {}, spark.createDataFrame([(0, 5, 0.9)], "draw int, folds int, accuracy double")

    monkeypatch.setattr(P, "search_forest", search)
    assert QUERIES["forest_search"](spark, str(tmp_path)).count() == 1
    assert seen == [(2600, None)]


def grown(rows, common, monkeypatch):
    """A forest over one block, grown here, and how many entries of columns it went through."""
    import pyarrow as pa

    monkeypatch.setattr(G, "COMMON", common)
    batch = pa.RecordBatch.from_pydict({
        "feature": pa.array([v.indices.tolist() for v, _, _ in rows], pa.list_(pa.int32())), "value": pa.array([v.values.tolist() for v, _, _ in rows]),
        "y": pa.array([y for _, y, _ in rows], pa.int32()), "weight": np.array([float(w) for _, _, w in rows])})
    bins = G.Bins(40, np.repeat(np.arange(40), 4), np.tile([-1.0, .5, 1.0, 2.0], 40))
    block, seen = G.Block(G._packed(0, batch, bins)), []
    block.arrange(bins)
    cells = block.cells
    block.cells = lambda feature: (seen.append(len(c[0])) or c for c in cells(feature))
    plan = {"trees": 5, "depth": 12, "min_leaf": 1, "bootstrap": True, "impurity": "gini", "seed": 1, "width": 40, "classes": 3, "take": 7}
    trees = np.arange(5)
    forest = G.Forest(plan, trees, G.Forest(plan, trees, np.zeros((5, 4))).totals(block))
    forest.grow(lambda f, nodes: f.best(bins, f.counts(block, bins, nodes, f.subset)))
    return forest, sum(seen)


def test_common_features_are_looked_up_by_the_rows_of_a_node(monkeypatch):
    """The same trees whichever features are common; a node no longer goes through whole columns, which took most of a fit of texts."""
    rows = list(mixed(700))
    none, entries = grown(rows, 0, monkeypatch)
    some, fewer = grown(rows, 8, monkeypatch)
    every, nothing = grown(rows, 1 << 30, monkeypatch)
    assert len(none.slot) > 200 and nothing == 0 < fewer < entries
    for other in (some, every):
        for name in ("slot", "number", "feature", "bin", "left", "gain", "stats"):
            assert np.array_equal(getattr(none, name), getattr(other, name))


def test_counts_come_in_parts(spark, monkeypatch):
    """A task adds up the counts of its blocks and sends them when they are many; a node's counts may come in several batches."""
    ready = table(spark, mixed(300))
    learner = random_forest(trees=6, depth=6, bootstrap=False, max_features="all")
    one = fitted(learner, ready)
    monkeypatch.setattr(G, "BLOCK", 20)
    monkeypatch.setattr(G, "CELLS", 500)
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "60")
    try:
        many = fitted(learner, ready)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    assert [nodes(t) for t in one.trees] == [nodes(t) for t in many.trees]
