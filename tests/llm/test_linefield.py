from itertools import product

import numpy as np
import pytest

from strophe.llm import linefield as L

FOLDER = "/root/testdata/sf0.01"


def brute_force(weights, features, label=None):
    """Marginals and the log-likelihood of a text by all labellings of its lines."""
    n = len(features)
    blank = np.zeros(L.WIDTH)
    x = [np.concatenate([features[t], features[t - 1] if t else blank, features[t + 1] if t + 1 < n else blank]) for t in range(n)]
    total, good, mine = 0.0, np.zeros(n), None
    for labels in product([0, 1], repeat=n):
        score = sum(weights[:-2] @ x[t] for t in range(n) if labels[t])
        score += sum(weights[-2] if a and b else weights[-1] if not a and not b else 0 for a, b in zip(labels, labels[1:]))
        total += np.exp(score)
        good += np.exp(score) * np.array(labels)
        if label is not None and all(y == label for y in labels):
            mine = score
    return good / total, None if mine is None else (mine - np.log(total)) / n


@pytest.fixture
def lines_of():
    rng = np.random.default_rng(3)
    lines = np.array([3, 1, 8, 2, 5])
    return rng.normal(size=L.SIZE) * 0.4, rng.normal(size=(lines.sum(), L.WIDTH)), lines, np.array([1.0, 0, 0, 1, 1])


def test_marginals_and_gradient_equal_enumeration(lines_of, monkeypatch):
    weights, features, lines, labels = lines_of
    parts = np.split(features, np.cumsum(lines)[:-1])
    want = np.concatenate([brute_force(weights, p)[0] for p in parts])
    for cells in (1, 10, 1 << 18):  # however the texts are put together
        monkeypatch.setattr(L, "CELLS", cells)
        got, gradient = L._marginals(weights, features, lines, labels)
        assert np.allclose(got, want)
    def loss(w):
        return sum(brute_force(w, p, y)[1] for p, y in zip(parts, labels))
    for k in range(L.SIZE):
        step = np.eye(L.SIZE)[k] * 1e-5
        assert gradient[k] == pytest.approx((loss(weights + step) - loss(weights - step)) / 2e-5, abs=1e-4)


def test_features_by_plain_counting():
    text = "Ab cd cd 12 !\n\n##é é, x"
    features, length, lines = L.line_features([text, "", None, "q\n"])
    assert lines.tolist() == [3, 1, 1, 2] and length.tolist() == [13, 0, 8, 0, 0, 1, 0]
    at = dict(zip(L.FEATURES, features[0]))
    assert at["upper"] == 2 * 1 / 7 and at["digits"] == 10 * 2 / 14 and at["calls"] == 10 / 14 and at["repeats"] == 2 / 6
    at = dict(zip(L.FEATURES, features[2]))
    assert at["signs"] == 10 * 2 / 9 and at["stops"] == 10 / 9 and at["other letters"] == 10 * 2 / 9 / 4 and at["few words"] == 1
    long = " ".join(["word"] * 50_000)
    alone = L.line_features([long])
    assert np.allclose(L.line_features(["x", long, "y"])[0][1], alone[0][0])


def test_query_on_held_out_documents(spark):
    mine = L.op13_line_quality(spark, FOLDER)
    assert mine.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    rows = {r.doc_id: r for r in mine.collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    held = [d for d in labels if rows[d].held_out]
    right = sum(rows[d].predicted == labels[d] for d in held) / len(held)
    assert len(held) > 60 and right >= 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows.values())


def test_held_out_labels_and_other_columns_change_nothing(spark, documents, prose):
    rows = [(k, prose + f" {k}\n" + prose if k % 2 else "JUNK!! " * 20 + f"### {k}") for k in range(40)]
    docs = documents(rows)
    known = spark.createDataFrame([(k, k % 2) for k in range(40)] + [(3, None), (None, 0), (99, 1)], "doc_id long, quality int")
    field = L.fit(L.training_rows(docs, known), rounds=15)
    scores = {r.doc_id: r.score for r in L.label_lines(docs, field).collect()}
    assert all((scores[k] >= 0.7) == bool(k % 2) for k in range(40))
    again = L.fit(L.training_rows(docs.withColumnsRenamed({"lang": "label"}).withColumn("features", docs.text), known.repartition(7)), rounds=15)
    assert np.allclose(field.weights, again.weights, atol=1e-5)


def test_awkward_rows(spark, documents, awkward):
    none = L.fit(L.training_rows(documents(awkward), spark.createDataFrame([], "doc_id long, quality int")))
    assert not any(none.weights)
    field = L.Field(tuple(np.random.default_rng(5).normal(size=L.SIZE).round(3).tolist()))
    got = L.label_lines(documents(awkward).repartition(3), field).collect()
    assert len(got) == len(awkward)
    for r in got:
        assert 0 <= r.score <= 1 and sum(x.length + 1 for x in r.lines) > 0
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, []).append(r.score)
    assert by_id[1] == by_id[2] and len(set(by_id[5])) == 1  # null as empty; repeated rows alike
    for doc, text in [(10, awkward[-3][1]), (6, awkward[6][1])]:
        want = brute_force(np.array(field.weights), L.line_features([text])[0])[0]
        weight = np.array([len(x) + 1 for x in text.split("\n")])
        assert by_id[doc][0] == pytest.approx((want * weight).sum() / weight.sum())
    assert L.label_lines(documents(awkward).limit(0), field).count() == 0
