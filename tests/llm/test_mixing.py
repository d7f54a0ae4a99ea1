import pytest
from pyspark.sql import functions as F

from strophe.llm.mixing import Mix, meet, mixed, op9_mix_sources, source_targets

FOLDER = "/root/testdata/sf0.001"


def targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """The rule as it is told: divide by weight, cap, reshare what is over until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    out, open_, left = {}, set(names), share * sum(sizes.values())
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] >= most * sizes[s]}
        if not over:
            return out | {s: level * weight[s] for s in open_}
        for s in over:
            out[s] = most * sizes[s]
            left -= out[s]
        open_ -= over
    return out


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 100, "c": 100}, {"a": 1, "b": 5000, "c": 3, None: 40}, {"é": 7, "z": 9, "Z": 1000, "": 50}, {None: 10}, {"a": 0, "b": 10},
    {"a": 0, "b": 0}])
def test_targets(spark, sizes):
    rows = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r.source: r.target for r in source_targets(rows).collect()}
    assert got == pytest.approx(targets(sizes))


def test_meeting_keeps_words_and_expectations():
    for a, p, b, q in ((10, .3, 4, .6), (5, .5, 5, .5), (1, .9, 100, .01), (7, .2, 3, .99)):
        up, down = meet(a, p, b, q, 0.0), meet(a, p, b, q, 1 - 1e-12)
        for x, y in (up, down):
            assert a * x + b * y == pytest.approx(a * p + b * q) and (x in (0, 1) or y in (0, 1)) and 0 <= x <= 1 and 0 <= y <= 1
        gain, loss = a * (up[0] - p), a * (p - down[0])  # first with probability loss / (gain + loss)
        assert loss * gain - gain * loss == 0 and gain > 0 and loss > 0


def check_mix(rows, group=None):
    by = {}
    for r in rows:
        by.setdefault(r.source, []).append(r)
    want = targets({s: sum(r.size for r in rs) for s, rs in by.items()})
    for source, rs in by.items():
        size = sum(r.size for r in rs)
        assert {r.source_size for r in rs} == {size}
        assert all(r.target == pytest.approx(want[source]) for r in rs)
        assert all(0 <= r.copies <= 2 for r in rs)
        assert abs(sum(r.copies * r.size for r in rs) - want[source]) <= max(r.size for r in rs) / 2 + 1e-6


def test_awkward_rows(documents, awkward):
    rows = Mix().copies(documents(awkward)).collect()
    assert len(rows) == len(awkward)
    check_mix(rows)


def test_empty_table(documents):
    assert Mix().copies(documents([])).count() == 0 and mixed(documents([]), Mix()).count() == 0


@pytest.mark.parametrize("group,fan", [(4096, 64), (5, 2)])
def test_tree_reaches_targets(spark, group, fan):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("source"),
                                    (F.xxhash64("id") % 50 + 60).alias("size"))
    mix = Mix(group=group, fan=fan)
    rows = mix.copies(docs, size=F.col("size")).collect()
    check_mix(rows)
    again = mix.copies(docs.repartition(7), size=F.col("size")).collect()
    assert sorted((r.id, r.copies) for r in rows) == sorted((r.id, r.copies) for r in again)


def test_copies_follow_expectation(spark):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 200, "a").otherwise("b").alias("source"), (F.col("id") % 17 + 3).alias("size"))
    total = 0
    for seed in range(6):
        rows = Mix(seed=seed).copies(docs, size=F.col("size")).where("source = 'a' and size < 10").collect()
        total += sum(r.copies for r in rows) / len(rows) / 6
        want = rows[0].target / rows[0].source_size
    assert total == pytest.approx(want, abs=0.12)


def test_mixed_repeats_whole_rows(documents, prose):
    docs = documents([(i, prose + f" {i}", f"s{i % 4}") for i in range(40)] + [(0, prose + " 0", "s0"), (None, None, None)])
    out = mixed(docs, Mix())
    assert out.columns == docs.columns
    want = {}
    for r in Mix().copies(docs.withColumn("r", F.lit(1))).collect():
        want[r.source] = r.target
    got = {r.source: r.n for r in out.groupBy("source").agg(F.sum(F.size(F.split("text", " "))).alias("n")).collect()}
    assert all(abs(got.get(s, 0) - t) <= 21 for s, t in want.items())


def test_query(spark):
    docs = {r.doc_id: (len(r.text.split()), r.source) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = op9_mix_sources(spark, FOLDER).collect()
    want = targets({s: sum(n for n, t in docs.values() if t == s) for _, s in docs.values()})
    assert all(r.target == pytest.approx(want[docs[r.doc_id][1]]) and r.taken <= 2 * r.size for r in rows) and len(rows) == len(docs)
