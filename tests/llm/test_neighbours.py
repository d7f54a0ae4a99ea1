from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from strophe.llm.neighbours import Forest, NearestNeighbours, op10_nearest_neighbours


def brute_force(rows, is_query, k=5):
    usable, dims = {}, Counter(len(v) for _, v in rows if v is not None).most_common(1)[0][0]
    for i, v in rows:
        if i is not None and v is not None and len(v) == dims and None not in v and np.isfinite(v).all() and np.any(v):
            usable.setdefault(i, []).append(np.array(v, float))
    out = {}
    for q, vectors in usable.items():
        if not is_query(q):
            continue
        scores = {i: max((v * w).sum() / np.sqrt((v * v).sum()) / np.sqrt((w * w).sum()) for v in vs for w in vectors)
                  for i, vs in usable.items() if i != q}
        out[q] = sorted(scores.items(), key=lambda x: (-round(x[1], 12), x[0]))[:k]
    return out


def table(spark, rows):
    return spark.createDataFrame([(i, v, "x", 0.5) for i, v in rows], "vec_id long, embedding array<float>, id string, score double")


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: r.rank):
        out.setdefault(r.query_id, []).append((r.id, r.score))
    return out


def check(spark, rows, search, exact=True):
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    got = found(search.search(table(spark, rows), F.col("id") % 10 == 0))
    want = brute_force(rows, lambda i: i % 10 == 0)
    assert got.keys() == want.keys()
    hits = 0
    for q in want:
        assert len(got[q]) == len(want[q]) and [s for _, s in got[q]] == sorted((s for _, s in got[q]), reverse=True)
        hits += len({i for i, _ in got[q]} & {i for i, _ in want[q]})
        if exact:
            assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
            assert [s for _, s in got[q]] == pytest.approx([s for _, s in want[q]], abs=1e-12)
    return hits / max(1, sum(map(len, want.values())))


def test_awkward_vectors(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=4).tolist()
    rows = [(i, rng.normal(size=4).tolist()) for i in range(60)] + [(100 + i, base) for i in range(30)]
    rows += [(200, None), (201, [0.0] * 4), (202, [1.0, None, 0.0, 2.0]), (203, [float("nan")] * 4), (204, [float("inf"), 0, 0, 0]),
             (205, [1.0, 2.0]), (None, base), (10, base), (210, []), (30, rows[30][1])]
    check(spark, rows, NearestNeighbours())


def test_ids_repeated_often(spark):
    rng = np.random.default_rng(4)
    base, other = rng.normal(size=4), rng.normal(size=4)
    rows = [(1000 + i, rng.normal(size=4).tolist()) for i in range(1, 9)]
    rows += [(10, (base + 0.01).tolist())] + [(8, base.tolist())] * 9 + [(i, base.tolist()) for i in (9, 11, 12, 13)]
    check(spark, rows, NearestNeighbours())
    rows = [(1000 + i, rng.normal(size=4).tolist()) for i in range(1, 9)]
    rows += [(20, other.tolist())] + [(21, (other + 0.001 * rng.normal(size=4)).tolist()) for _ in range(12)]
    check(spark, rows, NearestNeighbours())
    check(spark, rows, NearestNeighbours(block=3))


def test_few_rows(spark):
    check(spark, [(10, [1.0, 0.0]), (11, [0.0, 1.0])], NearestNeighbours())
    assert NearestNeighbours().search(table(spark, [(10, [1.0, 0.0])]), F.lit(True)).count() == 0
    assert NearestNeighbours().search(table(spark, []), F.lit(True)).count() == 0
    assert NearestNeighbours().search(table(spark, [(1, None)]), F.lit(True)).count() == 0


def test_recall_and_small_blocks(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(20, 16)) * 3
    rows = [(i, (centres[i % 20] + rng.normal(size=16)).tolist()) for i in range(2000)]
    recall = check(spark, rows, NearestNeighbours(leaf=32, visit=0.5, block=7), exact=False)
    assert recall >= 0.9


def test_leaves_and_search_agree():
    rng = np.random.default_rng(3)
    sample = rng.normal(size=(500, 8))
    sample /= np.linalg.norm(sample, axis=1, keepdims=True)
    forest = Forest.grow(sample, 3, 4, 1)
    cells = forest.leaves(sample)
    sizes = np.bincount(cells.ravel(), minlength=forest.cuts.size)
    for at in range(20):
        assert set(forest.search(sample[at], sizes, 1)) <= set(cells[:, at])
        assert sorted(forest.search(sample[at], sizes, 10 ** 9)) == np.flatnonzero(sizes).tolist()


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    got, want = {}, brute_force(rows, lambda i: i % 50 == 0)
    for r in op10_nearest_neighbours(spark, folder).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert got.keys() == want.keys()
    assert sum(len(got[q] & {i for i, _ in want[q]}) for q in want) >= 0.9 * sum(map(len, want.values()))
