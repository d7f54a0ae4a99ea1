"""Approximate nearest neighbours by cosine: a forest of random-projection trees.

*Fit.*  Trees are grown on a bounded sample (``sample`` rows, by hash of the id): a node
projects on the difference of two random members and cuts at the median.
*Index.*  Every row walks down every tree to a leaf.  Of equal vectors only the ``k + 1`` of
smallest id enter, since no answer can hold others; a repeated id counts once among them.
*Search.*  A query walks all trees through one priority queue, ordered by the largest margin
by which a branch was missed, until the leaves seen hold ``visit`` times as many entries as
there are vectors.  Queries and vectors meet leaf by leaf, both in blocks of bounded size,
and each block hands on the ``k`` best ids.
*Rerank.*  Scores are the exact cosine in double precision of the original vectors.

``visit`` sets the recall.  Data without structure need about 1 (an entry counts once per
tree, and a vector is met in several); clustered data need far less.

Nulls: vectors that are null, zero, or hold null or non-finite components take no part,
nor do vectors of another length than most, nor rows without id.  Rows that repeat an id
count as one with the best score, and never as their own neighbour.  Ties go to the smaller
id.  Other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..sources.staging import stage
from .base import query, table


@dataclass(frozen=True)
class Forest:
    """Directions and cuts of each tree; node ``i`` has the children ``2i`` and ``2i + 1``."""

    directions: np.ndarray  # trees x nodes x dimensions
    cuts: np.ndarray  # trees x nodes

    @property
    def depth(self) -> int:
        return int(self.cuts.shape[1]).bit_length() - 1

    @staticmethod
    def grow(sample: np.ndarray, trees: int, depth: int, seed: int) -> Forest:
        rng = np.random.default_rng(seed)
        directions = np.zeros((trees, 1 << depth, sample.shape[1]))
        cuts = np.zeros((trees, 1 << depth))
        for tree in range(trees):
            members = {1: np.arange(len(sample))}
            for node in range(1, 1 << depth):
                mine = members.pop(node)
                way = np.subtract(*sample[rng.choice(mine, 2)]) if len(mine) else np.zeros(sample.shape[1])
                if not way.any():
                    way = rng.normal(size=sample.shape[1])
                way /= np.linalg.norm(way)
                along = sample[mine] @ way
                cut = np.median(along) if len(mine) else 0.0
                directions[tree, node], cuts[tree, node] = way, cut
                members[2 * node], members[2 * node + 1] = mine[along < cut], mine[along >= cut]
        return Forest(directions, cuts)

    def leaves(self, vectors: np.ndarray) -> np.ndarray:
        """Trees x vectors: the cell (tree and leaf as one number) of each unit vector."""
        out = np.empty((len(self.cuts), len(vectors)), np.int64)
        for tree, (ways, cuts) in enumerate(zip(self.directions, self.cuts)):
            node = np.ones(len(vectors), np.int64)
            for _ in range(self.depth):
                node = 2 * node + ((vectors * ways[node]).sum(1) >= cuts[node])
            out[tree] = tree * len(cuts) + node - len(cuts)
        return out

    def search(self, vector: np.ndarray, sizes: np.ndarray, enough: float) -> list[int]:
        """Cells nearest to a unit vector, all trees in one queue, until they hold ``enough`` entries."""
        width, found, held = self.cuts.shape[1], [], 0
        queue = [(0.0, tree, 1) for tree in range(len(self.cuts))]
        while queue and held < enough:
            margin, tree, node = heapq.heappop(queue)
            while node < width:
                side = float(self.directions[tree, node] @ vector - self.cuts[tree, node])
                near = 2 * node + (side >= 0)
                heapq.heappush(queue, (max(margin, abs(side)), tree, near ^ 1))
                node = near
            cell = tree * width + node - width
            if sizes[cell]:
                found.append(cell)
                held += int(sizes[cell])
        return found


def _matrix(column: pa.ChunkedArray | pa.Array, dims: int) -> np.ndarray:
    flat = column.combine_chunks().flatten() if isinstance(column, pa.ChunkedArray) else column.flatten()
    return flat.to_numpy(zero_copy_only=False).reshape(-1, dims)


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(1, keepdims=True))


@dataclass(frozen=True)
class NearestNeighbours:
    k: int = 5
    trees: int = 8
    leaf: int = 256
    sample: int = 16_384
    visit: float = 1.1
    block: int = 4096
    seed: int = 1

    def usable(self, rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
        vector = F.col(vector_col).cast("array<double>")
        fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        return (rows.select(F.col(id_col).cast("long").alias("id"), vector.alias("vector"))
                .where(F.col("id").isNotNull() & F.col("vector").isNotNull())
                .where(fine & F.exists("vector", lambda x: x != 0)))

    def search(self, rows: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
        """``(query_id, rank, id, score)``: the nearest found of each row that ``is_query`` (over ``id``) picks."""
        k, dims_of = self.k, F.size("vector")
        usable = stage(self.usable(rows, id_col, vector_col))
        lengths = usable.groupBy(dims_of.alias("d")).count().orderBy(F.desc("count"), "d").first()
        dims = lengths["d"] if lengths else 1
        usable = usable.where(dims_of == dims)
        alike = Window.partitionBy("vector").orderBy("id")
        vectors = stage(usable.dropDuplicates(["id", "vector"]).withColumn("_n", F.row_number().over(alike)).where(F.col("_n") <= k + 1).drop("_n"))
        queries = usable.where(is_query)
        total, n_queries = vectors.count(), queries.count()

        picked = vectors.orderBy(F.xxhash64("id", F.lit(self.seed)), "id").limit(self.sample).select("vector").toArrow()
        sample = _unit(_matrix(picked.column(0), dims)) if len(picked) else np.zeros((0, dims))
        leaves = max(1, min(total // self.leaf, len(sample) // 8))
        forest = rows.sparkSession.sparkContext.broadcast(Forest.grow(sample, self.trees, leaves.bit_length() - 1, self.seed))

        def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                cells = forest.value.leaves(_unit(_matrix(batch.column(1), dims)))
                for tree in cells:
                    yield pa.RecordBatch.from_arrays([pa.array(tree), *batch.columns], ["cell", "id", "vector"])

        filed = vectors.mapInArrow(file, "cell long, id long, vector array<double>")
        # One row per leaf of the forest, which the sample bounds.
        held = filed.groupBy("cell").count().toPandas()
        sizes = np.zeros(forest.value.cuts.size, np.int64)
        sizes[held["cell"].to_numpy(np.int64)] = held["count"].to_numpy(np.int64)
        sizes = rows.sparkSession.sparkContext.broadcast(sizes)
        block, enough, lots = self.block, self.visit * total, max(1, -(-n_queries // self.block))

        def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                out = []
                for id_, vector in zip(frame["id"], frame["vector"]):
                    unit = _unit(np.asarray(vector)[None])[0]
                    out.extend((c, b, id_, vector) for c in forest.value.search(unit, sizes.value, enough)
                               for b in range(-(-int(sizes.value[c]) // block)))
                yield pd.DataFrame(out, columns=["cell", "block", "id", "vector"])

        tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        asked = (queries.repartition(tasks, "id").mapInPandas(ask, "cell long, block int, id long, vector array<double>")
                 .withColumn("lot", F.pmod(F.xxhash64("id"), F.lit(lots)).cast("int")))

        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                parts = -(-sizes.value[batch.column(0).to_numpy()] // block)
                at = batch.column(1).to_numpy().view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)
                mine = pa.array((at.astype(np.int64) % parts).astype(np.int32))
                for lot in range(lots):
                    yield pa.RecordBatch.from_arrays([*batch.columns, mine, pa.array(np.full(len(mine), lot, np.int32))],
                                                     ["cell", "id", "vector", "block", "lot"])

        dealt = filed.mapInArrow(deal, "cell long, id long, vector array<double>, block int, lot int")

        def compare(left: pa.Table, right: pa.Table) -> pa.Table:
            found: list[tuple[int, int, float]] = []
            if len(left) and len(right):
                q_ids, ids = left.column("id").to_numpy(), right.column("id").to_numpy()
                q, v = _matrix(left.column("vector"), dims), _matrix(right.column("vector"), dims)
                # Rows of one id stand next to each other, so that the best of each id can be taken.
                order = np.argsort(ids, kind="stable")
                ids, v = ids[order], v[order]
                starts = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
                q_norm, norm = np.sqrt((q * q).sum(1)), np.sqrt((v * v).sum(1))
                for a in range(0, len(q), 256):
                    near = (q[a:a + 256] @ v.T) / q_norm[a:a + 256, None] / norm
                    near[q_ids[a:a + 256, None] == ids] = -2
                    best = near if len(starts) == len(ids) else np.maximum.reduceat(near, starts, axis=1)
                    best = best if len(starts) <= k else np.partition(best, -k, 1)[:, -k:]
                    for i, j in zip(range(a, a + len(near)), near >= best.min(1, keepdims=True) - 1e-9):
                        at = np.flatnonzero(j & (ids != q_ids[i]))
                        # The same sum for every row, so equal vectors score alike.
                        score = (v[at] * q[i]).sum(1) / (norm[at] * q_norm[i])
                        seen = set()
                        for n in np.lexsort((ids[at], -score)):
                            if len(seen) == k:
                                break
                            if ids[at[n]] not in seen:
                                seen.add(ids[at[n]])
                                found.append((q_ids[i], ids[at[n]], score[n]))
            columns = zip(*found) if found else ([], [], [])
            return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64()))],
                            names=["query_id", "id", "score"])

        keys = ["cell", "block", "lot"]
        found = asked.groupBy(*keys).cogroup(dealt.groupBy(*keys)).applyInArrow(compare, "query_id long, id long, score double")
        found = found.groupBy("query_id", "id").agg(F.max("score").alias("score"))
        best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
        return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")


@query()
def op10_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    found = NearestNeighbours().search(table(spark, folder, "embeddings"), F.col("id") % 50 == 0)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")
