"""Random forests over sparse rows.

The library's own learner holds a bin for every feature of every row and reads all rows once for each group of nodes.  Here a row
keeps only the features it has, and one job grows a level of all trees:

* values become bins once; thresholds are percentiles of a feature's values in about ``SAMPLE`` rows, as in the library, and every
  feature, seen in that sample or not, can be split at zero;
* rows are packed into blocks of at most ``BLOCK``, sorted by feature; a task sets out the features that many rows of a block have as a
  table of bins, where a node looks at its own rows only, and goes through the few rows of any other feature;
* a task sends the rows of its blocks down the trees and counts classes by node, feature and bin; a feature's rows without a value
  are the node's total less the others;
* the counts of a node meet in one task, which finds its best split; the driver gets one row for each node.

A table of one block is grown without a job for each level: its counts are the totals already, so trees are dealt to tasks.
The result is the library's model, written in its saved form and loaded.
"""

from __future__ import annotations

import itertools
import json
import math
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassificationModel, RandomForestClassifier
from pyspark.sql import Column, DataFrame, functions as F

from ..sources.staging import shared_folder, stage

BLOCK, BINS, SAMPLE = 10_000, 32, 10_000
PAIRS = 1 << 23  # nodes times features that are looked at by one job
CELLS = 1 << 21  # values of a block that are looked at at a time
COMMON = 64  # a feature that one of so many rows of a block has, or more, is common there
_MODELS = "org.apache.spark.ml.classification."
_BLOCK_SCHEMA = "id long, n long, feature binary, start binary, row binary, bin binary, y binary, weight binary"
_COUNTS = "node int, feature int, bin int, label int, weight double, count double"
_SPLITS = "node int, feature int, bin int, gain double, left array<double>"
_NODES = ("tree int, id int, prediction double, impurity double, stats array<double>, rows long, gain double, "
          "left int, right int, feature int, threshold array<double>")


class Bins:
    """The thresholds of all features: bin ``b`` of a feature holds the values above its threshold ``b - 1`` and up to ``b``."""

    def __init__(self, width: int, feature: np.ndarray, value: np.ndarray):
        every = np.arange(width)
        feature = np.concatenate([every, every, feature])
        value = np.concatenate([np.full(width, -5e-324), np.zeros(width), value])  # below zero, zero, above
        self.width, self.levels = width, np.unique(value)
        self.keys = np.unique(feature * (len(self.levels) + 1) + np.searchsorted(self.levels, value))
        self.start = np.searchsorted(self.keys, np.arange(width + 1) * (len(self.levels) + 1))
        self.most = int(np.diff(self.start).max()) + 1
        self.zero = self.of(every, np.zeros(width))

    def of(self, feature: np.ndarray, value: np.ndarray) -> np.ndarray:
        below = np.searchsorted(self.levels, value)
        return np.searchsorted(self.keys, feature.astype(np.int64) * (len(self.levels) + 1) + below) - self.start[feature]

    def threshold(self, feature: np.ndarray, bin: np.ndarray) -> np.ndarray:
        return self.levels[self.keys[self.start[feature] + bin] % (len(self.levels) + 1)]


def _cells(vector: Column) -> tuple[Column, Column]:
    """The positions and values that a vector holds."""
    v = F.unwrap_udt(vector)
    return F.coalesce(v["indices"], F.sequence(F.lit(0), F.size(v["values"]) - 1)), v["values"]


def fit_bins(ready: DataFrame, vector: str, width: int, rows: int, seed: int) -> Bins:
    at, values = _cells(F.col(vector))
    seen = ready.sample(min(1.0, SAMPLE / rows), seed).select(F.inline(F.arrays_zip(at.alias("feature"), values.alias("value"))))
    cuts = seen.where("value != 0").groupBy("feature").agg(F.percentile("value", [i / BINS for i in range(1, BINS)]).alias("cuts"))
    found = cuts.select("feature", F.array_distinct("cuts").alias("cuts")).toArrow()  # at most one value for each in the sample, or 31
    sizes = found["cuts"].combine_chunks().value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    return Bins(width, np.repeat(found["feature"].to_numpy().astype(np.int64), sizes), found["cuts"].combine_chunks().flatten().to_numpy())


# Blocks ---------------------------------------------------------------------------------------------------------

def to_blocks(ready: DataFrame, vector: str, label: str, weight: str | None, bins: Bins) -> DataFrame:
    at, values = _cells(F.col(vector))
    rows = ready.select(at.alias("feature"), values.alias("value"), F.col(label).cast("int").alias("y"),
                        (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("weight"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for first in range(0, batch.num_rows, BLOCK):
                yield pa.RecordBatch.from_pylist([_packed(number, batch.slice(first, BLOCK), bins)])
                number += 1

    return rows.mapInArrow(pack, _BLOCK_SCHEMA)


def _packed(number: int, batch: pa.RecordBatch, bins: Bins) -> dict:
    sizes = batch["feature"].value_lengths().to_numpy(zero_copy_only=False)
    feature = batch["feature"].flatten().to_numpy()
    row = np.repeat(np.arange(batch.num_rows, dtype=np.uint16), sizes)
    bin = bins.of(feature, batch["value"].flatten().to_numpy())
    kept = bin != bins.zero[feature]
    order = np.argsort(feature[kept], kind="stable")
    distinct, start = np.unique(feature[kept][order], return_index=True)
    parts = {"feature": distinct.astype(np.int32), "start": np.append(start, len(order)).astype(np.int32),
             "row": row[kept][order], "bin": bin[kept][order].astype(np.uint8),
             "y": batch["y"].to_numpy().astype(np.int32), "weight": batch["weight"].to_numpy()}
    return {"id": number, "n": batch.num_rows} | {k: v.tobytes() for k, v in parts.items()}


_BAG = np.searchsorted(np.cumsum([math.exp(-1) / math.factorial(i) for i in range(9)]), np.arange(65_536) / 65_536).astype(np.uint8)


class Block:
    """Rows as columns of bins."""

    def __init__(self, row: dict):
        kinds = {"feature": np.int32, "start": np.int32, "row": np.uint16, "bin": np.uint8, "y": np.int32, "weight": np.float64}
        self.id, self.n = row["id"], row["n"]
        for name, kind in kinds.items():
            setattr(self, name, np.frombuffer(row[name], kind))

    def arrange(self, bins: Bins) -> None:
        """A place for each feature of the block, and a table of the common ones, at most ``COMMON`` times the rows' mean size wide:
        0 for a row without a value, else its bin and one."""
        size = np.diff(self.start)
        common = np.flatnonzero(size.astype(np.int64) * COMMON >= self.n)
        self.place = np.full(bins.width, -1, np.int32)
        self.place[self.feature] = np.arange(len(self.feature))
        self.column = np.full(len(self.feature) + 1, -1, np.int32)  # the last one is the column of a feature without a place
        self.column[common] = np.arange(len(common))
        self.table = np.zeros((len(common) + 1, self.n), np.uint8)  # with one for none
        of_entry = np.repeat(self.column[:-1], size)
        kept = of_entry >= 0
        self.table[of_entry[kept], self.row[kept]] = self.bin[kept] + 1
        self.even = bool((self.weight == 1).all())

    def bag(self, plan: dict, trees: np.ndarray) -> np.ndarray:
        """How often each tree takes each row: Poisson numbers, the same whenever they are asked for."""
        if not plan["bootstrap"]:
            return np.ones((len(trees), self.n), np.uint8)
        return np.stack([_BAG[np.random.default_rng((plan["seed"], int(t), self.id)).integers(0, 65_536, self.n, np.uint16)] for t in trees])

    def cells(self, feature: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each of some features the entries of its column: (place in ``feature``, entry), in parts of about ``CELLS``."""
        at = self.place[feature]
        which = np.flatnonzero(at >= 0)
        first = self.start[at[which]].astype(np.int64)
        size = self.start[at[which] + 1] - first
        part = np.cumsum(size) // CELLS
        for cut in np.split(np.arange(len(which)), np.flatnonzero(np.diff(part)) + 1):
            total = np.cumsum(size[cut])
            if len(cut) and total[-1]:
                yield np.repeat(which[cut], size[cut]), np.repeat(first[cut] - total + size[cut], size[cut]) + np.arange(total[-1])


# Trees ----------------------------------------------------------------------------------------------------------

class Forest:
    """The nodes of some trees, level by level; of two children the right one follows the left one."""

    def __init__(self, plan: dict, trees: np.ndarray, totals: np.ndarray):
        self.plan, self.trees = plan, trees
        n = len(trees)
        self.slot, self.number, self.stats = np.arange(n), np.zeros(n, np.int64), totals  # place of the tree, number in the tree
        self.sizes = np.ones(n, np.int64)
        self.feature, self.bin, self.left = (np.full(n, -1) for _ in range(3))
        self.gain = np.full(n, -1.0)
        self.levels = [0, n]

    def grow(self, find: Callable[[Forest, np.ndarray], tuple]) -> None:
        """Level by level; ``find(forest, nodes)`` gives best splits as ``(node, feature, bin, gain, left stats)``, by node."""
        wave = max(1, PAIRS // self.plan["take"])
        for _ in range(self.plan["depth"]):
            last = np.arange(*self.levels[-2:])
            stats = self.stats[last]
            mixed = ((stats[:, :-1] > 0).sum(axis=1) > 1) & (stats[:, -1] >= 2 * self.plan["min_leaf"])
            nodes = last[mixed]
            parts = [find(self, nodes[i:i + wave]) for i in range(0, len(nodes), wave)]
            if not any(len(p[0]) for p in parts):
                break
            node, feature, bin, gain, left = (np.concatenate(x) for x in zip(*parts))
            self.feature[node], self.bin[node], self.gain[node] = feature, bin, gain
            first = len(self.slot)
            self.left[node] = first + 2 * np.arange(len(node))
            slot = np.repeat(self.slot[node], 2)
            order = np.argsort(slot, kind="stable")
            within = np.empty(len(slot), np.int64)
            within[order] = np.arange(len(slot)) - np.searchsorted(slot[order], slot[order])
            self.number = np.append(self.number, self.sizes[slot] + within)
            self.sizes += np.bincount(slot, minlength=len(self.sizes))
            self.slot = np.append(self.slot, slot)
            self.stats = np.concatenate([self.stats, np.stack([left, self.stats[node] - left], axis=1).reshape(2 * len(node), -1)])
            self.feature, self.bin, self.left = (np.append(x, np.full(len(slot), -1)) for x in (self.feature, self.bin, self.left))
            self.gain = np.append(self.gain, np.full(len(slot), -1.0))
            self.levels.append(len(self.slot))

    def subset(self, nodes: np.ndarray) -> np.ndarray:
        """The features that each node may split, drawn for it alone."""
        width, take = self.plan["width"], self.plan["take"]
        found = np.empty((len(nodes), take), np.int64)
        for i, v in enumerate(nodes):
            draw = np.random.default_rng((self.plan["seed"], int(self.trees[self.slot[v]]), int(self.number[v])))
            found[i] = draw.choice(width, take, replace=False, shuffle=False)
        return found

    def descend(self, block: Block, zero: np.ndarray, bag: np.ndarray) -> np.ndarray:
        """The last node for every row of the block in every tree, tree after tree; -1 for a row that the tree does not take."""
        n, state = block.n, np.where(bag > 0, np.arange(len(self.trees), dtype=np.int32)[:, None], np.int32(-1))
        left, bin = self.left.astype(np.int32), self.bin.astype(np.int16)
        default = (left + (zero[self.feature] > bin)).astype(np.int32)
        place = np.where(left >= 0, block.place[self.feature], -1)
        column = block.column[place]
        rare = np.flatnonzero((place >= 0) & (column < 0))
        rare_of = self.slot[rare] * len(self.levels) + np.searchsorted(self.levels, rare, "right")
        rare, rare_of = rare[np.argsort(rare_of, kind="stable")], np.sort(rare_of)
        first = column % np.int32(len(block.table)) * np.int32(n)
        table, after = block.table.ravel(), bin + np.int16(1)
        for slot, at in enumerate(state):  # what is looked at of a tree stays in the processor's cache
            row = np.flatnonzero(at >= 0)
            node = at[row]
            for level in range(1, len(self.levels)):
                to = left[node]
                split = to >= 0
                if not split.all():
                    at[row] = node
                    row, node, to = row[split], node[split], to[split]
                if not len(row):
                    break
                nodes = rare[slice(*np.searchsorted(rare_of, [slot * len(self.levels) + level, slot * len(self.levels) + level + 1]))]
                moved = []
                if len(nodes):
                    at[row] = node
                    for which, entry in block.cells(self.feature[nodes]):
                        there = block.row[entry]
                        hit = np.flatnonzero(at[there] == nodes[which])
                        of = nodes[which[hit]]
                        moved.append((there[hit], left[of] + (block.bin[entry[hit]] > bin[of])))
                found = table.take(first[node] + row)
                node = np.where(found > 0, to + (found > after[node]), default[node])
                if moved:
                    at[row] = node
                    for there, to in moved:
                        at[there] = to
                    node = at[row]
            at[row] = node
        return state.ravel()

    def counts(self, block: Block, bins: Bins, nodes: np.ndarray, subset: Callable[[np.ndarray], np.ndarray]) -> dict[str, np.ndarray]:
        """Weight and number of the block's rows by node, feature, bin and class; rows without a value are left out."""
        bag = block.bag(self.plan, self.trees)
        state = self.descend(block, bins.zero, bag)
        bag = bag.ravel()
        first, last = self.levels[-2:]
        wanted = np.zeros(last - first + 1, bool)
        wanted[nodes - first] = True
        at = np.flatnonzero(wanted[np.where(state < first, last, state) - first])
        at = at[np.argsort((state[at] - first).astype(np.uint16 if last - first <= 1 << 16 else np.int32), kind="stable")]
        there, start = np.unique(state[at], return_index=True)
        rows = np.diff(np.append(start, len(at)))
        step = max(1, CELLS // self.plan["take"])
        cuts = np.union1d(np.arange(0, len(there), step), np.flatnonzero(np.diff(start // CELLS)) + 1)
        found = []
        for part in np.split(np.arange(len(there)), cuts[1:]):
            if len(part):
                feature = subset(there[part])
                own = at[start[part[0]]:start[part[-1]] + rows[part[-1]]]
                found += self._common(block, bins, bag, there[part], rows[part], own, feature)
                found += self._rare(block, bins, bag, state, there[part], feature)
        columns = {"node": np.int32, "feature": np.int32, "bin": np.int32, "label": np.int32, "weight": float, "count": float}
        return {n: np.concatenate([f[i] for f in found]) if found else np.zeros(0, k) for i, (n, k) in enumerate(columns.items())}

    def _common(self, block: Block, bins: Bins, bag: np.ndarray, nodes: np.ndarray, rows: np.ndarray, at: np.ndarray,
                feature: np.ndarray) -> Iterator[tuple]:
        """Counts of the common features from the table; ``at`` are the nodes' rows, node after node."""
        column = block.column[block.place[feature]]
        most, classes, row = int((column >= 0).sum(axis=1).max()), self.plan["classes"], at % block.n
        if not most:
            return
        order = np.argsort(column < 0, axis=1, kind="stable")[:, :most]  # the common ones of each node first
        column = np.take_along_axis(column, order, axis=1) % np.int32(len(block.table)) * np.int32(block.n)
        base, table = row.astype(np.int32), block.table.ravel()
        owner = np.repeat(np.arange(len(nodes)), rows)
        keys, places, step = [], [], max(1, (CELLS >> 3) // most)
        for i in range(0, len(at), step):
            cell = column[owner[i:i + step]]
            cell += base[i:i + step, None]
            value = table.take(cell.ravel())
            hit = np.flatnonzero(value)
            place = hit // most
            place += i
            pair = owner[place] * most + hit % most
            keys.append((pair * bins.most + value[hit] - 1) * classes + block.y[row[place]])
            places.append(place)
        key, place = np.concatenate(keys), np.concatenate(places)
        size = len(nodes) * most * bins.most * classes
        if size > 4 * len(key):
            key, at_key = np.unique(key, return_inverse=True)
            size = len(key)
        else:
            at_key, key = key, np.arange(size)
        times = bag[at].astype(np.float64)
        count = np.bincount(at_key, times[place], size)
        sums = count if block.even else np.bincount(at_key, (times * block.weight[row])[place], size)
        kept = np.flatnonzero(count)
        key = key[kept]
        pair = key // classes // bins.most
        node = pair // most
        yield nodes[node], feature[node, order[node, pair % most]], key // classes % bins.most, key % classes, sums[kept], count[kept]

    def _rare(self, block: Block, bins: Bins, bag: np.ndarray, state: np.ndarray, nodes: np.ndarray, feature: np.ndarray) -> Iterator[tuple]:
        """Counts of the other features, from their few rows."""
        place = block.place[feature]
        which, at = np.nonzero((place >= 0) & (block.column[place] < 0))
        node, feature, classes = nodes[which], feature[which, at], self.plan["classes"]
        offset = self.slot[node] * block.n
        for which, entry in block.cells(feature):
            at = offset[which] + block.row[entry]
            hit = np.flatnonzero(state[at] == node[which])
            which, entry, at = which[hit], entry[hit], at[hit]
            key, place = np.unique((which * bins.most + block.bin[entry]) * classes + block.y[block.row[entry]], return_inverse=True)
            times = bag[at].astype(np.float64)
            pair = key // classes // bins.most
            yield (node[pair], feature[pair], key // classes % bins.most, key % classes,
                   np.bincount(place, times * block.weight[block.row[entry]], len(key)), np.bincount(place, times, len(key)))

    def totals(self, block: Block) -> np.ndarray:
        """Weight by class, and number, of the rows that each tree takes."""
        bag, classes = block.bag(self.plan, self.trees), self.plan["classes"]
        weights = np.stack([np.bincount(block.y, b * block.weight, classes) for b in bag])
        return np.column_stack([weights, bag.sum(axis=1, dtype=np.float64)])

    def best(self, bins: Bins, counts: dict[str, np.ndarray]) -> tuple:
        """The best split of each node whose counts are given in full."""
        classes, width = self.plan["classes"], bins.width
        key, at = np.unique((counts["node"].astype(np.int64) * width + counts["feature"]) * bins.most + counts["bin"], return_inverse=True)
        cells = np.column_stack([
            *[np.bincount(at, counts["weight"] * (counts["label"] == c), len(key)) for c in range(classes)],
            np.bincount(at, counts["count"], len(key))])
        pairs, pair = np.unique(key // bins.most, return_inverse=True)
        rest = self.stats[pairs // width] - np.column_stack([np.bincount(pair, cells[:, c], len(pairs)) for c in range(classes + 1)])
        there = rest[:, -1] > 0
        key = np.append(key, (pairs * bins.most + bins.zero[pairs % width])[there])
        order = np.argsort(key)
        key, cells = key[order], np.concatenate([cells, rest[there]])[order]
        pair = key // bins.most
        first = np.searchsorted(pair, pair)
        running = np.cumsum(cells, axis=0)
        left = running - running[first] + cells[first]
        node, feature = pair // width, pair % width
        total = self.stats[node]
        right = total - left
        fewest = self.plan["min_leaf"]
        gain = impurity(total, self.plan) - (_size(left) * impurity(left, self.plan) + _size(right) * impurity(right, self.plan)) / _size(total)
        good = np.flatnonzero((np.append(pair[1:] == pair[:-1], False) if len(pair) else np.zeros(0, bool))
                              & (left[:, -1] >= fewest) & (right[:, -1] >= fewest) & (gain > 1e-12))
        good = good[np.lexsort((key[good], -np.round(gain[good], 12), node[good]))]
        good = good[np.unique(node[good], return_index=True)[1]]
        return node[good], feature[good], key[good] % bins.most, gain[good], np.where(np.abs(left[good]) < 1e-9, 0.0, left[good])

    def table(self, bins: Bins) -> pa.Table:
        """The nodes as the library keeps them: numbered from 0 in each tree; equal leaves of one parent are one leaf, as it has them."""
        stats = np.where(self.stats < 1e-9, 0.0, self.stats)
        prediction = stats[:, :-1].argmax(axis=1)
        left = self.left.copy()
        for first, last in reversed(list(zip(self.levels, self.levels[1:]))):
            nodes = first + np.flatnonzero(left[first:last] >= 0)
            child = left[nodes]
            left[nodes[(left[child] < 0) & (left[child + 1] < 0) & (prediction[child] == prediction[child + 1])]] = -1
        alive = np.zeros(len(left), bool)
        alive[:len(self.trees)] = True
        for first, last in zip(self.levels, self.levels[1:]):
            nodes = first + np.flatnonzero(alive[first:last] & (left[first:last] >= 0))
            alive[left[nodes]] = alive[left[nodes] + 1] = True
        kept = np.flatnonzero(alive)
        kept = kept[np.argsort(self.slot[kept], kind="stable")]
        number = np.full(len(left) + 1, -1)
        number[kept] = np.arange(len(kept)) - np.searchsorted(self.slot[kept], self.slot[kept])
        split = left[kept] >= 0
        cut = bins.threshold(np.where(split, self.feature[kept], 0), np.where(split, self.bin[kept], 0))
        return pa.table({
            "tree": pa.array(self.trees[self.slot[kept]], pa.int32()), "id": pa.array(number[kept], pa.int32()),
            "prediction": prediction[kept].astype(np.float64), "impurity": impurity(stats[kept], self.plan),
            "stats": _lists(stats[kept, :-1]), "rows": stats[kept, -1].astype(np.int64),
            "gain": np.where(split, self.gain[kept], -1.0),
            "left": pa.array(np.where(split, number[left[kept]], -1), pa.int32()),
            "right": pa.array(np.where(split, number[np.where(split, left[kept] + 1, -1)], -1), pa.int32()),
            "feature": pa.array(np.where(split, self.feature[kept], -1), pa.int32()),
            "threshold": pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(split)), pa.int32()), pa.array(cut[split]))})


def _lists(rows: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * rows.shape[1], pa.int32()), pa.array(np.ascontiguousarray(rows).ravel()))


def _size(stats: np.ndarray) -> np.ndarray:
    return stats[:, :-1].sum(axis=1)


def impurity(stats: np.ndarray, plan: dict) -> np.ndarray:
    share = np.maximum(stats[:, :-1], 0)
    share = share / np.maximum(share.sum(axis=1, keepdims=True), 1e-300)
    if plan["impurity"] == "gini":
        return 1 - (share * share).sum(axis=1)
    return -(share * np.log2(np.where(share > 0, share, 1))).sum(axis=1)


# Jobs -----------------------------------------------------------------------------------------------------------

def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield Block(batch.slice(i, 1).to_pylist()[0])


def _arrow(columns: dict) -> pa.RecordBatch:
    """Whole numbers as 32 bits."""
    return pa.RecordBatch.from_pydict({
        k: pa.array(v, pa.int32()) if isinstance(v, np.ndarray) and v.dtype.kind in "iu" else v for k, v in columns.items()})


def _summed(counts: dict[str, np.ndarray], bins: Bins, classes: int) -> dict[str, np.ndarray]:
    """Counts of several blocks, added up."""
    key = ((counts["node"].astype(np.int64) * bins.width + counts["feature"]) * bins.most + counts["bin"]) * classes + counts["label"]
    _, first, at = np.unique(key, return_index=True, return_inverse=True)
    return {n: np.bincount(at, v, len(first)) if n in ("weight", "count") else v[first] for n, v in counts.items()}


def _by_jobs(blocks: DataFrame, plan: dict, bins: Bins) -> Forest:
    """A job for each level (or several, if its nodes have more than ``PAIRS`` features to look at)."""
    context = blocks.sparkSession.sparkContext
    shared = context.broadcast(bins)
    trees, classes = np.arange(plan["trees"]), plan["classes"]
    bare = Forest(plan, trees, np.zeros((len(trees), classes + 1)))

    def totals(batches):
        for block in _blocks(batches):
            found = bare.totals(block)
            yield _arrow({"tree": trees, "stats": _lists(found)})

    sums = blocks.mapInArrow(totals, "tree int, stats array<double>").groupBy("tree").agg(
        F.array(*[F.sum(F.get("stats", F.lit(c))) for c in range(classes + 1)]).alias("stats")).collect()
    forest = Forest(plan, trees, np.array([r.stats for r in sorted(sums)]))

    def find(forest: Forest, nodes: np.ndarray) -> tuple:
        state = context.broadcast(forest)

        def count(batches):
            drawn = np.empty((len(nodes), plan["take"]), np.int32)
            known = np.zeros(len(nodes), bool)

            def subset(some):
                at = np.searchsorted(nodes, some)
                fresh = at[~known[at]]
                drawn[fresh] = state.value.subset(nodes[fresh])
                known[fresh] = True
                return drawn[at]

            held, several = {}, False
            for block in _blocks(batches):
                block.arrange(shared.value)
                fresh = state.value.counts(block, shared.value, nodes, subset)
                held, several = {n: np.concatenate([held[n], fresh[n]]) for n in held} or fresh, several or bool(held)
                if len(held["node"]) > CELLS:
                    held = _summed(held, shared.value, classes)
                    if len(held["node"]) > CELLS >> 1:
                        yield _arrow(held)
                        held, several = {}, False
            if held:
                yield _arrow(_summed(held, shared.value, classes) if several else held)

        def choose(batches):
            """Counts come node after node; what is held is those of some nodes."""
            held, room = [], CELLS >> 1
            for batch in itertools.chain((b for b in batches if b.num_rows), [None]):
                if held and (batch is None or sum(b.num_rows for b in held) > room):
                    whole = pa.Table.from_batches(held)
                    whole = {n: whole[n].to_numpy() for n in whole.column_names}
                    end = len(whole["node"]) if batch is None else int(np.searchsorted(whole["node"], whole["node"][-1]))  # the last node may go on
                    node, feature, bin, gain, left = state.value.best(shared.value, {n: v[:end] for n, v in whole.items()})
                    yield _arrow({"node": node, "feature": feature, "bin": bin, "gain": gain, "left": _lists(left)})
                    held = [_arrow({n: v[end:] for n, v in whole.items()})]
                    room = max(CELLS >> 1, 2 * held[0].num_rows)
                held.append(batch)

        tasks = max(1, min(context.defaultParallelism, len(nodes)))
        rows = blocks.mapInArrow(count, _COUNTS).repartition(tasks, "node").sortWithinPartitions("node").mapInArrow(
            choose, _SPLITS).toArrow().sort_by("node")
        state.destroy()
        left = rows["left"].combine_chunks().flatten().to_numpy().reshape(-1, classes + 1)
        return *(rows[n].to_numpy() for n in ("node", "feature", "bin", "gain")), left

    forest.grow(find)
    shared.destroy()
    return forest


def _by_trees(blocks: DataFrame, plan: dict, bins: Bins) -> DataFrame:
    """The nodes of all trees over a table of one block, trees dealt to tasks."""
    spark = blocks.sparkSession
    shared = spark.sparkContext.broadcast(bins)
    tasks = max(1, min(spark.sparkContext.defaultParallelism, plan["trees"] // 10))

    def grow(batches):
        for batch in batches:
            for row in batch.to_pylist():
                block, trees = Block(row), np.arange(row["part"], plan["trees"], tasks)
                block.arrange(shared.value)
                bare = Forest(plan, trees, np.zeros((len(trees), plan["classes"] + 1)))
                forest = Forest(plan, trees, bare.totals(block))
                forest.grow(lambda f, nodes: f.best(shared.value, f.counts(block, shared.value, nodes, f.subset)))
                yield from forest.table(shared.value).to_batches()

    parts = spark.range(tasks).select(F.col("id").cast("int").alias("part"))
    return parts.crossJoin(F.broadcast(blocks)).repartition(tasks, "part").mapInArrow(grow, _NODES)


def _take(strategy: str, width: int) -> int:
    """How many features a node may split, as the library reads ``featureSubsetStrategy`` for more than one tree."""
    named = {"all": width, "auto": math.sqrt(width), "sqrt": math.sqrt(width), "log2": math.log2(max(width, 2)), "onethird": width / 3}
    if strategy in named:
        wanted = named[strategy]
    else:
        wanted = int(strategy) if strategy.isdigit() else float(strategy) * width
    return max(1, min(width, math.ceil(wanted)))


def fit_sparse_forest(ready: DataFrame, forest: RandomForestClassifier) -> RandomForestClassificationModel:
    """What ``forest.fit(ready)`` is for, over a staged table, with the same parameters."""
    vector, label = forest.getFeaturesCol(), forest.getLabelCol()
    weight = forest.getWeightCol() if forest.isSet("weightCol") else None
    first = ready.select(vector).first()
    if first is None:
        raise ValueError("a forest needs rows")
    width = len(first[0])
    rows, top = ready.agg(F.count(F.lit(1)), F.max(label)).first()
    plan = {"trees": forest.getNumTrees(), "depth": forest.getMaxDepth(), "min_leaf": forest.getMinInstancesPerNode(),
            "bootstrap": forest.getBootstrap() and forest.getNumTrees() > 1, "impurity": forest.getImpurity(),
            "seed": forest.getSeed() & (1 << 63) - 1, "width": width, "classes": int(top) + 1,
            "take": _take(forest.getFeatureSubsetStrategy(), width) if forest.getNumTrees() > 1 else width}
    bins = fit_bins(ready, vector, width, rows, forest.getSeed())
    if rows <= BLOCK:
        nodes = _by_trees(to_blocks(ready.coalesce(1), vector, label, weight, bins), plan, bins)
    else:
        grown = _by_jobs(stage(to_blocks(ready, vector, label, weight, bins)), plan, bins)
        nodes = ready.sparkSession.createDataFrame(grown.table(bins))
    return _model(nodes, forest, plan)


def _model(nodes: DataFrame, forest: RandomForestClassifier, plan: dict) -> RandomForestClassificationModel:
    """The library's model with these nodes, through its saved form."""
    spark = nodes.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/strophe/{uuid.uuid4().hex}"
    tree = DecisionTreeClassifier(
        featuresCol=forest.getFeaturesCol(), labelCol=forest.getLabelCol(), impurity=forest.getImpurity(), maxDepth=forest.getMaxDepth(),
        minInstancesPerNode=forest.getMinInstancesPerNode(), seed=forest.getSeed())

    def saved(estimator, name: str, kind: str, **more) -> dict:
        estimator.save(f"{path}/{name}")
        return json.loads(spark.read.text(f"{path}/{name}/metadata").first()[0]) | {"class": _MODELS + kind} | more

    sizes = {"numFeatures": plan["width"], "numClasses": plan["classes"]}
    about = saved(forest, "forest", "RandomForestClassificationModel", numTrees=plan["trees"], **sizes)
    one = saved(tree, "tree", "DecisionTreeClassificationModel", **sizes)
    spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.text(f"{path}/model/metadata")
    trees = [(i, json.dumps(one | {"uid": f"{one['uid']}_{i}"}), 1.0) for i in range(plan["trees"])]
    spark.createDataFrame(trees, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/model/treesMetadata")
    node = F.struct("id", "prediction", "impurity", F.col("stats").alias("impurityStats"), F.col("rows").alias("rawCount"), "gain",
                    F.col("left").alias("leftChild"), F.col("right").alias("rightChild"), F.struct(
                        F.col("feature").alias("featureIndex"), F.col("threshold").alias("leftCategoriesOrThreshold"),
                        F.lit(-1).alias("numCategories")).alias("split"))
    nodes.select(F.col("tree").alias("treeID"), node.alias("nodeData")).write.parquet(f"{path}/model/data")
    return RandomForestClassificationModel.load(f"{path}/model")
