"""Document quality by a linear-chain conditional random field over lines.

Each line of a text is good or bad.  A line's own features (length, shares of capitals, signs,
digits and repeated words, ...), those of the line before and those of the line after score it
as good; two weights reward neighbours that are both good or both bad.  Forward-backward gives
each line's marginal probability of being good, and a document's score is the mean of these,
weighted by the lengths of the lines.

Training: the label of a document is the label of its lines.  The gradient of the mean
log-likelihood is summed by Spark over a staged sample of labelled documents, one small vector
a task and round; about ``rows`` documents are taken by the hash of their id (a documented
bound; all are taken if there are fewer).  Scoring reads every whole text in one pass without a shuffle.

Nulls: a null text is empty.  An empty text is one empty line and is scored as such.  A null id
counts as the empty text in hashes, joins no label, and is scored like any row.  A label that is
null plays no part; of several labels of one id the smallest counts.  Repeated rows are scored alike and, if labelled,
each is a training row.  An empty table has no scores; without any labelled document of either kind a model
cannot be fitted and all weights are 0, so every score is 0.5.  A text of any length is read whole; its lines
are rows of numpy arrays inside one task.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.staging import stage
from .base import query, table
from .wordhash import word_hashes

ROWS = 8192
ROUNDS = 40
BLOCK = 1 << 20
CELLS = 1 << 18
TASKS = 12
_KINDS = 9
_LOWER, _UPPER, _OTHER_LETTER, _DIGIT, _SIGN, _CALL, _STOP, _REST, _NONE = range(_KINDS)


def _kinds() -> np.ndarray:
    kind = np.full(256, _REST, np.uint8)
    kind[97:123], kind[65:91], kind[0xC0:], kind[48:58] = _LOWER, _UPPER, _OTHER_LETTER, _DIGIT
    kind[list(b"#*$%&|<>@^~_=+\\/{}[]")] = _SIGN
    kind[list(b"!?")] = _CALL
    kind[list(b".,;:'\"()-")] = _STOP
    kind[0x80:0xC0] = _NONE  # later bytes of a code point
    kind[10] = _NONE
    return kind


_KIND = _kinds()
FEATURES = ["one", "length", "upper", "signs", "calls", "digits", "stops", "rest", "other letters", "word length", "repeats", "few words"]
WIDTH = len(FEATURES)
SIZE = 3 * WIDTH + 2  # own, previous, next; good beside good, bad beside bad


def line_features(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features and length of each line of the texts, and the number of lines of each text."""
    data = "".join((t or "") + "\n" for t in texts).encode("utf-8", "replace")
    array = np.frombuffer(data, np.uint8)
    ends = np.flatnonzero(array == 10)
    lines = len(ends)
    sizes = np.diff(ends, prepend=-1)
    line = np.repeat(np.arange(lines), sizes)
    counts = np.bincount(line * _KINDS + _KIND[array], minlength=lines * _KINDS).reshape(lines, _KINDS).astype(np.float64)
    start, words = word_hashes(array)
    where = line[start]
    n_words = np.bincount(where, minlength=lines)
    again = (words[1:] == words[:-1]) & (where[1:] == where[:-1])
    repeats = np.bincount(where[1:][again], minlength=lines)
    length = counts[:, :_NONE].sum(axis=1)
    letters = counts[:, _LOWER] + counts[:, _UPPER] + counts[:, _OTHER_LETTER]
    blank = np.maximum(n_words - 1, 0)
    per = 10 / (length + 1)
    out = np.stack([
        np.ones(lines), np.log1p(length) / 4, 2 * counts[:, _UPPER] / (letters + 1), counts[:, _SIGN] * per, counts[:, _CALL] * per,
        counts[:, _DIGIT] * per, counts[:, _STOP] * per, np.maximum(counts[:, _REST] - blank, 0) * per, counts[:, _OTHER_LETTER] * per / 4,
        (length - blank) / (n_words + 1) / 5, 2 * repeats / (n_words + 1), (n_words < 5).astype(float)], axis=1)
    return out, length, np.bincount(np.repeat(np.arange(len(texts)), [(t or "").count("\n") + 1 for t in texts]), minlength=len(texts))


def blocks(texts: Sequence[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``BLOCK`` characters."""
    at = 0
    while at < len(texts):
        to, size = at, 0
        while to < len(texts) and (to == at or size + len(texts[to] or "") < BLOCK):
            size += len(texts[to] or "")
            to += 1
        yield at, to
        at = to


@dataclass(frozen=True)
class Field:
    """The weights: own, previous and next line's features, then good beside good and bad beside bad."""

    weights: tuple[float, ...]

    def marginals(self, features: np.ndarray, lines: np.ndarray) -> np.ndarray:
        """The probability of each line to be good; ``lines`` counts the lines of each text."""
        return _marginals(np.array(self.weights), features, lines, None)[0]


def _with_neighbours(features: np.ndarray, lines: np.ndarray) -> np.ndarray:
    first = np.cumsum(lines) - lines
    before, after = np.zeros_like(features), np.zeros_like(features)
    before[1:], after[:-1] = features[:-1], features[1:]
    before[first] = 0
    after[first + lines - 1] = 0
    return np.concatenate([features, before, after], axis=1)


def _marginals(weights: np.ndarray, features: np.ndarray, lines: np.ndarray, labels: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of all lines and, with the texts' labels, the gradient of the summed mean log-likelihood of a text's lines."""
    x = _with_neighbours(features, lines)
    score = x @ weights[:-2]
    stay1, stay0 = weights[-2:]
    out, gradient = np.empty(len(score)), np.zeros(SIZE)
    first = np.cumsum(lines) - lines
    order = np.argsort(-lines, kind="stable")
    at = 0
    while at < len(order):
        longest = int(lines[order[at]])
        part = order[at:at + max(1, CELLS // longest)]
        at += len(part)
        n = lines[part]
        cell = first[part][:, None] + np.minimum(np.arange(longest)[None, :], n[:, None] - 1)
        s = score[cell]
        a1, a0 = np.empty_like(s), np.empty_like(s)
        b1, b0 = np.zeros_like(s), np.zeros_like(s)
        a1[:, 0], a0[:, 0] = s[:, 0], 0
        running = np.searchsorted(-n, -np.arange(longest))  # texts with more than t lines come first
        for t in range(1, longest):
            k = running[t]
            p1, p0 = a1[:k, t - 1], a0[:k, t - 1]
            a1[:k, t] = np.logaddexp(p1 + stay1, p0) + s[:k, t]
            a0[:k, t] = np.logaddexp(p1, p0 + stay0)
        for t in range(longest - 2, -1, -1):
            k = running[t + 1]
            n1, n0 = b1[:k, t + 1] + s[:k, t + 1], b0[:k, t + 1]
            b1[:k, t] = np.logaddexp(n1 + stay1, n0)
            b0[:k, t] = np.logaddexp(n1, n0 + stay0)
        inside = np.arange(longest)[None, :] < n[:, None]
        odds = np.where(inside, (a1 + b1) - (a0 + b0), 0)
        p = 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
        out[cell[inside]] = p[inside]
        if labels is None:
            continue
        y, share = labels[part], 1 / n
        gradient[:-2] += (((y[:, None] - p) * share[:, None])[inside]) @ x[cell[inside]]
        if longest > 1:
            pair = inside[:, 1:]
            total = np.logaddexp(a1[np.arange(len(n)), n - 1], a0[np.arange(len(n)), n - 1])[:, None]
            good = np.where(pair, np.exp(np.minimum(a1[:, :-1] + stay1 + s[:, 1:] + b1[:, 1:] - total, 0)), 0)
            bad = np.where(pair, np.exp(np.minimum(a0[:, :-1] + stay0 + b0[:, 1:] - total, 0)), 0)
            gradient[-2] += ((y * (n - 1) - good.sum(axis=1)) * share).sum()
            gradient[-1] += (((1 - y) * (n - 1) - bad.sum(axis=1)) * share).sum()
    return out, gradient


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = ROWS, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality") -> DataFrame:
    """``(features, lines, label)`` of about ``rows`` labelled documents, staged."""
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(
        F.min(label_col).cast("double").alias("label"))
    n = known.count()
    mine = known.where(F.pmod(F.xxhash64("_id"), F.lit(1 << 20)) < int(min(1.0, rows / max(n, 1)) * (1 << 20)))
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")).join(mine, "_id").select("text", "label")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for at, to in blocks(texts):
                features, _, lines = line_features(texts[at:to])
                cuts = np.cumsum(lines)[:-1]
                data = [f.astype("<f4").tobytes() for f in np.split(features, cuts)]
                yield pa.RecordBatch.from_arrays([pa.array(data, pa.binary()), pa.array(lines, pa.int64()), batch.column(1).slice(at, to - at)],
                                                 ["features", "lines", "label"])

    return stage(texts.mapInArrow(measure, "features binary, lines long, label double").repartition(TASKS))


def _gradient(sample: DataFrame, weights: np.ndarray) -> np.ndarray:
    """The gradient over all rows, then their number; each task sends one such vector."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SIZE + 1)
        for batch in batches:
            if not len(batch):
                continue
            features = np.frombuffer(b"".join(batch.column(0).to_pylist()), "<f4").astype(np.float64).reshape(-1, WIDTH)
            total[:-1] += _marginals(weights, features, batch.column(1).to_numpy(), batch.column(2).to_numpy())[1]
            total[-1] += len(batch)
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()])], ["total"])

    return np.sum([np.zeros(SIZE + 1), *[r[0] for r in sample.mapInArrow(add, "total array<double>").collect()]], axis=0)


def fit(sample: DataFrame, rounds: int = ROUNDS, step: float = 0.6, penalty: float = 1e-4) -> Field:
    """Weights by ``rounds`` gradient steps with a step size of its own for each weight (Adam)."""
    weights, mean, square = np.zeros(SIZE), np.zeros(SIZE), np.zeros(SIZE)
    for t in range(1, rounds + 1):
        total = _gradient(sample, weights)
        if not total[-1]:
            break
        g = total[:-1] / total[-1] - penalty * weights
        mean, square = 0.9 * mean + 0.1 * g, 0.99 * square + 0.01 * g * g
        size = step * min(1.0, 2 * (1 - (t - 1) / rounds))
        weights = weights + size * (mean / (1 - 0.9 ** t)) / (np.sqrt(square / (1 - 0.99 ** t)) + 1e-8)
    return Field(tuple(float(w) for w in np.round(weights, 6)))


def label_lines(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, score, lines)``: each line's length and probability to be good, in order, and their weighted mean."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for at, to in blocks(texts):
                features, length, lines = line_features(texts[at:to])
                good = field.marginals(features, lines)
                first = np.cumsum(lines) - lines
                share = length + 1  # an empty line counts a little, so that a text of empty lines has a score
                score = np.clip(np.add.reduceat(good * share, first) / np.add.reduceat(share, first), 0, 1)
                marks = pa.StructArray.from_arrays([pa.array(length.astype(np.int64)), pa.array(good)], ["length", "good"])
                lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(good)), pa.int32()), marks)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, to - at), pa.array(score), lists], ["doc_id", "score", "lines"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(
        run, "doc_id long, score double, lines array<struct<length:long,good:double>>").withColumnRenamed("doc_id", id_col)


@query()
def op13_line_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    rest = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(4))
    field = fit(training_rows(docs, labels.where(rest != 2)))
    scored = label_lines(docs, field)
    return scored.select("doc_id", (rest == 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
