"""SentencePiece encoding and decoding by a relational lattice.

A text, with a blank in front, is cut into words wherever no piece has the two neighbouring bytes
side by side: before a run of blanks, around line feeds, between most letters and signs.  No piece
crosses such a cut, so words are encoded by themselves, every frequent one once:

1. The words are counted, first within a task, then by a grouping.
2. The lattice of a word: its substrings of at most the longest piece's length meet the piece
   table (a vocabulary, hence bounded) by equality, and the matches are the edges, grouped by
   word.
3. The edges of a word are folded.  For a unigram model that is Viterbi's fold, over rows that
   Spark explodes, joins and groups, with higher-order functions: the best score of each prefix
   and the edge that gave it.  A BPE model has no path scores, its pieces are joined in the order
   of their scores: the fold keeps the cut points of a word as a bit mask and joins, again and
   again, the first edge that spans exactly two neighbouring parts.  Viterbi over the scores of a
   BPE model would give other ids than the model does.  As Spark rows this took 24 rows a word and
   more memory than an executor has, so for BPE the same explode, join, group and fold run on
   arrays, over all words of an Arrow batch at once; substrings grow by a character at a time,
   and those that no piece starts with drop out.  Words too long for the mask are cut by the same
   rules in plain Python.  Characters that are no piece become the pieces of their UTF-8 bytes.
4. Word codes go back to the texts: the most frequent words, at most ``FREQUENT``, as one
   broadcast table of hashes and ids.  A text's other words go through the same lattice and fold
   where the text is read, those of a block of texts at once, so no text is moved; for a unigram
   model their codes come through a join, as a list that meets the text by document id.

Nulls: a null or empty text has no ids and decodes to the empty text.  Rows with a null id
or a repeated id are encoded like any other row.  The blank sign U+2581 counts as a blank,
as it does in the format.  Other columns are ignored.
"""

from __future__ import annotations

import heapq
import json
import zlib
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..sources.staging import stage
from .base import query, slices, table
from .wordhash import mix, powers

FREQUENT = 1 << 20
LONG = 60  # characters of a word whose cut points fit in one number
NO_ID = (1 << 63) - 1


@dataclass(frozen=True)
class Pieces:
    """A model's pieces, blanks for U+2581, with ids and scores; ``first_byte`` is the id of byte 0."""

    names: tuple[str, ...]
    ids: tuple[int, ...]
    scores: tuple[float, ...]
    first_byte: int
    unigram: bool = False

    @staticmethod
    def load(path: str, unigram: bool = False) -> Pieces:
        """Pieces of a model file, which does not say to its reader whether it is a unigram model."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        usual = [i for i in range(model.vocab_size())
                 if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        names = tuple(model.id_to_piece(i).replace("▁", " ") for i in usual)
        return Pieces(names, tuple(usual), tuple(model.get_score(i) for i in usual), model.piece_to_id("<0x00>"), unigram)

    @property
    def longest(self) -> int:
        return max(map(len, self.names))

    def apart(self) -> np.ndarray:
        """Whether a text may be cut between two bytes, by both: no piece has them side by side."""
        out = np.ones((256, 256), bool)
        for name in self.names:
            raw = np.frombuffer(name.encode("utf-8", "replace"), np.uint8)
            out[raw[:-1], raw[1:]] = False
        out[:, 0x80:0xC0] = False  # inside a character
        return out

    def frame(self, spark: SparkSession) -> DataFrame:
        rank = {s: r for r, s in enumerate(sorted(set(self.scores), reverse=True))}
        rows = pd.DataFrame({"piece": self.names, "id": self.ids, "score": self.scores, "rank": [rank[s] for s in self.scores]})
        return spark.createDataFrame(rows, "piece string, id int, score double, rank int")


HELD = 200_000  # distinct words that a task counts before it passes them on


def word_counts(docs: DataFrame, pieces: Pieces, text_col: str) -> DataFrame:
    apart = pieces.apart()

    def passed(held: Counter[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([w.decode() for w in held], pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()
        for batch in slices(batches):
            for _, _, data, first in blocks(batch.column(0).to_pylist()):
                at = word_starts(np.frombuffer(data, np.uint8), apart, first).tolist()
                held.update([data[i:j] for i, j in zip(at, [*at[1:], len(data)])])
                if len(held) >= HELD:
                    yield passed(held)
                    held.clear()
        if held:
            yield passed(held)

    found = docs.select(F.col(text_col).alias("text")).mapInArrow(counted, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


# An edge is one number, so that a word's edges sort fast: rank, place, length, id.
_RANK, _PLACE, _SIZE, _ID = 36, 30, 24, 0
_NO_PIECE = (1 << 24) - 1


def edges(words: DataFrame, pieces: Pieces) -> DataFrame:
    """``(word, n, edges)``: the pieces in each word, and each single character, by rank and place."""
    # Places and lengths are counted through in rows, so that substrings are cut in generated code.  A word too
    # long for a bit mask keeps one row and no more.
    size, most = F.length("word"), pieces.longest
    pairs = F.when(size <= LONG, size * most).otherwise(1)
    spots = words.select("word", "n", F.explode(F.sequence(F.lit(0), pairs - 1)).alias("i")).select(
        "word", "n", F.expr(f"i div {most}").cast("int").alias("s"), (F.col("i") % most + 1).alias("k")).where("s + k <= length(word)")
    cut = spots.withColumn("piece", F.expr("substring(word, s + 1, k)"))
    met = cut.join(F.broadcast(pieces.frame(words.sparkSession)), "piece", "left").where("id is not null or k = 1")
    edge = F.expr(f"shiftleft(cast(coalesce(rank, 0) as long), {_RANK}) | shiftleft(cast(s as long), {_PLACE}) | "
                  f"shiftleft(cast(k as long), {_SIZE}) | coalesce(id, {_NO_PIECE})")
    return met.groupBy("word", "n").agg(F.sort_array(F.collect_list(edge)).alias("edges"))


def _field(edge: Column, at: int, bits: int) -> Column:
    return F.shiftright(edge, at).bitwiseAND(F.lit((1 << bits) - 1)).cast("int")


def _bit(at: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), at)


def _spans(edge_list: Column) -> Column:
    """Edges with the bits of their two ends and of the cut points inside."""
    def span(e: Column) -> Column:
        s = _field(e, _PLACE, 6)
        end = s + _field(e, _SIZE, 6)
        return F.struct(s.alias("s"), end.alias("e"), _field(e, _RANK, 27).alias("rank"), _field(e, _ID, 24).alias("id"), _bit(s).bitwiseOR(_bit(end)).alias("ends"),
                        (_bit(end) - _bit(s + 1)).alias("inside"))

    return F.transform(edge_list, span)


def _best(spans: Column, size: Column, scores: Sequence[float]) -> Column:
    """Cut points of a unigram word: Viterbi over prefixes, of which each keeps its score and its cut points."""
    unknown = F.lit(min(scores) - 10.0)
    of_rank = F.from_json(F.lit(json.dumps(sorted(set(scores), reverse=True))), "array<double>")

    def extend(best: Column, at: Column) -> Column:
        def through(e: Column) -> Column:
            before = F.get(best, e["s"])
            score = F.when(e["id"] == _NO_PIECE, unknown).otherwise(F.get(of_rank, e["rank"]))
            return F.struct((before["score"] + score).alias("score"),
                            before["cuts"].bitwiseOR(_bit(at)).alias("cuts"))

        into = F.filter(spans, lambda e: e["e"] == at)
        return F.concat(best, F.array(F.array_max(F.transform(into, through))))

    first = F.array(F.struct(F.lit(0.0).alias("score"), F.lit(1).cast("long").alias("cuts")))
    return F.element_at(F.aggregate(F.sequence(F.lit(1), size), first, extend), -1)["cuts"]


def _byte_ids(char: Column, first_byte: int) -> Column:
    digits = F.hex(F.encode(char, "UTF-8"))
    return F.transform(F.sequence(F.lit(1), F.length(digits), F.lit(2)),
                       lambda i: F.conv(F.substring(digits, i, F.lit(2)), 16, 10).cast("int") + first_byte)


def merge_long(word: str, known: dict[str, tuple[int, int]], first_byte: int) -> list[int]:
    """The codes of one word too long for a bit mask: neighbours joined by rank, then place, with a heap."""
    parts: list[str | None] = list(word)
    after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
    heap: list[tuple[int, int, str]] = []

    def offer(i: int) -> None:
        if i >= 0 and after[i] < len(parts) and (both := parts[i] + parts[after[i]]) in known:
            heapq.heappush(heap, (known[both][0], i, both))

    for i in range(len(parts)):
        offer(i)
    while heap:
        _, i, both = heapq.heappop(heap)
        if parts[i] is None or after[i] >= len(parts) or parts[i] + parts[after[i]] != both:
            continue
        gone = after[i]
        parts[i], parts[gone], after[i] = both, None, after[gone]
        if after[i] < len(parts):
            before[after[i]] = i
        offer(before[i])
        offer(i)
    return [c for p in parts if p is not None for c in ([known[p][1]] if p in known else [b + first_byte for b in p.encode("utf-8", "replace")])]


def viterbi_long(word: str, known: dict[str, tuple[float, int]], longest: int, first_byte: int, unknown: float) -> list[int]:
    """The codes of one word of a unigram model too long for a bit mask: back pointers instead; ties as in ``_best``."""
    best, back = [0.0] + [float("-inf")] * len(word), [0] * (len(word) + 1)
    for end in range(1, len(word) + 1):
        for start in range(max(0, end - longest), end):
            piece = word[start:end]
            if piece in known or end - start == 1:
                score = best[start] + (known[piece][0] if piece in known else unknown)
                if score >= best[end]:
                    best[end], back[end] = score, start
    codes, end = [], len(word)
    while end:
        piece = word[back[end]:end]
        codes.append([known[piece][1]] if piece in known else [b + first_byte for b in piece.encode("utf-8", "replace")])
        end = back[end]
    return [c for part in reversed(codes) for c in part]


@dataclass(frozen=True)
class Beginnings:
    """The beginnings of all pieces by number: what one more character makes of each, and which piece it is."""

    step: np.ndarray  # beginning and character in one number, ascending
    to: np.ndarray
    rank: np.ndarray
    id: np.ndarray  # -1 for a beginning that is no piece

    @staticmethod
    def of(pieces: Pieces) -> Beginnings:
        number = {"": 0}
        for name in pieces.names:
            for k in range(1, len(name) + 1):
                number.setdefault(name[:k], len(number))
        steps = sorted((number[p[:-1]] << 21 | ord(p[-1]), i) for p, i in number.items() if p)
        rank, own = np.zeros(len(number), np.int64), np.full(len(number), -1, np.int64)
        at = [number[n] for n in pieces.names]
        rank[at] = np.unique(-np.array(pieces.scores), return_inverse=True)[1]
        own[at] = pieces.ids
        return Beginnings(*np.array(steps, np.int64).reshape(-1, 2).T.copy(), rank, own)

    def edges(self, chars: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place, length and number of each piece in ``chars``; ``left`` characters are left of a place's word."""
        at, now, size, found = np.arange(len(chars)), np.zeros(len(chars), np.int64), 0, []
        while len(at):
            key = now << 21 | chars[at + size]
            size += 1
            i = np.minimum(np.searchsorted(self.step, key), len(self.step) - 1)
            met = self.step[i] == key
            at, now = at[met], self.to[i[met]]
            piece = self.id[now] >= 0
            found.append((at[piece], np.full(piece.sum(), size), now[piece]))
            more = left[at] > size
            at, now = at[more], now[more]
        return tuple(np.concatenate(c) for c in zip(*found)) if found else (at, at, now)

    def encode(self, words: list[str], first_byte: int) -> pa.ListArray:
        """The codes of words of at most ``LONG`` characters."""
        size = np.array([len(w) for w in words], np.int64)
        chars = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        word = np.repeat(np.arange(len(words)), size)
        place = np.arange(len(chars)) - (np.cumsum(size) - size)[word]
        at, k, node = self.edges(chars, size[word] - place)
        several = k > 1
        cuts = joined(word[at[several]], place[at[several]], k[several], self.rank[node[several]], size)
        part = np.flatnonzero(cuts[word] >> place.astype(np.uint64) & np.uint64(1))
        # The id of a part is that of the edge with its place and length.
        key = at << 6 | k
        order = np.argsort(key)
        wanted = part << 6 | np.diff(np.append(part, len(chars)))
        i = np.minimum(np.searchsorted(key[order], wanted), len(key) - 1)
        ids = np.where(key[order][i] == wanted, self.id[node[order][i]], -1) if len(key) else np.full(len(part), -1)
        other = [chr(c).encode("utf-8", "replace") for c in chars[part[ids < 0]]]
        many = np.ones(len(part), np.int64)
        many[ids < 0] = [len(b) for b in other]
        out = np.repeat(ids, many)
        out[out < 0] = np.frombuffer(b"".join(other), np.uint8).astype(np.int64) + first_byte
        ends = np.cumsum(np.bincount(word[part], many, len(words)).astype(np.int64))
        return pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(out, pa.int32()))


def joined(word: np.ndarray, place: np.ndarray, k: np.ndarray, rank: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Cut points of BPE words as bits: in each round each word joins its first edge that spans two parts."""
    one = np.uint64(1)
    cuts = (one << (size + 1).astype(np.uint64)) - one
    order = np.argsort(word << 36 | rank << 6 | place)
    word, start, end = word[order], place[order].astype(np.uint64), (place + k)[order].astype(np.uint64)
    ends, inside = one << start | one << end, (one << end) - (one << (start + one))
    while len(word):
        now = cuts[word]
        within = now & inside
        # A cut point never comes back: an edge without its ends is out, and so is one that has become a part.
        open_ = ((now & ends) == ends) & (within != 0)
        word, ends, inside, within = word[open_], ends[open_], inside[open_], within[open_]
        fits = np.flatnonzero((within & (within - one)) == 0)
        first = fits[np.append(True, np.diff(word[fits]) != 0)[:len(fits)]]
        cuts[word[first]] &= ~inside[first]
        going = np.zeros(len(cuts), bool)
        going[word[first]] = True
        word, ends, inside = (c[going[word]] for c in (word, ends, inside))
    return cuts


BATCH = 8192  # words whose edges are held at a time


def word_codes(words: DataFrame, pieces: Pieces) -> DataFrame:
    """``(word, n, ids)`` of ``words(word, n)``."""
    return _unigram_codes(words, pieces) if pieces.unigram else _bpe_codes(words, pieces)


def _bpe_folder(pieces: Pieces) -> Callable[[list[str]], list]:
    """A function from words of any length to the codes of each, ``BATCH`` words at a time."""
    lattice, first_byte = Beginnings.of(pieces), pieces.first_byte
    known = {p: (r, i) for p, r, i in zip(pieces.names, np.unique(-np.array(pieces.scores), return_inverse=True)[1].tolist(), pieces.ids)}

    def fold(words: list[str]) -> list:
        out: list = [None] * len(words)
        short = [k for k, w in enumerate(words) if len(w) <= LONG]
        for start in range(0, len(short), BATCH):
            some = short[start:start + BATCH]
            codes = lattice.encode([words[k] for k in some], first_byte)
            ids, at = codes.values.to_numpy(), codes.offsets.to_numpy().tolist()
            for k, a, b in zip(some, at, at[1:]):
                out[k] = ids[a:b]
        for k, word in enumerate(words):
            if len(word) > LONG:
                out[k] = merge_long(word, known, first_byte)
        return out

    return fold


def _bpe_codes(words: DataFrame, pieces: Pieces, then: Callable | None = None,
               result: str = "word string, n long, ids array<int>") -> DataFrame:
    """``(word, n, ids)``, or what ``then`` makes of batches of that in the same worker, of schema ``result``."""
    fold = _bpe_folder(pieces)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), BATCH):
                part = batch.slice(start, BATCH)
                ids = fold(part.column(0).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(ids, pa.list_(pa.int32()))], ["word", "n", "ids"])

    return words.select("word", "n").mapInArrow(coded if then is None else lambda batches: then(coded(batches)), result)


def _unigram_codes(words: DataFrame, pieces: Pieces) -> DataFrame:
    size = F.length("word")
    short = size <= LONG
    spans = F.when(short, _spans(F.col("edges")))
    cut = edges(words, pieces).select("word", "n", spans.alias("spans"))
    cut = cut.withColumn("m", F.when(short, _best(F.col("spans"), size, pieces.scores)))
    m = F.col("m")
    parts = F.array_sort(F.transform(
        F.filter("spans", lambda e: (m.bitwiseAND(e["ends"]) == e["ends"]) & (m.bitwiseAND(e["inside"]) == 0)),
        lambda e: F.struct(e["s"].alias("s"), e["id"].alias("id"))))
    ids = F.flatten(F.transform(parts, lambda p: F.when(p["id"] != _NO_PIECE, F.array(p["id"])).otherwise(
        _byte_ids(F.substring(F.col("word"), p["s"] + 1, F.lit(1)), pieces.first_byte))))
    first_byte = pieces.first_byte
    scored = {p: (s, i) for p, s, i in zip(pieces.names, pieces.scores, pieces.ids)}
    longest, unknown = pieces.longest, min(pieces.scores) - 10.0

    @F.pandas_udf("array<int>")
    def best(found: pd.Series) -> pd.Series:
        return found.map(lambda w: None if w is None else viterbi_long(w, scored, longest, first_byte, unknown))

    coded = cut.select("word", "n", F.when(short, ids).alias("ids"), best(F.when(~short, F.col("word"))).alias("_long"))
    return coded.select("word", "n", F.coalesce("ids", "_long").alias("ids"))


# The same cut on bytes, for a block of texts at once.
_FIRST = mix(np.arange(1, 257, dtype=np.uint64))
_SECOND = mix(np.arange(1001, 1257, dtype=np.uint64))
_UP = np.uint64(0x9E3779B97F4A7C15)
_DOWN = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def word_starts(data: np.ndarray, apart: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Start of each word in the bytes of prepared texts that start at ``first``."""
    start = np.zeros(len(data), bool)
    start[1:] = apart[data[:-1], data[1:]]
    start[first[first < len(data)]] = True
    return np.flatnonzero(start)


def span_hashes(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Two hashes of each stretch of ``data`` from one place of ``at`` to the next, the last one to the end."""
    if not len(at):
        return np.empty((2, 0), np.uint64)
    end = np.append(at[1:], len(data))
    width = max([1 << max(16, int(len(data)).bit_length()), *_POWERS])
    if width not in _POWERS:
        _POWERS.clear()
        _POWERS[width] = (powers(_UP, width), powers(_DOWN, width))
    up, down = _POWERS[width]
    out = np.empty((2, len(at)), np.uint64)
    for i, values in enumerate((_FIRST, _SECOND)):
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(values[data] * up[:len(data)], out=total[1:])
        out[i] = mix((total[end] - total[at]) * down[at] + (end - at).astype(np.uint64))
    return out


def prepare_bytes(text: str | None) -> bytes:
    return (" " + text.replace("▁", " ")).encode("utf-8", "replace") if text else b""


def blocks(texts: Sequence[str | None], most: int = 1 << 20) -> Iterator[tuple[int, int, bytes, np.ndarray]]:
    """Neighbouring texts, prepared, of at most ``most`` bytes or one text: from, to, bytes, start of each text."""
    begin, size, held = 0, 0, []
    for i, text in enumerate(texts):
        data = prepare_bytes(text)
        if held and size + len(data) > most:
            yield begin, i, b"".join(held), np.cumsum([0, *map(len, held[:-1])])
            begin, size, held = i, 0, []
        held.append(data)
        size += len(data)
    if held:
        yield begin, begin + len(held), b"".join(held), np.cumsum([0, *map(len, held[:-1])])


@dataclass(frozen=True)
class Frequent:
    """Codes of frequent words, by hash."""

    first: np.ndarray
    second: np.ndarray
    offset: np.ndarray
    ids: np.ndarray

    @staticmethod
    def collect(words: DataFrame, pieces: Pieces) -> Frequent:
        """Codes of ``words(word, n)``, which must be bounded; only hashes and ids come to the driver."""
        def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                words = [w.encode() for w in batch.column(0).to_pylist()]
                sizes = np.array([len(w) for w in words], np.int64)
                a, b = span_hashes(np.frombuffer(b"".join(words), np.uint8), np.cumsum(sizes) - sizes).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b.astype(np.int32)), batch.column("ids")], ["a", "b", "ids"])

        result = "a long, b int, ids array<int>"
        tab = (_unigram_codes(words, pieces).mapInArrow(hashed, result) if pieces.unigram
               else _bpe_codes(words, pieces, hashed, result)).toArrow().sort_by("a")
        ids = tab.column("ids").combine_chunks()
        offset = np.concatenate([[0], np.cumsum(ids.value_lengths().to_numpy())]) if len(tab) else np.zeros(1)
        flat = ids.flatten().to_numpy()
        small = np.uint16 if not len(flat) or flat.max() < 1 << 16 else np.int32
        return Frequent(*(tab.column(c).to_numpy() for c in "ab"), offset.astype(np.int32), flat.astype(small))

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Index of each word, -1 for one that is not here."""
        if not len(self.first):
            return np.full(hashes.shape[1], -1)
        a, b = hashes.view(np.int64)
        at = np.minimum(np.searchsorted(self.first, a), len(self.first) - 1)
        return np.where((self.first[at] == a) & (self.second[at] == b.astype(np.int32)), at, -1)

    def fill(self, at: np.ndarray, others: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words ``at`` and how many each has; those at -1 have the ids in ``others``, in order."""
        size = np.where(at >= 0, self.offset[at + 1] - self.offset[at], 0).astype(np.int64) if len(self.first) else np.zeros(len(at), np.int64)
        missing = np.flatnonzero(at < 0)
        size[missing] = [len(o) for o in others]
        to = np.cumsum(size) - size
        out = np.empty(int(size.sum()), np.int32)
        step = np.arange(len(out)) - np.repeat(to, size)
        known = np.repeat(at >= 0, size)
        if known.any():
            out[known] = self.ids[(np.repeat(self.offset[at], size) + step)[known]]
        for m, o in zip(missing, others):
            out[to[m]:to[m] + len(o)] = o
        return out, size


def encode(docs: DataFrame, pieces: Pieces, id_col: str = "doc_id", text_col: str = "text", frequent: int = FREQUENT,
           then: tuple[Callable[[pa.RecordBatch], pa.RecordBatch], str] | None = None) -> DataFrame:
    """``(doc_id, text, ids)`` of each row.

    ``then``, a function of such batches and the schema of what it returns (``doc`` first), runs where the
    codes are made, which spares a second Python worker for each task.
    """
    spark = docs.sparkSession
    apart = pieces.apart()
    counts = stage(word_counts(docs, pieces, text_col))
    # How many words are how frequent, by powers of two: at most 63 rows.
    level = F.floor(F.log2("n")).cast("int")
    steps = {r["level"]: r["count"] for r in counts.groupBy(level.alias("level")).count().collect()}
    least, held = max(steps, default=0) + 1, 0
    while least > 0 and held + steps.get(least - 1, 0) <= frequent:
        least -= 1
        held += steps.get(least, 0)
    shared = spark.sparkContext.broadcast(Frequent.collect(counts.where(level >= least), pieces))
    rare = counts.where(level < least)

    texts = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc"), F.col(text_col).alias("text"))

    def coded(part: pa.RecordBatch, texts: list[str | None], data: bytes, first: np.ndarray,
              others: Callable[[list[int], list[bytes]], list]) -> pa.RecordBatch:
        """The codes of a block; ``others`` has those of words that are not frequent, from the number of their text."""
        raw = np.frombuffer(data, np.uint8)
        at = word_starts(raw, apart, first)
        found, end = shared.value.find(span_hashes(raw, at)), np.append(at[1:], len(data))
        missing = np.flatnonzero(found < 0)
        of = np.searchsorted(first, at[missing], "right") - 1
        ids, many = shared.value.fill(found, others(of.tolist(), [data[i:j] for i, j in zip(at[missing].tolist(), end[missing].tolist())]))
        # Ids before each text: those of all words before its first one.
        offset = np.append(0, np.cumsum(many))[np.append(np.searchsorted(at, first), len(at))]
        out = pa.RecordBatch.from_arrays(
            [part.column(0), pa.array(texts, pa.string()),
             pa.ListArray.from_arrays(pa.array(offset, pa.int32()), pa.array(ids, pa.int32()))], ["doc", "text", "ids"])
        return out if then is None else then[0](out)

    result = "doc long, text string, ids array<int>" if then is None else then[1]
    if pieces.unigram:
        coded_ = _with_joined(texts, word_codes(rare, pieces).select("word", "ids"), shared, apart, coded, result)
    else:
        coded_ = _with_folded(texts, pieces, coded, result)
    doc = F.when(F.col("doc") != NO_ID, F.col("doc")).alias(id_col)
    return coded_.select(doc, *[F.col(c).alias(text_col if c == "text" else c) for c in coded_.columns if c != "doc"])


def _with_folded(texts: DataFrame, pieces: Pieces, coded: Callable[..., pa.RecordBatch], result: str) -> DataFrame:
    """Texts coded where they are read: the rare words of a block go through lattice and fold there, each once.

    No text is moved.  A rare word stands in few texts, so it is folded little more often than once.
    """
    fold = _bpe_folder(pieces)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def others(_: list[int], words: list[bytes]) -> list:
            distinct = list(set(words))
            own = dict(zip(distinct, fold([w.decode() for w in distinct])))
            return [own[w] for w in words]

        for some in slices(batches):
            texts = some.column(1).to_pylist()
            for begin, stop, data, first in blocks(texts):
                yield coded(some.slice(begin, stop - begin), texts[begin:stop], data, first, others)

    return texts.mapInArrow(run, result)


def _with_joined(texts: DataFrame, rare: DataFrame, shared, apart: np.ndarray, coded: Callable[..., pa.RecordBatch], result: str) -> DataFrame:
    """Texts coded where they meet the codes of their rare words, which Spark's functions have folded."""
    def rare_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, docs_, words = batch.column(0).to_pylist(), [], []
            for begin, _, data, first in blocks(batch.column(1).to_pylist()):
                raw = np.frombuffer(data, np.uint8)
                at = word_starts(raw, apart, first)
                missing = np.flatnonzero(shared.value.find(span_hashes(raw, at)) < 0)
                end, of = np.append(at[1:], len(data)), np.searchsorted(first, at[missing], "right") - 1
                mine = {(ids[begin + d], data[i:j]) for d, i, j in zip(of.tolist(), at[missing].tolist(), end[missing].tolist())}
                docs_.extend(d for d, _ in mine)
                words.extend(w.decode() for _, w in mine)
            yield pa.RecordBatch.from_arrays([pa.array(docs_, pa.int64()), pa.array(words, pa.string())], ["doc", "word"])

    wanted = texts.mapInArrow(rare_words, "doc long, word string")
    lists = wanted.join(rare, "word").groupBy("doc").agg(F.collect_list(F.struct("word", "ids")).alias("rare"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            packed = [None if t is None else press.compress(t.encode("utf-8", "replace")) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], ["doc", "packed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdDecompressor()
        for some in slices(batches):
            texts = [None if p is None else press.decompress(p).decode() for p in some.column(1).to_pylist()]
            for begin, stop, data, first in blocks(texts):
                part = some.slice(begin, stop - begin)
                own = [{r["word"].encode(): r["ids"] for r in rows or []} for rows in part.column(2).to_pylist()]
                yield coded(part, texts[begin:stop], data, first, lambda of, words: [own[d][w] for d, w in zip(of, words)])

    met = texts.mapInArrow(pack, "doc long, packed binary").join(lists, "doc", "left").select("doc", "packed", "rare")
    return met.mapInArrow(run, result)


def piece_bytes(pieces: Pieces) -> list[bytes]:
    """What each id stands for; nothing for ids without a sign."""
    names = [b""] * max(max(pieces.ids) + 1, pieces.first_byte + 256)
    for i, name in zip(pieces.ids, pieces.names):
        names[i] = name.encode()
    for b in range(256):
        names[pieces.first_byte + b] = bytes([b])
    return names


def read_ids(ids: Sequence[int], names: Sequence[bytes]) -> str:
    return b"".join([names[i] for i in ids]).decode("utf-8", "replace")[1:]


def decode(coded: DataFrame, pieces: Pieces, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``coded`` with the text of its ids; bytes that are no UTF-8 become the replacement sign."""
    names = piece_bytes(pieces)

    @F.pandas_udf("string")
    def read(rows: pd.Series) -> pd.Series:
        return rows.map(lambda ids: None if ids is None else read_ids(ids.tolist(), names))

    return coded.withColumn(out, read(ids_col))


def public_pieces() -> Pieces:
    import public_tokenizers

    return Pieces.load(public_tokenizers.path("piece_bpe_32k.model"))


@query()
def op8_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    pieces = public_pieces()
    names = piece_bytes(pieces)

    def digest(coded: pa.RecordBatch) -> pa.RecordBatch:
        ids = [i.values.to_numpy() for i in coded.column(2)]
        texts = coded.column(1).to_pylist()
        return pa.RecordBatch.from_arrays(
            [coded.column(0), pa.array([len(i) for i in ids], pa.int64()),
             pa.array([zlib.crc32(i.astype("<u4").tobytes()) for i in ids], pa.int64()),
             pa.array([read_ids(i.tolist(), names) == (t or "") for i, t in zip(ids, texts)], pa.bool_())],
            ["doc", "n_ids", "ids_crc32", "round_trip"])

    return encode(table(spark, folder, "documents"), pieces,
                  then=(digest, "doc long, n_ids long, ids_crc32 long, round_trip boolean"))
