"""Spelling variants by generation over a reduced alphabet.

1. *Words.*  Runs of letters are counted per task and added up; a word that is frequent and
   long enough belongs to the vocabulary.
2. *Reduction.*  Letters are mapped to a few symbols so that each symbol stands for about as
   many letters of the vocabulary.  The number of symbols rises with the eighth root of the
   vocabulary, so a reduced word stands for a few words at every size.
3. *Generation.*  Each reduced word's whole one-edit neighbourhood (itself, every deletion,
   replacement and insertion) is computed in numpy as hashes and joined to the hashes of the
   reduced vocabulary.  Two words one edit apart are at most one edit apart after reduction,
   so none is lost.
4. *Verification* on the words themselves: a distance of exactly one code point.
5. A reduced word that stands for more than ``CROWD`` words is not compared with all of them:
   the words that reach it generate their neighbourhoods once more over the whole alphabet,
   where a key has one word.  So candidates are at most ``CROWD`` times the generated rows.
6. A word's form is its near word of largest count, if that is ``RATIO`` times its own; forms
   are followed to the root by doubling, in as many rounds as the logarithm of a chain.

Words of more than ``LONG`` letters travel as digests and are compared after they were looked up.

Nulls: a null text has no words; a null id is the empty text in the hash that drops letters.
Empty texts and empty tables give no words.  A text of any length is cut into its words in one
pass; a word may be as long as a text.  Repeated rows count as often as they occur.  Of near words with
equal counts the first in code-point order is the form.  Other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.joins import lookup_join
from ..sources.staging import stage
from .base import query, table

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LEAST_LENGTH, LEAST_COUNT, RATIO = 6, 5, 5
SLIPS = 199  # one run in so many loses a letter; 0 leaves all as they are
CROWD = 64
LONG = 64
FLUSH = 200_000
CELLS = 1 << 18
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def slipped(doc_id: int | None, run: str, slips: int) -> str:
    """The run, without one letter where the hash of document and run says so."""
    if not slips:
        return run
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if h % slips:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slips: int = SLIPS,
                least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """``(word, n)``: the vocabulary with its counts over all documents."""
    def emit(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
                                          ["word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):  # scalars, so that only one text is a Python string
                text = text.as_py()
                if not text:
                    continue
                doc_id = doc_id.as_py()
                runs = Counter(RUN.findall(text.encode("utf-8", "replace").lower().decode()))  # bytes lower A-Z alone
                for run, n in runs.items():
                    word = slipped(doc_id, run, slips)
                    if len(word) >= least_length:
                        counts[word] += n
                if len(counts) >= FLUSH:
                    yield emit(counts)
                    counts.clear()
        if counts:
            yield emit(counts)

    texts = docs.select(F.col(id_col).cast("long"), F.col(text_col))
    return (texts.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= least_count))


# Letters are Latin-1, so a word is one byte a letter and a mapping is a table of 256 symbols.
Alphabet = tuple[np.ndarray, int]


def balanced(letters: Sequence[tuple[str, int]], symbols: int) -> Alphabet:
    """Each letter, the most frequent first, goes to the symbol with the least load."""
    mapping, load = np.zeros(256, np.uint64), [0] * symbols
    for letter, n in sorted(letters, key=lambda x: (-x[1], x[0])):
        at = load.index(min(load))
        mapping[ord(letter)] = at + 1
        load[at] += n
    return mapping, symbols


def whole(letters: Sequence[tuple[str, int]]) -> Alphabet:
    """Every letter is its own symbol."""
    mapping = np.zeros(256, np.uint64)
    mapping[sorted(ord(x) for x, _ in letters)] = np.arange(1, len(letters) + 1, dtype=np.uint64)
    return mapping, len(letters)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


def reduced(words: Sequence[str], alphabet: Alphabet) -> np.ndarray:
    """Symbols of words of one length, one row a word."""
    return alphabet[0][np.frombuffer("".join(words).encode("latin-1"), np.uint8)].reshape(len(words), -1)


def hashes(words: Sequence[str], alphabet: Alphabet) -> np.ndarray:
    """The hash of each reduced word, of any lengths."""
    out = np.empty(len(words), np.uint64)
    for k, word in enumerate(words):
        symbols = reduced([word], alphabet)[0]
        out[k] = (symbols * _powers(_BASE, len(symbols))).sum()
    return out


def neighbourhoods(words: Sequence[str], alphabet: Alphabet) -> tuple[np.ndarray, np.ndarray]:
    """``(index, hash)`` of all reduced words at most one edit from each of ``words`` (of one length), each once."""
    symbols = reduced(words, alphabet)
    rows, n = symbols.shape
    up = _powers(_BASE, n + 1)
    before = np.zeros((rows, n + 1), np.uint64)
    np.cumsum(symbols * up[:n], axis=1, out=before[:, 1:])
    total = before[:, -1:]
    every = np.arange(1, alphabet[1] + 1, dtype=np.uint64)
    replaced = total[:, :, None] + (every[None, None, :] - symbols[:, :, None]) * up[None, :n, None]
    deleted = before[:, :-1] + (total - before[:, 1:]) * _BACK
    inserted = (before + (total - before) * _BASE)[:, :, None] + every[None, None, :] * up[None, :, None]
    found = np.concatenate([replaced.reshape(rows, -1), deleted, inserted.reshape(rows, -1)], axis=1)
    found.sort(axis=1)
    new = np.ones(found.shape, bool)
    new[:, 1:] = found[:, 1:] != found[:, :-1]
    return np.nonzero(new)[0], found[new]


def _keyed(words: DataFrame, alphabet: Alphabet) -> DataFrame:
    """``(key, ref, n)`` of ``words(word, ref, n)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = hashes(batch.column(0).to_pylist(), alphabet)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), batch.column(1), batch.column(2)], ["key", "ref", "n"])

    return words.select("word", "ref", "n").mapInArrow(run, "key long, ref string, n long")


def _generated(words: DataFrame, alphabet: Alphabet) -> DataFrame:
    """``(key, a)`` for each reduced word near to each of ``words(word, ref)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, refs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            by_length: dict[int, list[int]] = {}
            for k, word in enumerate(words):
                by_length.setdefault(len(word), []).append(k)
            for length, members in by_length.items():
                step = max(1, CELLS // (2 * (length + 1) * (alphabet[1] + 1)))
                for at in range(0, len(members), step):
                    part = members[at:at + step]
                    index, keys = neighbourhoods([words[k] for k in part], alphabet)
                    mine = pa.array([refs[k] for k in part], pa.string()).take(pa.array(index))
                    yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), mine], ["key", "a"])

    return words.select("word", "ref").mapInArrow(run, "key long, a string")


def _digest(ref: str) -> Column:
    return F.startswith(ref, F.lit("#"))


def _one_edit(a: str, b: str) -> Column:
    return F.levenshtein(a, b, 1) == 1


def _meet(sources: DataFrame, targets: DataFrame, alphabet: Alphabet, crowd: int | None) -> DataFrame:
    """``(a, b, n_b)``: verified pairs (those with digests not yet), and ``b`` null where ``a`` reaches a crowded key.

    A key has one row here, with its words in an array of at most ``crowd``, so a hot key is
    divided by splitting the generated rows alone.
    """
    word = F.struct(F.col("ref").alias("b"), F.col("n").alias("n_b"))
    keyed = _keyed(targets, alphabet)
    if crowd is None:
        grouped = keyed.select("key", F.array(word).alias("words"))
    else:
        keyed = stage(keyed)
        sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("size"))
        few = keyed.join(sizes.where(F.col("size") <= crowd), "key").groupBy("key").agg(F.collect_list(word).alias("words"))
        many = sizes.where(F.col("size") > crowd).select("key", F.array(F.lit(None).cast("struct<b:string,n_b:bigint>")).alias("words"))
        grouped = few.unionByName(many)
    met = _generated(sources, alphabet).join(grouped.hint("shuffle_hash"), "key").select("a", F.explode("words").alias("w"))
    near = (F.col("a") != F.col("b")) & (_digest("a") | _digest("b") | _one_edit("a", "b"))
    return met.select("a", "w.b", "w.n_b").where(F.col("b").isNull() | near)


def near_words(vocab: DataFrame, symbols: int | None = None, crowd: int = CROWD) -> DataFrame:
    """``(word, ref, n, near, n_near)`` of ``vocab(word, n)``: ``near`` is ``(n, word)`` of the best near word.

    ``symbols`` is the size of the reduced alphabet, by default the eighth root of the vocabulary's size.
    """
    ref = F.when(F.length("word") <= LONG, F.col("word")).otherwise(F.concat(F.lit("#"), F.sha2("word", 256)))
    vocab = stage(vocab.select("word", "n", ref.alias("ref")))
    size, longs = vocab.agg(F.count(F.lit(1)), F.count_if(_digest("ref"))).first()
    # At most as many letters as Latin-1 has.
    letters = [(r[0], r[1]) for r in vocab.select(F.explode(F.split("word", "")).alias("x")).where("x <> ''").groupBy("x").count().collect()]
    symbols = symbols or max(3, -int(-(max(size, 1) ** 0.125) // 1))
    found = stage(_meet(vocab, vocab, balanced(letters, symbols), crowd))
    pairs = found.where(F.col("b").isNotNull())
    reached = found.where(F.col("b").isNull()).select(F.col("a").alias("ref")).distinct()
    if not reached.isEmpty():
        alphabet = balanced(letters, symbols)
        keyed = _keyed(vocab, alphabet)
        crowded = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > crowd)
        targets = vocab.join(keyed.join(crowded, "key", "left_semi").select("ref"), "ref", "left_semi")
        pairs = pairs.union(_meet(vocab.join(reached, "ref", "left_semi"), targets, whole(letters), None))
    if longs:
        pairs = _looked_up(stage(pairs), vocab)
    best = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("n_b")).alias("n"), F.col("b").alias("word"))).alias("near"))
    out = vocab.join(best, vocab["ref"] == best["a"], "left")
    near = F.when(F.col("near").isNotNull(), F.struct((-F.col("near.n")).alias("n"), F.col("near.word").alias("word")))
    return out.select("word", "n", near.alias("near"), F.coalesce("n_near", F.lit(0)).alias("n_near"))


def _looked_up(pairs: DataFrame, vocab: DataFrame) -> DataFrame:
    """Pairs with digests replaced by their words and verified; ``a`` stays a reference."""
    words = vocab.where(_digest("ref"))
    of_a = words.select(F.col("ref").alias("a"), F.col("word").alias("_a"))
    of_b = words.select(F.col("ref").alias("b"), F.col("word").alias("_b"))
    long_ = pairs.where(_digest("a") | _digest("b")).join(of_a, "a", "left").join(of_b, "b", "left").select(
        "a", F.coalesce("_a", "a").alias("_a"), F.coalesce("_b", "b").alias("b"), "n_b")
    return pairs.where(~(_digest("a") | _digest("b"))).unionByName(long_.where(_one_edit("_a", "b")).drop("_a"))


def roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` of ``forms(word, form)``: forms followed to the last.  Counts rise along a chain, so none is a circle."""
    reach = stage(forms.select("word", F.col("form").alias("root")))
    while True:
        next_ = reach.select(F.col("word").alias("root"), F.col("root").alias("_further"))
        longer = stage(lookup_join(reach, next_, ["root"], "left").select(
            "word", F.coalesce("_further", "root").alias("root"), F.col("_further").isNotNull().alias("moved")))
        if longer.where("moved").isEmpty():
            return longer.select("word", "root")
        reach = longer.select("word", "root")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ratio: int = RATIO, slips: int = SLIPS,
                      least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, symbols: int | None = None,
                      crowd: int = CROWD) -> DataFrame:
    """``(word, n, n_near, form, form_n, root)`` of every word of the vocabulary."""
    vocab = word_counts(docs, id_col, text_col, slips, least_length, least_count)
    near = near_words(vocab, symbols, crowd)
    is_form = F.col("near.n") >= ratio * F.col("n")
    formed = stage(near.select("word", "n", "n_near", F.when(is_form, F.col("near.word")).alias("form"),
                               F.when(is_form, F.col("near.n")).alias("form_n")))
    rooted = roots(formed.where("form is not null").select("word", "form"))
    return formed.join(rooted, "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


@query()
def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    found = spelling_variants(table(spark, folder, "documents"))
    return found.select("word", "form", "root", "n", "n_near", "form_n")
