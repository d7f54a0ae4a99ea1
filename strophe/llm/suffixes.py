"""Substring dedup by suffix order and longest-previous-factor arrays.

A byte goes if some string of ``LENGTH`` bytes that covers it also starts earlier, in a
document of smaller id or further left in the same one.  Windows of that length are the
suffixes to compare.  Sorting all of them would move the text a hundredfold, so:

1. *Anchors.*  A window names the smallest-hashed 32-byte string in it as its anchor, hence
   equal windows have equal anchors.  Neighbouring windows with one anchor form a context,
   about 35 windows.  Contexts are compared by hash, all copies but the first are removed,
   and a context stays in play only if another one with the same anchor differs from it:
   these lie at the ends of repeated passages.  Within a task copies are dropped before the
   shuffle, and an anchor with many different contexts (a common phrase) sends a few.
2. *Suffix order.*  Contexts in play meet by anchor with their bytes.  A block of them is
   one string whose suffixes are ranked to depth ``LENGTH`` by doubling.  In that order the
   nearest entries on either side that start earlier (previous and next smaller positions)
   give the longest previous factor; where it reaches ``LENGTH`` the window is a repeat.
   An anchor with more than ``GROUP`` contexts is refined.  Equal windows have it at the same
   place, so a window holds either the next half of its other bytes to the left of the anchor
   or more than that half to its right: each context becomes at most two rows, one for each
   side, under an anchor longer by that half.  This goes on where a group is still too large,
   until an anchor is a window; then the first of a group stays and no bytes are compared.
3. Removed stretches are gathered per document and cut out of its text.

Nulls: a null text is empty.  A row with a null id comes after all others.  Rows that
repeat an id are told apart by 87 bits of hashes of their text and come in their order; equal
rows get equal results, each keeping its own first occurrence.  An empty table gives no rows.
A text of any length is hashed in one pass; only its contexts and its compressed bytes travel.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.joins import lookup_join
from ..sources.staging import stage
from .base import query, table

LENGTH = 100
GRAM = 32  # bytes of an anchor; a window has LENGTH - GRAM + 1 of them
SURPLUS = 64  # contexts of one anchor that a task sends to the shuffle
GROUP = 1024  # contexts of one anchor in a block
BLOCK_BYTES = 1 << 20
FLUSH = 1_000_000
NO_ID = (1 << 63) - 1
KNOWN, REMOVED = 1, 2
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * _A
    x += b
    x ^= x >> np.uint64(29)
    x *= _B
    x ^= x >> np.uint64(32)
    return x


def eights(data: np.ndarray, big_endian: bool = False) -> np.ndarray:
    """The eight bytes that start at each position, as one number."""
    x = data.astype(np.uint64)
    for n in (1, 2, 4):
        shift = np.uint64(8 * n)
        x = (x[:-n] << shift) | x[n:] if big_endian else x[:-n] | (x[n:] << shift)
    return x


def window_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the GRAM bytes and of the LENGTH bytes at each position."""
    x = eights(data)
    x = _join(x, x)
    for n in (8, 16):
        x = _join(x[:-n], x[n:])
    y = _join(x[:-32], x[32:])
    return x, _join(y[:-(LENGTH - 64)], y[LENGTH - 64:])


def contexts(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First and last window of each context, its anchor's hash and its own, and where the anchor stands."""
    if len(data) < LENGTH:
        none = np.empty(0, np.uint64)
        return none.astype(np.int64), none.astype(np.int64), none, none, none.astype(np.int64)
    gram, window = window_hashes(data)
    low = np.uint64(0xFFFFFFFF)
    least = (gram & ~low) | np.arange(len(gram), dtype=np.uint64)
    for n in (1, 2, 4, 8, 16, 32, LENGTH - GRAM + 1 - 64):
        least = np.minimum(least[:-n], least[n:])
    anchor = (least & low).astype(np.int64)
    cut = np.flatnonzero(np.diff(anchor)) + 1
    lo = np.concatenate([[0], cut])
    hi = np.concatenate([cut - 1, [len(anchor) - 1]])
    return lo, hi, gram[anchor[lo]], _join(window[lo], window[hi] + (hi - lo).astype(np.uint64)), anchor[lo]


# A place is one number: 23 bits of checksum, 31 of offset, 7 of further windows, 2 of marks.
def places(crc: np.ndarray | int, lo: np.ndarray, more: np.ndarray) -> np.ndarray:
    return (np.asarray(crc, np.int64) << 40) | (lo.astype(np.int64) << 9) | (more.astype(np.int64) << 2)


def checksum(text: bytes) -> int:
    return zlib.crc32(text) & 0x7FFFFF


def tag(text: bytes) -> int:
    """What tells texts of one id apart besides the checksum."""
    return int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "little", signed=True)


def _batch(**columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns.values()], list(columns))


def _runs(*keys: np.ndarray) -> np.ndarray:
    """True where a row differs from the one before."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return new


def _again(new: np.ndarray, doc: np.ndarray, mark: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Rows of a run that stand where its first one does: the same text of a repeated row."""
    first = np.flatnonzero(new)[np.cumsum(new) - 1]
    return ~new & (doc == doc[first]) & (mark == mark[first]) & (place >> 2 == place[first] >> 2)


def find_contexts(docs: DataFrame) -> DataFrame:
    """``(gram, context, doc, tag, place)`` of ``docs(doc, text)``, reduced within each task."""
    def reduce(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        gram, context, doc, mark, place = (np.concatenate(c) for c in zip(*parts))
        order = np.lexsort((place, mark, doc, context, gram))
        gram, context, doc, mark, place = gram[order], context[order], doc[order], mark[order], place[order]
        new_gram, new = _runs(gram), _runs(gram, context)
        in_gram = np.cumsum(new_gram) - 1
        kinds = np.bincount(in_gram, weights=new)[in_gram]
        rank = np.cumsum(new) - 1
        rank = rank - rank[np.flatnonzero(new_gram)][in_gram]
        own = ~_again(new, doc, mark, place)
        place = place | np.where(new, np.where(kinds > 1, KNOWN, 0), REMOVED)
        # What needs no other row of its anchor goes to any task.
        loose = ~new | (rank >= SURPLUS)
        gram = np.where(loose, _join(doc.view(np.uint64), place.view(np.uint64)), gram)
        return _batch(gram=gram[own].view(np.int64), context=context[own].view(np.int64), doc=doc[own], tag=mark[own], place=place[own])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                data = text.encode("utf-8", "replace")
                lo, hi, gram, context, _ = contexts(np.frombuffer(data, np.uint8))
                if len(lo):
                    parts.append((gram, context, np.full(len(lo), doc, np.int64), np.full(len(lo), tag(data), np.int64),
                                  places(checksum(data), lo, hi - lo)))
                    held += len(lo)
                if held >= FLUSH:
                    yield reduce(parts)
                    parts, held = [], 0
        if parts:
            yield reduce(parts)

    return docs.mapInArrow(find, "gram long, context long, doc long, tag long, place long")


def sort_out(found: DataFrame) -> DataFrame:
    """``(doc, tag, crc, lo, more, removed)``: copies of a context, and first occurrences that differ from others of their anchor."""
    def judge(gram, context, doc, mark, place) -> pa.RecordBatch | None:
        new_gram, new = _runs(gram), _runs(gram, context)
        in_gram = np.cumsum(new_gram) - 1
        marks = place & 3
        shared = (np.bincount(in_gram, weights=new) > 1) | (np.bincount(in_gram, weights=marks == KNOWN) > 0)
        removed = ~new | (marks == REMOVED)
        out = (removed | shared[in_gram]) & ~_again(new, doc, mark, place)
        place = place[out]
        return _batch(doc=doc[out], tag=mark[out], crc=(place >> 40).astype(np.int32), lo=((place >> 9) & 0x7FFFFFFF).astype(np.int32),
                      more=((place >> 2) & 127).astype(np.int32), removed=removed[out])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        for batch in batches:
            rows = [batch.column(i).to_numpy() for i in range(5)]
            last = int(np.searchsorted(rows[0], rows[0][-1]))  # rows are sorted; the last anchor may go on
            if held and last == 0 and held[-1][0][-1] == rows[0][-1]:
                held.append(rows)
                continue
            done = [np.concatenate(c) for c in zip(*held, [r[:last] for r in rows])]
            if len(done[0]):
                yield judge(*done)
            held = [[r[last:] for r in rows]]
        if held:
            yield judge(*[np.concatenate(c) for c in zip(*held)])

    return found.repartition("gram").sortWithinPartitions("gram", "context", "doc", "tag", "place").mapInArrow(
        walk, "doc long, tag long, crc int, lo int, more int, removed boolean")


def packed_texts(docs: DataFrame) -> DataFrame:
    """``(doc, tag, crc, packed)``: texts compressed for a shuffle."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            texts = [t.encode("utf-8", "replace") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([tag(t) for t in texts], pa.int64()), pa.array([checksum(t) for t in texts], pa.int32()),
                 pa.array([press.compress(t) for t in texts], pa.binary())], ["doc", "tag", "crc", "packed"])

    return docs.mapInArrow(pack, "doc long, tag long, crc int, packed binary")


PIECES = "gram long, doc long, tag long, crc int, lo int, at int, size int, bytes binary"
ROW = ["doc", "tag", "crc"]


def with_bytes(docs: DataFrame, open_: DataFrame) -> DataFrame:
    """``PIECES`` of the contexts in ``open_``: the anchor has ``size`` bytes from ``at`` on."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdDecompressor()
        for batch in batches:
            for start in range(0, len(batch), 512):
                out: list[list] = [[] for _ in range(8)]
                for doc, mark, crc, packed, los in zip(*(c.to_pylist() for c in batch.slice(start, 512).columns)):
                    data = press.decompress(packed)
                    lo, hi, gram, _, anchor = contexts(np.frombuffer(data, np.uint8))
                    mine = np.flatnonzero(np.isin(lo, los))
                    known = [gram[mine].view(np.int64), np.full(len(mine), doc, np.int64), np.full(len(mine), mark, np.int64),
                             np.full(len(mine), crc, np.int32), lo[mine].astype(np.int32), (anchor - lo)[mine].astype(np.int32),
                             np.full(len(mine), GRAM, np.int32)]
                    for column, values in zip(out, known):
                        column.append(values)
                    out[7].extend(data[lo[k]:hi[k] + LENGTH] for k in mine)
                yield pa.RecordBatch.from_arrays([*[pa.array(np.concatenate(c)) for c in out[:7]], pa.array(out[7], pa.binary())],
                                                 ["gram", *ROW, "lo", "at", "size", "bytes"])

    wanted = open_.groupBy(*ROW).agg(F.collect_set("lo").alias("los"))
    return packed_texts(docs).join(wanted, ROW).select(*ROW, "packed", "los").mapInArrow(cut, PIECES)


def refined(pieces: DataFrame) -> DataFrame:
    """Each context as one row for the windows that hold the next bytes to the left of the anchor, one for the others."""
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for _, doc, mark, crc, lo, at, size, data in zip(*(c.to_pylist() for c in batch.columns)):
                windows = len(data) - LENGTH + 1
                half = (LENGTH - size + 1) // 2
                left = min(windows, at - half + 1)  # windows from 0 on that start at least ``half`` before the anchor
                sides = []
                if left > 0:
                    sides.append((0, left, at - half, size + half))
                if left < windows:
                    sides.append((max(left, 0), windows, at, LENGTH - half + 1))
                for first, end, from_, long in sides:
                    key = hashlib.blake2b(data[from_:from_ + long], digest_size=8, person=str(long).encode()).digest()
                    rows.append((int.from_bytes(key, "little", signed=True), doc, mark, crc, lo + first, from_ - first, long,
                                 data[first:end - 1 + LENGTH]))
            if rows:
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                                 ["gram", *ROW, "lo", "at", "size", "bytes"])

    return pieces.select("gram", *ROW, "lo", "at", "size", "bytes").mapInArrow(split, PIECES)


def suffix_ranks(data: np.ndarray) -> np.ndarray:
    """Rank of each position of ``data`` by its LENGTH bytes; positions nearer to the end are left out."""
    rank = np.unique(eights(data, big_endian=True), return_inverse=True)[1]
    for n in (8, 16, 32, LENGTH - 64):
        rank = np.unique(rank[:-n] * np.int64(len(data) + 1) + rank[n:], return_inverse=True)[1]
    return rank


def smaller_before(place: np.ndarray, run: np.ndarray) -> np.ndarray:
    """For each entry the nearest one before it, in its run, with a smaller place; -1 if there is none."""
    to = np.arange(-1, len(place) - 1)
    todo = np.flatnonzero(to >= 0)
    while len(todo):
        at = to[todo]
        apart = run[at] != run[todo]
        to[todo[apart]] = -1
        more = ~apart & (place[at] >= place[todo])
        todo = todo[more]
        to[todo] = to[at[more]]
        todo = todo[to[todo] >= 0]
    return to


def earlier_factors(data: np.ndarray, starts: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Whether the LENGTH bytes at each of ``starts`` occur at another start of smaller ``place``.

    ``place`` orders the starts, equal ones being no copies of each other.  In suffix order the longest previous factor of a start is
    the longer of its common prefixes with the previous and with the next entry of smaller
    place; here prefixes are told apart up to LENGTH.
    """
    rank = suffix_ranks(data)[starts]
    order = np.argsort(rank, kind="stable")
    run, at = rank[order], place[order]
    found = smaller_before(at, run) >= 0
    found |= smaller_before(at[::-1], run[::-1])[::-1] >= 0
    out = np.empty(len(starts), bool)
    out[order] = found
    return out


def repeats(pieces: DataFrame) -> DataFrame:
    """``(doc, tag, crc, start, end)``: stretches of ``PIECES`` to remove, each group of one anchor by itself."""
    def compare(tab: pa.Table) -> pa.RecordBatch:
        doc, mark, crc, lo = (tab.column(c).to_numpy() for c in ("doc", "tag", "crc", "lo"))
        text = tab.column("bytes").to_pylist()
        data = np.frombuffer(b"".join(text), np.uint8)
        sizes = np.array([len(t) for t in text])
        n = sizes - LENGTH + 1
        piece = np.repeat(np.arange(len(n)), n)
        offset = np.arange(len(piece)) - np.repeat(np.cumsum(n) - n, n)
        starts = np.repeat(np.cumsum(sizes) - sizes, n) + offset
        position = lo[piece] + offset
        order = np.lexsort((position, crc[piece], mark[piece], doc[piece]))
        place = np.empty(len(piece), np.int64)
        place[order] = np.cumsum(_runs(doc[piece][order], mark[piece][order], crc[piece][order], position[order]))
        again = earlier_factors(data, starts, place)
        edge = np.flatnonzero(_runs(piece, again))
        ends = np.append(edge[1:], len(piece)) - 1
        keep = again[edge]
        first, last = edge[keep], ends[keep]
        return _batch(doc=doc[piece[first]], tag=mark[piece[first]], crc=crc[piece[first]], start=position[first].astype(np.int32),
                      end=(position[last] + LENGTH).astype(np.int32))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            if not len(batch):
                continue
            held.append(batch)
            size += batch.column("bytes").nbytes
            if size < BLOCK_BYTES:
                continue
            # Rows are sorted by anchor; the last group may go on in the next batch.
            tab = pa.Table.from_batches(held)
            new = np.flatnonzero(_runs(tab.column("gram").to_numpy()))
            if new[-1]:
                yield compare(tab.slice(0, new[-1]))
                tab = tab.slice(new[-1])
            held = tab.combine_chunks().to_batches()
            size = tab.column("bytes").nbytes
        if held:
            yield compare(pa.Table.from_batches(held))

    sorted_ = pieces.repartition("gram").sortWithinPartitions("gram")
    return sorted_.select("gram", *ROW, "lo", "bytes").mapInArrow(walk, "doc long, tag long, crc int, start int, end int")


def repeated_spans(docs: DataFrame) -> DataFrame:
    """``(doc, tag, crc, spans)``: what to remove from ``docs(doc, text)``, overlapping and unordered."""
    known = stage(sort_out(find_contexts(docs)))
    copies = known.where("removed").select(*ROW, F.col("lo").alias("start"), (F.col("lo") + F.col("more") + LENGTH).alias("end"))
    pieces = stage(with_bytes(docs, known.where("not removed")))
    spans = [copies]
    while True:
        # Anchors with too many contexts are refined; the others are compared.
        full = stage(pieces.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > GROUP).select("gram", F.lit(True).alias("full")))
        if full.isEmpty():
            spans.append(repeats(pieces))
            break
        marked = stage(lookup_join(pieces, full, ["gram"], "left"))
        spans.append(repeats(marked.where("full is null")))
        crowded = marked.where("full")
        pieces = stage(refined(crowded.where(F.col("size") < LENGTH)))
        # Where the anchor is the window, all of a group are equal: the first one stays.
        same = crowded.where(F.col("size") == LENGTH).select("gram", *ROW, F.col("lo").alias("start"))
        firsts = stage(same.groupBy("gram").agg(F.min(F.struct(*ROW, "start")).alias("first")))
        if not firsts.isEmpty():
            late = lookup_join(same, firsts, ["gram"]).where(F.struct(*ROW, "start") > F.col("first"))
            spans.append(late.select(*ROW, "start", (F.col("start") + LENGTH).alias("end")))
    everything = spans[0]
    for more in spans[1:]:
        everything = everything.union(more)
    return everything.groupBy(*ROW).agg(F.collect_list(F.struct("start", "end")).alias("spans"))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_bytes, spans, kept)`` of each row: maximal removed stretches in bytes, and the bytes that stay."""
    known = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdDecompressor()
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.slice(at, 512)
                sizes, spans, kept = [], [], []
                for packed, mine in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                    data = press.decompress(packed)
                    gone = merged([(s["start"], s["end"]) for s in mine or []])
                    edges = [0, *[e for span in gone for e in span], len(data)]
                    sizes.append(len(data))
                    spans.append([{"start": a, "end": b} for a, b in gone])
                    kept.append(b"".join(data[a:b] for a, b in zip(edges[0::2], edges[1::2])))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sizes, pa.int64()),
                     pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), pa.array(kept, pa.binary())],
                    ["doc", "n_bytes", "spans", "kept"])

    out = packed_texts(known).join(repeated_spans(known), ROW, "left").select("doc", "packed", "spans").mapInArrow(
        cut, "doc long, n_bytes long, spans array<struct<start:int,end:int>>, kept binary")
    return out.withColumn("doc", F.when(F.col("doc") != NO_ID, F.col("doc"))).withColumnRenamed("doc", id_col)


@query()
def op7_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = remove_repeats(table(spark, folder, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + (x["end"] - x["start"]))
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"))
