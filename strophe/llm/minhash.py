"""Near-duplicates: banded MinHash candidates, an odd-sketch check, links confirmed on whole sets.

A document is its set of word shingles.  Documents whose sets are equal form a class
with one representative, so copies never meet as pairs.  MinHash samples of the
representatives are cut into bands; equal bands put them into a bucket.

1. Each member of a bucket is compared with the smallest id of that bucket (a star, not
   all pairs).  Odd sketches (each sample flips one bit of a bitmap; the bits in which two
   bitmaps differ estimate how many samples differ) drop pairs far below the limit;
   the rest is confirmed on the whole sets.
2. Members of a bucket that then still lie in different components are compared with each
   other, by sketches, in blocks of bounded size, and the survivors confirmed likewise.
   Pairs inside one component need no look, so a bucket of near copies costs nothing here.

Step 2 looks at every pair of a bucket that step 1 did not join, so a link is lost only if
no band agrees: below 1e-6 at the limit with the default bands.

Nulls: a null or wordless text has an empty set and links with nothing.  A row without id
takes no part in links and gets a null component.  Rows that repeat an id are one document
(linked if any of their texts is), each keeping its own row.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.staging import stage
from .base import query, slices, table
from .components import components
from .wordhash import mix, shingle_set, word_rows

BITS = 1024


@dataclass(frozen=True)
class NearDuplicates:
    """Parameters: words of a shingle, limit of the similarity in percent, bands and their width."""

    width: int = 3
    percent: int = 85
    bands: int = 24
    rows: int = 5
    samples: int = 128
    block: int = 512
    seed: int = 1

    def most_different_bits(self) -> int:
        """Bits of two sketches that differ at six standard deviations below the limit."""
        off = 1 - self.percent / 100
        samples = min(self.samples, self.samples * off + 6 * (self.samples * off * (1 - off)) ** 0.5)
        return int(np.ceil(BITS / 2 * (1 - np.exp(-4 * samples / BITS))))

    def signatures(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """``(id, n, digest, bands, sketch)`` of each row; bands and sketch are null for an empty set."""
        width, bands, rows, samples, seed = self.width, self.bands, self.rows, self.samples, self.seed
        if bands * rows > samples:
            raise ValueError("bands x rows may not exceed the samples")

        def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            keys = mix(np.arange(1, samples + 1, dtype=np.uint64) + np.uint64(seed << 20))[:, None] | np.uint64(1)
            lane = np.arange(1, bands + 1, dtype=np.uint64) << np.uint64(32)
            at_bit = np.arange(samples, dtype=np.uint64) << np.uint64(48)
            for batch in slices(batches):
                out = [[], [], [], []]
                for words in word_rows(batch.column(1).to_pylist()):
                    items = shingle_set(words, width)
                    out[0].append(len(items))
                    if not len(items):
                        for column in out[1:]:
                            column.append(None)
                        continue
                    out[1].append(hashlib.blake2b(items.tobytes(), digest_size=16).digest())
                    low = np.full(samples, np.iinfo(np.uint64).max, np.uint64)
                    for i in range(0, len(items), 512):
                        np.minimum(low, ((items[None, i:i + 512] ^ keys) * keys).min(1), out=low)
                    band = np.zeros(bands, np.uint64)
                    for column in low[:bands * rows].reshape(bands, rows).T:
                        band = mix(band * np.uint64(31) + column + lane)
                    out[2].append(band.view(np.int64))
                    flips = np.bincount((mix(low + at_bit) % np.uint64(BITS)).astype(np.int64), minlength=BITS) & 1
                    out[3].append(np.packbits(flips.astype(np.uint8), bitorder="little").view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(out[0], pa.int64()), pa.array(out[1], pa.binary()),
                     pa.array(out[2], pa.list_(pa.int64())), pa.array(out[3], pa.list_(pa.int64()))],
                    ["id", "n", "digest", "bands", "sketch"])

        return docs.select(F.col(id_col).cast("long").alias("id"), text_col).mapInArrow(
            sign, "id long, n long, digest binary, bands array<long>, sketch array<long>")

    def sets(self, docs: DataFrame, ids: DataFrame, id_col: str, text_col: str) -> DataFrame:
        """``(id, items)``: the shingle sets of the documents in ``ids``."""
        width = self.width

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                items = [shingle_set(w, width).view(np.int64) for w in word_rows(batch.column(1).to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(items, pa.list_(pa.int64()))], ["id", "items"])

        texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
        return texts.join(ids, "id", "left_semi").mapInArrow(cut, "id long, items array<long>")

    def confirmed(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """Those ``pairs(a, b)`` whose sets reach the limit."""
        left, right = (sets.select(F.col("id").alias(k), F.col("items").alias(f"_{k}")) for k in "ab")
        shared = F.size(F.array_intersect("_a", "_b"))
        return (pairs.join(left, "a").join(right, "b")
                .withColumn("_n", shared).where(F.expr(f"100 * _n >= {self.percent} * (size(_a) + size(_b) - _n)"))
                .select("a", "b"))

    def alike(self, pairs: DataFrame, reps: DataFrame) -> DataFrame:
        """Those ``pairs(a, b)`` that sizes and odd sketches leave possible."""
        left, right = (reps.select(F.col("id").alias(k), F.col("n").alias(f"_n{k}"), F.col("sketch").alias(f"_{k}"))
                       for k in "ab")
        differing = F.aggregate(F.zip_with("_a", "_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
        fits = F.expr(f"100 * least(_na, _nb) >= {self.percent} * greatest(_na, _nb)")
        return (pairs.join(left, "a").join(right, "b").where(fits).where(differing <= self.most_different_bits())
                .select("a", "b"))

    def across(self, members: DataFrame) -> DataFrame:
        """Pairs of ``members(bucket, size, id, n, root, sketch)`` in one bucket but different components.

        A bucket is cut into blocks of about ``block`` members and every two blocks meet in a
        group of their own, so a task holds two blocks whatever the bucket's size.
        """
        percent, most = self.percent, self.most_different_bits()
        blocks = F.ceil(F.col("size") / self.block).cast("int")
        own = F.pmod(F.xxhash64("id"), blocks).cast("int")
        met = (members.withColumn("_own", own)
               .withColumn("_other", F.explode(F.sequence(F.lit(0), blocks - 1)))
               .select("bucket", F.least("_own", "_other").alias("lo"), F.greatest("_own", "_other").alias("hi"),
                       "_own", "id", "n", "root", "sketch"))

        def compare(key: tuple, tab: pa.Table) -> pa.Table:
            mine = tab.column("_own").to_numpy()
            ids, n, root = (tab.column(c).to_numpy() for c in ("id", "n", "root"))
            bits = tab.column("sketch").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(len(ids), -1)
            lo, hi = np.flatnonzero(mine == key[1]), np.flatnonzero(mine == key[2])
            a, b = [], []
            for i in lo:
                other = hi[hi > i] if key[1] == key[2] else hi
                other = other[(root[other] != root[i]) & (100 * np.minimum(n[other], n[i]) >= percent * np.maximum(n[other], n[i]))]
                if len(other):
                    other = other[np.bitwise_count(bits[other] ^ bits[i]).sum(1, dtype=np.int64) <= most]
                    a.append(np.full(len(other), ids[i]))
                    b.append(ids[other])
            a, b = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (a, b))
            return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})

        return met.groupBy("bucket", "lo", "hi").applyInArrow(compare, "a long, b long").distinct()

    def __call__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """``(id, n_shingles, component_id, kept)`` of each row of ``docs``."""
        signed = stage(self.signatures(docs, id_col, text_col))
        reps = stage(signed.where("id is not null and n > 0").groupBy("digest").agg(
            F.min("id").alias("id"), F.first("n").alias("n"), F.first("bands").alias("bands"),
            F.first("sketch").alias("sketch"), F.count(F.lit(1)).alias("copies")))

        filed = reps.select("id", F.explode("bands").alias("bucket"))
        shared = filed.groupBy("bucket").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("size")).where("size > 1")
        filed = stage(filed.join(shared, "bucket"))
        sets = stage(self.sets(docs, filed.select("id").distinct(), id_col, text_col))

        stars = filed.where("id <> first").select(F.col("first").alias("a"), F.col("id").alias("b")).distinct()
        linked = stage(self.confirmed(self.alike(stars, reps), sets))
        roots = components(linked)
        filed = filed.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
        open_ = filed.groupBy("bucket").agg(F.min("root").alias("_x"), F.max("root").alias("_y")).where("_x <> _y")
        members = (filed.join(open_.select("bucket"), "bucket", "left_semi").select("bucket", "size", "id", "root")
                   .join(reps.select("id", "n", "sketch"), "id"))
        # Rows of one id with different texts are one document, so its classes are linked.
        twice = signed.where("id is not null").groupBy("id").agg(F.min("digest").alias("_x"), F.max("digest").alias("_y")).where("_x <> _y")
        same = (signed.join(twice.select("id"), "id").select("digest", F.col("id").alias("a"))
                .join(reps.select("digest", F.col("id").alias("b")), "digest").select("a", "b"))
        linked = linked.union(self.confirmed(self.across(members), sets)).union(same)

        classes = reps.select("digest", F.col("id").alias("_rep")).join(
            components(linked).select(F.col("id").alias("_rep"), "root"), "_rep", "left")
        known = signed.select("id", "n", "digest").join(
            classes.select("digest", F.coalesce("root", "_rep").alias("root")), "digest", "left")
        component = F.when(F.col("id").isNotNull(), F.coalesce("root", "id"))
        return known.select("id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                            F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, finder: NearDuplicates, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each group; rows without id stay."""
    verdict = finder(docs, id_col, text_col).where("not kept").select(F.col("id").alias(id_col)).distinct()
    return docs.join(verdict, id_col, "left_anti")


@query()
def op1_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = NearDuplicates()(table(spark, folder, "documents"))
    return found.withColumnRenamed("id", "doc_id")
