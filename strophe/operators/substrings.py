"""Substring join: texts that contain any of many needles.

A needle of ``gram`` letters or more is looked for by its rarest gram.  The grams of all needles
are known first; the texts' distinct grams that are among them form an inverted index of text
ids, whose counts say which gram of a needle is rarest.  Only texts with that gram meet the
needle.  Shorter needles are compared with the texts' distinct pieces of their length.  What is
shuffled are ids with one gram, at most one row for each position of a text; whole texts meet
nothing but survivors.  Needles and texts go by a 128-bit digest of the text, so repeated texts
are searched once in the joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.arrays import bind
from ..sources.staging import stage
from .joins import BROADCAST_BYTES, data_bytes, lookup_join
from .unnest import unnest

GRAM = 4


def pieces(text: Column | str, n: int) -> Column:
    """The stretches of ``n`` letters at each position of a text, taken from its letters so that the cost is linear."""
    text = F.col(text) if isinstance(text, str) else text

    def cut(letters: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(letters) - n)
        return F.when(F.size(letters) >= n, F.transform(starts, lambda i: F.concat(*[F.get(letters, i + k) for k in range(n)]))).otherwise(
            F.array().cast("array<string>"))

    return bind(F.split(text, ""), cut)


def rarest_grams(needles: DataFrame, index: DataFrame) -> DataFrame:
    """``(_gram, _needle)``: each needle under the gram that the fewest texts of ``index(_id, _gram)`` have; none if a gram is in no text."""
    counts = index.groupBy("_gram").agg(F.count(F.lit(1)).alias("_texts"))
    known = lookup_join(needles, stage(counts), ["_gram"], "left").withColumn("_texts", F.coalesce("_texts", F.lit(0)))
    best = known.groupBy("_needle").agg(F.min(F.struct("_texts", "_gram")).alias("_best"))
    return best.where("_best._texts > 0").select(F.col("_best._gram").alias("_gram"), "_needle")


def substring_matches(texts: DataFrame, text: str, needles: DataFrame, needle: str, gram: int = GRAM,
                      broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Distinct ``texts`` that contain any of the ``needles`` (null and empty needles match nothing)."""
    needles = stage(needles.select(F.col(needle).alias("_needle")).where("length(_needle) > 0").distinct())
    hay = texts.select(text).where(F.col(text).isNotNull()).withColumn("_id", F.md5(text))
    lengths = [r[0] for r in needles.select(F.least(F.length("_needle"), F.lit(gram)).alias("n")).distinct().collect()]  # at most ``gram``
    found = []
    for n in sorted(lengths):
        if n < gram:
            short = stage(needles.where(F.length("_needle") == n).select(F.col("_needle").alias("_piece")))
            cut = unnest(hay, ["_id"], F.array_distinct(pieces(text, n)), "_piece")
            hits = lookup_join(cut, short, ["_piece"], broadcast_bytes=broadcast_bytes).select("_id").distinct()
            found.append(_whole(hay, text, stage(hits), None, broadcast_bytes))
            continue
        parts = stage(unnest(needles.where(F.length("_needle") >= n), ["_needle"], F.array_distinct(pieces("_needle", n)), "_gram"))
        wanted = stage(parts.select("_gram").distinct())
        cut = unnest(hay, ["_id"], F.array_distinct(pieces(text, n)), "_gram")
        index = stage(lookup_join(cut, wanted, ["_gram"], broadcast_bytes=broadcast_bytes).select("_id", "_gram").distinct())
        keyed = stage(rarest_grams(parts, index))
        pairs = lookup_join(index, keyed, ["_gram"], broadcast_bytes=broadcast_bytes).select("_id", "_needle").distinct()
        found.append(_whole(hay, text, stage(pairs), "_needle", broadcast_bytes))
    if not found:
        return texts.select(text).limit(0)
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out.dropDuplicates(["_id"]).select(text)


def _whole(hay: DataFrame, text: str, hits: DataFrame, needle: str | None, broadcast_bytes: int) -> DataFrame:
    """The texts of ``hits(_id[, needle])``, verified where there is a needle."""
    asked = hits.withColumnRenamed("_id", "_asked")
    same = hay["_id"] == asked["_asked"]
    if needle:
        same &= F.contains(hay[text], asked[needle])
    if data_bytes(hits) <= broadcast_bytes:
        asked = F.broadcast(asked)
    return hay.join(asked, same, "left_semi").select("_id", text)
