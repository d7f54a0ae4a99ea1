"""Substring dedup by hashing lines, paragraphs or sentences.

A text is cut into units: lines, paragraphs (between blank lines) or sentences (a line, cut
after a full stop, question or exclamation mark that white space follows).  A unit is
normalised (lower case, runs of white space as one blank, ends trimmed) and digested.
Digests are grouped over all documents; the occurrence of smallest (document id, number of
the unit) is kept and every other one is removed, its offsets in the original text on record.

Units of fewer than ``min_words`` words stay: list marks, greetings and closings repeat
without being copies.  With ``runs`` the minimum holds for neighbouring units together: a unit
goes if it lies in a stretch of units, ``min_words`` words or more in all, that stands earlier
as a whole and does not overlap this one.  Units without words do not part a stretch.  For each unit the shortest
such stretch that starts and that ends with it is digested; any longer one consists of these.
A removed unit takes the white space behind it along.

The smallest occurrence is a minimum, so tasks reduce copies before the shuffle; the
repeated digests are joined back, which Spark splits for a line that stands in most
documents.  Whole texts move once, to meet the list of their removed units.

Nulls: a null text has no units and stays null.  A row with a null id ranks last.  Rows that
repeat an id rank by a hash of their text; equal rows get equal results, each keeping its
own first occurrence.  Other columns are carried along, but for those with a name of the result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import md5

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..sources.staging import stage
from .base import query, table, word_array

LAST = (1 << 63) - 1
# Where a unit ends: the separator belongs to the unit before it.
CUTS = {"line": r"(?<=\n)", "paragraph": r"(?<=\n)(?<=\n\n)(?!\n)", "sentence": r"(?<=\n)|(?<=[.!?][ \t])"}
_SPANS = "array<struct<start:int,end:int>>"
SPACE = re.compile(r"[\x20\x09-\x0D]+")
_DIGESTS, _DIGEST_TYPES = ["digest", "doc", "hash", "n", "size"], [pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int32()]


def cut_units(text: Column | str, unit: str = "line") -> Column:
    """The units of a text with the white space behind them; together they are the text."""
    return F.filter(F.split(text, CUTS[unit]), lambda u: u != "")


def normal(unit: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(unit, r"[\x20\x09-\x0D]+", " ")))


def occurrences(docs: DataFrame, unit: str, min_words: int) -> DataFrame:
    """``(digest, at)`` of every unit long enough; ``at`` is (document, hash of the text, number of the unit)."""
    units = docs.select("_doc", "_hash", F.posexplode_outer(cut_units("_text", unit)).alias("n", "unit")).where("n is not null")
    plain = units.select("_doc", "_hash", "n", normal(F.col("unit")).alias("plain"))
    long = plain.where(F.size(word_array("plain")) >= min_words)
    return long.select(F.unhex(F.md5("plain")).alias("digest"),
                       F.struct(F.col("_doc").alias("doc"), F.col("_hash").alias("hash"), F.col("n").alias("n")).alias("at"))


def repeated_units(docs: DataFrame, unit: str, min_words: int) -> DataFrame:
    """``(_doc, _hash, gone)``: the numbers of the units to remove from each document."""
    found = stage(occurrences(docs, unit, min_words))
    firsts = (found.groupBy("digest").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
              .select("digest", "first"))
    late = found.join(firsts, "digest").where("at > first")
    return late.groupBy(F.col("at.doc").alias("_doc"), F.col("at.hash").alias("_hash")).agg(F.collect_list("at.n").alias("gone"))


def stretches(text: str, cut: re.Pattern, min_words: int) -> dict[tuple[int, int], bytes]:
    """Digests of the shortest stretches of ``min_words`` words that start or end with each unit, by (first unit, units)."""
    units = [(n, words) for n, u in enumerate(u for u in cut.split(text) if u) if (words := SPACE.sub(" ", u).strip(" ").lower())]
    sums = [0]
    for _, words in units:
        sums.append(sums[-1] + words.count(" ") + 1)
    found, first = set(), 0
    for last in range(1, len(sums)):
        # Each start whose stretch is first complete here, then the latest start of one that ends here.
        while sums[last] - sums[first] >= min_words:
            found.add((first, last))
            first += 1
        if first and sums[last] - sums[first - 1] >= min_words:
            found.add((first - 1, last))
    return {(units[a][0], units[b - 1][0] - units[a][0] + 1): md5("\n".join(w for _, w in units[a:b]).encode("utf-8", "replace")).digest()
            for a, b in found}


def repeated_runs(docs: DataFrame, unit: str, min_words: int) -> DataFrame:
    """``(_doc, _hash, gone)`` as ``repeated_units``, of stretches of neighbouring units."""
    pattern = CUTS[unit]

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = re.compile(pattern)
        for batch in batches:
            for at in range(0, len(batch), 256):
                part, rows = batch.slice(at, 256), []
                for doc, hash_, text in zip(*(c.to_pylist() for c in part.columns)):
                    rows += [(d, doc, hash_, n, size) for (n, size), d in stretches(text, cut, min_words).items()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 5, _DIGEST_TYPES)], _DIGESTS)

    made = docs.where("_text is not null").select("_doc", "_hash", "_text").mapInArrow(
        digests, "digest binary, doc long, hash long, n int, size int")
    found = stage(made.select("digest", F.struct("doc", "hash", "n").alias("at"), "size"))
    # Staged, so that Spark may split the join for a stretch that stands in most documents.
    firsts = stage(found.groupBy("digest").agg(F.min("at").alias("first"), F.max("at").alias("last")).where("first < last")
                   .select("digest", "first"))
    apart = (F.col("at.doc") != F.col("first.doc")) | (F.col("at.hash") != F.col("first.hash")) | (F.col("at.n") >= F.col("first.n") + F.col("size"))
    late = found.join(firsts, "digest").where(F.col("at") > F.col("first")).where(apart)
    spans = late.groupBy(F.col("at.doc").alias("_doc"), F.col("at.hash").alias("_hash")).agg(F.collect_set(F.struct("at.n", "size")).alias("spans"))
    numbers = F.flatten(F.transform("spans", lambda s: F.sequence(s["n"], s["n"] + s["size"] - 1)))
    return spans.select("_doc", "_hash", F.array_distinct(numbers).alias("gone"))


def remove_repeated(docs: DataFrame, unit: str = "line", min_words: int = 10, id_col: str = "doc_id",
                    text_col: str = "text", runs: bool = False) -> DataFrame:
    """``docs`` with ``kept_text``, ``n_units``, ``n_removed`` (units) and ``removed``, the spans (in characters) cut out.

    ``runs`` counts the words of neighbouring repeated units together.  Spans of neighbouring units are joined.  A text of which nothing goes is returned as it is.
    """
    keyed = docs.select(F.struct("*").alias("_row"), F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("_doc"),
                        F.col(text_col).alias("_text"), F.xxhash64(text_col).alias("_hash"))
    repeated = repeated_runs if runs else repeated_units
    joined = keyed.join(repeated(keyed.select("_doc", "_hash", "_text"), unit, min_words), ["_doc", "_hash"], "left")
    pattern = CUTS[unit]

    @F.pandas_udf(f"struct<kept:string,n_units:long,removed:{_SPANS}>")
    def cut(texts: pd.Series, gone: pd.Series) -> pd.DataFrame:
        splitter, rows = re.compile(pattern), []
        for text, numbers in zip(texts, gone):
            pieces = [] if text is None else [u for u in splitter.split(text) if u]
            drop, spans, kept, at = set() if numbers is None else set(numbers), [], [], 0
            for n, piece in enumerate(pieces):
                if n not in drop:
                    kept.append(piece)
                elif spans and spans[-1]["end"] == at:
                    spans[-1]["end"] += len(piece)
                else:
                    spans.append({"start": at, "end": at + len(piece)})
                at += len(piece)
            rows.append((None if text is None else "".join(kept), len(pieces), spans))
        return pd.DataFrame(rows, columns=["kept", "n_units", "removed"])

    made = {"kept_text": F.col("_cut.kept"), "n_units": F.col("_cut.n_units"),
            "n_removed": F.coalesce(F.size(F.array_distinct("gone")), F.lit(0)).cast("long"), "removed": F.col("_cut.removed")}
    names = {c: f"_kept_{i}" for i, c in enumerate(docs.columns) if c not in made}
    # Else a filter on the kept text would be pushed below the cut and every text cut twice, in a second worker.  Columns are
    # taken out of the row beside it, since those that nobody reads are not seen through such a function.
    out = joined.select(*[F.col("_row")[c].alias(n) for c, n in names.items()], "gone", cut.asNondeterministic()("_text", "gone").alias("_cut"))
    return out.select(*[F.col(n).alias(c) for c, n in names.items()], *[v.alias(k) for k, v in made.items()])


def _measured(found: DataFrame) -> DataFrame:
    chars = F.aggregate("removed", F.lit(0).cast("long"), lambda s, x: s + (x["end"] - x["start"]))
    return found.select("doc_id", "n_units", "n_removed", F.size("removed").cast("long").alias("n_spans"),
                        chars.alias("removed_chars"), F.col("kept_text").alias("text"))


@query(r"""
WITH t AS (
  SELECT doc_id, list_filter(string_split(regexp_replace(text, '(\n|[.!?][ \t])', '\1' || chr(1), 'g'), chr(1)), lambda u: u <> '') AS units
  FROM documents),
u AS (SELECT doc_id, unnest(units) AS unit, generate_subscripts(units, 1) AS n FROM t),
digests AS (SELECT *, lower(trim(regexp_replace(unit, '[\x20\x09-\x0D]+', ' ', 'g'), ' ')) AS plain FROM u),
ranked AS (
  SELECT doc_id, n, unit,
         len(string_split(plain, ' ')) >= 10 AND row_number() OVER (PARTITION BY plain ORDER BY doc_id, n) > 1 AS gone
  FROM digests),
spans AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY n), false) AS opens FROM ranked)
SELECT doc_id, CAST(count(n) AS BIGINT) AS n_units, CAST(count_if(gone) AS BIGINT) AS n_removed,
       CAST(count_if(opens) AS BIGINT) AS n_spans,
       CAST(coalesce(sum(length(unit)) FILTER (gone), 0) AS BIGINT) AS removed_chars,
       coalesce(string_agg(unit, '' ORDER BY n) FILTER (NOT gone), '') AS text
FROM documents LEFT JOIN spans USING (doc_id) GROUP BY doc_id
""")
def op6_unit_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return _measured(remove_repeated(table(spark, folder, "documents").select("doc_id", "text"), "sentence"))


@query()
def op6_unit_runs(spark: SparkSession, folder: str) -> DataFrame:
    """As ``op6_unit_dedup``, with the word minimum for runs of neighbouring sentences."""
    return _measured(remove_repeated(table(spark, folder, "documents").select("doc_id", "text"), "sentence", runs=True))
