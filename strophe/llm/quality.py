"""Quality rules as a short-circuit cascade, in built-in column functions only.

Every rule gives a boolean column that is true where a text fails.  ``Cascade.fit`` runs each
rule on a sample, takes the time per row as its cost and the share of failing rows as its
selectivity, and orders rules by rejections per cost.  ``Cascade.keep`` is a CASE chain in
that order, so an expensive rule only sees texts that the cheaper and sharper ones passed.
The verdict is the conjunction of all rules and does not depend on the order: only the
work does, hence a different timing on a rerun changes no result.

Nulls: a null text is an empty one, and an empty text fails (too few words).  Ids, ties,
repeated rows and other columns play no part: each row is judged by its own text, however
long.  An empty table gives an empty one.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..sources.staging import stage
from .base import let, query, table, word_array

SYMBOLS = r"[#*$%&|<>]"
WINDOW = 8
SAMPLE_ROWS = 2_000


def repeat_words(words: Column, width: int = WINDOW) -> Column:
    """Words that lie in a window of ``width`` words found at least twice in the text.

    Windows are compared by hash.  Most texts have only distinct ones, which a hash set
    shows; the others sort (hash, position), keep positions whose hash has an equal
    neighbour, and add up how far each of these windows reaches beyond the one before.
    """
    def covered(windows: Column) -> Column:
        pairs = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def positions(t: Column) -> Column:
            found = F.filter(t, lambda x, j: F.coalesce(F.get(t, j - 1)["h"] == x["h"], F.lit(False))
                             | F.coalesce(F.get(t, j + 1)["h"] == x["h"], F.lit(False)))
            return F.array_sort(F.transform(found, lambda x: x["i"]))

        def reach(at: Column) -> Column:
            step = F.transform(at, lambda p, j: F.when(j == 0, F.lit(width)).otherwise(F.least(F.lit(width), p - F.get(at, j - 1))))
            return F.aggregate(step, F.lit(0), lambda s, x: s + x)

        return let(pairs, lambda t: let(positions(t), reach))

    def windows(hashes: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(hashes) - (width - 1)), lambda i: F.xxhash64(F.slice(hashes, i, width)))

    def counted(w: Column) -> Column:
        return F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(covered(w))

    hashed = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) <= width, F.lit(0)).otherwise(let(hashed, lambda h: let(windows(h), counted)))


def repeated_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda line: F.rlike(line, F.lit(r"[^\x20\x09-\x0D]")))
    return let(lines, lambda a: F.size(a) - F.size(F.array_distinct(a)))


def word_chars(words: Column) -> Column:
    return F.length(F.array_join(words, ""))


def symbols(text: Column) -> Column:
    return F.regexp_count(text, F.lit(SYMBOLS))


@dataclass(frozen=True)
class Rule:
    """``fails`` gives, for a text and its words, a column that is true for a text to reject."""

    name: str
    fails: Callable[[Column, Column], Column]


def base_rules() -> list[Rule]:
    return [Rule("too_short", lambda text, words: F.size(words) < 20),
            Rule("repetitive", lambda text, words: 100 * repeat_words(words) > 30 * F.size(words))]


def content_rules() -> list[Rule]:
    """Limits far outside prose, so that clean texts pass whatever their language."""
    def wordy(words: Column) -> Column:
        return F.size(F.filter(words, lambda w: F.rlike(w, F.lit(r"\p{L}"))))

    return [
        Rule("symbols", lambda text, words: 10 * symbols(text) > F.size(words)),
        Rule("word_length", lambda text, words: ~word_chars(words).between(2 * F.size(words), 15 * F.size(words))),
        Rule("repeated_lines", lambda text, words: 100 * repeated_lines(text) > 30 * F.size(F.split(text, "\n"))),
        Rule("not_words", lambda text, words: 100 * wordy(words) < 60 * F.size(words)),
    ]


def with_words(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``_text`` (null as empty) and ``_words``."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.withColumn("_text", text).withColumn("_words", word_array(F.col("_text")))


@dataclass(frozen=True)
class Cascade:
    rules: Sequence[Rule]

    @staticmethod
    def fit(docs: DataFrame, rules: Sequence[Rule], text_col: str = "text", rows: int = SAMPLE_ROWS, seed: int = 1) -> Cascade:
        """Order ``rules`` by rejections per second, measured on about ``rows`` rows of ``docs``."""
        total = docs.count()
        share = min(1.0, rows / max(total, 1))
        sample = stage(docs.select(F.col(text_col).alias("_sampled")).sample(False, share, seed))
        sample = with_words(sample, "_sampled")

        def run(fails: Column) -> tuple[float, int, int]:
            start = time.perf_counter()
            n, failed = sample.agg(F.count("_words"), F.count_if(fails)).first()
            return time.perf_counter() - start, n, failed

        run(F.lit(False))
        idle = min(run(F.lit(False))[0] for _ in range(2))
        scored = []
        for at, rule in enumerate(rules):
            seconds, n, failed = min(run(rule.fails(F.col("_text"), F.col("_words"))) for _ in range(2))
            scored.append((-(failed + 1) / (n + 1) / max(seconds - idle, 1e-3), at, rule))
        return Cascade([rule for *_, rule in sorted(scored, key=lambda s: s[:2])])

    def keep(self, first: Column | None = None, text: Column | str = "_text", words: Column | str = "_words") -> Column:
        """True for a text that no rule rejects; ``first``, if given, is a rejection known already."""
        text, words = [F.col(c) if isinstance(c, str) else c for c in (text, words)]
        chain = F.when(F.lit(False) if first is None else first, F.lit(False))
        for rule in self.rules:
            chain = chain.when(rule.fails(text, words), F.lit(False))
        return chain.otherwise(F.lit(True))


def measures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``_text``, ``_words``, the five counts and ``base_failed``."""
    text, words = F.col("_text"), F.col("_words")
    counted = with_words(docs, text_col).withColumns({
        "n_words": F.size(words).cast("long"), "word_chars": word_chars(words).cast("long"),
        "n_symbols": symbols(text).cast("long"), "n_dup_lines": repeated_lines(text).cast("long"),
        "n_repeat_words": repeat_words(words).cast("long")})
    return counted.withColumn("base_failed", F.expr("n_words < 20 or 100 * n_repeat_words > 30 * n_words"))


def measured_rules() -> list[Rule]:
    """The content rules over counts that ``measures`` has taken already."""
    known = {"symbols": lambda text, words: F.expr("10 * n_symbols > n_words"),
             "word_length": lambda text, words: F.expr("not word_chars between 2 * n_words and 15 * n_words"),
             "repeated_lines": lambda text, words: 100 * F.col("n_dup_lines") > 30 * F.size(F.split(text, "\n"))}
    return [Rule(r.name, known.get(r.name, r.fails)) for r in content_rules()]


def good_documents(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that no rule rejects, unchanged.

    Words are bound once for all rules: as a column, the optimizer would put the split into each of them.
    """
    cascade = Cascade.fit(docs, base_rules() + content_rules(), text_col)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.where(let(word_array(text), lambda words: cascade.keep(text=text, words=words)))


@query("""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text,
         list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS lines,
         len(string_split(coalesce(text, ''), chr(10))) AS n_lines
  FROM documents),
windows AS (SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS w
            FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 7)) AS i FROM t)),
again AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, w) > 1),
reach AS (SELECT doc_id, least(8, i - coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i), i - 8)) AS n FROM again),
repeats AS (SELECT doc_id, sum(n) AS n FROM reach GROUP BY doc_id),
counts AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words, n_lines,
         len(list_filter(words, lambda w: regexp_matches(w, '\\p{L}'))) AS wordy
  FROM t LEFT JOIN repeats r USING (doc_id)),
judged AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR word_chars NOT BETWEEN 2 * n_words AND 15 * n_words
            OR 100 * n_dup_lines > 30 * n_lines OR 100 * wordy < 60 * n_words) AS kept
FROM judged
""")
def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    cascade = Cascade.fit(docs, content_rules())
    verdict = {r.name: r for r in measured_rules()}
    ordered = Cascade([verdict[r.name] for r in cascade.rules])
    return measures(docs).withColumn("kept", ordered.keep(F.col("base_failed"))).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
