"""Term tables: postings, document frequencies, TF-IDF, vocabularies, chi-squared.

``postings`` is the common form: one row per document and distinct term.  It is
made without a shuffle.  Terms are then counted with map-side combining, and a
term that occurs in every document is joined through ``lookup_join``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.arrays import pad_sequence, term_counts
from ..functions.text import WORD
from ..sources.staging import stage
from .dictionary import dictionary as as_dictionary
from .joins import BROADCAST_BYTES, hashable, lookup_join
from .ordered import numbered
from .unnest import unnest, unnest_structs

SHARDS = 16
SCORE_DIGITS = 9  # scores are ranked rounded, so the order of a sum cannot decide a tie


def postings(df: DataFrame, doc: str, tokens: str | Column, by: Sequence[str] = ()) -> DataFrame:
    """``(by..., doc, term, tf)``."""
    tokens = F.col(tokens) if isinstance(tokens, str) else tokens
    return unnest_structs(df, [*by, doc], term_counts(tokens), "term")


def anti_terms(terms: DataFrame, stop: DataFrame, term: str = "term") -> DataFrame:
    """Drop the terms of a stop list kept as a table."""
    listed = stop.select(F.col(stop.columns[0]).alias(term), F.lit(True).alias("_stop")).distinct()
    return lookup_join(terms, stage(listed), [term], "left").where("_stop is null").drop("_stop")


def term_stats(posted: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Document frequency and corpus frequency per term."""
    return posted.groupBy(*by, "term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf"))


def _bound(limit: int | float, n: Column) -> Column:
    """A whole number counts documents, a fraction is a share of them."""
    return F.lit(limit) if isinstance(limit, int) else F.lit(limit) * n


def fit_terms(
    posted: DataFrame, docs: DataFrame, by: Sequence[str] = (), min_df: int | float = 1,
    max_df: int | float = 1.0, max_features: int | None = None,
) -> DataFrame:
    """The fitted vocabulary ``(by..., term, df, cf, n, idf)``, staged.

    ``docs`` has one row per document, also for documents without terms, which
    count in ``n``.  The cap keeps the terms with the highest corpus frequency.
    """
    by = list(by)
    stats = term_stats(posted, by)
    if by:
        sizes = stage(docs.groupBy(*by).agg(F.count(F.lit(1)).alias("n")))
        stats = lookup_join(stats, sizes, by)
    else:
        stats = stats.withColumn("n", F.lit(docs.count()).cast("long"))
    n = F.col("n")
    kept = stats.where((F.col("df") >= _bound(min_df, n)) & (F.col("df") <= _bound(max_df, n)))
    if max_features is not None:
        kept = top_per_group(kept, by, F.col("cf"), max_features)
    return stage(kept.withColumn("idf", F.log((1 + n) / (1 + F.col("df"))) + 1))


def top_per_group(df: DataFrame, by: Sequence[str], score: Column, k: int, term: Column | str = "term",
                  rank: str | None = None) -> DataFrame:
    """The ``k`` best rows per group, ties in term order.

    The row-number filter keeps ``k`` rows per group and task before the shuffle.
    Without groups the rows are dealt to ``SHARDS`` shards first, so that the one task
    that merges sees at most ``SHARDS * k`` rows, however many tasks there were.
    """
    best = [F.desc("_score"), F.col(term) if isinstance(term, str) else term]
    scored = df.withColumn("_score", score)
    if not by:
        shard = F.pmod(F.xxhash64(*hashable(df)), F.lit(SHARDS))
        place = F.row_number().over(Window.partitionBy("_shard").orderBy(*best))
        scored = scored.withColumn("_shard", shard).withColumn("_place", place).where(
            F.col("_place") <= k).drop("_shard", "_place")
    if by:
        place = F.row_number().over(Window.partitionBy(*by).orderBy(*best))
        scored = scored.withColumn("_rank", place).where(F.col("_rank") <= k)
    else:
        scored = scored.orderBy(*best).limit(k)
        if rank:
            scored = scored.withColumn("_rank", F.row_number().over(Window.partitionBy().orderBy(*best)))
    return (scored.withColumn(rank, F.col("_rank").cast("int")) if rank else scored).drop("_score", "_rank")


def tfidf_transform(posted: DataFrame, terms: DataFrame, doc: str, by: Sequence[str] = ()) -> DataFrame:
    """``(by..., doc, term, weight)`` with rows of length one; unknown terms drop out."""
    raw = lookup_join(posted, terms.select(*by, "term", "idf"), [*by, "term"]).select(
        *by, doc, "term", (F.col("tf") * F.col("idf")).alias("_w"))
    length = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(*by, doc)))
    return raw.select(*by, doc, "term", (F.col("_w") / length).alias("weight"))


def tfidf(df: DataFrame, doc: str, tokens: str | Column, by: Sequence[str] = (), **limits) -> DataFrame:
    """Fit and transform; the postings are staged because both steps read them."""
    posted = stage(postings(df, doc, tokens, by))
    return tfidf_transform(posted, fit_terms(posted, df, by, **limits), doc, by)


def mean_weights(weights: DataFrame, terms: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean weight of each term over all documents of its group; absent counts as 0."""
    by = list(by)
    sums = weights.groupBy(*by, "term").agg(F.sum("weight").alias("_sum"))
    return lookup_join(sums, terms.select(*by, "term", "n"), [*by, "term"]).select(
        *by, "term", (F.col("_sum") / F.col("n")).alias("weight"))


def key_terms(df: DataFrame, doc: str, tokens: str | Column, by: Sequence[str], k: int = 5,
              min_df: int | float = 0.02, max_df: int | float = 0.8) -> DataFrame:
    """The ``k`` terms with the highest mean TF-IDF of each class, fitted per class in one job.

    A share as ``min_df`` bounds the vocabulary: at most mean terms per document / min_df terms survive.
    """
    posted = stage(postings(df, doc, tokens, by))
    terms = fit_terms(posted, df, by, min_df, max_df)
    means = mean_weights(tfidf_transform(posted, terms, doc, by), terms, by)
    return top_per_group(means, by, F.round("weight", SCORE_DIGITS), k, rank="rank")


def chi2_scores(posted: DataFrame, docs: DataFrame, label: str) -> DataFrame:
    """Chi-squared of term counts against class shares, ``(term, df, cf, chi2)``.

    With o the count in a class and e = share * total, the sum of (o-e)^2/e over
    all classes is sum(o^2/share)/total - total, so absent cells need no rows.
    Documents without a label play no part.
    """
    posted = posted.where(F.col(label).isNotNull())
    sizes = stage(docs.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("_n")))
    total = sizes.agg(F.sum("_n")).first()[0] or 0
    observed = posted.groupBy(label, "term").agg(F.sum("tf").alias("_o"), F.count(F.lit(1)).alias("_df"))
    shared = lookup_join(observed, sizes, [label]).withColumn("_share", F.col("_n") / F.lit(total))
    return shared.groupBy("term").agg(
        F.sum("_df").alias("df"), F.sum("_o").alias("cf"),
        (F.sum(F.col("_o").cast("double") * F.col("_o") / F.col("_share")) / F.sum("_o") - F.sum("_o")).alias("chi2"))


def chi2_select(posted: DataFrame, docs: DataFrame, label: str, k: int = 5000, min_df: int | float = 2,
                max_df: int | float = 0.8) -> DataFrame:
    """The ``k`` terms with the highest chi-squared; among equal ones the later in the alphabet, staged."""
    docs = docs.where(F.col(label).isNotNull())
    n = docs.count()
    scores = chi2_scores(posted, docs, label).where(
        (F.col("df") >= _bound(min_df, F.lit(n))) & (F.col("df") <= _bound(max_df, F.lit(n))))
    best = top_per_group(scores, [], F.round("chi2", SCORE_DIGITS), k, term=F.desc("term"))
    return stage(best.withColumn("n", F.lit(n).cast("long")).withColumn(
        "idf", F.log((1 + F.lit(n)) / (1 + F.col("df"))) + 1))


def fit_vocab(df: DataFrame, doc: str, tokens: str, max_words: int = 20000) -> DataFrame:
    """``(term, cf, idx)``: 1 is kept for unknown words, indices below ``max_words`` go by frequency.

    Equal counts keep first-seen order.  Document id and position are packed into
    one number, so that the minimum is a fixed-width aggregate.
    """
    seen = F.col(doc).cast("decimal(20,0)") * F.lit(1 << 32).cast("decimal(11,0)") + F.col("_pos")
    words = unnest(df, [doc], tokens, "term", "_pos")
    counts = words.groupBy("term").agg(F.count(F.lit(1)).alias("cf"), F.min(seen).alias("_seen"))
    ranked = top_per_group(counts, [], F.col("cf"), max(max_words - 2, 0), term="_seen", rank="idx")
    return stage(ranked.select("term", "cf", (F.col("idx") + 1).alias("idx")))


def to_sequences(df: DataFrame, doc: str, tokens: str, vocab: DataFrame, length: int | None = None,
                 out: str = "sequence") -> DataFrame:
    """``(doc, sequence)`` of vocabulary indices, unknown words as 1.

    With ``length`` tokens are cut first and the result is padded with 0.  What is
    shuffled is then one short integer list per document.
    """
    taken = F.col(tokens) if length is None else F.slice(tokens, 1, length)
    words = df.select(doc, F.posexplode_outer(taken).alias("_pos", "term"))
    indexed = lookup_join(words, vocab.select("term", "idx"), ["term"], "left")
    unknown = F.when(F.col("_pos").isNotNull(), F.struct("_pos", F.coalesce("idx", F.lit(1)).alias("idx")))
    ordered = indexed.groupBy(doc).agg(F.sort_array(F.collect_list(unknown)).alias("_s"))
    seq = F.transform("_s", lambda s: s["idx"])
    return ordered.select(doc, (seq if length is None else pad_sequence(seq, length)).alias(out))


def dictionary(posted: DataFrame, doc: str) -> DataFrame:
    """Term ids in the order of first document, then term; numbered without one task for all terms."""
    terms = posted.groupBy("term").agg(F.min(doc).alias("_first"), F.count(F.lit(1)).alias("df"))
    return numbered(terms, [], ["_first", "term"], "term_id").select("term", "df", "term_id")


def bag_of_words(posted: DataFrame, doc: str, ids: DataFrame) -> DataFrame:
    """``(doc, term_id, tf)``."""
    return lookup_join(posted, ids.select("term", "term_id"), ["term"]).select(doc, "term_id", "tf")


def dense_matrix(bag: DataFrame, doc: str, max_docs: int = 1000) -> DataFrame:
    """One row per term, one column per document; each document is a column, so there may be few."""
    docs = sorted(r[0] for r in bag.select(doc).distinct().limit(max_docs + 1).collect())
    if len(docs) > max_docs:
        raise ValueError(f"more than {max_docs} documents do not fit into columns")
    return bag.groupBy("term_id").pivot(doc, docs).agg(F.sum("tf")).na.fill(0)


@dataclass(frozen=True)
class Scaling:
    """Mean and population standard deviation of one column."""

    mean: float
    std: float

    def apply(self, col: Column) -> Column:
        return (col - F.lit(self.mean)) / F.lit(self.std)


def fit_scaling(df: DataFrame, col: str) -> Scaling:
    mean, std = df.agg(F.avg(col), F.stddev_pop(col)).first()
    return Scaling(mean or 0.0, std or 1.0)


def lemmatize(df: DataFrame, keys: Sequence[str], tokens: str, lemmas: DataFrame, out: str = "lemmas",
              keep_punctuation: bool = False, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Replace each token by its entry in ``lemmas(token, lemma)``, itself when there is none.

    Punctuation tokens are dropped unless asked for; null text stays null.  A lemma table of
    checked size is looked up inside the row, which then does not move.  Beyond it the tokens
    are joined, and put together again before they are shuffled.
    """
    known = as_dictionary(lemmas, "token", "lemma", broadcast_bytes)
    if known is not None:
        kept = F.col(tokens) if keep_punctuation else F.filter(tokens, lambda t: t.rlike(WORD))
        return df.withColumn(out, known.replace(kept))
    words = unnest(df, keys, tokens, "token", "_pos")
    if not keep_punctuation:
        words = words.where(F.col("token").rlike(WORD))
    found = lookup_join(words, lemmas.select("token", "lemma"), ["token"], "left")
    lists = found.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("_pos", F.coalesce("lemma", "token").alias("lemma")))).alias("_l"))
    empty = F.when(F.col(tokens).isNotNull(), F.array().cast("array<string>"))
    return df.join(lists, list(keys), "left").select(
        *df.columns, F.coalesce(F.col("_l.lemma"), empty).alias(out))


# Endings an English word form may carry and what stands in their place (WordNet's detachment rules).
DETACHMENT_RULES = [
    ("s", ""), ("ses", "s"), ("ves", "f"), ("xes", "x"), ("zes", "z"), ("ches", "ch"), ("shes", "sh"),
    ("men", "man"), ("ies", "y"), ("es", "e"), ("es", ""), ("ed", "e"), ("ed", ""), ("ing", "e"), ("ing", ""),
    ("er", ""), ("est", ""), ("er", "e"), ("est", "e"),
]


def derive_lemmas(words: DataFrame, token: str = "token") -> DataFrame:
    """A lemma table from the words of a corpus: strip an ending where the base is itself a word.

    Stands in for an external dictionary; the first rule in the list wins.
    """
    words = stage(words.select(F.col(token).alias("token")).distinct())
    forms = F.array(*[
        F.when(F.endswith("token", F.lit(end)) & (F.length("token") > len(end) + 1), F.struct(
            F.lit(i).alias("rule"),
            F.concat(F.expr(f"left(token, length(token) - {len(end)})"), F.lit(base)).alias("lemma")))
        for i, (end, base) in enumerate(DETACHMENT_RULES)])
    guesses = words.select("token", F.explode(F.filter(forms, lambda x: x.isNotNull())).alias("g")).select(
        "token", "g.rule", "g.lemma")
    known = guesses.join(words.select(F.col("token").alias("lemma")), "lemma")
    return known.groupBy("token").agg(F.min(F.struct("rule", "lemma")).alias("m")).select("token", "m.lemma")
