"""Lexicons induced from seed words, and the labels they give."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import analyze
from ..operators.lexicon import associations, induced_lexicon, seed_terms
from ..operators.scoring import lexicon_label
from ..plans.labels import merge_labels
from ..sources.staging import stage
from ..wordlists import EMOTIONS
from .base import documents, literals, query, words_sql
from .flows import STANZA_CTES, stanzas

# Invented prose has no words of joy or fear: the most frequent terms of at most a fifth of the texts are dealt out as seeds.
SEEDS, SHARE, LEAST, BEST = 5, 0.2, 5, 200


def lexicon_sql(bags: str, key: str) -> str:
    """CTEs from ``bags(key, t)``, one row per text with its distinct terms, to ``lexicon(term, e, weight)``."""
    return f"""terms AS (SELECT {key}, unnest(t) AS term FROM {bags}), total AS (SELECT count(*) AS n FROM {bags}),
    dfs AS (SELECT term, count(*) AS df FROM terms GROUP BY term),
    seeds AS (SELECT term, (row_number() OVER (ORDER BY df DESC, term) - 1) % 8 AS e FROM dfs, total WHERE df <= {SHARE}::DOUBLE * n
      QUALIFY row_number() OVER (ORDER BY df DESC, term) <= {8 * SEEDS}),
    marks AS (SELECT DISTINCT {key}, e FROM terms JOIN seeds USING (term)),
    spoken AS (SELECT e, count(*) AS m FROM marks GROUP BY e),
    met AS (SELECT term, e, count(*) AS together FROM terms JOIN marks USING ({key}) GROUP BY ALL),
    cells AS (SELECT term, e, df, coalesce(together, 0) AS together,
        ln((coalesce(together, 0) + 1.0::DOUBLE) * (n + 1.0::DOUBLE) / ((df + 1.0::DOUBLE) * (coalesce(m, 0) + 1.0::DOUBLE))) AS pmi
      FROM (SELECT * FROM dfs, (SELECT unnest(range(8)) AS e), total WHERE df >= {LEAST})
        LEFT JOIN met USING (term, e) LEFT JOIN spoken USING (e)),
    lexicon AS (SELECT term, e, round(pmi, 9) AS weight FROM cells WHERE round(pmi, 9) > 0
      QUALIFY row_number() OVER (PARTITION BY e ORDER BY round(pmi, 9) DESC, term) <= {BEST})"""


_NAME = f"([{literals(EMOTIONS)}])[e + 1]"
_BAGS = f"bags AS (SELECT doc_id, list_distinct({words_sql('text')}) AS t FROM documents)"


def _tokens(spark, folder):
    return stage(documents(spark, folder, "doc_id", "text").select("doc_id", analyze(F.col("text")).alias("tokens")))


@query(f"WITH {_BAGS}, {lexicon_sql('bags', 'doc_id')} SELECT term, {_NAME} AS label, round(weight, 6) AS weight FROM lexicon")
def lexicon_induced(spark, folder):
    """The terms most associated with each label's seeds."""
    docs = _tokens(spark, folder)
    found = induced_lexicon(docs, "tokens", seed_terms(docs, "tokens", per_label=SEEDS, max_df=SHARE), k=BEST, min_df=LEAST)
    return found.withColumn("weight", F.round("weight", 6))


@query(f"WITH {_BAGS}, {lexicon_sql('bags', 'doc_id')} SELECT term, {_NAME} AS label, df, CAST(together AS BIGINT) AS together, round(pmi, 6) AS pmi FROM cells")
def term_associations(spark, folder):
    """Every term with every label: texts with both, and their mutual information."""
    docs = _tokens(spark, folder)
    found = associations(docs, "tokens", seed_terms(docs, "tokens", per_label=SEEDS, max_df=SHARE), min_df=LEAST)
    return found.withColumn("pmi", F.round("pmi", 6))


@query(f"""WITH {STANZA_CTES},
    bags AS (SELECT id, stanza_number, list_distinct(string_split(lemmas, ' ')) AS t FROM stanza_table WHERE lemmas <> ''
      UNION ALL SELECT id, stanza_number, CAST([] AS VARCHAR[]) FROM stanza_table WHERE lemmas IS NULL OR lemmas = ''),
    {lexicon_sql('bags', 'id, stanza_number')},
    words AS (SELECT id, stanza_number, unnest(string_split(lemmas, ' ')) AS term FROM stanza_table WHERE lemmas <> ''),
    sums AS (SELECT id, stanza_number, e, round(sum(weight), 9) AS s FROM words JOIN lexicon USING (term) GROUP BY ALL),
    labels AS (SELECT id, stanza_number, ([{literals(EMOTIONS)}])[arg_min(e, (-s, e)) + 1] AS label FROM sums GROUP BY ALL)
    SELECT id, stanza_number, is_chorus, label FROM stanza_table JOIN labels USING (id, stanza_number)""")
def p_label_merge(spark, folder):
    """Stanzas labelled by an induced lexicon, the labels of three shards merged back."""
    rows = stage(stanzas(spark, folder))
    tokens = "lemmatized_stanzas"
    lexicon = induced_lexicon(rows, tokens, seed_terms(rows, tokens, per_label=SEEDS, max_df=SHARE), k=BEST, min_df=LEAST)
    shards = []
    for i in range(3):  # as many people label a part each
        part = lexicon_label(rows.where(F.col("id") % 3 == i), ["id", "stanza_number"], tokens, lexicon, digits=9)
        shards.append(part.where("label is not null").select("id", "stanza_number", "label"))
    return merge_labels(rows, shards).select("id", "stanza_number", "is_chorus", "label")
