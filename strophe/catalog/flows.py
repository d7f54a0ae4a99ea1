"""The composed user-level jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import analyze
from ..operators import terms as K
from ..operators.rows import bools_to_int, encode_label
from ..operators.sampling import train_val_test
from ..plans import songs as P
from ..sources.staging import stage
from ..wordlists import EMOTIONS, GENRES
from .base import SONGS_SQL, literals, query, songs, spread, tokens_sql, words_sql
from .samples import _ranked
from .terms import VOCAB_SQL
from .texts import CHORUS_SQL, CUT_SQL, EXPLODE_SQL, INFORMATIVE_SQL, LEMMAS_SQL, STRIP_HEADER_SQL

_FLAGS = [f"is_{g}" for g in GENRES]

_TAG = "CASE " + " ".join(f"WHEN is_{g} THEN '{g}'" for g in GENRES) + " ELSE 'misc' END"


@query(f"""WITH {SONGS_SQL}, tagged AS (SELECT id, {_TAG} AS tag FROM songs),
    kept AS (SELECT * FROM tagged WHERE tag <> 'misc'), r AS ({_ranked('kept', 'id', 'tag')})
    SELECT id, {', '.join(f"tag = '{g}' AS is_{g}" for g in GENRES)} FROM r WHERE r <= round_even(n * 0.05::DOUBLE, 0)""")
def p_sample(spark, folder):
    return P.sample_songs(songs(spark, folder).drop("label")).select("id", *_FLAGS)


STANZA_CTES = f"""{CUT_SQL}, kept AS (SELECT id, {INFORMATIVE_SQL} AS l FROM cut),
    st AS (SELECT id, {EXPLODE_SQL} FROM kept),
    flagged AS (SELECT id, stanza_number, stanzas, {CHORUS_SQL} OR count(*) OVER (PARTITION BY id, stanzas) > 1 AS is_chorus FROM st),
    cleaned AS (SELECT id, stanza_number, {STRIP_HEADER_SQL} AS stanzas, is_chorus, title, artist
      FROM flagged JOIN (SELECT id, title, artist FROM songs) USING (id)),
    uniq AS (SELECT * FROM cleaned QUALIFY row_number() OVER (
      PARTITION BY title, artist, stanzas, is_chorus ORDER BY id, stanza_number) = 1),
    w AS (SELECT id, stanza_number, CAST(unnest(range(len(l))) AS INTEGER) AS pos, unnest(l) AS piece
      FROM (SELECT id, stanza_number, {tokens_sql('stanzas')} AS l FROM uniq)),
    vocab AS (SELECT DISTINCT piece AS token FROM w), {LEMMAS_SQL},
    lists AS (SELECT id, stanza_number, string_agg(coalesce(lemma, piece), ' ' ORDER BY pos) AS lemmas
      FROM w LEFT JOIN lemmas ON piece = token WHERE regexp_matches(piece, '[\\p{{L}}\\p{{N}}_]') GROUP BY ALL),
    stanza_table AS (SELECT u.id, u.stanza_number, u.title, u.artist, u.is_chorus, CASE WHEN u.stanzas IS NOT NULL
      THEN coalesce(lists.lemmas, '') END AS lemmas FROM uniq u LEFT JOIN lists USING (id, stanza_number))"""


def stanzas(spark, folder):
    return P.stanza_table(spread(songs(spark, folder).select("id", "title", "artist", "lyrics")))


@query(f"WITH {STANZA_CTES} SELECT id, stanza_number, title, artist, is_chorus, lemmas FROM stanza_table")
def p_stanzas(spark, folder):
    return stanzas(spark, folder).withColumn("lemmas", F.array_join("lemmatized_stanzas", " ")).drop(
        "lemmatized_stanzas")


@query(f"""WITH {SONGS_SQL}, q AS ({_ranked('songs', 'id', 'label')}),
    s AS (SELECT *, ceil(round(n * 0.3::DOUBLE, 9)) AS t FROM q),
    parts AS (SELECT id, label, views, {', '.join(_FLAGS)}, CASE WHEN r <= t THEN 'test'
      WHEN r <= t + ceil(round((n - t) * 0.3::DOUBLE, 9)) THEN 'val' ELSE 'train' END AS split FROM s),
    toks AS (SELECT doc_id, {words_sql('text')} AS l FROM documents),
    src AS (SELECT doc_id, l FROM toks JOIN parts ON doc_id = id WHERE split = 'train'),
    {VOCAB_SQL.format(max=20000)},
    words AS (SELECT doc_id, unnest(range(len(l))) AS pos, unnest(l) AS term FROM toks),
    seqs AS (SELECT doc_id, string_agg(coalesce(idx, 1), ' ' ORDER BY pos) AS seq, count(*) AS len
      FROM words LEFT JOIN vocab USING (term) WHERE pos < 150 GROUP BY doc_id)
    SELECT id, split, CAST(list_position([{literals(EMOTIONS)}], label) - 1 AS INTEGER) AS y,
      round((views - (SELECT avg(views) FROM parts WHERE split = 'train'))
        / (SELECT stddev_pop(views) FROM parts WHERE split = 'train'), 6) AS scaled,
      {', '.join(f'CAST({f} AS INTEGER) AS {f}' for f in _FLAGS)},
      trim(coalesce(seq, '') || repeat(' 0', CAST(150 - coalesce(len, 0) AS INTEGER))) AS sequence
    FROM parts LEFT JOIN seqs ON doc_id = id""")
def p_nn_features(spark, folder):
    """The prepared columns without the topics (these are in ``nn_prepared``)."""
    rows = songs(spark, folder).select("id", "label", "views", *_FLAGS)
    docs = spread(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")).select(
        F.col("doc_id").alias("id"), analyze(F.col("text")).alias("tokens"))
    parts = stage(train_val_test(rows, "label"))
    tokens = stage(docs.join(parts.select("id", "split"), "id"))
    train = tokens.where("split = 'train'")
    vocab = K.fit_vocab(train, "id", "tokens", 20000)
    seqs = K.to_sequences(tokens, "id", "tokens", vocab, 150)
    scaling = K.fit_scaling(parts.where("split = 'train'"), "views")
    return bools_to_int(parts, _FLAGS).join(seqs, "id").select(
        "id", "split", encode_label(F.col("label")).alias("y"),
        F.round(scaling.apply(F.col("views")), 6).alias("scaled"), *_FLAGS,
        F.array_join(F.transform("sequence", lambda i: i.cast("string")), " ").alias("sequence"))
