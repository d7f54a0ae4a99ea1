"""Row operators: scans, flags, encodings, filters, set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import arrays as A
from ..functions.text import bracket_tags, parse_setstring
from ..operators import counts as C, rows as R
from ..operators.substrings import substring_matches
from ..operators.ordered import with_row_id
from ..operators.positions import Positions
from ..operators.unnest import unnest
from ..wordlists import EMOTIONS, GENRES
from .base import SONGS_SQL, STANZA_ROWS_SQL, literals, query, songs, stanza_rows, table

FLAGS = [f"is_{g}" for g in GENRES]


@query("SELECT doc_id, lang, source, n_chars, length(text) AS n_text FROM documents")
def scan_documents(spark, folder):
    return table(spark, folder, "documents").select(
        "doc_id", "lang", "source", "n_chars", F.length("text").cast("long").alias("n_text"))


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS id FROM orders")
def row_id(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    return with_row_id(orders, ["o_orderdate", "o_orderkey"]).select("o_orderkey", "id")


@query(f"""WITH {SONGS_SQL} SELECT id, CASE
    WHEN is_country THEN 'is_country' WHEN is_pop THEN 'is_pop' WHEN is_rap THEN 'is_rap' WHEN is_rb THEN 'is_rb'
    WHEN is_rock THEN 'is_rock' ELSE 'is_country' END AS tag FROM songs""")
def argmax_cols(spark, folder):
    return songs(spark, folder).select("id", R.argmax_columns(FLAGS).alias("tag"))


@query(f"""WITH {SONGS_SQL} SELECT id, tag FROM songs WHERE tag IS DISTINCT FROM 'es'""")
def filter_misc(spark, folder):
    return R.exclude_value(songs(spark, folder), "tag", "es").select("id", "tag")


@query("""SELECT doc_id, lang = 'de' AS is_de, lang = 'en' AS is_en, lang = 'es' AS is_es, lang = 'fr' AS is_fr
    FROM documents""")
def one_hot(spark, folder):
    return R.one_hot(table(spark, folder, "documents").select("doc_id", "lang"), "lang", "is")


@query(f"""WITH {SONGS_SQL} SELECT id, {', '.join(f'CAST({f} AS INTEGER) AS {f}' for f in FLAGS)} FROM songs""")
def bools_to_int(spark, folder):
    return R.bools_to_int(songs(spark, folder).select("id", *FLAGS), FLAGS)


@query("""SELECT id, stanza FROM (SELECT d.doc_id AS id, CASE WHEN l.quality IS NOT NULL THEN d.text END AS stanza
    FROM documents d LEFT JOIN labels l USING (doc_id)) WHERE stanza IS NOT NULL""")
def stanzas_notnull(spark, folder):
    rows = table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id", "left").select(
        F.col("doc_id").alias("id"), F.when(F.col("quality").isNotNull(), F.col("text")).alias("stanza"))
    return rows.where(F.col("stanza").isNotNull())


@query("""SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d JOIN labels l ON d.doc_id = l.doc_id
    WHERE l.quality IS NOT NULL AND l.toxic IS NOT NULL""")
def drop_nulls(spark, folder):
    labels = table(spark, folder, "labels")
    docs = table(spark, folder, "documents").select("doc_id", "lang")
    return docs.join(labels, "doc_id", "left").dropna("any")


@query(f"""WITH {SONGS_SQL} SELECT id, title FROM songs
    WHERE NOT contains(lyrics, chr(10) || chr(10)) AND NOT regexp_matches(lyrics, '\\[[^\\n]*\\]')""")
def unsplit_docs(spark, folder):
    return songs(spark, folder).where(R.unsplit("lyrics")).select("id", "title")


@query(f"""WITH {SONGS_SQL} SELECT count(*) AS n, min(id) AS first_id FROM songs
    WHERE NOT (contains(lyrics, 'Verse') OR contains(lyrics, 'verse') OR contains(lyrics, chr(10) || chr(10)))""")
def no_marker_stats(spark, folder):
    return R.no_marker_stats(songs(spark, folder), "id", "lyrics")


_INDEX_SQL = f"CAST(list_position([{literals(EMOTIONS)}], label) - 1 AS INTEGER)"


@query(f"""WITH {SONGS_SQL} SELECT id, {_INDEX_SQL} AS idx, label AS back FROM songs""")
def label_encode(spark, folder):
    rows = songs(spark, folder).select("id", R.encode_label(F.col("label")).alias("idx"))
    return rows.withColumn("back", R.decode_label(F.col("idx")))


@query(f"""WITH {SONGS_SQL}, v AS (SELECT id, unnest(range(8)) AS pos, {_INDEX_SQL} AS idx FROM songs)
    SELECT id, CAST(pos AS INTEGER) AS pos, CAST(pos = idx AS INTEGER) AS hit FROM v""")
def label_vector(spark, folder):
    vector = A.one_hot_vector(R.encode_label(F.col("label")), len(EMOTIONS))
    return songs(spark, folder).select("id", F.posexplode(vector).alias("pos", "hit"))


@query("""SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS idx FROM embeddings""")
def argmax_vector(spark, folder):
    return table(spark, folder, "embeddings").select("vec_id", A.argmax_vector(F.col("embedding")).alias("idx"))


@query(f"""WITH {STANZA_ROWS_SQL}, {', '.join(
    f"part{i} AS (SELECT id, stanza_number, label FROM stanza_rows WHERE id % 9 = {i})" for i in range(9))}
    {' UNION ALL '.join(f'SELECT * FROM part{i}' for i in range(9))}""")
def union_labelled(spark, folder):
    rows = stanza_rows(spark, folder).select("id", "stanza_number", "label")
    return R.union_tables([rows.where(F.col("id") % 9 == i) for i in range(9)])


_NAMES_SQL = "string_split(trim(regexp_replace(features, '\"([^\"]+)\"', '\\1', 'g'), '{}'), ',')"


@query(f"""WITH {SONGS_SQL} SELECT DISTINCT name FROM (
    SELECT artist AS name FROM songs UNION ALL SELECT trim(unnest({_NAMES_SQL})) FROM songs) WHERE name <> ''""")
def artist_universe(spark, folder):
    rows = songs(spark, folder).select("artist", parse_setstring(F.col("features")).alias("features"))
    return R.name_universe(rows, "artist", "features")


@query(f"""WITH {SONGS_SQL}, tags AS (
        SELECT DISTINCT unnest(regexp_extract_all(lyrics, '\\[[\\p{{L}}\\p{{N}}_]+\\]')) AS tag FROM songs),
    artists AS (SELECT DISTINCT artist FROM songs)
    SELECT DISTINCT tag FROM tags, artists WHERE contains(tag, artist)""")
def artist_tag_join(spark, folder):
    rows = songs(spark, folder)
    tags = unnest(rows, [], bracket_tags(F.col("lyrics")), "tag")
    artists = rows.select("artist")
    return substring_matches(tags, "tag", artists, "artist")


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_orderkey >= 100 AND l_orderkey < 5000")
def row_slice(spark, folder):
    rows = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return C.row_slice(rows, "l_orderkey", 100, 5000)


def _lines(spark, folder) -> Positions:
    return Positions.of(table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity"), ["l_orderkey", "l_linenumber", "l_quantity"])


_PLACES_SQL = """WITH placed AS (
    SELECT l_orderkey, l_linenumber, l_quantity, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_quantity) - 1 AS place,
           count(*) OVER () AS total FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_quantity, place FROM placed WHERE """


@query(_PLACES_SQL + "place < 1000")
def row_head(spark, folder):
    return _lines(spark, folder).head(1000, "place")


@query(_PLACES_SQL + "place >= total - 1000")
def row_tail(spark, folder):
    return _lines(spark, folder).tail(1000, "place")


@query(_PLACES_SQL.replace(", place FROM placed", " FROM placed") + "place >= 1300 AND place < total - 1700")
def row_between(spark, folder):
    return _lines(spark, folder).between(1300, -1700)


@query("SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT user_id, event_type FROM events)) AS duplicates FROM events")
def duplicate_count(spark, folder):
    return R.duplicate_count(table(spark, folder, "events"), ["user_id", "event_type"])


@query("SELECT DISTINCT l_partkey, l_suppkey, l_returnflag FROM lineitem")
def dedup_rows(spark, folder):
    return table(spark, folder, "lineitem").select("l_partkey", "l_suppkey", "l_returnflag").distinct()


@query("SELECT DISTINCT source, lang FROM documents")
def distinct_values(spark, folder):
    return table(spark, folder, "documents").select("source", "lang").distinct()
