"""Counts, shares, histograms, joins on keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import line_count
from ..operators import counts as C
from ..operators.rows import unsplit
from ..operators.sampling import class_weights as weights
from ..plans.labels import label_distribution as distribution, merge_labels
from .base import SONGS_SQL, STANZA_ROWS_SQL, query, songs, stanza_rows, table


@query("SELECT lang, count(*) AS n FROM documents GROUP BY lang ORDER BY n DESC, lang")
def class_counts(spark, folder):
    return C.class_counts(table(spark, folder, "documents"), "lang")


@query(f"""WITH {SONGS_SQL}, c AS (SELECT label, count(id) AS n FROM songs GROUP BY label),
    p AS (SELECT label, n, 100.0::DOUBLE * n / (SELECT sum(n) FROM c) AS percent FROM c)
    SELECT label, n, round(percent, 6) AS percent,
      label || ' (' || CAST(round_even(percent, 0) AS INTEGER) || '%)' AS text FROM p""")
def label_distribution(spark, folder):
    return distribution(songs(spark, folder), "label", "id").withColumn("percent", F.round("percent", 6))


@query("SELECT min(n) AS n FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_returnflag)")
def smallest_class(spark, folder):
    return C.smallest_class(table(spark, folder, "lineitem"), "l_returnflag")


@query("""WITH h AS (SELECT least(ceil(o_totalprice / 10000) - 1, 99) AS bin FROM orders WHERE o_totalprice > 0),
    c AS (SELECT bin, count(*) AS n FROM h GROUP BY bin)
    SELECT CAST(b.i AS INTEGER) AS bin, coalesce(n, 0) AS n FROM range(100) b(i) LEFT JOIN c ON b.i = c.bin""")
def histogram_right_closed(spark, folder):
    return C.histogram(table(spark, folder, "orders"), "o_totalprice", 10000, 100)


@query(f"""WITH {SONGS_SQL}, u AS (
      SELECT length(lyrics) - length(replace(lyrics, chr(10), '')) + 1 AS lines FROM songs
      WHERE NOT contains(lyrics, chr(10) || chr(10)) AND NOT regexp_matches(lyrics, '\\[[^\\n]*\\]')),
    c AS (SELECT least(lines - 1, 99) AS bin, count(*) AS n FROM u GROUP BY ALL)
    SELECT CAST(b.i AS INTEGER) AS bin, coalesce(n, 0) AS n FROM range(100) b(i) LEFT JOIN c ON b.i = c.bin""")
def line_histogram(spark, folder):
    rows = songs(spark, folder).where(unsplit("lyrics")).select(line_count(F.col("lyrics")).alias("lines"))
    return C.histogram(rows, "lines", 1, 100)


@query(f"""WITH {SONGS_SQL} SELECT count(*) AS n, CAST(count_if(is_country) AS BIGINT) AS n_is_country, CAST(count_if(is_pop) AS BIGINT) AS n_is_pop,
    CAST(count_if(is_rock) AS BIGINT) AS n_is_rock FROM songs""")
def flag_counts(spark, folder):
    return C.flag_counts(songs(spark, folder), ["is_country", "is_pop", "is_rock"])


@query("SELECT arg_min(doc_id, (-n_chars, doc_id)) AS doc_id, max(n_chars) AS n_chars FROM documents")
def max_by(spark, folder):
    return C.max_row(table(spark, folder, "documents"), "doc_id", "n_chars")


@query(f"""WITH {SONGS_SQL}, c AS (SELECT label, count(*) AS n FROM songs GROUP BY label)
    SELECT label, n, round((SELECT sum(n) FROM c)::DOUBLE / ((SELECT count(*) FROM c) * n), 6) AS weight FROM c""")
def class_weights(spark, folder):
    return weights(songs(spark, folder), "label").withColumn("weight", F.round("weight", 6))


@query(f"""WITH {STANZA_ROWS_SQL} SELECT a.id, a.stanza_number, length(a.stanzas) AS n_chars, b.label
    FROM stanza_rows a JOIN (SELECT id, stanza_number, label FROM stanza_rows WHERE label <> 'system'
      UNION ALL SELECT id, stanza_number, 'again' FROM stanza_rows WHERE id % 9 = 1) b
    ON a.id = b.id AND a.stanza_number = b.stanza_number""")
def label_join(spark, folder):
    rows = stanza_rows(spark, folder)
    texts = rows.select("id", "stanza_number", F.length("stanzas").cast("long").alias("n_chars"))
    return merge_labels(texts, [rows.where("label <> 'system'"),
                                rows.where("id % 9 = 1").withColumn("label", F.lit("again"))])
