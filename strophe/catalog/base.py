"""Registration of queries, and the views that stand in for song tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import ANALYZER_TOKEN, TOKEN
from ..sources.staging import spread
from ..wordlists import EMOTIONS, ENGLISH_STOPWORDS, KEY_TERM_STOPWORDS, WHITESPACE

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def literals(values) -> str:
    return ", ".join("'" + str(v).replace("'", "''") + "'" for v in values)


WS_SQL = "'" + WHITESPACE + "'"
STOP_SQL = literals(KEY_TERM_STOPWORDS)
ENGLISH_SQL = literals(ENGLISH_STOPWORDS)

# Texts carry no section markers, so each residue of the id gets another kind of them.
_LYRICS = """CASE doc_id % 4
  WHEN 0 THEN '[Verse 1]' || chr(10) || replace(text, chr(10), chr(10) || '[Chorus]' || chr(10))
  WHEN 1 THEN '[' || source || ']' || chr(10) || replace(text, chr(10), chr(10) || chr(10))
  WHEN 2 THEN '(Chorus)' || chr(10) || replace(text, chr(10), ' [Produced by X]' || chr(10) || chr(10) || 'Verse 2:' || chr(10))
  ELSE text END"""
_EMOTION = "(CAST(substr(source, 4) AS INT) % 8)"
_COLUMNS = {
    "id": "doc_id",
    "artist": "source",
    "tag": "lang",
    "views": "n_chars",
    "features": """'{"' || source || '","x ' || lang || '"}'""",
    "is_country": "(lang = 'en' AND doc_id % 3 <> 0)",
    "is_pop": "(lang = 'fr')",
    "is_rap": "(lang = 'de')",
    "is_rb": "(lang = 'es' AND doc_id % 5 <> 0)",
    "is_rock": "(n_chars % 7 = 0)",
    "lyrics": _LYRICS,
}


def _select(columns: dict[str, str]) -> str:
    return ", ".join(f"{expr} AS {name}" for name, expr in columns.items())


# Documents have no title: their first eight words stand in.
_OPENING = "^([^ \\n]+(?: [^ \\n]+){0,7})"
_TITLE = {
    "spark": "regexp_extract(text, r'" + _OPENING + "', 1)",
    "sql": "regexp_extract(text, '" + _OPENING + "', 1)",
}
_LABEL = {
    "spark": f"element_at(array({literals(EMOTIONS)}), {_EMOTION} + 1)",
    "sql": f"([{literals(EMOTIONS)}])[{_EMOTION} + 1]",
}
SONGS_SQL = f"songs AS (SELECT {_select(_COLUMNS | {'title': _TITLE['sql'], 'label': _LABEL['sql']})} FROM documents)"


def documents(spark: SparkSession, folder: str, *cols: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return spread(docs.select(*cols) if cols else docs)


def songs(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as songs; unused columns never leave the scan."""
    columns = _COLUMNS | {"title": _TITLE["spark"], "label": _LABEL["spark"]}
    return table(spark, folder, "documents").selectExpr(*[f"{e} AS {n}" for n, e in columns.items()])


def stanza_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Conversations as stanzas split already."""
    return table(spark, folder, "conversations").select(
        F.col("conv_id").alias("id"), F.col("turn").alias("stanza_number"), F.col("role").alias("label"),
        F.col("text").alias("stanzas"))


STANZA_ROWS_SQL = "stanza_rows AS (SELECT conv_id AS id, turn AS stanza_number, role AS label, text AS stanzas FROM conversations)"


def words_sql(text: str) -> str:
    return f"regexp_extract_all(lower({text}), '{ANALYZER_TOKEN}')"


def tokens_sql(text: str) -> str:
    """Words and punctuation, contractions split."""
    plain = f"regexp_extract_all(lower({text}), '{TOKEN}')"
    return (f"flatten(list_transform({plain}, lambda t: CASE t WHEN 'cannot' THEN ['can', 'not'] "
            "WHEN 'gimme' THEN ['gim', 'me'] WHEN 'gonna' THEN ['gon', 'na'] WHEN 'gotta' THEN ['got', 'ta'] "
            "WHEN 'lemme' THEN ['lem', 'me'] WHEN 'wanna' THEN ['wan', 'na'] ELSE [t] END))")


def noise_sql(text: str) -> str:
    return f"trim(regexp_replace({text}, '['',\\[\\]’\\p{{Nd}}]', '', 'g'), {WS_SQL})"
