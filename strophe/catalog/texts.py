"""Text functions over whole documents, one output row per piece."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import arrays as A, text as T
from ..operators.sections import (
    dedup_keep_first as keep_first, explode_stanzas as explode, flag_chorus, repeated_in_group,
)
from ..operators.terms import (
    DETACHMENT_RULES, anti_terms, derive_lemmas, lemmatize as lemmatize_rows, postings, term_stats,
)
from ..operators.ordered import cumcount
from ..operators.unnest import unnest, unnest_structs
from ..sources.staging import stage
from ..wordlists import (
    BARE_KEYWORDS, CHORUS_KEYWORDS, ENGLISH_STOPWORDS, HEADER_ONLY_KEYWORDS, PUNCTUATION, SECTION_KEYWORDS, WHITESPACE,
)
from .base import (
    ENGLISH_SQL, SONGS_SQL, WS_SQL, documents, literals, noise_sql, query, songs, spread, table, tokens_sql, words_sql,
)

KW = "|".join(SECTION_KEYWORDS)
WS = f"[{WHITESPACE}]"


def pieces(df: DataFrame, array: Column, key: str = "id") -> DataFrame:
    return unnest(df, [key], array, "piece", "pos")


def pieces_sql(inner: str, key: str = "id") -> str:
    """``inner`` is a SELECT or CTE chain that ends in (key, l)."""
    return f"SELECT {key}, CAST(unnest(range(len(l))) AS INTEGER) AS pos, unnest(l) AS piece FROM ({inner})"


def clean_sql(text: str) -> str:
    return rf"regexp_replace({text}, '(\[(?:{KW})[^\]\n]*\])|\[[^\]\n]*\]', '\1', 'g')"


def cascade_sql(source: str, keep: str = "") -> str:
    """CTEs from ``source(id, ly)`` to ``cut(id, ly, l)``."""
    keep = "".join(f", {c}" for c in keep.split())

    def step(name: str, before: str, test: str, sep: str) -> str:
        return (f"{name} AS (SELECT id, ly{keep}, CASE WHEN {test} THEN "
                f"flatten(list_transform(l, lambda x: string_split(x, {sep}))) ELSE l END AS l FROM {before})")

    return ", ".join([
        f"s0 AS (SELECT id, ly{keep}, [trim(ly, {WS_SQL})] AS l FROM {source})",
        step("s1", "s0", rf"regexp_matches(ly, '(?i)\[(?:{KW})[^\n]')", "chr(10) || '['"),
        step("s2", "s1", "regexp_matches(ly, '(?i)verse')", "'Verse'"),
        step("s3", "s2", "contains(ly, chr(10) || chr(10))", "chr(10) || chr(10)"),
        step("s4", "s3", r"regexp_matches(ly, '(?i)\(chorus\)')", "'('"),
        f"cut AS (SELECT id, ly{keep}, list_filter(list_transform(l, lambda x: trim(x, {WS_SQL})), lambda x: x <> '') AS l FROM s4)",
    ])


INFORMATIVE_SQL = (
    rf"list_filter(l, lambda x: x <> '' AND NOT regexp_matches(x, '(?i)^{WS}*(?:{'|'.join(HEADER_ONLY_KEYWORDS)})"
    rf"[^\n]*?\]{WS}*$|^[^\n]{{0,20}}{WS}*$'))"
)
CHORUS_SQL = rf"coalesce(regexp_matches(stanzas, '(?i)^{WS}*[\[(]?(?:{'|'.join(CHORUS_KEYWORDS)}){WS}*[\])]'), false)"
STRIP_HEADER_SQL = r"replace(regexp_replace(stanzas, '^[^\n]*?\]|\)\n*', '', 'g'), chr(10), ' ')"
EXPLODE_SQL = ("unnest(CASE WHEN len(l) = 0 THEN [NULL] ELSE l END) AS stanzas, "
               "CAST(unnest(CASE WHEN len(l) = 0 THEN [0] ELSE range(len(l)) END) AS INTEGER) AS stanza_number")

CUT_SQL = f"{SONGS_SQL}, src AS (SELECT id, {clean_sql('lyrics')} AS ly FROM songs), {cascade_sql('src')}"
KEPT_SQL = f"{CUT_SQL}, kept AS (SELECT id, {INFORMATIVE_SQL} AS l FROM cut)"
STANZAS_SQL = f"{KEPT_SQL}, st AS (SELECT id, {EXPLODE_SQL} FROM kept)"


@query(f"WITH {SONGS_SQL} SELECT id, {clean_sql('lyrics')} AS lyrics FROM songs")
def clean_brackets(spark, folder):
    return spread(songs(spark, folder)).select("id", T.clean_brackets(F.col("lyrics")).alias("lyrics"))


@query(f"WITH {CUT_SQL} " + pieces_sql("SELECT id, l FROM cut"))
def split_stanzas(spark, folder):
    return pieces(spread(songs(spark, folder).select("id", "lyrics")), T.split_stanzas(T.clean_brackets(F.col("lyrics"))))


def _fallback_sql(test: str, cut: str) -> str:
    return (f"CASE WHEN {test} THEN {cut} WHEN contains(ly, chr(10) || chr(10)) "
            f"THEN string_split(trim(ly, {WS_SQL}), chr(10) || chr(10)) ELSE [ly] END")


_BRACKETS = rf"\[(?:{KW})[^\n]*\]"
_MARK = "chr(1)"
_BEFORE_BRACKET_SQL = rf"regexp_replace({{text}}, '\n+([\[(])', {_MARK} || '\1', 'g')"


def _mode(spark, folder, mode: str, lyrics: str | None = None) -> DataFrame:
    rows = songs(spark, folder).select("id", "lyrics")
    if lyrics:
        rows = table(spark, folder, "documents").selectExpr("doc_id AS id", f"{lyrics} AS lyrics")
    return pieces(spread(rows), T.split_stanzas(F.col("lyrics"), mode))


@query(f"WITH {SONGS_SQL}, src AS (SELECT id, lyrics AS ly FROM songs) " + pieces_sql(
    "SELECT id, " + _fallback_sql(f"regexp_matches(ly, '{_BRACKETS}')",
                                  f"string_split(trim(ly, {WS_SQL}), chr(10) || '[')") + " AS l FROM src"))
def split_bracket(spark, folder):
    return _mode(spark, folder, "bracket")


# A zero-width cut follows each cut before a bracket, hence two marks.
_LINE_SQL = (rf"string_split(regexp_replace(regexp_replace(trim(ly, {WS_SQL}), '\n+([\[(])', {_MARK} || {_MARK} || '\1', 'g'), "
             rf"'\n([^\[({WHITESPACE}{chr(1)}])', chr(10) || {_MARK} || '\1', 'g'), {_MARK})")


@query(f"WITH {SONGS_SQL}, src AS (SELECT id, lyrics AS ly FROM songs) " + pieces_sql(
    "SELECT id, " + _fallback_sql(f"regexp_matches(ly, '(?i){_BRACKETS}')", _LINE_SQL) + " AS l FROM src"))
def split_line(spark, folder):
    return _mode(spark, folder, "line")


_PAREN_SQL = f"string_split({_BEFORE_BRACKET_SQL.format(text=f'trim(ly, {WS_SQL})')}, {_MARK})"


@query(f"WITH {SONGS_SQL}, src AS (SELECT id, lyrics AS ly FROM songs) " + pieces_sql(
    "SELECT id, " + _fallback_sql(rf"regexp_matches(ly, '(?i)[\[(](?:{KW})[^\n]+?[\])]')", _PAREN_SQL) + " AS l FROM src"))
def split_paren(spark, folder):
    return _mode(spark, folder, "paren")


_BARE = """CASE doc_id % 3 WHEN 0 THEN replace(text, chr(10), chr(10) || 'Chorus 2 ')
  WHEN 1 THEN replace(text, chr(10), ' Hook' || chr(10) || '(Bridge) ') ELSE text END"""
_BARE_KW = "|".join(BARE_KEYWORDS)
_KEYWORD_SQL = rf"regexp_replace(trim(ly, {WS_SQL}), '({_BARE_KW})({WS})', {_MARK} || '\1' || {_MARK} || '\2', 'g')"


@query(f"WITH src AS (SELECT doc_id AS id, {_BARE} AS ly FROM documents) " + pieces_sql(
    "SELECT id, " + _fallback_sql(
        rf"regexp_matches(ly, '(?i)(?:^|[^\[(\p{{L}}\p{{N}}_])(?:{_BARE_KW}){WS}')",
        f"string_split({_BEFORE_BRACKET_SQL.format(text=_KEYWORD_SQL)}, {_MARK})") + " AS l FROM src"))
def split_keyword(spark, folder):
    return _mode(spark, folder, "keyword", _BARE)


@query(f"WITH {SONGS_SQL} " + pieces_sql(
    f"SELECT id, list_transform(string_split(lyrics, chr(10) || chr(10)), lambda x: trim(x, {WS_SQL})) AS l FROM songs"))
def split_blank(spark, folder):
    return _mode(spark, folder, "blank_line")


def _kept(spark, folder) -> DataFrame:
    sections = T.drop_uninformative(T.split_stanzas(T.clean_brackets(F.col("lyrics"))))
    return spread(songs(spark, folder).select("id", "lyrics")).select("id", sections.alias("sections"))


@query(f"WITH {KEPT_SQL} " + pieces_sql("SELECT id, l FROM kept"))
def drop_uninformative(spark, folder):
    return pieces(_kept(spark, folder), F.col("sections"))


@query(f"WITH {STANZAS_SQL} SELECT id, stanza_number, stanzas FROM st")
def explode_stanzas(spark, folder):
    return explode(_kept(spark, folder), "sections").select("id", "stanza_number", "stanzas")


@query(f"""WITH {STANZAS_SQL} SELECT id, stanza_number,
    {CHORUS_SQL} OR count(*) OVER (PARTITION BY id, stanzas) > 1 AS is_chorus FROM st""")
def chorus_flag(spark, folder):
    """On exploded rows; ``p_stanzas`` has the same flag computed inside the song's row."""
    rows = stage(explode(_kept(spark, folder), "sections"))
    return flag_chorus(rows, ["id"]).select("id", "stanza_number", "is_chorus")


@query("""SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS n FROM events""")
def stanza_number(spark, folder):
    """A running number per group on flat rows."""
    rows = table(spark, folder, "events").select("user_id", "event_id", "ts")
    return cumcount(rows, ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "n")


@query("""SELECT l_orderkey, l_linenumber, count(*) OVER (PARTITION BY l_orderkey, l_returnflag) > 1 AS repeated
    FROM lineitem""")
def repeated_flag(spark, folder):
    rows = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    return repeated_in_group(rows, ["l_orderkey"], "l_returnflag").select("l_orderkey", "l_linenumber", "repeated")


@query(f"WITH {STANZAS_SQL} SELECT id, stanza_number, {STRIP_HEADER_SQL} AS stanza FROM st")
def strip_header(spark, folder):
    rows = explode(_kept(spark, folder), "sections")
    return rows.select("id", "stanza_number", T.strip_header(F.col("stanzas")).alias("stanza"))


_FIRST = "row_number() OVER (PARTITION BY l_partkey, l_returnflag, l_linestatus ORDER BY l_orderkey, l_linenumber)"


@query(f"SELECT * FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, l_linestatus FROM lineitem QUALIFY {_FIRST} = 1)")
def dedup_keep_first(spark, folder):
    rows = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_linestatus")
    return keep_first(rows, ["l_partkey", "l_returnflag", "l_linestatus"], ["l_orderkey", "l_linenumber"])


@query(f"SELECT doc_id, {noise_sql('text')} AS text FROM documents")
def strip_noise(spark, folder):
    return documents(spark, folder, "doc_id", "text").select("doc_id", T.strip_noise(F.col("text")).alias("text"))


@query(pieces_sql(f"SELECT doc_id, {tokens_sql('text')} AS l FROM documents", "doc_id"))
def tokenize(spark, folder):
    return pieces(documents(spark, folder, "doc_id", "text"), T.tokenize(F.col("text")), "doc_id")


@query(f"""WITH w AS ({pieces_sql(f"SELECT doc_id, {tokens_sql(noise_sql('text'))} AS l FROM documents", "doc_id")})
    SELECT doc_id, piece AS term, count(*) AS n FROM w
    WHERE piece NOT IN ({ENGLISH_SQL}) AND piece NOT IN ({literals(PUNCTUATION)}) GROUP BY ALL""")
def stopword_filter(spark, folder):
    tokens = T.remove_stopwords(T.tokenize(T.strip_noise(F.col("text"))), [*ENGLISH_STOPWORDS, *PUNCTUATION])
    docs = documents(spark, folder, "doc_id", "text")
    return unnest_structs(docs, ["doc_id"], A.term_counts(tokens), "term").withColumnRenamed("tf", "n")


@query("""WITH freq AS (SELECT unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}')) AS term FROM documents),
    stop AS (SELECT term FROM freq GROUP BY term HAVING count(*) > 0.001 * (SELECT count(*) FROM freq))
    SELECT doc_id, term, count(*) AS tf FROM (
        SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}')) AS term FROM documents)
    WHERE term NOT IN (SELECT term FROM stop) GROUP BY ALL""")
def stopword_table(spark, folder):
    """A stop list kept as a table: here the frequent words of the corpus itself."""
    posted = stage(postings(documents(spark, folder, "doc_id", "text"), "doc_id", T.analyze(F.col("text"))))
    stats = stage(term_stats(posted))
    frequent = stats.where(F.col("cf") > stats.agg(F.lit(0.001) * F.sum("cf")).scalar()).select("term")
    return anti_terms(posted, frequent).select("doc_id", "term", "tf")


_RULES_SQL = ", ".join(f"({i}, '{end}', '{base}')" for i, (end, base) in enumerate(DETACHMENT_RULES))
LEMMAS_SQL = f"""rules AS (SELECT * FROM (VALUES {_RULES_SQL}) r(rule, ending, base)),
    lemmas AS (SELECT token, arg_min(lemma, rule) AS lemma FROM (
        SELECT v.token, left(v.token, length(v.token) - length(r.ending)) || r.base AS lemma, r.rule
        FROM vocab v JOIN rules r ON suffix(v.token, r.ending) AND length(v.token) > length(r.ending) + 1)
      WHERE lemma IN (SELECT token FROM vocab) GROUP BY token)"""


@query(f"""WITH w AS ({pieces_sql(f"SELECT doc_id, {tokens_sql('text')} AS l FROM documents", "doc_id")}),
    vocab AS (SELECT DISTINCT piece AS token FROM w), {LEMMAS_SQL}
    SELECT doc_id, string_agg(coalesce(lemma, piece), ' ' ORDER BY pos) AS lemmas
    FROM w LEFT JOIN lemmas ON piece = token WHERE regexp_matches(piece, '[\\p{{L}}\\p{{N}}_]') GROUP BY doc_id""")
def lemmatize(spark, folder):
    rows = documents(spark, folder, "doc_id", "text").select("doc_id", T.tokenize(F.col("text")).alias("tokens"))
    rows = stage(rows)
    lemmas = stage(derive_lemmas(unnest(rows, [], "tokens", "token")))
    return lemmatize_rows(rows, ["doc_id"], "tokens", lemmas).select(
        "doc_id", A.join_tokens(F.col("lemmas")).alias("lemmas"))


_LIST = "concat('[', array_join(transform(regexp_extract_all(text, '[\\\\p{L}]+', 0), x -> concat(\"'\", x, \"'\")), ', '), ']')"


@query(pieces_sql("SELECT doc_id, regexp_extract_all(text, '[\\p{L}]+') AS l FROM documents", "doc_id"))
def parse_pylist(spark, folder):
    rows = documents(spark, folder, "doc_id", "text").selectExpr("doc_id", f"{_LIST} AS literal")
    return pieces(rows, T.parse_pylist(F.col("literal")), "doc_id")


@query(f"WITH {SONGS_SQL} " + pieces_sql("SELECT id, [artist, 'x ' || tag] AS l FROM songs"))
def parse_setstring(spark, folder):
    return pieces(songs(spark, folder), T.parse_setstring(F.col("features")))


@query(f"SELECT doc_id, array_to_string({words_sql('text')}, ' ') AS text FROM documents")
def join_tokens(spark, folder):
    return documents(spark, folder, "doc_id", "text").select(
        "doc_id", A.join_tokens(T.analyze(F.col("text"))).alias("text"))


@query(f"""WITH {SONGS_SQL} SELECT DISTINCT unnest(regexp_extract_all(lyrics, '\\[[\\p{{L}}\\p{{N}}_]+\\]')) AS tag
    FROM songs""")
def bracket_tags(spark, folder):
    return unnest(songs(spark, folder), [], T.bracket_tags(F.col("lyrics")), "tag").distinct()


@query("SELECT doc_id, CAST(length(text) - length(replace(text, chr(10), '')) + 1 AS INTEGER) AS n_lines FROM documents")
def line_count(spark, folder):
    return table(spark, folder, "documents").select("doc_id", T.line_count(F.col("text")).alias("n_lines"))


@query(pieces_sql(f"""SELECT doc_id, CASE WHEN list_contains(t, 'and') THEN t[1:list_position(t, 'and')] ELSE t END AS l
    FROM (SELECT doc_id, {words_sql('text')} AS t FROM documents)""", "doc_id"))
def take_until(spark, folder):
    return pieces(documents(spark, folder, "doc_id", "text"), A.bind(
        T.analyze(F.col("text")), lambda t: T.take_until(t, "and")), "doc_id")


@query(f"""WITH w AS (SELECT doc_id, {words_sql('text')} AS t FROM documents),
    g AS (SELECT doc_id, unnest(t || CASE WHEN len(t) > 1
        THEN list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]) ELSE [] END) AS term FROM w)
    SELECT doc_id, term, count(*) AS tf FROM g GROUP BY ALL""")
def analyze_ngrams(spark, folder):
    terms = T.analyze(F.col("text"), (1, 2))
    return unnest_structs(documents(spark, folder, "doc_id", "text"), ["doc_id"], A.term_counts(terms), "term")
