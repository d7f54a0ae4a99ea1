"""Text columns: markup cleaning, section splitting, tokenising.

The patterns follow Python's ``re`` semantics.  Java differs in ``.`` (also stops
at ``\\r`` and others, hence ``[^\\n]``), in ``\\s`` and ``\\w`` (ASCII only, hence the
explicit classes) and in case folding (hence ``(?iu)``).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, functions as F

from ..wordlists import (
    BARE_KEYWORDS, CHORUS_KEYWORDS, CONTRACTIONS, HEADER_ONLY_KEYWORDS, SECTION_KEYWORDS, WHITESPACE,
)
from .arrays import bind

WS = f"[{WHITESPACE}]"
WORD = r"[\p{L}\p{N}_]"
_SECTIONS = "|".join(SECTION_KEYWORDS)

CLEAN_BRACKETS = rf"(\[(?:{_SECTIONS})[^\]\n]*\])|\[[^\]\n]*\]"
SECTION_START = rf"(?iu)\[(?:{_SECTIONS})[^\n]"
BRACKET_HEADER = rf"\[(?:{_SECTIONS})[^\n]*\]"
ANY_BRACKET_HEADER = rf"(?iu)[\[(](?:{_SECTIONS})[^\n]+?[\])]"
BARE_HEADER = rf"(?<![\[(])(?<!{WORD})(?:{'|'.join(BARE_KEYWORDS)})(?={WS})"
SPLIT_BEFORE_BRACKET = r"\n+(?=\[|\()"
SPLIT_LINE = rf"{SPLIT_BEFORE_BRACKET}|(?<=\n)(?=[^{WHITESPACE}])"
SPLIT_BARE = rf"({'|'.join(BARE_KEYWORDS)})(?={WS})"
HEADER_ONLY = rf"^{WS}*(?:{'|'.join(HEADER_ONLY_KEYWORDS)})[^\n]*?\]{WS}*$"
CHORUS_HEADER = rf"(?iu)^{WS}*[\[(]?(?:{'|'.join(CHORUS_KEYWORDS)}){WS}*[\])]"
HEADER = r"^[^\n]*?\]|\)\n*"
NOISE = r"[',\[\]’\p{Nd}]"
TOKEN = rf"{WORD}+|[^\p{{L}}\p{{N}}_{WHITESPACE}]"
ANALYZER_TOKEN = WORD + "{2,}"
BRACKET_TAG = rf"\[{WORD}+\]"


def strip(col: Column, chars: str = WHITESPACE) -> Column:
    return F.btrim(col, F.lit(chars))


def clean_brackets(col: Column) -> Column:
    """Remove ``[...]`` unless it starts with a section keyword."""
    return F.regexp_replace(col, CLEAN_BRACKETS, "$1")


def _cascade(col: Column, paren_test: str) -> Column:
    """``col`` must be a column or bound: it is read once per test."""
    paren = {"exact": r"(?iu)\(Chorus\)", "any_chorus": r"(?iu)Chorus"}[paren_test]
    # All four tests look at the whole text, so they are taken once and bound.
    facts = F.struct(
        strip(col).alias("text"),
        col.rlike(SECTION_START).alias("headers"),
        col.rlike("(?iu)Verse").alias("verse"),
        F.contains(col, F.lit("\n\n")).alias("blank"),
        col.rlike(paren).alias("paren"),
    )

    def cut_if(flag: Column, sep: str):
        return lambda x: F.when(flag, F.split(x, sep)).otherwise(F.array(x))

    def cut(facts: Column) -> Column:
        pieces = F.array(facts["text"])
        for flag, sep in (("headers", r"\n\["), ("verse", "Verse"), ("blank", "\n\n"), ("paren", r"\(")):
            pieces = F.flatten(F.transform(pieces, cut_if(facts[flag], sep)))
        return F.filter(F.transform(pieces, lambda x: strip(x)), lambda x: x != "")

    return bind(facts, cut)


def split_stanzas(col: Column, mode: str = "cascade", paren_test: str = "exact") -> Column:
    """Split a text into sections.

    ``cascade``     headers, then "Verse", then blank lines, then "(" - stripped, without empties
    ``bracket``     at newline + ``[`` when a bracket header exists
    ``line``        before brackets and at each line start when a bracket header exists
    ``paren``       before ``[`` or ``(`` when a header in either bracket exists
    ``keyword``     at bare keywords, which stay as elements of their own
    ``blank_line``  at blank lines only, stripped, empties kept

    The middle four fall back to blank lines, else to the unstripped text.
    """
    if mode == "blank_line":
        return F.transform(F.split(col, "\n\n"), lambda x: strip(x))
    if mode == "cascade":
        return bind(col, lambda c: _cascade(c, paren_test))
    return bind(col, lambda c: _by_header(c, mode))


def _by_header(col: Column, mode: str) -> Column:
    text = strip(col)
    mark = "\u0001"
    test, pieces = {
        "bracket": (col.rlike(BRACKET_HEADER), F.split(text, r"\n\[")),
        "line": (col.rlike("(?iu)" + BRACKET_HEADER), F.split(text, SPLIT_LINE)),
        "paren": (col.rlike(ANY_BRACKET_HEADER), F.split(text, SPLIT_BEFORE_BRACKET)),
        "keyword": (
            col.rlike("(?iu)" + BARE_HEADER),
            F.split(F.regexp_replace(F.regexp_replace(text, SPLIT_BARE, f"{mark}$1{mark}"),
                                     SPLIT_BEFORE_BRACKET, mark), mark),
        ),
    }[mode]
    return (F.when(test, pieces)
            .when(F.contains(col, F.lit("\n\n")), F.split(text, "\n\n"))
            .otherwise(F.array(col)))


def drop_uninformative(sections: Column, min_chars: int | None = 20) -> Column:
    """Drop header-only sections and, unless ``min_chars`` is None, single lines up to that length."""
    pattern = "(?iu)" + HEADER_ONLY
    if min_chars is not None:
        pattern += rf"|^[^\n]{{0,{min_chars}}}{WS}*$"
    return F.filter(sections, lambda x: (x != "") & ~x.rlike(pattern))


def is_chorus_header(col: Column) -> Column:
    return F.coalesce(col.rlike(CHORUS_HEADER), F.lit(False))


def strip_header(col: Column) -> Column:
    """Cut the header of the first line and closing parentheses; newlines become blanks."""
    return F.replace(F.regexp_replace(col, HEADER, ""), F.lit("\n"), F.lit(" "))


def strip_noise(col: Column) -> Column:
    return strip(F.regexp_replace(col, NOISE, ""))


def tokenize(col: Column, contractions: Mapping[str, tuple[str, ...]] | None = CONTRACTIONS) -> Column:
    """Lower-cased words and single punctuation marks."""
    tokens = F.regexp_extract_all(F.lower(col), F.lit(TOKEN), F.lit(0))
    if not contractions:
        return tokens

    def expand(t: Column) -> Column:
        chain = None
        for word, parts in contractions.items():
            value = F.array(*map(F.lit, parts))
            chain = F.when(t == word, value) if chain is None else chain.when(t == word, value)
        return F.when(t.isin(*contractions), chain).otherwise(F.array(t))

    listed = F.array(*map(F.lit, contractions))
    return bind(tokens, lambda ts: F.when(
        F.arrays_overlap(ts, listed), F.flatten(F.transform(ts, expand))).otherwise(ts))


def remove_stopwords(tokens: Column, words: Iterable[str]) -> Column:
    """Drop tokens of a fixed list; see ``operators.terms.anti_terms`` for lists kept as tables."""
    words = list(words)
    return F.filter(tokens, lambda t: ~t.isin(*words)) if words else tokens


def take_until(tokens: Column, marker: str) -> Column:
    """The prefix up to and including ``marker``, or everything."""
    at = F.array_position(tokens, F.lit(marker))
    return F.slice(tokens, F.lit(1), F.when(at > 0, at).otherwise(F.size(tokens)).cast("int"))


def analyze(col: Column, ngram: tuple[int, int] = (1, 1), stop: Iterable[str] = ()) -> Column:
    """Tokens of two or more word characters, optionally with word n-grams."""
    words = remove_stopwords(F.regexp_extract_all(F.lower(col), F.lit(ANALYZER_TOKEN), F.lit(0)), stop)
    return ngrams(words, ngram)


def ngrams(tokens: Column, ngram: tuple[int, int]) -> Column:
    low, high = ngram
    if (low, high) == (1, 1):
        return tokens

    def of_size(t: Column, n: int) -> Column:
        if n == 1:
            return t
        grams = F.transform(
            F.sequence(F.lit(0), F.size(t) - n),
            lambda i: F.concat_ws(" ", *[F.get(t, i + k) for k in range(n)]))
        return F.when(F.size(t) >= n, grams).otherwise(F.array().cast("array<string>"))

    return bind(tokens, lambda t: F.concat(*[of_size(t, n) for n in range(low, high + 1)]))


def parse_pylist(col: Column) -> Column:
    """A Python list literal of strings as an array."""
    fixed = F.regexp_replace(col, r"\\x([0-9a-fA-F]{2})", r"\\u00$1")
    return F.from_json(fixed, "array<string>",
                       {"allowBackslashEscapingAnyCharacter": "true", "allowSingleQuotes": "true"})


def parse_setstring(col: Column) -> Column:
    """``{"a","b"}`` as an array of distinct, non-empty names (commas inside quotes split too)."""
    plain = strip(F.regexp_replace(col, '"([^"]+)"', "$1"), "{}")
    names = F.filter(F.transform(F.split(plain, ","), lambda x: strip(x)), lambda x: x != "")
    return F.array_distinct(F.transform(names, lambda x: strip(x, "'\"")))


def bracket_tags(col: Column) -> Column:
    return F.regexp_extract_all(col, F.lit(BRACKET_TAG), F.lit(0))


def line_count(col: Column) -> Column:
    return (F.length(col) - F.length(F.replace(col, F.lit("\n"), F.lit(""))) + 1).cast("int")


def format_weight(term: Column, weight: Column) -> Column:
    return F.concat(term, F.lit(": "), weight.cast("string"))


def format_share(label: Column, percent: Column) -> Column:
    return F.concat(label, F.lit(" ("), F.bround(percent, 0).cast("int").cast("string"), F.lit("%)"))
