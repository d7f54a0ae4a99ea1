from pyspark.sql import functions as F
import pytest

from strophe.functions import arrays as A, text as T


@pytest.fixture
def value(spark):
    def run(text, fn):
        df = spark.createDataFrame([(text,)], "t string")
        return df.select(fn(F.col("t")).alias("v")).first()[0]

    return run


SONG = ("[Intro]\nla la la\n\n[Verse 1]\nfirst line of verse\n[Chorus]\nsing it loud tonight\n\n[Chorus]")


def test_clean_brackets(value):
    text = "[Verse 1]\na [x] b [chorus] [Chorus [x2]] [Pre-Chorus]"
    assert value(text, T.clean_brackets) == "[Verse 1]\na  b  [Chorus [x2]] "
    assert value("[Hookers] [Produced\nby]", T.clean_brackets) == "[Hookers] [Produced\nby]"


@pytest.mark.parametrize("text,expected", [
    (SONG, ["[Intro]\nla la la", "1]\nfirst line of verse", "Chorus]\nsing it loud tonight"]),
    ("no markers here at all in this song", ["no markers here at all in this song"]),
    ("(Chorus)\nwe sing (hey)\nall night long my friend", ["Chorus)\nwe sing", "hey)\nall night long my friend"]),
    ("short", []),
])
def test_stanzas(value, text, expected):
    assert value(text, lambda c: T.drop_uninformative(T.split_stanzas(T.clean_brackets(c)))) == expected


def test_any_chorus_variant(value):
    text = "a chorus (one) two"
    assert value(text, T.split_stanzas) == ["a chorus (one) two"]
    assert value(text, lambda c: T.split_stanzas(c, paren_test="any_chorus")) == ["a chorus", "one) two"]


def test_drop_uninformative_rules(value):
    array = lambda *xs: (lambda c: T.drop_uninformative(F.array(*map(F.lit, xs))))
    assert value("", array("Chorus: X]", "x" * 20, "x" * 21, "ab\ncd", "", "hook 2]\n")) == ["x" * 21, "ab\ncd"]
    keep_short = lambda c: T.drop_uninformative(F.array(F.lit("abc"), F.lit("Verse]")), min_chars=None)
    assert value("", keep_short) == ["abc"]


@pytest.mark.parametrize("text,flag", [
    ("[Intro]\nla", False), ("Chorus]\nsing", True), ("Chorus)\nwe", True), ("Chorus 2]\n", False),
    ("Chorus: X]", False), ("  [hook ]", True), ("the Chorus]", False), (None, False),
])
def test_chorus_header(value, text, flag):
    assert value(text, T.is_chorus_header) is flag


@pytest.mark.parametrize("text,expected", [
    ("[Intro]\nla la la", " la la la"),
    ("1]\nfirst line of verse", " first line of verse"),
    ("Chorus)\nwe sing", "Choruswe sing"),
    ("hey)\nall night long my friend", "heyall night long my friend"),
    ("a\nb]c\nd", "a b]c d"),
    (None, None),
])
def test_strip_header(value, text, expected):
    assert value(text, T.strip_header) == expected


@pytest.mark.parametrize("mode,text,expected", [
    ("line", "Line one\n[Verse]x", ["Line one", "", "[Verse]x"]),
    ("line", "a\n\nb", ["a", "b"]),
    ("line", " a\nb ", [" a\nb "]),
    ("bracket", "[Verse]a\n[x]b\n\nc", ["[Verse]a", "x]b\n\nc"]),
    ("bracket", "[verse]a\n[x]b\n\nc", ["[verse]a\n[x]b", "c"]),
    ("paren", "(chorus 1)\nx\n\n[y]z", ["(chorus 1)\nx", "[y]z"]),
    ("paren", "one line", ["one line"]),
    ("keyword", "Verse 2 la la\nChorus 1 hey\n[x]", ["", "Verse 2", " la la\n", "Chorus 1", " hey", "[x]"]),
    ("keyword", "[Verse] la", ["[Verse] la"]),
    ("blank_line", "a\n\n\nb\n\n", ["a", "b", ""]),
])
def test_split_modes(value, mode, text, expected):
    assert value(text, lambda c: T.split_stanzas(c, mode)) == expected


def test_tokens(value):
    assert value("Don’t 5 gonna, Éa!", lambda c: T.tokenize(T.strip_noise(c))) == ["dont", "gon", "na", "éa", "!"]
    assert value("été ça a", T.analyze) == ["été", "ça"]
    assert value("the night is young", lambda c: T.analyze(c, (1, 2), ["the", "is"])) == [
        "night", "young", "night young"]
    assert value("solo", lambda c: T.analyze(c, (1, 2))) == ["solo"]
    assert value("x", lambda c: T.take_until(F.array(*map(F.lit, ["intro", "verse", "one"])), "verse")) == [
        "intro", "verse"]
    assert value("x", lambda c: T.take_until(F.array(*map(F.lit, ["intro", "one"])), "verse")) == ["intro", "one"]


@pytest.mark.parametrize("text,expected", [
    ("['a', \"don't\", 'b']", ["a", "don't", "b"]),
    (r"['it\'s', 'b\xa0']", ["it's", "b "]),
    ("[]", []),
])
def test_parse_pylist(value, text, expected):
    assert value(text, T.parse_pylist) == expected


def test_parse_setstring(value):
    assert value('{"Kid A","B, C",D}', T.parse_setstring) == ["Kid A", "B", "C", "D"]
    assert value("{}", T.parse_setstring) == []


def test_small_helpers(value):
    assert value("a\nb\nc", T.line_count) == 3
    assert value("[ab] [a b] [É1]", T.bracket_tags) == ["[ab]", "[É1]"]
    assert value("joy", lambda c: T.format_share(c, F.lit(17.6))) == "joy (18%)"
    assert value("joy", lambda c: T.format_weight(c, F.lit(0.25))) == "joy: 0.25"


def test_arrays(value):
    words = lambda *xs: F.array(*map(F.lit, xs)) if xs else F.array().cast("array<string>")
    assert [tuple(r) for r in value("", lambda c: A.term_counts(words("b", "a", "b")))] == [("a", 1), ("b", 2)]
    assert value("", lambda c: A.term_counts(words())) == []
    assert value("", lambda c: A.repeated_items(words("b", "a", "b", "b", "c", "a"))) == ["a", "b"]
    assert value("", lambda c: A.repeated_items(words("b"))) == []
    assert value("", lambda c: A.repeated_items(words())) == []
    ints = lambda xs: F.array(*map(F.lit, xs))
    assert value("", lambda c: A.pad_sequence(ints([5, 6, 7]), 5)) == [5, 6, 7, 0, 0]
    assert value("", lambda c: A.pad_sequence(ints([1, 2, 3, 4, 5, 6]), 5)) == [1, 2, 3, 4, 5]
    assert value("", lambda c: A.argmax_vector(ints([0.1, 0.4, 0.4]))) == 1
    assert value("", lambda c: A.one_hot_vector(F.lit(2), 4)) == [0, 0, 1, 0]
