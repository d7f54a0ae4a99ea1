from collections import Counter

import pytest

from strophe.llm.quality import Cascade, base_rules, content_rules, good_documents, measures

SPACES = " \t\n\x0b\x0c\r"


def words_of(text):
    for c in SPACES:
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def brute_force(text):
    text = text or ""
    words = words_of(text)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    seen, again = Counter(windows), set()
    for i, w in enumerate(windows):
        if seen[w] > 1:
            again.update(range(i, i + 8))
    lines = [line for line in text.split("\n") if words_of(line)]
    n, symbols = len(words), sum(c in "#*$%&|<>" for c in text)
    chars, copies = sum(map(len, words)), len(lines) - len(set(lines))
    failed = n < 20 or 100 * len(again) > 30 * n
    kept = not (failed or 10 * symbols > n or not 2 * n <= chars <= 15 * n or 100 * copies > 30 * len(text.split("\n"))
                or 100 * sum(any(c.isalpha() for c in w) for w in words) < 60 * n)
    return n, chars, symbols, copies, len(again), failed, kept


@pytest.fixture
def texts(prose):
    rep = "one two three four five six seven eight nine "
    return [None, "", " \n ", "word", prose, prose + " " + prose, rep * 30, prose + "\n" + rep + "x " + rep, rep + rep, "a b " * 15,
            "\n".join(["same line here"] * 20 + [prose]), "# $ % " * 20 + prose, "| " * 40, "1 2 3 4 5 6 7 8 9 10 " * 3, "x" * 2000 + " " + prose,
            "\x0b".join(prose.split()), "a b " * 25, "tabs\tand\rreturns " + prose, prose.replace(" ", "\n")]


def test_measures_and_verdict(documents, texts):
    docs = documents(list(enumerate(texts)))
    got = {r.doc_id: r for r in measures(docs).withColumn("good", Cascade(base_rules() + content_rules()).keep()).collect()}
    for i, text in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.good) == brute_force(text), text


def test_order_changes_no_verdict(documents, texts):
    docs = documents(list(enumerate(texts)) + [(4, texts[4]), (None, texts[4])])
    rules = base_rules() + content_rules()
    fitted = Cascade.fit(docs, rules)
    assert {r.name for r in fitted.rules} == {r.name for r in rules}
    kept = good_documents(docs)
    assert kept.columns == docs.columns
    want = sorted(str((i, t)) for i, t in [*enumerate(texts), (4, texts[4]), (None, texts[4])] if brute_force(t)[-1])
    assert sorted(str((r.doc_id, r.text)) for r in kept.collect()) == want


def test_empty_table(documents):
    assert good_documents(documents([])).count() == 0


def test_columns_named_like_its_own(spark, prose):
    docs = spark.createDataFrame([(prose, "kept", 1)], "text string, _text string, _words int")
    assert [tuple(r) for r in good_documents(docs).collect()] == [(prose, "kept", 1)]


def test_long_text(spark):
    words = [f"w{i * 37 % 5003}" for i in range(60_000)]
    row = measures(spark.createDataFrame([(" ".join(words),)], "text string")).first()
    assert (row.n_words, row.n_repeat_words) == brute_force(" ".join(words))[0:5:4]
