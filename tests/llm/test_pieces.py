import functools

import pytest
import sentencepiece
from pyspark.sql import functions as F

from strophe.llm.pieces import Pieces, decode, encode, op8_sentencepiece, public_pieces, viterbi_long, word_codes

public_tokenizers = pytest.importorskip("public_tokenizers")
FOLDER = "/root/testdata/sf0.001"
ODD = ["a  b\nc\td", " x", "x ", "  ", "é", "\n\n a", "x\r\n", "日本語 text 😀", "q" * 500 + "the theing " * 3, "ing" * 100, "a" * 26,
       "====== ------- ....... !!!!!!", "wait... what?! (really) \"so\" it's re-done; yes: 3.14,15", "end.\nStart,\nnext", "«quoted», ”too”."]


@pytest.fixture(scope="module")
def model():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


@pytest.mark.parametrize("frequent", [1 << 20, 40, 0])
def test_ids_of_the_library_and_round_trip(documents, awkward, model, frequent):
    rows = awkward + [(100 + i, t) for i, t in enumerate(ODD)]
    pieces = public_pieces()
    got = decode(encode(documents(rows), pieces, frequent=frequent), pieces).collect()
    assert sorted((r.text or "", str(r.doc_id)) for r in got) == sorted((t[1] or "", str(t[0])) for t in rows)
    for r in got:
        assert list(r.ids) == model.encode(r.text or ""), r.text
        assert r.decoded == (r.text or "")


def test_blank_sign_counts_as_blank(documents, model):
    pieces = public_pieces()
    (row,) = decode(encode(documents([(1, "a▁b")]), pieces), pieces).collect()
    assert list(row.ids) == model.encode("a▁b") and row.decoded == "a b"


def test_empty_table(documents):
    assert encode(documents([]), public_pieces()).count() == 0


def test_rare_words_are_coded_where_the_text_is(documents, awkward):
    """Shuffled bytes of a model with merges are those of the word counts: no text meets anything, however many words are rare."""
    coded = encode(documents(awkward), public_pieces(), frequent=0)
    plan = coded._jdf.queryExecution().toString()
    assert "Join" not in plan and "Exchange" not in plan
    assert coded.count() == len(awkward)


def test_unigram_viterbi(spark):
    """Best score over all ways to cut a word; characters that are no piece cost most."""
    scores = {" ": -3.0, "a": -2.5, "b": -2.6, "ab": -3.1, "ba": -3.0, "aba": -6.9, " a": -4.0, "bab": -5.0, " abab": -9.9}
    pieces = Pieces(tuple(scores), tuple(range(10, 10 + len(scores))), tuple(scores.values()), 100, unigram=True)
    unknown = min(scores.values()) - 10

    @functools.cache
    def best(word):
        if not word:
            return 0.0, ()
        found = []
        for n in range(1, len(word) + 1):
            head = word[:n]
            if head in scores or n == 1:
                rest, ids = best(word[n:])
                own = [pieces.ids[pieces.names.index(head)]] if head in scores else [100 + b for b in head.encode()]
                found.append((scores.get(head, unknown) + rest, (*own, *ids)))
        return max(found)

    words = [" abab", " aba", "abababab", "bbb", " aé", "baba", " a b".strip(), "xabx"]
    table = spark.createDataFrame([(w, 1) for w in words], "word string, n long")
    for r in word_codes(table, pieces).collect():
        value = {i: scores[n] for n, i in zip(pieces.names, pieces.ids)}
        total = sum(value.get(i, 0) for i in r.ids) + unknown * sum(c not in " ab" for c in r.word)
        assert total == pytest.approx(best(r.word)[0]), r.word


def test_long_unigram_words(documents, spark):
    """Words above and below the limit are cut alike, and the best way is taken."""
    scores = {" ": -3.0, "a": -2.5, "b": -2.6, "ab": -3.1, "ba": -3.0, "aba": -6.9, " a": -4.0, "bab": -5.0, "abab": -6.2}
    pieces = Pieces(tuple(scores), tuple(range(10, 10 + len(scores))), tuple(scores.values()), 100, unigram=True)
    known = {n: (s, i) for n, s, i in zip(pieces.names, pieces.scores, pieces.ids)}
    unknown = min(scores.values()) - 10.0
    words = ["ab" * 25 + "a" * k + end for k in range(15) for end in ("", "é", "日b", "bab")] + ["x" * 61, "ab" * 1000, "http://" + "a/b" * 40]
    assert min(map(len, words)) < 60 < max(map(len, words))
    table = spark.createDataFrame([(w, 1) for w in words], "word string, n long")
    for r in word_codes(table, pieces).collect():
        assert r.ids == viterbi_long(r.word, known, pieces.longest, pieces.first_byte, unknown), r.word
        best = [0.0]
        for end in range(1, len(r.word) + 1):
            best.append(max(best[s] + scores.get(r.word[s:end], unknown) for s in range(max(0, end - 4), end) if r.word[s:end] in scores or end - s == 1))
        value = {i: s for s, i in known.values()}
        total = sum(value.get(i, 0) for i in r.ids) + unknown * sum(c not in " ab" for c in r.word)
        assert total == pytest.approx(best[-1]), r.word
    text = "ab " + "ba" * 400 + " aé\n" + "q" * 90
    (row,) = decode(encode(documents([(1, text)]), pieces), pieces).collect()
    assert row.decoded == text


def test_query(spark, model):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    got = op8_sentencepiece(spark, FOLDER).collect()
    assert len(got) == len(docs) and all(r.round_trip and r.n_ids == len(model.encode(docs[r.doc_id])) for r in got)
