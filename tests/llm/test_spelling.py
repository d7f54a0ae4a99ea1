import re
import zlib
from collections import Counter

import pytest

from strophe.llm import spelling as S

FOLDER = "/root/testdata/sf0.01"


def vocabulary(rows, least_length=6, least_count=5):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= least_length and n >= least_count}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    k = 0
    while k < min(len(a), len(b)) and a[k] == b[k]:
        k += 1
    return a[k + 1:] == b[k + 1:] or a[k + 1:] == b[k:] or a[k:] == b[k + 1:]


def variants(vocab, near=None):
    """Brute force: all pairs, or words with one letter taken out in common."""
    out = {}
    if near is None:
        near = {a: [b for b in vocab if one_edit(a, b)] for a in vocab}
    form = {}
    for a, n in vocab.items():
        best = min(near[a], key=lambda b: (-vocab[b], b), default=None)
        form[a] = best if best is not None and vocab[best] >= 5 * n else None
    for a, n in vocab.items():
        root = a
        while form[root]:
            root = form[root]
        out[a] = (form[a], root, n, len(near[a]), vocab[form[a]] if form[a] else None)
    return out


def result(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    vocab = vocabulary(rows)
    holes = {}
    for w in vocab:
        for k in range(len(w)):
            holes.setdefault(w[:k] + w[k + 1:], set()).add(w)
    near = {a: [b for b in {b for k in range(len(a)) for b in holes.get(a[:k] + a[k + 1:], ())}
                | {b for b in holes.get(a, ())} | {a[:k] + a[k + 1:] for k in range(len(a))} & vocab.keys() if one_edit(a, b)]
            for a in vocab}
    assert len(vocab) > 3000
    mine = S.op11_spelling_variants(spark, FOLDER)
    assert mine.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    got = result(mine)
    assert got == variants(vocab, near)
    assert sum(v[0] is not None for v in got.values()) > 50


@pytest.mark.parametrize("symbols, crowd", [(2, 1), (3, 2), (5, 64), (None, 64)])
def test_small_alphabets_and_crowds(spark, documents, symbols, crowd):
    stems = ["abcdefgh", "abcdefgk", "bcdefgh", "abcdefghh", "aabcdefgh", "zzzzzz", "zzzzzzz", "zzzzzzzz", "überzüge", "überzug", "uberzüge",
             "ÀBCDEFG", "àBCDEFG", "xxyyxxyy", "yyxxyyxx", "x" * 70, "x" * 71, "x" * 64, "x" * 65, "x" * 69 + "y"]
    rows = [(k, " ".join([w] * (5 + 13 * k % 90))) for k, w in enumerate(stems)]
    rows += [(100 + k, f"{w}, {w}") for k, w in enumerate(stems)]
    got = result(S.spelling_variants(documents(rows), symbols=symbols, crowd=crowd))
    assert got == variants(vocabulary(rows))


def test_chains_of_forms(spark, documents):
    chain = [("aaaaaab", 5), ("aaaaaabc", 25), ("aaaaaabcd", 125), ("aaaaaabcde", 625), ("aaaaaabcdef", 3125), ("aaaaaabcdeg", 3125)]
    rows = [(k, " ".join([w] * n)) for k, (w, n) in enumerate(chain)]
    got = result(S.spelling_variants(documents(rows), slips=0))
    assert got["aaaaaab"] == ("aaaaaabc", "aaaaaabcdef", 5, 1, 25)
    assert got["aaaaaabcde"][:2] == ("aaaaaabcdef", "aaaaaabcdef")  # equal counts: the first in code-point order
    assert got["aaaaaabcdef"] == (None, "aaaaaabcdef", 3125, 2, None)


def test_awkward_rows_and_empty_table(spark, documents, awkward):
    got = result(S.spelling_variants(documents(awkward)))
    assert got == variants(vocabulary([(r[0], r[1]) for r in awkward]))
    assert result(S.spelling_variants(documents([(1, None), (2, ""), (3, "12 ; 7")]))) == {}
    assert S.spelling_variants(documents([(1, "x")]).limit(0)).count() == 0


def test_neighbourhood_holds_every_edit():
    alphabet = S.balanced([(c, 10 - k) for k, c in enumerate("abcdefg")], 3)
    word = "abcabe"
    keys = set(S.neighbourhoods([word], alphabet)[1].tolist())
    edits = {word[:k] + word[k + 1:] for k in range(6)} | {word[:k] + c + word[k + 1:] for k in range(6) for c in "abcdefg"}
    edits |= {word[:k] + c + word[k:] for k in range(7) for c in "abcdefg"}
    assert {int(S.hashes([e], alphabet)[0]) for e in edits} == keys
