import hashlib
import random

import numpy as np
import pytest

from strophe.llm import suffixes
from strophe.sources.staging import stage
from strophe.llm.suffixes import LENGTH, earlier_factors, op7_suffix_dedup, remove_repeats, smaller_before

FOLDER = "/root/testdata/sf0.001"


def brute_force(rows):
    """doc_id -> (bytes, spans, kept) for rows with different ids."""
    seen, out = set(), {}
    for doc, text in sorted(rows, key=lambda r: float("inf") if r[0] is None else r[0]):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - LENGTH + 1):
            window = data[p:p + LENGTH]
            if window in seen:
                gone[p:p + LENGTH] = b"\1" * LENGTH
            seen.add(window)
        spans = [p for p in range(len(data)) if gone[p] and not (p and gone[p - 1])]
        out[doc] = (len(data), len(spans), bytes(c for c, g in zip(data, gone) if not g))
    return out


def found(df):
    return {r.doc_id: (r.n_bytes, len(r.spans), bytes(r.kept)) for r in df.collect()}


def test_awkward_rows(documents, awkward):
    rows = [r[:2] for r in {r[0]: r for r in awkward}.values()]
    assert found(remove_repeats(documents(rows))) == brute_force(rows)


def test_repeated_rows_agree(documents, prose):
    got = remove_repeats(documents([(1, prose), (1, prose), (2, prose), (1, "x" * 99)])).collect()
    assert sorted((r.doc_id, bytes(r.kept)) for r in got) == [(1, prose.encode()), (1, prose.encode()), (1, b"x" * 99), (2, b"")]


def test_empty_table(documents):
    assert remove_repeats(documents([])).count() == 0


def test_null_ids_with_equal_checksums(documents, monkeypatch):
    """Texts that share an id and a checksum stay apart; one of them repeats another document, the other nothing."""
    rng = random.Random(11)
    by_crc, pair = {}, None
    while pair is None:
        text = "".join(rng.choice("abcdefgh ") for _ in range(180))
        other = by_crc.setdefault(suffixes.checksum(text.encode()), text)
        if other != text:
            pair = (other, text)
    for doc in (None, 7):
        got = remove_repeats(documents([(1, pair[0]), (doc, pair[0]), (doc, pair[1]), (doc, pair[1])])).collect()
        kept = sorted((bytes(r.kept) for r in got if r.doc_id == doc), key=len)
        assert kept == [b"", pair[1].encode(), pair[1].encode()]


def test_refined_rows_hold_every_window_once(spark):
    data = bytes(range(200))[:168]
    piece = [(5, 1, 2, 3, 10, 68, 32, bytearray(data))]
    rows = spark.createDataFrame(piece, suffixes.PIECES)
    for _ in range(8):
        rows = stage(suffixes.refined(rows.where(f"size < {LENGTH}")))
        got = rows.collect()
        if not got:
            break
        windows = [r.lo + k for r in got for k in range(len(r.bytes) - LENGTH + 1)]
        assert len(set(windows)) == len(windows) and len(got) <= 69
        for r in got:
            assert 0 <= r["at"] and r["at"] + r["size"] <= LENGTH + (len(r.bytes) - LENGTH)
            for k in range(len(r.bytes) - LENGTH + 1):  # the longer anchor lies in every window
                assert k <= r["at"] and r["at"] + r["size"] <= k + LENGTH
        if all(r["size"] < LENGTH for r in got):
            assert sorted(windows) == list(range(10, 79))


@pytest.mark.parametrize("group,surplus", [(1024, 64), (4, 2), (1, 1)])
def test_random_overlaps(documents, monkeypatch, group, surplus):
    """Passages pasted in many places, runs of one sign, periods; also with tiny groups, which makes every anchor a hot one."""
    monkeypatch.setattr(suffixes, "GROUP", group)
    monkeypatch.setattr(suffixes, "SURPLUS", surplus)
    rng = random.Random(3)
    passages = ["".join(rng.choice("abcdé ") for _ in range(rng.randrange(60, 400))) for _ in range(8)]
    rows = []
    for doc in range(60):
        parts = []
        for _ in range(rng.randrange(1, 6)):
            p = rng.choice(passages)
            a = rng.randrange(len(p))
            parts += ["".join(rng.choice("xyzé ") for _ in range(rng.randrange(30))), p[a:a + rng.randrange(20, 400)]]
        rows.append((doc * 3 - 40, "".join(parts)))
    rows += [(500, "a" * 350), (501, "ab" * 200), (502, "a" * 99), (503, "a" * 100)]
    rng.shuffle(rows)
    assert found(remove_repeats(documents(rows))) == brute_force(rows)


def test_smaller_before():
    rng = np.random.default_rng(1)
    place, run = rng.permutation(300), np.sort(rng.integers(0, 9, 300))
    want = [max((j for j in range(i) if place[j] < place[i] and run[j] == run[i]), default=-1) for i in range(300)]
    got = smaller_before(place, run)
    assert [(w >= 0) for w in want] == [(g >= 0) for g in got]
    assert got.tolist() == want


def test_earlier_factors():
    data = np.frombuffer(b"z" * 130 + bytes(range(120)) + bytes(range(120)), np.uint8)
    starts = np.array([0, 10, 130, 150, 250, 252])
    assert earlier_factors(data, starts, np.array([1, 0, 5, 2, 3, 4])).tolist() == [True, False, True, False, False, False]


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    want = {d: (n, n - len(kept), spans, hashlib.sha256(kept).hexdigest()) for d, (n, spans, kept) in brute_force(rows).items()}
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in op7_suffix_dedup(spark, FOLDER).collect()}
    assert got == want
