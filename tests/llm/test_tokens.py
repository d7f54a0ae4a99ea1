import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from strophe.llm.tokens import encode_texts, op4_token_ids, read_tokens, token_counts, write_tokens

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")
FOLDER = "/root/testdata/sf0.001"
ODD = ["", "a", "\n", "\na", " a", "a ", "a\n", "don't, I'm.", "x<|endoftext|>y z", "<|endoftext|>", "a  b", "日本 語, é.", "foo.\nBar, baz\tqux",
       "ß. 12,5. a1. 1.", "a\n\nb", "a \n b", "\ra", "\r", "it's\nwe've, you'll.", "x,\ny.", ",", ".", "é,", "...", "ǆ, ɐ.", "a b, c", "a,. b", "\n,", "x  y"]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def ids(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def test_words_give_the_ids_of_the_text(tokenizer):
    for text, data in zip(ODD, encode_texts(PATH, ODD, b"")):
        assert np.frombuffer(data, "<u4").tolist() == ids(tokenizer, text), text


def test_round_trip_and_layout(spark, documents, awkward, tokenizer, tmp_path):
    rows = awkward + [(100 + i, t) for i, t in enumerate(ODD)]
    folder = str(tmp_path / "tokens")
    write_tokens(documents(rows), folder, PATH, end_id=2, files=3)
    tokens = read_tokens(spark, folder)
    want = sorted((str(r[0]), tuple(ids(tokenizer, r[1]) + [2])) for r in rows)
    assert sorted((str(r.doc_id), tuple(r.ids)) for r in tokens.collect()) == want

    files = sorted((tmp_path / "tokens").glob("*.parquet"))
    order = [d for f in files for d in pq.read_table(f).column("doc_id").to_pylist()]
    assert order == sorted(order, key=lambda d: (d is not None, d))
    group = pq.ParquetFile(files[-1]).metadata.row_group(0)
    encodings = [set(group.column(i).encodings) for i in range(2)]
    assert "DELTA_BINARY_PACKED" in encodings[0] and "RLE_DICTIONARY" in encodings[1]
    assert all(group.column(i).has_offset_index for i in range(2))

    at = 0
    for r in sorted(token_counts(tokens).collect(), key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    assert at == sum(len(w) for _, w in want)


def test_counts_read_no_ids(spark, documents, prose, tmp_path):
    write_tokens(documents([(1, prose)]), str(tmp_path / "t"), PATH)
    plan = read_tokens(spark, str(tmp_path / "t")).where(F.col("doc_id") > 0).select("doc_id")._jdf.queryExecution().toString()
    assert "ReadSchema: struct<doc_id:bigint>" in plan and "GreaterThan(doc_id,0)" in plan


def test_empty_table(spark, documents, tmp_path):
    write_tokens(documents([]), str(tmp_path / "t"), PATH, end_id=2)
    assert token_counts(read_tokens(spark, str(tmp_path / "t"))).count() == 0


def test_query(spark, tokenizer):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    got, at = {r.doc_id: r for r in op4_token_ids(spark, FOLDER).collect()}, 0
    for doc in sorted(docs):
        mine = ids(tokenizer, docs[doc]) + [2]
        assert (got[doc].start, got[doc].n_tokens, got[doc].ids_crc32) == (at, len(mine), zlib.crc32(np.array(mine, "<u4").tobytes()))
        at += len(mine)
