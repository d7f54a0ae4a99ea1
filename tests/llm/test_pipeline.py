import sys
from collections import Counter
from pathlib import Path

import pytest
import sentencepiece

sys.path.insert(0, str(Path(__file__).parent))
sys.path.insert(0, str(Path(__file__).parents[2]))

import corpus_pipeline  # noqa: E402
import test_minhash  # noqa: E402
import test_mixing  # noqa: E402
import test_quality  # noqa: E402
import test_units  # noqa: E402
from strophe.sources.staging import stage  # noqa: E402

public_tokenizers = pytest.importorskip("public_tokenizers")
FOLDER = "/root/testdata/sf0.001"


def test_stages_against_plain_python(spark):
    """Every stage of a run over the whole table, each held against a plain version on the input it had."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    seen = []
    for _, step in corpus_pipeline.STAGES:
        after = stage(step(spark, docs, FOLDER))
        seen.append(([tuple(r) for r in docs.collect()], after.collect()))
        if step is not corpus_pipeline.encoded:
            assert after.columns == docs.columns
        docs = after
    quality, near, units, mix, tokens = seen

    before, after = quality
    assert sorted(r.doc_id for r in after) == sorted(r[0] for r in before if test_quality.brute_force(r[1])[-1])

    before, after = near
    root = {i: c for i, _, c in test_minhash.brute_force([r[:2] for r in before], 5, 80)}
    assert sorted(r.doc_id for r in after) == sorted(i for i, c in root.items() if i == c)

    before, after = units
    kept = test_units.brute_force([r[:2] for r in before], "sentence", 10)
    assert {r.doc_id: r.text for r in after} == {i: t for i, t in kept.items() if t.strip() or dict((r[0], r[1]) for r in before)[i] == t}
    assert all(r.n_chars == len(r.text) for r in after)

    before, after = mix
    sizes = Counter()
    for r in before:
        sizes[r[3]] += len(r[1].split())
    want = test_mixing.targets(dict(sizes))
    taken = Counter()
    for r in after:
        taken[r.source] += len(r.text.split())
    most = {s: max(len(r[1].split()) for r in before if r[3] == s) for s in sizes}
    assert all(abs(taken[s] - want[s]) <= most[s] / 2 + 1e-6 for s in sizes)
    assert set(map(tuple, after)) <= set(before) and max(Counter(r.doc_id for r in after).values()) <= 2

    before, after = tokens
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    assert sorted((r.doc_id, list(r.ids)) for r in after) == sorted((r[0], model.encode(r[1])) for r in before)
    assert sorted(map(tuple, corpus_pipeline.run(spark, FOLDER).select("doc_id", "n_ids").collect())) == sorted((r.doc_id, r.n_ids) for r in after)


@pytest.mark.parametrize("name,step", corpus_pipeline.STAGES)
def test_stage_with_awkward_rows(spark, documents, awkward, name, step):
    docs = documents(awkward)
    out = step(spark, docs, FOLDER)
    out.collect()
    assert name == "token ids" or out.columns == docs.columns
    assert step(spark, documents([]), FOLDER).count() == 0


def test_repeated_sentences_keep_columns_of_any_name(spark):
    """Columns named like those of the operator come through unchanged."""
    names = "doc_id long, text string, lang string, source string, n_chars long, removed string, n_removed string, n_units string, kept_text string, _document string"
    first = "the first sentence of this text has well over ten words in it and more."
    rows = [(1, first, "en", "s", 72, "a", "b", "c", "d", "e"), (2, f"{first} And something of its own.", "en", "s", 99, None, "q", "r", "t", "u")]
    out = {r.doc_id: r for r in corpus_pipeline.without_repeats(spark, spark.createDataFrame(rows, names), "").collect()}
    assert tuple(out[1])[5:] == ("a", "b", "c", "d", "e") and tuple(out[2])[5:] == (None, "q", "r", "t", "u")
    assert out[1].text == first and first not in out[2].text and out[2].n_chars == len(out[2].text)
