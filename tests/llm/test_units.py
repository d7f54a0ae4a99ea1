import re

import pytest
from pyspark.sql import functions as F

from strophe.llm.units import CUTS, op6_unit_dedup, op6_unit_runs, remove_repeated


def brute_force(rows, unit, min_words):
    """Kept text of each (doc_id, text) with different ids."""
    seen, out = set(), {}
    for doc, text in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        kept = []
        for u in re.split(CUTS[unit], text or ""):
            plain = " ".join(re.split(r"[\x20\x09-\x0D]+", u.strip(" \t\n\x0b\x0c\r"))).lower()
            if len([w for w in plain.split(" ") if w]) >= min_words:
                if plain in seen:
                    continue
                seen.add(plain)
            kept.append(u)
        out[doc] = None if text is None else "".join(kept)
    return out


@pytest.mark.parametrize("unit", list(CUTS))
def test_awkward_rows(documents, awkward, prose, unit):
    rows = [r[:2] for r in {r[0]: r for r in awkward}.values()]
    rows += [(50, f"Intro. {prose.title()}. Then\n\n{prose}\n\n\nend"), (51, f"{prose}.  Again {prose}! {prose}? {prose}"), (52, "a b\n" * 5)]
    docs = documents(rows)
    got = remove_repeated(docs, unit)
    assert {r.doc_id: r.kept_text for r in got.collect()} == brute_force(rows, unit, 10)
    for r in got.collect():
        cut = r.text or ""
        for span in reversed(r.removed):
            cut = cut[:span.start] + cut[span.end:]
        assert cut == (r.kept_text or "")


def test_repeated_rows_agree(documents, prose):
    got = remove_repeated(documents([(1, prose), (1, prose), (2, prose), (None, prose)])).collect()
    assert sorted((str(r.doc_id), r.kept_text) for r in got) == [("1", prose), ("1", prose), ("2", ""), ("None", "")]


def test_empty_table(documents):
    assert remove_repeated(documents([])).count() == 0


def test_columns(documents, prose):
    docs = documents([(1, prose)]).withColumn("removed", F.lit("mine")).withColumn("gone", F.lit(5))
    out = remove_repeated(docs)
    assert out.columns == [c for c in docs.columns if c != "removed"] + ["kept_text", "n_units", "n_removed", "removed"]
    assert out.first().gone == 5 and out.first().n == "y"


def test_hot_line(documents, prose):
    rows = [(i, f"{prose}\nown words of document {i}") for i in range(300)]
    got = remove_repeated(documents(rows)).collect()
    assert sum(r.n_removed for r in got) == 299 and all(r.kept_text.endswith(f"document {r.doc_id}") for r in got)


def runs_by_force(rows, unit, min_words):
    """Kept text of each (doc_id, text) with different ids: all stretches of units, of any length, against all earlier ones."""
    docs, first = {}, {}
    for doc, text in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        pieces = [u for u in re.split(CUTS[unit], text or "") if u]
        plain = [" ".join(re.split(r"[\x20\x09-\x0D]+", u.strip(" \t\n\x0b\x0c\r"))).lower() for u in pieces]
        full, gone = [n for n, p in enumerate(plain) if p], set()
        for a in range(len(full)):
            for b in range(a + 1, min(len(full), a + 14) + 1):
                inside = [plain[n] for n in full[a:b]]
                if len(" ".join(inside).split(" ")) >= min_words:
                    at = first.setdefault(tuple(inside), (doc, full[a]))
                    if at[0] != doc or full[a] >= at[1] + full[b - 1] - full[a] + 1:
                        gone.update(range(full[a], full[b - 1] + 1))
        docs[doc] = None if text is None else "".join(p for n, p in enumerate(pieces) if n not in gone)
    return docs


def test_runs_of_short_units(documents, prose):
    talk = "Who is there? It is me. Come in then. Thank you. Where have you been? Out. Sit down. I will."
    rows = [(1, f"{prose.title()}. {talk} The end of one."), (2, f"Another start. {talk} {prose}. Thank you. Out. I will."),
            (3, "Out. I will. Thank you. Come in then. Sit down. It is me."), (4, "a b. " * 12), (5, "Where have you been?\n\nOut. Sit down. I will.\n"),
            (6, None), (7, ""), (8, "Who is there? It is me. Come in then, please. Thank you.")]
    got = {r.doc_id: r.kept_text for r in remove_repeated(documents(rows), "sentence", runs=True).collect()}
    assert got == runs_by_force(rows, "sentence", 10)
    assert got[2] == "Another start. Thank you. Out. I will." and got[3] == rows[2][1] and got[4] == "a b. " * 5
    assert got[5] == rows[4][1] and got[8] == rows[7][1]


@pytest.mark.parametrize("unit", list(CUTS))
def test_runs_with_awkward_rows(documents, awkward, prose, unit):
    rows = [r[:2] for r in {r[0]: r for r in awkward}.values()] + [(50, f"Intro. {prose}. Then\n\n{prose}\n\n\nend"), (52, "a b\n" * 9)]
    got = remove_repeated(documents(rows), unit, runs=True).collect()
    assert {r.doc_id: r.kept_text for r in got} == runs_by_force(rows, unit, 10)
    assert all((r.n_removed > 0) == bool(r.removed) for r in got)
    assert remove_repeated(documents([]), unit, runs=True).count() == 0


def test_runs_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    runs = {r.doc_id: r for r in op6_unit_runs(spark, folder).collect()}
    assert {i: r.text for i, r in runs.items()} == {i: t or "" for i, t in runs_by_force(rows, "sentence", 10).items()}
    # What a sentence of ten words loses, a run loses too.
    assert all(runs[r.doc_id].n_removed >= r.n_removed for r in op6_unit_dedup(spark, folder).collect())


def test_a_filter_on_the_kept_text_cuts_no_text_twice(documents, prose):
    found = remove_repeated(documents([(1, prose), (2, prose)]), "sentence")
    kept = found.where(F.length("kept_text") > 0)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    assert [r.doc_id for r in kept.collect()] == [1]


def test_the_text_is_moved_once(documents, prose):
    found = remove_repeated(documents([(1, prose), (2, prose)]).select("doc_id", "text"), "sentence").select("doc_id", "kept_text")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "named_struct(doc_id, doc_id" not in plan and "struct(doc_id" not in plan
