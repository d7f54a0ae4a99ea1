import random
import re

from strophe.llm.minhash import NearDuplicates, drop_near_duplicates, op1_minhash_near_dedup

FOLDER = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1)))


def brute_force(rows, width=3, percent=85):
    """(n_shingles, component) of each row; rows with one id are one document."""
    sets = [(i, shingles(t, width)) for i, t in rows]
    parent = {i: i for i, _ in sets if i is not None}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    known = [(i, s) for i, s in sets if i is not None and s]
    for x, (i, a) in enumerate(known):
        for j, b in known[:x]:
            both = len(a & b)
            if 100 * both >= percent * (len(a) + len(b) - both):
                low, high = sorted((root(i), root(j)))
                parent[high] = low
    return sorted(((i, len(s), None if i is None else root(i)) for i, s in sets), key=str)


def found(df):
    return sorted(((r.id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


def test_awkward_rows(documents, awkward):
    df = NearDuplicates()(documents(awkward))
    assert found(df) == brute_force([r[:2] for r in awkward])
    assert all(r.kept == (r.id is None or r.id == r.component_id) for r in df.collect())


def test_empty_table(documents):
    assert NearDuplicates()(documents([])).count() == 0


def test_links_that_no_star_finds(documents):
    """Chains of edits: neighbours are alike, ends are not, and the blocks are tiny."""
    rng = random.Random(7)
    rows = []
    for group in range(6):
        words = [f"g{group}w{i}" for i in range(120)]
        for step in range(25):
            rows.append((group * 100 + step, " ".join(words)))
            for _ in range(2):
                words[rng.randrange(len(words))] = f"x{rng.randrange(10 ** 6)}"
    rng.shuffle(rows)
    df = NearDuplicates(block=4)(documents(rows))
    assert found(df) == brute_force(rows)


def test_limit_is_exact(documents):
    base = [f"w{i}" for i in range(102)]  # 100 shingles
    rows = [(1, " ".join(base)), (2, " ".join(base[:87])), (3, " ".join(base[:86]))]  # 85 and 84 of them
    wide = NearDuplicates(bands=64, rows=2)
    assert {r.id: r.component_id for r in wide(documents(rows[:2])).collect()} == {1: 1, 2: 1}
    assert {r.id: r.component_id for r in wide(documents([rows[0], rows[2]])).collect()} == {1: 1, 3: 3}


def test_hot_groups(documents, prose):
    rows = [(i, prose) for i in range(400)] + [(1000 + i, prose + f" tail{i}") for i in range(300)]
    assert {r.component_id for r in NearDuplicates(block=16)(documents(rows)).collect()} == {0}


def test_dropping_keeps_columns_and_one_row(documents, prose):
    docs = documents([(2, prose), (1, prose + " more"), (None, prose), (3, None)])
    kept = drop_near_duplicates(docs, NearDuplicates(width=5, percent=80, bands=32, rows=4))
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "3", "None"]


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    df = op1_minhash_near_dedup(spark, FOLDER).withColumnRenamed("doc_id", "id")
    assert found(df) == brute_force(rows)
