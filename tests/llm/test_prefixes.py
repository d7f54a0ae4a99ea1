import hashlib
import re
import zlib

import pytest

from strophe.llm import prefixes as P

FOLDER = "/root/testdata/sf0.01"
SCHEMA = "conv_id long, turn int, role string, text string"


def digest(turn):
    role, text = turn
    return hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()


def trie(rows):
    """Brute force: every prefix as a tuple."""
    talks = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            talks.setdefault(conv, []).append((turn is not None, turn or 0, (role or "", text or "")))
    talks = {c: [t[2] for t in sorted(ts, key=lambda t: (t[0], t[1], digest(t[2])))] for c, ts in talks.items()}
    built = {}
    for c, own in talks.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        built[c] = tuple(talks.get(base, [])[:h] + own[h:])
    members = {}
    for c, path in built.items():
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
    out = {}
    for path, who in members.items():
        under = [p for p in members if p[:len(path)] == path]
        inner = {p[:-1] for p in members if p}
        out[(len(path), min(who))] = (
            min(members[path[:-1]]) if path else None, len(who), sum(len(p) == len(path) + 1 for p in under),
            sum(p not in inner for p in under),
            sum((len(members[p]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) for p in under if p),
            hashlib.sha256(",".join(map(str, sorted(c for c in who if built[c] == path))).encode()).hexdigest())
    return out


def result(df):
    return {(r.depth, r.conv_id): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in df.collect()}


def of(df):
    return P.prefix_trie(P.rebuilt(P.turn_lists(df)))


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    mine = P.op12_conversation_trie(spark, FOLDER)
    assert set(t for _, t in mine.dtypes) == {"bigint", "string"}
    assert result(mine) == trie(rows)


@pytest.fixture
def awkward_talks():
    rows = [(c, t, "user" if t % 2 == 0 else None, f"opening {t}" if t < 2 else f"own {c % 7} {t}\tword") for c in range(60) for t in range(c % 6)]
    rows += [(100, None, None, None), (100, 3, "user", ""), (100, 3, "user", "tie"), (100, 3, "user", "tie"), (None, 1, "user", "nobody's")]
    rows += [(-5, 0, "user", "below zero"), (-20, 0, "user", "base below zero"), (-20, 1, "x", "y"), (-41, 1, "x", "y")]
    rows += [(200, t, "user", " ".join(["long"] * 20_000)) for t in range(40)]
    rows += [(c, t, "user", f"copy {t}") for c in range(300, 420) for t in range(5)]
    return rows


@pytest.mark.parametrize("slice_bytes, last_rows, chunk", [(16 << 20, 1 << 14, 1 << 16), (300, 3, 3), (1, 1, 1)])
def test_awkward_rows(spark, awkward_talks, slice_bytes, last_rows, chunk, monkeypatch):
    monkeypatch.setattr(P, "SLICE_BYTES", slice_bytes)
    monkeypatch.setattr(P, "LAST_ROWS", last_rows)
    monkeypatch.setattr(P, "CHUNK", chunk)
    df = spark.createDataFrame([(*r, "a", "b", "c") for r in awkward_talks], SCHEMA + ", turns string, trail string, key string")
    assert result(of(df.repartition(5))) == trie(awkward_talks)


def test_empty_table_and_only_null_ids(spark):
    assert of(spark.createDataFrame([], SCHEMA)).count() == 0
    assert of(spark.createDataFrame([(None, 1, "user", "x")], SCHEMA)).count() == 0


def test_conversation_without_turns_of_its_own(spark):
    rows = [(c, 0, "user", "only one") for c in range(1, 20)]  # no base; those with h > 0 lose their one turn
    got = result(of(spark.createDataFrame(rows, SCHEMA)))
    assert got == trie(rows)
    assert got[(0, 1)][5] != hashlib.sha256(b"").hexdigest()
