"""The prefix trie of conversations by truncation peeling.

1. *Turns* become a 128-bit digest of role and text and a count of words, so no text is
   shuffled.  A conversation is one row: the turns' digests chained into a trail of 16 bytes a
   turn, whose last 16 name the node where it ends.  Equal trails are merged, combined within
   each task first, so thousands of copies are one row.
2. *Peeling.*  Trails are range-partitioned, which keeps those of one opening together, and cut
   into slices of about ``SLICE_BYTES``.  A slice is peeled from its greatest depth: what ended
   there is merged with the nodes that survive, each node is aggregated as it is discovered, its
   last turn is stripped, and what is left is grouped again.  So the number of jobs does not
   depend on the longest conversation, and an opening that a third of all conversations share
   lies in many slices.
3. Only the openings of a slice's first and last trail may go on in other slices.  Their sums
   stay open and are handed on, two rows a slice, to a next pass over these rows, until few
   enough are left for one task.
4. *Ends.*  The ids that end at a node are hashed in order by range-partitioned slices.  A node
   that lies within one slice is hashed there; the ids of the others go on as joined texts of at
   most ``CHUNK`` ids.

Nulls: rows without a conversation id are left out; a null role or text is empty; a null turn
comes first.  Turns of one number come in the order of their digests, and each repeated row is a
turn of its own.  A text of any length counts by its digest.  A conversation without turns ends
at the root.  An empty table has no nodes.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.joins import lookup_join
from ..sources.staging import stage
from .base import WORD, query, table

KEY = 16
CHUNK = 1 << 16
SLICE_BYTES = 16 << 20
LAST_ROWS = 1 << 14
_ADD = pa.struct([("depth", pa.int32())] + [(c, pa.int64()) for c in ("n", "conv", "children", "leaves", "saved")])
_PEELED = pa.schema([
    ("depth", pa.int64()), ("key", pa.binary()), ("parent", pa.binary()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()),
    ("conv_id", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()),
    ("trail", pa.binary()), ("words", pa.list_(pa.int64())), ("adds", pa.list_(_ADD))])
_PEELED_SQL = ("depth long, key binary, parent binary, parent_conv_id long, n_convs long, conv_id long, n_children long, n_leaves long, "
               "saved_tokens long, trail binary, words array<long>, "
               "adds array<struct<depth:int,n:long,conv:long,children:long,leaves:long,saved:long>>")


def turn_lists(rows: DataFrame) -> DataFrame:
    """``(conv_id, turns)`` of ``rows(conv_id, turn, role, text)``: digest and words of each turn, in order."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))
    turn = F.struct("turn", digest.alias("digest"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
    listed = rows.where(F.col("conv_id").isNotNull()).select("conv_id", turn.alias("t")).groupBy("conv_id").agg(
        F.sort_array(F.collect_list("t")).alias("t"))  # nulls first
    return listed.select("conv_id", F.transform("t", lambda t: F.struct(t["digest"], t["words"])).alias("turns"))


def rebuilt(lists: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """Conversations that share openings: the first h turns of the one whose id is the next smaller multiple, then their own.

    h is the crc32 of the decimal id modulo ``most``.
    """
    lists = stage(lists)
    opening = lists.select(F.col("conv_id").alias("_base"), F.slice("turns", 1, most - 1).alias("_first"))
    h = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(most)).cast("int")
    both = lists.withColumn("_h", h).join(opening, F.col("conv_id") - F.col("conv_id") % every == F.col("_base"), "left")
    none = F.slice("turns", 1, 0)
    own = F.slice("turns", F.col("_h") + 1, F.greatest(F.size("turns"), F.lit(1)))
    return both.select("conv_id", F.concat(F.coalesce(F.slice("_first", F.lit(1), F.col("_h")), none), own).alias("turns"))


def trails(lists: DataFrame) -> DataFrame:
    """``(conv_id, trail, words)``: the chained digests of the turns and the words of each."""
    link = lambda at, t: F.concat(at, F.unhex(F.md5(F.concat(_last(at), t["digest"]))))
    return lists.select(
        "conv_id", F.aggregate("turns", F.lit(b""), link).alias("trail"), F.transform("turns", lambda t: t["words"]).alias("words"))


def _last(trail: Column | str) -> Column:
    """The name of the node at the end of a trail."""
    return F.substring(trail, -KEY, KEY)


def _names(trail: bytes) -> list[bytes]:
    """The names of the nodes along a trail, from the root."""
    return [b""] + [trail[k:k + KEY] for k in range(0, len(trail), KEY)]


def peel(trails: list[bytes], words: list[np.ndarray], adds: list[list[dict]], last: bool) -> Iterator[list[tuple]]:
    """Rows of ``_PEELED``: complete nodes, then what stays open of the first and the last trail.

    ``adds`` holds what is known of nodes along each trail: members, their smallest, and the sums
    over children that are complete.  In the ``last`` pass every node is complete.
    """
    ends = [min(range(len(trails)), key=trails.__getitem__), max(range(len(trails)), key=trails.__getitem__)]
    open_: dict[bytes, int] = {}
    for row in () if last else ends:
        for name in _names(trails[row]):
            open_.setdefault(name, row)
    kept: dict[int, list[dict]] = {}
    levels: dict[int, dict[bytes, list]] = {}

    def put(row: int, depth: int, n: int, conv: int, children: int, leaves: int, saved: int) -> list:
        name = trails[row][KEY * (depth - 1):KEY * depth] if depth else b""
        node = levels.setdefault(depth, {}).setdefault(name, [row, 0, conv, 0, 0, 0, []])
        node[1] += n
        node[2] = min(node[2], conv)
        node[3] += children
        node[4] += leaves
        node[5] += saved
        return node

    for row, known in enumerate(adds):
        for a in known:
            put(row, **a)
    out: list[tuple] = []
    for depth in range(max(levels), -1, -1):
        for name, (row, n, conv, children, leaves, saved, waiting) in levels.pop(depth, {}).items():
            incomplete = name in open_
            # The nodes below waited for the smallest member of this one.
            out.extend((depth + 1, key, name if incomplete else None, None if incomplete else conv, *sums, None, None, None) for key, *sums in waiting)
            if incomplete:
                kept.setdefault(open_[name], []).append(
                    {"depth": depth, "n": n, "conv": conv, "children": children, "leaves": leaves, "saved": saved})
                continue
            leaves = max(leaves, 1)
            saved += (n - 1) * int(words[row][depth - 1]) if depth else 0
            if depth:
                put(row, depth - 1, n, conv, 1, leaves, saved)[6].append((name, n, conv, children, leaves, saved))
            else:
                out.append((0, name, None, None, n, conv, children, leaves, saved, None, None, None))
        if len(out) >= 10_000:
            yield out
            out = []
    out.extend((*[None] * 9, trails[row], words[row].tolist(), known) for row, known in kept.items())
    if out:
        yield out


def _peel_slices(rows: DataFrame, last: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trails, words, adds = [], [], []
        for batch in batches:
            trails += batch.column(0).to_pylist()
            words += [w.values.to_numpy() for w in batch.column(1)]
            adds += batch.column(2).to_pylist()
        if trails:
            for out in peel(trails, words, adds, last):
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _PEELED)], schema=_PEELED)

    return rows.select("trail", "words", "adds").mapInArrow(run, _PEELED_SQL)


def peeled(ends: DataFrame) -> DataFrame:
    """``(depth, key, parent_conv_id, n_convs, conv_id, n_children, n_leaves, saved_tokens)`` of the nodes above ``ends(conv_id, trail, words)``."""
    zero = F.lit(0).cast("long")
    add = F.struct(F.floor(F.octet_length("trail") / KEY).cast("int").alias("depth"), "n", "conv", zero.alias("children"), zero.alias("leaves"),
                   zero.alias("saved"))
    rows = stage(ends.groupBy("trail", "words").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv")).select(
        "trail", "words", F.array(add).alias("adds")))
    passes: list[DataFrame] = []
    n, size = rows.agg(F.count(F.lit(1)), F.sum(F.octet_length("trail") + 64 * F.size("adds"))).first()
    while True:
        # Rows of open trails are two a slice, so each pass has far fewer of them.
        last = n <= LAST_ROWS and bool(passes) or n <= 1
        if last:
            out = stage(_peel_slices(rows.coalesce(1), True))
            passes.append(out)
            break
        slices = max(-(-size // SLICE_BYTES), int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) if not passes else 1)
        out = stage(_peel_slices(rows.repartitionByRange(slices, "trail"), False))
        passes.append(out)
        rows = out.where(F.col("trail").isNotNull()).select("trail", "words", "adds")
        before, (n, size) = n, rows.agg(F.count(F.lit(1)), F.sum(F.octet_length("trail") + 64 * F.size("adds"))).first()
        if n >= before:  # nothing was gained: each trail is a slice of its own
            n = 1
    nodes, *later = [p.where(F.col("trail").isNull()).drop("trail", "words", "adds") for p in passes]
    if not later:
        return nodes.drop("parent")
    upper = later[0]
    for more in later[1:]:
        upper = upper.union(more)
    # Parents without a known smallest member were open in some pass, so a later one completed them: few rows a slice.
    names = upper.select(F.col("key").alias("parent"), F.col("conv_id").alias("_up"))
    found = lookup_join(nodes.union(upper), names, ["parent"], "left")
    return found.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_up")).drop("parent", "_up")


def end_digests(ends: DataFrame) -> DataFrame:
    """``(key, ends_sha256)`` of each node where conversations end: the hash of their ids, ascending and joined by commas."""
    def hash_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        at, ids, open_ = None, [], True  # a slice's first node may have begun in an earlier one

        def close(is_open: bool) -> None:
            text = ",".join(map(str, ids))
            out.append((at, ids[0], text, None) if is_open else (at, ids[0], None, hashlib.sha256(text.encode()).hexdigest()))

        def flush() -> pa.RecordBatch:
            names = ["key", "first", "text", "ends_sha256"]
            types = [pa.binary(), pa.int64(), pa.string(), pa.string()]
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
            out.clear()
            return batch

        for batch in batches:
            for key, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if key != at:
                    if at is not None:
                        close(open_)
                        open_ = False
                    at, ids = key, []
                elif len(ids) >= CHUNK:
                    close(True)
                    ids, open_ = [], True
                ids.append(conv)
            if len(out) >= 4096:
                yield flush()
        if ids:
            close(True)
        if out:
            yield flush()

    def hash_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, running = None, None
        for batch in batches:
            keys, digests = [], []
            for key, text in zip(batch.column(0), batch.column(1)):  # scalars: one text at a time
                key = key.as_py()
                if key != at:
                    if at is not None:
                        keys.append(at)
                        digests.append(running.hexdigest())
                    at, running = key, hashlib.sha256()
                else:
                    running.update(b",")
                running.update(text.as_py().encode())
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(digests)], ["key", "ends_sha256"])
        if at is not None:
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.binary()), pa.array([running.hexdigest()])], ["key", "ends_sha256"])

    named = stage(ends.select(_last("trail").alias("key"), "conv_id"))
    sliced = stage(named.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id").mapInArrow(
        hash_slices, "key binary, first long, text string, ends_sha256 string"))
    across = sliced.where(F.col("text").isNotNull()).repartition("key").sortWithinPartitions("key", "first").select("key", "text").mapInArrow(
        hash_texts, "key binary, ends_sha256 string")
    return sliced.where(F.col("text").isNull()).select("key", "ends_sha256").union(across)


def prefix_trie(lists: DataFrame) -> DataFrame:
    """One row per distinct opening of the conversations ``lists(conv_id, turns)``."""
    ends = stage(trails(lists))
    return peeled(ends).join(end_digests(ends), "key", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


def crc_sql(codes: str) -> str:
    """The crc32 of a list of bytes, bit by bit."""
    bit = "xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)"
    byte = f"list_reduce(list_prepend(xor(b, x), CAST(range(8) AS BIGINT[])), lambda c, k: {bit})"
    return f"xor(list_reduce(list_prepend(4294967295, CAST({codes} AS BIGINT[])), lambda b, x: {byte}), 4294967295)"


_WORDS = r"len(regexp_extract_all({}, '[^\x20\x09-\x0D]+'))"


@query(f"""WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id
        ORDER BY turn NULLS FIRST, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS k
      FROM conversations WHERE conv_id IS NOT NULL),
    ids AS (SELECT c, {crc_sql("list_transform(string_split(CAST(c AS VARCHAR), ''), lambda d: ascii(d))")} % 4 AS h
      FROM (SELECT DISTINCT conv_id AS c FROM t)),
    turns AS (SELECT c, 0 AS part, k, role, text FROM ids JOIN t ON t.conv_id = c - c % 20 AND k <= h
      UNION ALL SELECT c, 1, k, role, text FROM ids JOIN t ON t.conv_id = c AND k > h),
    texts AS (SELECT role, text, md5(strlen(role) || ':' || role || text) AS id, {_WORDS.format('text')} AS words FROM turns GROUP BY ALL),
    paths AS (SELECT c, list(md5(strlen(role) || ':' || role || text) ORDER BY part, k) FILTER (role IS NOT NULL) AS path
      FROM ids LEFT JOIN turns USING (c) GROUP BY c),
    members AS (SELECT c, coalesce(len(path), 0) AS n, unnest(range(coalesce(len(path), 0) + 1)) AS depth,
      coalesce(path, CAST([] AS VARCHAR[])) AS path FROM paths),
    nodes AS (SELECT depth, array_to_string(path[1:depth], ',') AS p, min(c) AS conv_id, count(*) AS n_convs,
      coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (n = depth), '') AS ends, any_value(path[1:depth]) AS path
      FROM members GROUP BY ALL),
    cost AS (SELECT nodes.*, (n_convs - 1) * coalesce(words, 0) AS saves FROM nodes LEFT JOIN texts ON texts.id = path[depth]),
    family AS (SELECT n.*, up.conv_id AS parent_conv_id, coalesce(down.n, 0) AS n_children FROM cost n
      LEFT JOIN nodes up ON up.depth = n.depth - 1 AND up.p = array_to_string(n.path[1:n.depth - 1], ',')
      LEFT JOIN (SELECT depth - 1 AS depth, array_to_string(path[1:depth - 1], ',') AS p, count(*) AS n FROM nodes WHERE depth > 0
        GROUP BY ALL) down ON down.depth = n.depth AND down.p = n.p),
    under AS (SELECT up_to AS depth, array_to_string(path[1:up_to], ',') AS p, sum(saves) AS saved, count_if(n_children = 0) AS leaves
      FROM (SELECT path, saves, n_children, unnest(range(depth + 1)) AS up_to FROM family) GROUP BY ALL)
    SELECT conv_id, depth, parent_conv_id, n_convs, CAST(n_children AS BIGINT) AS n_children, CAST(leaves AS BIGINT) AS n_leaves,
      CAST(saved AS BIGINT) AS saved_tokens, sha256(ends) AS ends_sha256 FROM family JOIN under USING (depth, p)""")
def op12_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie(rebuilt(turn_lists(table(spark, folder, "conversations"))))
