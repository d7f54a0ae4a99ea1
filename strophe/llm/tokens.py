"""Token ids in Parquet list columns.

Texts are encoded on the executors and written as ``(doc_id, ids)`` in ascending order of
the id.  Ids of a vocabulary are few, so a dictionary of at most 2 ** 16 entries and
bit-packed indexes hold them in two bytes; ``doc_id`` rises, so it is delta-encoded.  Row
groups and pages have set sizes and the files carry page indexes: a reader of one range of
documents skips the other pages, a reader of counts does not touch the ids.

A byte-level BPE tokenizer splits at white space and between letters and other signs before
it merges, so a word has the same ids wherever it stands.  A text is cut before its blanks
and line feeds, and each worker encodes a word once while it keeps it (twice ``CACHE`` at
most).  Texts in which white space stands next to white space are encoded whole.

Nulls: a null text is empty (its document holds the end id alone); a null id sorts first.
Rows that repeat an id are written one after the other.  Other columns are not written.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.ordered import running_totals
from ..sources.staging import stage
from .base import query, table

ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 256 << 10
CACHE = 400_000
ROWS_PER_FILE = 1 << 16
_DOUBLE = re.compile(r"\s\s")
_LOADED: dict = {}


def _signs() -> dict[int, str]:
    """The visible sign of each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


_SIGNS = _signs()


class _Words(dict):
    """Ids of words, encoded when first asked for.

    A key is a word without its blank, a line feed and its word, or a return and a word that no blank precedes.
    What was not asked for since the last but one ``turn`` is forgotten.
    """

    def __init__(self, tokenizer) -> None:
        super().__init__()
        self.tokenizer, self.model, self.old = tokenizer, tokenizer.model, {}

    def __missing__(self, key: str) -> bytes:
        out = self.old.get(key)
        if out is None:
            if len(key) > 2 and key[-1] in ",." and key[-2].isalpha():
                out = self[key[:-1]] + self["\r" + key[-1]]
            elif key[:1] == "\n" and len(key) > 1:
                out = self["\r\n"] + self["\r" + key[1:]]
            else:
                out = self.encode(key[1:] if key[:1] == "\r" else key if key == "\n" else " " + key)
        self[key] = out
        return out

    def encode(self, text: str) -> bytes:
        """The ids of a stretch that starts and ends where the tokenizer splits."""
        word = text[1:] if text[:1] == " " else text
        if word.isalpha() and max(word) < "\u0250":  # one split, so the merges alone decide
            signs = text.replace(" ", _SIGNS[32]) if text.isascii() else text.encode().decode("latin-1").translate(_SIGNS)
            ids = [t.id for t in self.model.tokenize(signs)]
        else:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return array("I", ids).tobytes()

    def turn(self) -> None:
        if len(self) > CACHE:
            self.old = dict(self)
            self.clear()


def _load(path: str) -> _Words:
    """The words of a worker."""
    if path not in _LOADED:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        _LOADED[path] = _Words(Tokenizer.from_file(path))
    return _LOADED[path]


def _regular(cut: str) -> bool:
    """Whether no white space stood next to white space in a text whose line feeds got a blank in front."""
    if "  " in cut or "\n " in cut:
        return False
    return cut.replace("\n", "").isprintable() or not _DOUBLE.search(cut.replace(" \n", "\n"))


def encode_texts(path: str, texts: list[str], end: bytes) -> list[bytes]:
    """The ids of each text as little-endian 32-bit integers, then ``end``."""
    words, out = _load(path), []
    words.turn()
    for text in texts:
        cut = text.replace("\n", " \n")
        if _regular(cut):
            out.append(b"".join(map(words.__getitem__, ("\r" + cut).split(" "))) + end)
        else:
            out.append(np.array(words.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes() + end)
    return out


def encode(docs: DataFrame, tokenizer_path: str, end_id: int | None = None, id_col: str = "doc_id",
           text_col: str = "text", batch: int = 256) -> DataFrame:
    """``(doc_id, ids)`` of every row of ``docs``."""
    end = b"" if end_id is None else np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for at in range(0, len(rows), batch):
                part = rows.slice(at, batch)
                data = encode_texts(tokenizer_path, [t or "" for t in part.column(1).to_pylist()], end)
                sizes = np.cumsum([0, *[len(d) // 4 for d in data]])
                ids = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(np.frombuffer(b"".join(data), "<i4")))
                yield pa.RecordBatch.from_arrays([part.column(0), ids], ["doc_id", "ids"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, "doc_id long, ids array<int>")


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int | None = None, id_col: str = "doc_id",
                 text_col: str = "text", files: int | None = None) -> None:
    """Encode ``docs`` and write files of ascending id ranges, ascending inside, to the folder ``path``."""
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    if files is None:
        files = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-texts.count() // ROWS_PER_FILE))
    ranged = texts.repartitionByRange(files, "doc_id").sortWithinPartitions("doc_id")
    (encode(ranged, tokenizer_path, end_id, "doc_id", "text").write.mode("overwrite")
     .option("parquet.block.size", ROW_GROUP_BYTES).option("parquet.page.size", PAGE_BYTES)
     .option("parquet.enable.dictionary", "true").option("parquet.enable.dictionary#doc_id", "false")
     .option("parquet.writer.version", "v2").option("compression", "lz4_raw").parquet(path))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("doc_id long, ids array<int>").parquet(path)


def token_counts(tokens: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of a token table: where each document starts in the whole run of ids."""
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            ids = rows.column(1)
            at = ids.offsets.to_numpy()
            data = memoryview(ids.values.to_numpy(zero_copy_only=False).astype("<u4").tobytes())
            crc = [zlib.crc32(data[4 * a:4 * b]) for a, b in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(np.diff(at), pa.int64()), pa.array(crc, pa.int64())],
                                             ["doc_id", "n_tokens", "ids_crc32"])

    counts = stage(tokens.mapInArrow(digest, "doc_id long, n_tokens long, ids_crc32 long"))
    summed = running_totals(counts, [], [F.col("doc_id").asc_nulls_first(), F.col("ids_crc32"), F.col("n_tokens")],
                            {"_to": F.col("n_tokens")})
    return summed.select("doc_id", (F.col("_to") - F.col("n_tokens")).alias("start"), "n_tokens", "ids_crc32")


@query()
def op4_token_ids(spark: SparkSession, folder: str) -> DataFrame:
    import uuid

    import public_tokenizers

    from ..sources.staging import shared_folder

    path = f"{shared_folder(spark).rstrip('/')}/strophe/tokens-{uuid.uuid4().hex}"
    write_tokens(table(spark, folder, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return token_counts(read_tokens(spark, path))
