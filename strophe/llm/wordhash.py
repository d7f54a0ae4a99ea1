"""64-bit hashes of words and of word shingles, computed for a block of texts at once in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

BLOCK = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)
_VALUE[65:91] = _VALUE[97:123]  # A-Z count as a-z


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


_UP, _DOWN = powers(_BASE, 1), powers(_BACK, 1)


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each word in UTF-8 bytes that end in white space; A-Z hashed as a-z."""
    global _UP, _DOWN
    if len(_UP) < len(data):
        _UP, _DOWN = powers(_BASE, len(data)), powers(_BACK, len(data))
    inside = ~_SPACE[data]
    edge = np.flatnonzero(np.diff(inside, prepend=False))
    start, end = edge[0::2], edge[1::2]
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUE[data] * _UP[:len(data)], out=total[1:])
    return start, mix((total[end] - total[start]) * _DOWN[start] + (end - start).astype(np.uint64))


def word_rows(texts: list[str | None]) -> Iterator[np.ndarray]:
    """The word hashes of each text, in order."""
    at = 0
    while at < len(texts):
        block, size = [], 0
        while at < len(texts) and (not block or size < BLOCK):
            block.append((texts[at] or "").encode("utf-8", "replace"))
            size += len(block[-1]) + 1
            at += 1
        data = np.frombuffer(b" ".join(block) + b" ", np.uint8)
        start, words = word_hashes(data)
        last = np.searchsorted(start, np.cumsum([len(b) + 1 for b in block]))
        yield from np.split(words, last[:-1])


def shingle_set(words: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct hashes of ``width`` words in a row; all words as one shingle if there are fewer."""
    if not len(words):
        return words
    if len(words) < width:
        width, tag = len(words), np.uint64(len(words))
    else:
        tag = np.uint64(0)
    n = len(words) - width + 1
    out = np.full(n, tag, np.uint64)
    for i in range(width):
        out = mix(out * _BASE + words[i:i + n])
    return np.unique(out)
