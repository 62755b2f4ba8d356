"""Word shingles of whole texts as 64-bit ids, in numpy over Arrow buffers.

Texts are cut into pieces of a few MB, so the memory of a task does not grow
with its batch. A word is a run of bytes other than space, tab, LF, VT, FF and
CR, with A-Z lower-cased; its hash is a polynomial over its bytes. A shingle is
``k`` words in a row; a text with fewer words is one shingle; one without words
has none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 2 << 20
U = np.uint64

_rng = np.random.default_rng(20240229)
_VALUE = _rng.integers(1, 2 ** 63, 256, dtype=np.uint64) * U(2) + U(1)
_VALUE[65:91] = _VALUE[97:123]  # A-Z as a-z
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BASE = U(0x9E3779B97F4A7C15 | 1)
_BACK = U(pow(int(_BASE), -1, 2 ** 64))


def powers(n: int, base: np.uint64) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every bit (public splitmix64 finaliser)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def pieces(texts: pa.Array, size: int = PIECE) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, row offsets into them) for runs of rows of about
    ``size`` bytes, or one longer row; null texts are empty."""
    texts = texts.cast(pa.large_binary()).fill_null(b"") if texts.null_count else texts.cast(pa.large_binary())
    off = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(off, off[at] + size, side="right")) - 1)
        yield at, data[off[at]:off[end]], off[at:end + 1] - off[at]
        at = end


def word_hashes(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes in order, and for each row the number of words before it
    (one more entry at the end)."""
    word = ~_SPACE[data]
    start = word.copy()
    start[1:] &= ~word[:-1]
    inner = off[1:-1][off[1:-1] < len(data)]
    start[inner] = word[inner]
    stop = word.copy()
    stop[:-1] &= ~word[1:]
    ends = inner[inner > 0] - 1
    stop[ends] = word[ends]
    s, e = np.flatnonzero(start), np.flatnonzero(stop) + 1
    power = powers(len(data) + 1, _BASE)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUE[data] * power[:-1], out=total[1:])
    h = (total[e] - total[s]) * powers(len(data) + 1, _BACK)[s]
    return mix(h + (e - s).astype(np.uint64)), np.searchsorted(s, off)


def shingle_hashes(words: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, index of the first word, row) of every shingle, rows in order."""
    n = np.diff(first)
    count = np.where(n >= k, n - k + 1, (n > 0).astype(n.dtype))
    row = np.repeat(np.arange(len(n)), count)
    at = first[:-1][row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    left = first[1:][row] - at
    h = np.zeros(len(row), np.uint64)
    for j, c in enumerate(mix(np.arange(1, k + 1, dtype=np.uint64)) | U(1)):
        have = left > j
        h[have] += words[at[have] + j] * c
    return mix(h), at, row
