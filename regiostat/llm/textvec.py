"""Vectorised word hashing: whole Arrow text columns to 64-bit word hashes.

A text column is handled as its UTF-8 byte buffer.  A word is a maximal run
of word bytes; its hash is the polynomial ``sum T[byte] * B^offset`` modulo
2^64, read off a running sum, then mixed.  Equal words always get equal
hashes; two different words of one corpus share a hash with a probability
of about 2^-64 per pair, so results on hashes are taken as results on words.
No Python code runs per word or per byte.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(30)
        x *= _M1
        x ^= x >> np.uint64(27)
        x *= _M2
        x ^= x >> np.uint64(31)
    return x


def _inverse(odd: int) -> int:
    return pow(odd, -1, 1 << 64)


_BASE = 0x9E3779B97F4A7C15
_TABLE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``B^i`` and ``B^-i`` for ``i < n`` (kept for the next block)."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, 1 << 16)
        out = []
        for base in (_BASE, _inverse(_BASE)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            with np.errstate(over="ignore"):
                out.append(np.cumprod(steps, dtype=np.uint64))
        _POWERS[:] = out
    return _POWERS[0], _POWERS[1]


def lower_table() -> np.ndarray:
    """Byte table that lower-cases A-Z only."""
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


LOWER = lower_table()
SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes of ``[^\x20\x09-\x0D]``.
NOT_SPACE = ~SPACES
#: Bytes of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]`` (digits, a-z, all beyond ASCII).
ALNUM = np.zeros(256, dtype=bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def text_blocks(column: pa.Array | pa.ChunkedArray, block_bytes: int = 1 << 20) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Cut a string column into runs of rows of about ``block_bytes`` bytes
    (one row at least): ``(first row, bytes, row offsets)``.  Null is empty.
    Keeps the working memory of the callers bounded by a block (or by the
    longest single text)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = column.chunk(0) if column.num_chunks else pa.array([], pa.string())
    n = len(column)
    if column.null_count:
        column = column.fill_null("")
    if not n:
        return
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64 if wide else np.int32)[column.offset:column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + block_bytes, side="right")) - 1
        end = min(max(end, row + 1), n)
        yield row, data[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row]
        row = end


class Words:
    """Words of a block of texts, in order.

    ``hashes`` (uint64), ``starts``/``ends`` (byte offsets in the block),
    ``doc`` offsets (``first[i]:first[i+1]`` are the words of text ``i``)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, word: np.ndarray = NOT_SPACE, lower: bool = True):
        raw = LOWER[data] if lower else data
        n = len(raw)
        inside = word[raw]
        # a word never spans two texts: a text's first byte always starts anew
        first_byte = np.zeros(n + 1, dtype=bool)
        first_byte[offsets] = True
        before = np.empty(n, dtype=bool)
        after = np.empty(n, dtype=bool)
        if n:
            before[0], after[-1] = False, False
            before[1:], after[:-1] = inside[:-1], inside[1:]
        self.starts = np.flatnonzero(inside & (~before | first_byte[:n]))
        self.ends = np.flatnonzero(inside & (~after | first_byte[1:])) + 1
        powers, inverse = _powers(n + 1)
        with np.errstate(over="ignore"):
            run = np.zeros(n + 1, dtype=np.uint64)
            np.cumsum(_TABLE[raw] * powers[:n], out=run[1:])
            self.hashes = mix64((run[self.ends] - run[self.starts]) * inverse[self.starts])
        self.first = np.searchsorted(self.starts, offsets)
        self.raw = raw

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def spans_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of any byte spans of a block (content only)."""
    n = len(data)
    powers, inverse = _powers(n + 1)
    with np.errstate(over="ignore"):
        run = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_TABLE[data] * powers[:n], out=run[1:])
        return mix64((run[ends] - run[starts]) * inverse[starts])


def windows(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every ``k`` consecutive hashes (order matters)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros((n, *hashes.shape[1:]), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(k):
            out *= np.uint64(0x9E3779B97F4A7C15)
            out += hashes[i:i + n]
    return mix64(out ^ np.uint64(k))


def doc_windows(w: Words, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All ``k``-word windows that lie inside one text: ``(hashes, index of
    the first word, text number)``."""
    h = windows(w.hashes, k)
    doc = np.repeat(np.arange(len(w.first) - 1), w.counts)
    if not len(h):
        return h, np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.flatnonzero(doc[:len(h)] == doc[k - 1:k - 1 + len(h)])
    return h[at], at, doc[at]


def sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of ``values[first[i]:first[i+1]]`` for each i."""
    run = np.concatenate([np.zeros(1, dtype=values.dtype if values.dtype.kind == "f" else np.int64), np.cumsum(values)])
    return run[first[1:]] - run[first[:-1]]
