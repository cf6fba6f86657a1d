"""Vectorised word splitting and hashing of whole Arrow text columns.

Both word classes of the operators are decidable byte by byte in UTF-8 (every
byte of a non-ASCII character is a word byte), so a column is handled as one
byte array. Words get 64-bit hashes that depend on nothing but their bytes;
null texts have no words. Work is done in pieces of a few hundred KB, so
memory follows the longest single text, not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 20
_SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
_MUL = np.uint64(0x9E3779B97F4A7C15)
_C1, _C2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_S30, _S27, _S31 = np.uint64(30), np.uint64(27), np.uint64(31)


def mix(x: np.ndarray) -> np.ndarray:
    """Avalanche a uint64 array (splitmix finaliser)."""
    x = (x ^ (x >> _S30)) * _C1
    x = (x ^ (x >> _S27)) * _C2
    return x ^ (x >> _S31)


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _MUL)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Byte classes: "space" = [^\x20\x09-\x0D], "alnum" = digits, letters and everything above 0x7F, "phrase" = "space"
#: without the marks that end a piece of text.
CLASSES = {"space": np.ones(256, bool), "alnum": np.zeros(256, bool)}
CLASSES["space"][list(_SPACES)] = False
CLASSES["phrase"] = CLASSES["space"].copy()
CLASSES["phrase"][list(b".,;:!?")] = False
CLASSES["alnum"][48:58] = CLASSES["alnum"][97:123] = CLASSES["alnum"][65:91] = CLASSES["alnum"][128:] = True
_weights = np.cumprod(np.full(64, _MUL, np.uint64))


def _weight(n: int) -> np.ndarray:
    global _weights
    if n > len(_weights):
        _weights = np.cumprod(np.full(max(n, 2 * len(_weights)), _MUL, np.uint64))
    return _weights


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; nulls are empty."""
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64 if large else np.int32)[column.offset:column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def pieces(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of rows of about PIECE_BYTES; a longer text is a run of its own."""
    n, at = len(offsets) - 1, 0
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + PIECE_BYTES, "right")) - 1
        to = min(n, max(to, at + 1))
        yield at, to
        at = to


def spans(raw: np.ndarray, offsets: np.ndarray, kind: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first) of the words of a run: byte spans, and for each
    row the index of its first word (one more entry than rows)."""
    inside = CLASSES[kind][raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[offsets] = True
    before = np.empty(len(raw), bool)
    if len(raw):
        before[0] = False
        before[1:] = inside[:-1]
        before &= ~edge[:-1]
    starts = np.flatnonzero(inside & ~before)
    after = np.empty(len(raw), bool)
    if len(raw):
        after[-1] = False
        after[:-1] = inside[1:]
        after &= ~edge[1:]
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """64-bit hash of every word, A-Z lowered if asked."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lens = ends - starts
    total = int(lens.sum())
    begin = np.cumsum(lens) - lens
    at = np.arange(total) - np.repeat(begin, lens)
    w = _weight(int(lens.max()))
    b = raw[np.repeat(starts, lens) + at]
    h = np.add.reduceat(_BYTE[_LOWER[b] if lower else b] * w[at], begin)
    return mix(h + lens.astype(np.uint64))


def word_runs(column: pa.Array, kind: str, lower: bool = True) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, word hashes, word index of each row) by runs."""
    raw, offsets = text_bytes(column)
    for a, b in pieces(offsets):
        off = offsets[a:b + 1] - offsets[a]
        part = raw[offsets[a]:offsets[b]]
        starts, ends, first = spans(part, off, kind)
        yield a, b, hashes(part, starts, ends, lower), first


def row_words(column: pa.Array, kind: str, lower: bool = True) -> Iterator[np.ndarray]:
    """The word hashes of each row in turn."""
    for a, b, h, first in word_runs(column, kind, lower):
        for i in range(b - a):
            yield h[first[i]:first[i + 1]]


_SHIFTS = mix(np.arange(1, 33, dtype=np.uint64) * _C1) | np.uint64(1)


def shingles(h: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all windows of ``size`` words (in order, repeats kept); a
    shorter non-empty sequence is one window."""
    if len(h) < size:
        size = len(h)
        if not size:
            return h
    out = np.zeros(len(h) - size + 1, np.uint64)
    for k in range(size):
        out += h[k:len(h) - size + 1 + k] * _SHIFTS[k]
    return mix(out + np.uint64(size))


def hash_words(words: list[str]) -> np.ndarray:
    """Hashes of single words given as strings (they must be in lower case)."""
    raw, off = text_bytes(pa.array(words, pa.string()))
    keep = off[1:] > off[:-1]
    out = np.zeros(len(words), np.uint64)
    out[keep] = hashes(raw, off[:-1][keep], off[1:][keep])
    return out
