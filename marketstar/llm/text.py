"""Vectorised words and hashes over Arrow string columns (used inside tasks).

Everything works on the UTF-8 bytes of a chunk of whole documents, so no
Python object is made per word.  A chunk holds whole documents up to about
``CHUNK_BYTES``; one longer document makes a chunk of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 4 << 20
_POWERS = 1 << 16
U64 = np.uint64


def mix64(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser (public domain constants)."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def _table(n: int, seed: int) -> np.ndarray:
    return mix64((np.arange(1, n + 1, dtype=U64) + U64(seed)) * U64(0x9E3779B97F4A7C15))


_BYTE = _table(256, 11)
_POWER = _table(_POWERS, 23) | U64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


@dataclass
class Chunk:
    """Whole documents ``first`` .. ``first + n`` of a batch: bytes and each one's offsets (n + 1)."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def n(self) -> int:
        return len(self.offsets) - 1


@dataclass
class Words:
    """Byte ranges of all words of a chunk; ``doc_at`` (n + 1) delimits each document's words."""

    start: np.ndarray
    end: np.ndarray
    doc_at: np.ndarray

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.doc_at) - 1), np.diff(self.doc_at))


def string_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, int64 offsets) of a string or binary array; nulls are empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("" if not pa.types.is_binary(col.type) else b"")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    if len(col) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(col: pa.Array, size: int = CHUNK_BYTES) -> Iterator[Chunk]:
    data, offsets = string_buffers(col)
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1)
        yield Chunk(i, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
        i = j


def words(c: Chunk) -> Words:
    w = ~_SPACE[c.data]
    n = len(w)
    start, end = w.copy(), w.copy()
    if n:
        start[1:] &= ~w[:-1]
        end[:-1] &= ~w[1:]
        inner = c.offsets[(c.offsets > 0) & (c.offsets < n)]
        start[inner] = w[inner]
        end[inner - 1] = w[inner - 1]
    s, e = np.flatnonzero(start), np.flatnonzero(end) + 1
    return Words(s, e, np.searchsorted(s, c.offsets))


def word_hashes(data: np.ndarray, w: Words) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    if not len(w.start):
        return np.empty(0, U64)
    length = w.end - w.start
    at = np.cumsum(length) - length
    within = np.arange(int(length.sum())) - np.repeat(at, length)
    vals = _BYTE[data[within + np.repeat(w.start, length)]]
    within &= _POWERS - 1
    vals *= _POWER[within]
    return mix64(np.add.reduceat(vals, at) + length.astype(U64))


def run_hashes(h: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """Hash of each ``k`` consecutive entries (over the whole chunk; callers mask runs that cross documents)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, U64)
    mult = _table(k, 101 + seed) | U64(1)
    out = h[:n] * mult[0]
    for j in range(1, k):
        out += h[j : j + n] * mult[j]
    return mix64(out)


def rows_at(doc_at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, word index) of every start of ``k`` consecutive words within one document."""
    count = np.maximum(np.diff(doc_at) - k + 1, 0)
    doc = np.repeat(np.arange(len(count)), count)
    at = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count) + doc_at[:-1][doc]
    return doc, at
