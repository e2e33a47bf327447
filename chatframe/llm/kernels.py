"""Numpy helpers over Arrow text buffers, shared by the operators.

Rolling hashes are sums of ``T[byte] * P**i`` modulo 2**64 with an odd ``P``,
so the hash of any span is a difference of two prefix sums times an inverse
power.  They only choose candidates and group keys; where equality decides a
result, operators compare the bytes or a second independent hash.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
_M = (1 << 64) - 1
_P = 0x9E3779B97F4A7C15 | 1
_P_INV = pow(_P, -1, 1 << 64)
RUN_BASE = np.uint64(_P)


_HELD: dict = {}


def _give_back() -> None:
    """Return freed memory to the system, where the C library can (glibc)."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def held(name, make: Callable | None = None):
    """The one large object that a Python process keeps between tasks.

    Spark reuses its Python workers for whatever comes next.  An operator that
    starts in one asks for its own object by name (or for none), and what
    another operator kept there is given up first."""
    if name not in _HELD:
        if _HELD:
            _HELD.clear()
            gc.collect()
        pa.default_memory_pool().release_unused()
        _give_back()
        _HELD[name] = make() if make else None
    return _HELD[name]


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser (splitmix64) that spreads sums over all 64 bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_VALUES = mix64((np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)))


@lru_cache(maxsize=4)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0] = 1
    out[1:] = base
    return np.multiply.accumulate(out)


def powers(n: int) -> np.ndarray:
    return _powers(_P, 1 << max(12, (n - 1).bit_length()))[:n]


def inverse_powers(n: int) -> np.ndarray:
    return _powers(_P_INV, 1 << max(12, (n - 1).bit_length()))[:n]


def prefix_hash(buf: np.ndarray, values: np.ndarray = BYTE_VALUES) -> np.ndarray:
    """``H`` with ``H[i]`` the hash sum of ``buf[:i]`` (uint8 or pre-hashed uint64)."""
    v = values[buf] if buf.dtype == np.uint8 else buf
    h = np.empty(len(v) + 1, np.uint64)
    h[0] = 0
    np.cumsum(v * powers(len(v)) if len(v) else v, out=h[1:])
    return h


def span_hash(h: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Position-independent hashes of the spans ``[start, end)``."""
    inv = inverse_powers(len(h))
    return mix64((h[end] - h[start]) * inv[start] + (end - start).astype(np.uint64))


def text_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Data bytes and offsets of a binary or string column (nulls are empty)."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null(b"" if pa.types.is_binary(col.type) else "")
    _, offs, data = col.buffers()
    off = np.frombuffer(offs, np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return buf, off


def row_slices(off: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose bytes stay near ``limit`` (a longer text is alone)."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


#: lower-cases A-Z
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: word bytes of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing
WORD_BYTE = np.zeros(256, bool)
WORD_BYTE[48:58] = WORD_BYTE[97:123] = WORD_BYTE[128:] = True


def words_of(low: np.ndarray, bounds: np.ndarray | None = None, limit: int = SLICE_BYTES,
             ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and hash of every word of a lower-cased buffer.

    ``bounds`` are positions where a new text begins: words never cross them.
    The buffer is walked in pieces of ``limit`` bytes that are cut after
    non-word bytes, so only the word arrays grow with its length.
    """
    n = len(low)
    brk = np.zeros(n + 1, bool)
    brk[[0, n]] = True
    if bounds is not None:
        brk[bounds] = True
    parts, at = [], 0
    while at < n:
        end = min(n, at + limit)
        while end < n:
            gaps = np.flatnonzero(~WORD_BYTE[low[max(at, end - 4096):end]])
            if len(gaps):
                end = max(at, end - 4096) + int(gaps[-1]) + 1
                break
            end = min(n, end + 4096)
        piece = low[at:end]
        w = WORD_BYTE[piece]
        first, last = w & brk[at:end], w & brk[at + 1:end + 1]
        first[1:] |= w[1:] & ~w[:-1]
        last[:-1] |= w[:-1] & ~w[1:]
        if len(w):
            first[0], last[-1] = w[0], w[-1]
        s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
        parts.append((s + at, e + at, span_hash(prefix_hash(piece), s, e)))
        at = end
    if not parts:
        z = np.empty(0, np.int64)
        return z, z, np.empty(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def group_hash(word_hash: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` consecutive words (empty if there are fewer)."""
    m = len(word_hash) - n + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(m, np.uint64)
    for k in range(n):  # n is small; no power tables as long as the text
        out = out * RUN_BASE + word_hash[k:k + m]
    return mix64(out + np.uint64(n))


class BitSet:
    """A set of 64-bit hashes folded into ``2**bits`` bits: no misses, some
    false hits.  Its size is fixed, whatever number of hashes it holds."""

    def __init__(self, bits: int, words: np.ndarray | None = None):
        self.bits = bits
        self.words = np.zeros(1 << max(0, bits - 6), np.uint64) if words is None else words

    def _at(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        slot = h >> np.uint64(64 - self.bits)
        return (slot >> np.uint64(6)).astype(np.int64), np.uint64(1) << (slot & np.uint64(63))

    def add(self, h: np.ndarray) -> None:
        w, b = self._at(h)
        np.bitwise_or.at(self.words, w, b)

    def __contains__(self, h: int) -> bool:
        return bool(self.has(np.array([h], np.uint64))[0])

    def has(self, h: np.ndarray) -> np.ndarray:
        w, b = self._at(h)
        return (self.words[w] & b) != 0
