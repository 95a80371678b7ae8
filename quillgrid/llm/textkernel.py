"""Vectorised word splitting and hashing over Arrow string batches.

A word is a maximal run of bytes that are neither space nor 0x09-0x0D, i.e. ``[^\\x20\\x09-\\x0D]+``
(the same on bytes and on code points, since those separators are ASCII). A word's hash is a
polynomial in a random per-byte table modulo 2**64, taken from one running sum over the buffer, so
no Python object is made per word. Buffers are worked through in pieces that end at separators, so
temporary memory does not depend on the length of a text.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
PIECE = 1 << 20

_rng = np.random.Generator(np.random.PCG64(20240229))
_TABLE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
_LOWER = _TABLE.copy()
_LOWER[65:91] = _TABLE[97:123]
_Q = U64(0x9E3779B97F4A7C17)
_QI = U64(pow(int(_Q), -1, 2**64))
_POWERS: dict[str, np.ndarray] = {}

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: For terms of classifiers: ASCII punctuation and digits separate, too.
NONLETTER = SPACE.copy()
NONLETTER[:128] |= ~np.array([chr(i).isalpha() for i in range(128)])


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _POWERS.get("q")
    if have is None or len(have) < n:
        size = max(n, PIECE + 4096)
        for name, base in (("q", _Q), ("qi", _QI)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _POWERS[name] = np.multiply.accumulate(p)
    return _POWERS["q"], _POWERS["qi"]


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (n+1, from 0) of a string array; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if not (pa.types.is_string(col.type) or pa.types.is_large_string(col.type)):
        col = col.cast(pa.string())
    if col.null_count:
        col = col.fill_null("")
    kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
    _, offs, data = col.buffers()
    if len(col) == 0 or offs is None:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    o = np.frombuffer(offs, kind)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    b = np.frombuffer(data, np.uint8)[o[0] : o[-1]] if data is not None else np.zeros(0, np.uint8)
    return b, o - o[0]


def _cuts(b: np.ndarray, o: np.ndarray, sep: np.ndarray) -> Iterator[tuple[int, int]]:
    """Pieces of about PIECE bytes that end at the end of a text or behind a separator."""
    at, n = 0, len(b)
    while at < n:
        end = min(n, at + PIECE)
        if end < n:
            k = int(np.searchsorted(o, end, "right")) - 1
            if o[k] > at:
                end = int(o[k])
            else:
                limit = int(o[k + 1])
                back = np.flatnonzero(sep[b[at:end]])
                if len(back):
                    end = at + int(back[-1]) + 1
                else:
                    while end < limit and not sep[b[end]]:
                        end += 1
        yield at, end
        at = end


def words(b: np.ndarray, o: np.ndarray, lower: bool = False, sep: np.ndarray = SPACE, prefixes: tuple[int, ...] = ()) -> dict[str, np.ndarray]:
    """h: hash of each word in order; n: number of words of each text; start, end: byte positions;
    p: one row for each of ``prefixes``, the hash of the word's first so many bytes, 0 for words that are not longer."""
    hs, ss, es, ps = [], [], [], []
    table = _LOWER if lower else _TABLE
    edge = np.unique(o)
    for at, end in _cuts(b, o, sep):
        x = b[at:end]
        q, qi = _powers(len(x) + 1)
        inside = ~sep[x]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        own = edge[np.searchsorted(edge, at, "left") : np.searchsorted(edge, end, "left")] - at
        own = own[own < len(x)]
        first[own] = inside[own]
        own = own[own > 0]
        last[own - 1] = inside[own - 1]
        s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
        run = np.zeros(len(x) + 1, np.uint64)
        np.cumsum(table[x] * q[: len(x)], out=run[1:])
        back = qi[s]
        hs.append(mix((run[e] - run[s]) * back + (e - s).astype(np.uint64)))
        if prefixes:
            ps.append(np.stack([np.where(e - s > p, mix((run[np.minimum(s + p, e)] - run[s]) * back + U64(p)), U64(0)) for p in prefixes]))
        ss.append(s + at)
        es.append(e + at)
    cat = lambda xs, kind: np.concatenate(xs) if xs else np.zeros(0, kind)
    start = cat(ss, np.int64)
    cum = np.searchsorted(start, o, "left")
    return {"h": cat(hs, np.uint64), "n": np.diff(cum), "start": start, "end": cat(es, np.int64), "p": np.concatenate(ps, axis=1) if ps else np.zeros((len(prefixes), 0), np.uint64)}


def bounds(n: np.ndarray) -> np.ndarray:
    out = np.zeros(len(n) + 1, np.int64)
    np.cumsum(n, out=out[1:])
    return out


_GRAM = _rng.integers(1, 2**63, 16, dtype=np.uint64) * U64(2) + U64(1)


def shingles(h: np.ndarray, n: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of k words (of all words, where a text has 1 to k-1) and their number in each text."""
    w = bounds(n)
    count = np.where(n >= k, n - k + 1, (n > 0).astype(np.int64))
    if not len(h):
        return np.zeros(0, np.uint64), count
    pad = np.concatenate([h, np.zeros(k, np.uint64)])
    g = np.zeros(len(h), np.uint64)
    for j in range(k):
        g += pad[j : j + len(h)] * _GRAM[j]
    out_at = bounds(count)
    doc = np.repeat(np.arange(len(n)), count)
    at = w[:-1][doc] + (np.arange(out_at[-1]) - out_at[:-1][doc])
    out = g[at]
    short = np.flatnonzero((n > 0) & (n < k))
    for d in short:
        x = h[w[d] : w[d + 1]]
        with np.errstate(over="ignore"):
            out[out_at[d]] = np.sum(x * _GRAM[: len(x)]) + U64(len(x)) * U64(0xD6E8FEB86659FD93)
    return mix(out), count


def release() -> None:
    """Give freed memory back to the system: Python workers live on for later stages, and would hold their peak."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def releasing(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``work`` for mapInArrow, with memory given back at the end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for out in work(batches):
                yield out
                del out
        finally:
            release()

    return run
