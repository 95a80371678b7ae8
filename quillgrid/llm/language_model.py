"""Interpolated modified Kneser-Ney n-gram model, counted in Spark, read from memory-mapped sorted hash arrays.

Words are numbered first: what travels between tasks afterwards are numbers, not hashes. An n-gram of order three is (u, v, w), one of order
two (v, w); v is the centre. All that is known of a centre lies in one shard, unless the centre is frequent: then its n-grams are spread by
u, those of a frequent pair (u, v) by w, too, and their pairs are put together by a second deal.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkernel as K
from .shared import mapped, put, shared_dir, written
from .toxicity import held_out

U64 = np.uint64
END, BEGIN = U64(0x00000000000000E5), U64(0x00000000000000B6)
#: The longest n-grams; n-grams are counted in runs of about so many tokens before they leave a task; tokens to a shard.
ORDER, RUN, SHARD = 3, 3_000_000, 4_000_000
#: More different words are never numbered at once: three numbers of them fit into 64 bits.
MOST = 1 << 21
#: A word, or a bucket of pairs, is frequent if it has so large a share of a shard's tokens; buckets of pairs.
SHARE, HEAVY = 0.5, 1 << 16
#: The number of BEGIN; words of the corpus have numbers from 1 on, others have none.
FIRST, UNKNOWN = 0, -1
_MUL = U64(0x9E3779B97F4A7C15)
#: What a second deal carries: of words, of pairs of frequent centres, of frequent contexts.
WORDS, PAIRS, CONTEXTS = 0, 1, 2


def tokens(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens (words in lower case, then one end, of each text) and their number in each text."""
    b, o = K.buffers(col)
    w = K.words(b, o, lower=True)
    n = w["n"] + 1
    at = K.bounds(n)
    out = np.empty(at[-1], np.uint64)
    last = np.zeros(len(out), bool)
    last[at[1:] - 1] = True
    out[last] = END
    out[~last] = w["h"]
    return out, n


def before(t: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The token before each one; a text begins with BEGIN."""
    c = np.empty_like(t)
    c[1:] = t[:-1]
    c[K.bounds(n)[:-1]] = BEGIN
    return c


def pair(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    return K.mix(v * _MUL + w)


def _bucket(uv: np.ndarray) -> np.ndarray:
    return (uv & U64(HEAVY - 1)).astype(np.int64)


def _spread(key: np.ndarray, parts: int) -> np.ndarray:
    return (K.mix(key) % U64(parts)).astype(np.int64)


def _in(x: np.ndarray, some: np.ndarray) -> np.ndarray:
    """Which of x are among the sorted ``some``."""
    if not len(some):
        return np.zeros(len(x), bool)
    return some[np.minimum(np.searchsorted(some, x), len(some) - 1)] == x


class Deal:
    """Where n-grams lie. ``words``: numbers of frequent words; ``pairs``: which buckets of pairs of word hashes are frequent."""

    def __init__(self, shards: int, words: np.ndarray, pairs: np.ndarray, order: int):
        self.shards, self.words, self.pairs, self.order = shards, words, pairs, order

    def frequent(self, v: np.ndarray) -> np.ndarray:
        return _in(v, self.words)

    def of(self, u: np.ndarray, v: np.ndarray, w: np.ndarray, hot: np.ndarray, hot_pair: np.ndarray) -> np.ndarray:
        u, v, w = (x.astype(np.uint64) for x in (u, v, w))
        key = v
        if hot.any():
            if self.order == 2:
                key = np.where(hot, v ^ K.mix(w ^ U64(0x51ED27)), key)
            else:
                key = np.where(hot, v ^ K.mix(u ^ U64(0x2545F49)), key)
                key = np.where(hot & hot_pair, key ^ K.mix(w ^ U64(0x51ED27)), key)
        return _spread(key, self.shards)


def _home(number: np.ndarray, base: np.ndarray) -> np.ndarray:
    """The shard in which a word's numbers lie; FIRST has a place before the first words."""
    return np.maximum(np.searchsorted(base, number, "right") - 1, 0)


class Vocabulary:
    """Numbers of words: a shard's words follow those of the shards before it, in the order of their hashes. ``base``: the first number of each shard, and the one behind the last."""

    def __init__(self, folder: str, base: np.ndarray):
        self.folder, self.base = folder, base

    def numbers(self, h: np.ndarray) -> np.ndarray:
        """``h``: sorted hashes."""
        out = np.full(len(h), UNKNOWN, np.int64)
        s = _spread(h, len(self.base) - 1)
        order = np.argsort(s, kind="stable")
        for own in np.split(order, _starts(s[order])[1:]) if len(h) else ():
            i = int(s[own[0]])
            cols = _file(f"{self.folder}/vocabulary-{i:07d}")
            if cols:
                at = np.minimum(np.searchsorted(cols[0], h[own]), len(cols[0]) - 1)
                out[own] = np.where(cols[0][at] == h[own], self.base[i] + at, UNKNOWN)
        out[h == BEGIN] = FIRST
        return out


def _small(c: np.ndarray) -> type:
    if c.dtype == np.uint64:
        return np.uint64
    top = int(c.max()) if len(c) else 0
    return np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else np.int64


def _zip(*cols: np.ndarray) -> bytes:
    """Columns one after the other, each as (item size, length, bytes); small counts take one byte, hashes eight."""
    out = []
    for c in cols:
        c = c.astype(_small(c), copy=False)
        out += [np.array([c.itemsize if c.dtype != np.uint64 else 9, len(c)], np.int64).tobytes(), c.tobytes()]
        out.append(b"\0" * (-len(out[-1]) % 8))
    return b"".join(out)


def _unzip(data) -> list[np.ndarray]:
    raw = np.frombuffer(data, np.uint8) if not isinstance(data, np.ndarray) else data
    out, at = [], 0
    while at < len(raw):
        kind, n = (int(x) for x in raw[at : at + 16].view(np.int64))
        dt = {1: np.uint8, 2: np.uint16, 4: np.uint32, 8: np.int64, 9: np.uint64}[kind]
        size = n * np.dtype(dt).itemsize
        out.append(raw[at + 16 : at + 16 + size].view(dt))
        at += 16 + size + (-size % 8)
    return out


def _pack(*cols: np.ndarray) -> bytes:
    """_zip for the way between tasks, compressed."""
    raw = _zip(*cols)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpack(data: bytes) -> list[np.ndarray]:
    return _unzip(np.frombuffer(pa.decompress(memoryview(data)[8:], int.from_bytes(data[:8], "little"), "zstd"), np.uint8))


def _starts(*sorted_keys: np.ndarray) -> np.ndarray:
    """Places where a new key begins."""
    new = np.ones(len(sorted_keys[0]), bool)
    for i, k in enumerate(sorted_keys):
        if i == 0:
            new[1:] = k[1:] != k[:-1]
        else:
            new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def _sum_by(key: np.ndarray, *cols: np.ndarray) -> tuple[np.ndarray, ...]:
    order = np.argsort(key, kind="stable")
    key = key[order]
    at = _starts(key)
    return key[at], *(np.add.reduceat(c[order].astype(np.int64), at) if len(at) else np.zeros(0, np.int64) for c in cols)


def _kinds(at: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, ...]:
    """For groups that begin at ``at``: sum of c, and how many of c are 1, 2, 3 or more."""
    add = lambda x: np.add.reduceat(x.astype(np.int64), at) if len(at) else np.zeros(0, np.int64)
    return add(c), add(c == 1), add(c == 2), add(c >= 3)


START = pair(np.array([FIRST], np.uint64), np.array([FIRST], np.uint64))[0]


def _slim(*cols: np.ndarray) -> list[np.ndarray]:
    """Columns in the smallest type that holds them, as _zip writes them."""
    return [c.astype(_small(c)) for c in cols]


# Sorted arrays. Of a hash, 40 bits are kept besides the number of the shard; a value above 254 lies in arrays of its own.


def _keys(g: np.ndarray) -> list[np.ndarray]:
    return [(g >> U64(32)).astype(np.int64), ((g >> U64(24)) & U64(255)).astype(np.int64)]


def _counts(c: np.ndarray) -> list[np.ndarray]:
    over = np.flatnonzero(c >= 255)
    return [np.minimum(c, 255), over, c[over]]


def _contexts(g: np.ndarray, c: np.ndarray, n1: np.ndarray, n2: np.ndarray, n3: np.ndarray) -> list[np.ndarray]:
    """Keys and values of contexts. One that stands once is left out: the pair of its words says that it is there.
    One all of whose n-grams stand once has one number, the others four."""
    often = (c > 1) | (g == START)
    g, c, n1, n2, n3 = (x[often] for x in (g, c, n1, n2, n3))
    plain = (c == n1) & (c < 255)
    rest = np.flatnonzero(~plain)
    return [*_keys(g), np.where(plain, c, 255), rest, c[rest], n1[rest], n2[rest], n3[rest]]


def _find(keys: list[np.ndarray], q: np.ndarray) -> np.ndarray:
    """Place of each hash, or -1. ``q`` sorted is faster."""
    hi, lo = keys
    qh, ql = _keys(q)
    out = np.full(len(q), -1, np.int64)
    if not len(hi):
        return out
    at = np.searchsorted(hi, qh.astype(hi.dtype) if hi.dtype == np.uint32 else qh)
    todo = np.arange(len(q))
    while len(todo):
        k = np.minimum(at[todo], len(hi) - 1)
        same = (at[todo] < len(hi)) & (hi[k] == qh[todo])
        hit = same & (lo[k] == ql[todo])
        out[todo[hit]] = k[hit]
        todo = todo[same & ~hit]
        at[todo] += 1
    return out


def _get_counts(cols: list[np.ndarray], q: np.ndarray) -> np.ndarray:
    at = _find(cols[:2], q)
    c = np.where(at >= 0, cols[2][at], 0).astype(np.int64) if len(cols[2]) else np.zeros(len(q), np.int64)
    big = np.flatnonzero(c == 255)
    if len(big):
        c[big] = cols[4][np.searchsorted(cols[3], at[big])]
    return c


def _get_contexts(cols: list[np.ndarray], q: np.ndarray) -> np.ndarray:
    out = np.zeros((4, len(q)), np.int64)
    at = _find(cols[:2], q)
    if not len(cols[2]):
        return out
    c = np.where(at >= 0, cols[2][at], 0).astype(np.int64)
    out[0] = out[1] = c
    rest = np.flatnonzero(c == 255)
    if len(rest):
        k = np.searchsorted(cols[3], at[rest])
        for i in range(4):
            out[i, rest] = cols[4 + i][k]
    return out


def _runs(batches: Iterator[pa.RecordBatch], flush: Callable[[np.ndarray, np.ndarray], Iterator[pa.RecordBatch]]) -> Iterator[pa.RecordBatch]:
    """Tokens of whole texts, RUN or more at once."""
    ts, ns, size = [], [], 0
    for b in batches:
        for lo in range(0, b.num_rows, 2048):
            t, n = tokens(b.column(0).slice(lo, 2048))
            ts.append(t)
            ns.append(n)
            size += len(t)
            if size >= RUN:
                yield from flush(np.concatenate(ts), np.concatenate(ns))
                ts, ns, size = [], [], 0
    if size:
        yield from flush(np.concatenate(ts), np.concatenate(ns))


def _by_part(s: np.ndarray, parts: int, *cols: np.ndarray) -> Iterator[tuple[int, list[np.ndarray]]]:
    order = np.argsort(s, kind="stable")
    cut = np.searchsorted(s[order], np.arange(parts + 1))
    for i in np.flatnonzero(np.diff(cut)):
        yield int(i), [c[order[cut[i] : cut[i + 1]]] for c in cols]


def _blob(shard: int, data: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([data], pa.binary())], names=["shard", "blob"])


def _count_words(parts: int):
    """Rows (shard, blob): of each run the words with their counts; under shard -1, how many pairs each bucket has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = np.zeros(HEAVY, np.int64)

        def flush(t: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
            v = before(t, n)
            pairs[:] += np.bincount(_bucket(pair(before(v, n), v)), minlength=HEAVY)
            h, c = np.unique(t, return_counts=True)
            for i, cols in _by_part(_spread(h, parts), parts, h, c):
                yield _blob(i, _pack(*cols))

        yield from _runs(batches, flush)
        some = np.flatnonzero(pairs)
        yield _blob(-1, _pack(some, pairs[some]))

    return run


def _merge_vocabulary(folder: str, limit: float):
    """A file for each shard: sorted hashes and counts. Rows (shard, words, tokens, blob): places and counts of words above the limit, or buckets of pairs."""

    def finish(key: tuple, blobs: list[bytes]) -> Iterator[pa.RecordBatch]:
        h, c = _sum_by(*(np.concatenate(x) for x in zip(*(_unpack(b) for b in blobs), strict=True)))
        some = np.flatnonzero(c > limit)
        if key[0] >= 0:
            put(f"{folder}/vocabulary-{key[0]:07d}", _zip(h, c))
        blob = _pack(some, c[some]) if key[0] >= 0 else _pack(h[some], c[some])
        yield pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int32()), pa.array([len(h)], pa.int64()), pa.array([int(c.sum())], pa.int64()), pa.array([blob], pa.binary())], names=["shard", "words", "tokens", "blob"])

    return _by_shard(finish, 1)


def _count(deal: Deal, vocabulary: Vocabulary):
    """Rows (shard, blob): of each run of tokens, the n-grams in numbers, with their counts and whether (u, v) is a frequent pair."""

    def flush(t: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        yield from numbered(t, BEGIN, BEGIN, K.bounds(n)[:-1])

    def numbered(t: np.ndarray, v0: np.uint64, u0: np.uint64, first: np.ndarray) -> Iterator[pa.RecordBatch]:
        """t: a run; v0, u0: the tokens before its first one; first: where texts begin in it."""
        word, at = np.unique(np.concatenate([t, np.array([BEGIN, v0, u0], np.uint64)]), return_inverse=True)
        if len(word) > MOST and len(t) > 2:
            half = len(t) // 2
            yield from numbered(t[:half], v0, u0, first[first < half])
            yield from numbered(t[half:], t[half - 1], t[half - 2], first[first >= half] - half)
            return
        number = vocabulary.numbers(word)
        order = np.argsort(number)  # places in the order of numbers: sorted columns are smaller
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        word, number, at = word[order], number[order], place[at]
        w, (begin, v0, u0) = at[:-3].astype(np.uint64), at[-3:].astype(np.uint64)
        k = U64(len(word))
        v = np.concatenate([[v0], w[:-1]])
        u = np.concatenate([[u0], v[:-1]])
        v[first] = u[first] = begin
        second = first + 1
        u[second[second < len(u)]] = begin
        key = v * k + w
        if deal.order == 3:
            key = key * k + u  # below 2**64
        key.sort()
        at = _starts(key)
        c, key = np.diff(np.append(at, len(key))), key[at]
        u = (key % k).astype(np.int64) if deal.order == 3 else np.zeros(len(key), np.int64)
        if deal.order == 3:
            key //= k
        v, w = (key // k).astype(np.int64), (key % k).astype(np.int64)
        hot = deal.frequent(number)[v]
        hot_pair = np.zeros(len(v), bool)
        hot_pair[hot] = deal.pairs[_bucket(pair(word[u[hot]], word[v[hot]]))]
        u, v, w = number[u], number[v], number[w]
        for i, cols in _by_part(deal.of(u, v, w, hot, hot_pair), deal.shards, v, w, c, u, hot_pair):
            yield _blob(i, _pack(*cols) if deal.order == 3 else _pack(*cols[:3]))

    return lambda batches: _runs(batches, flush)


def _by_shard(finish: Callable[[tuple, list[bytes]], Iterator[pa.RecordBatch]], keys: int):
    """``finish`` over all blobs of each key; rows are sorted by the first ``keys`` columns, the blob comes behind them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_key, blobs = None, []
        for b in batches:
            for *key, x in zip(*(b.column(i).to_pylist() for i in range(keys + 1)), strict=True):
                if key != open_key and blobs:
                    yield from finish(tuple(open_key), blobs)
                    blobs = []
                open_key = key
                blobs.append(x)
        if blobs:
            yield from finish(tuple(open_key), blobs)

    return run


DEALT = "kind int, shard int, blob binary, n1 long, n2 long, n3 long, n4 long, m1 long, m2 long, m3 long, m4 long"


def _row(kind: int, shard: int, blob: bytes, n: list[int] = (0,) * 4, m: list[int] = (0,) * 4) -> pa.RecordBatch:
    names = [x.split(" ")[0] for x in DEALT.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([kind], pa.int32()), pa.array([shard], pa.int32()), pa.array([blob], pa.binary()), *(pa.array([int(x)], pa.int64()) for x in (*n, *m))], names=names)


def _four(c: np.ndarray) -> list[int]:
    return [int((c == k).sum()) for k in (1, 2, 3, 4)]


def _dealt(kind: int, s: np.ndarray, parts: int, cols: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    for i, own in _by_part(s, parts, *cols):
        yield _row(kind, i, _pack(*own))


def _word_rows(v: np.ndarray, w: np.ndarray, a: np.ndarray, base: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Of pairs (v, w), sorted by v, with their count a: what words need, as next word (in how many pairs) and as context."""
    if not len(v):
        return
    word, cont = np.unique(w, return_counts=True)
    at = _starts(v)
    none = lambda x: np.zeros(len(x), np.int64)
    h = np.concatenate([word, v[at]])
    cols = [h, np.concatenate([cont, none(at)]), *(np.concatenate([none(word), k]) for k in _kinds(at, a))]
    yield from _dealt(WORDS, _home(h, base), len(base) - 1, cols)


def _merge(folder: str, deal: Deal, base: np.ndarray):
    """A file for each shard with the n-grams, pairs and contexts that lie there; rows for the second deal; counts of counts."""

    def finish(key: tuple, blobs: list[bytes]) -> Iterator[pa.RecordBatch]:
        parts = [_unpack(x) for x in blobs]
        del blobs[:]
        v3, w3, c, *rest = (np.concatenate([p[i] for p in parts]) for i in range(len(parts[0])))
        del parts
        u3, hot_pair = rest if rest else (np.zeros(len(v3), np.uint8), np.zeros(len(v3), np.uint8))
        order = np.lexsort((u3, w3, v3))
        v3, w3, u3, c, hot_pair = (x[order] for x in (v3, w3, u3, c, hot_pair))
        del order, rest
        at = _starts(v3, w3, u3)
        c = np.add.reduceat(c.astype(np.int64), at)
        v3, w3, u3, hot_pair = (x[at] for x in (v3, w3, u3, hot_pair))
        at = _starts(v3, w3)
        v, w = v3[at].astype(np.int64), w3[at].astype(np.int64)
        raw = np.add.reduceat(c, at)
        files, high, a = [], [0] * 4, raw
        if deal.order == 3:
            uv = pair(u3.astype(np.uint64), v3.astype(np.uint64))
            g = pair(uv, w3.astype(np.uint64))
            order = np.argsort(g)
            files += [*_slim(*_keys(g[order])), *_slim(*_counts(c[order]))]
            high = _four(c)
            del g, u3, w3, v3
            a = np.where(v == FIRST, raw, np.diff(np.append(at, len(c))))
            order = np.argsort(uv, kind="stable")
            uv, own, hot = uv[order], c[order], hot_pair[order] > 0
            for some, far in ((~hot, False), (hot, True)):
                x, y = uv[some], own[some]
                start = _starts(x) if len(x) else np.zeros(0, np.int64)
                kinds = _kinds(start, y)
                if far:
                    yield from _dealt(CONTEXTS, _spread(x[start], deal.shards), deal.shards, [x[start], *kinds])
                else:
                    files += _contexts(x[start], *kinds)
            del uv, order, own
        far = deal.frequent(v) if deal.order == 3 else np.zeros(len(v), bool)
        vw = pair(v.astype(np.uint64), w.astype(np.uint64))
        g, near = vw[~far], a[~far]
        order = np.argsort(g)
        put(f"{folder}/grams-{key[0]:07d}", _zip(*_keys(g[order]), *_counts(near[order]), *files))
        if far.any():
            yield from _dealt(PAIRS, _spread(vw[far], deal.shards), deal.shards, [v[far], w[far], a[far]])
        yield from _word_rows(v[~far], w[~far], near, base)
        yield _row(-1, 0, b"", high, _four(near))

    return _by_shard(finish, 1)


def _merge_frequent(folder: str, base: np.ndarray):
    """Pairs of frequent centres, and frequent contexts: files of them, and what words need of these pairs."""

    def finish(key: tuple, blobs: list[bytes]) -> Iterator[pa.RecordBatch]:
        kind, shard = key
        cols = [np.concatenate(x) for x in zip(*(_unpack(b) for b in blobs), strict=True)]
        if kind == CONTEXTS:
            put(f"{folder}/contexts-{shard:07d}", _zip(*_contexts(*_sum_by(*cols))))
            return
        v, w, a = (x.astype(np.int64) for x in cols)
        order = np.lexsort((w, v))
        v, w, a = v[order], w[order], a[order]
        at = _starts(v, w)
        v, w, a = v[at], w[at], np.add.reduceat(a, at)
        g = pair(v.astype(np.uint64), w.astype(np.uint64))
        order = np.argsort(g)
        put(f"{folder}/pairs-{shard:07d}", _zip(*_keys(g[order]), *_counts(a[order])))
        yield from _word_rows(v, w, a, base)
        yield _row(-1, 0, b"", m=_four(a))

    return _by_shard(finish, 2)


def _merge_words(folder: str, base: np.ndarray):
    """A file for each shard of words, in the order of their numbers: as next word, in how many pairs; as context, count and next words of count 1, 2, 3 and more."""

    def finish(key: tuple, blobs: list[bytes]) -> Iterator[pa.RecordBatch]:
        lo = base[key[0]] if key[0] else FIRST
        n = int(base[key[0] + 1] - lo)
        h, *cols = (np.concatenate(x) for x in zip(*(_unpack(b) for b in blobs), strict=True))
        h, *cols = _sum_by(h.astype(np.int64), *cols)
        dense = [np.zeros(n, np.int64) for _ in cols]
        for d, c in zip(dense, cols, strict=True):
            d[h - lo] = c
        put(f"{folder}/words-{key[0]:07d}", _zip(*dense))
        yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in (int(cols[0].sum()), *_four(cols[0]))], names=["types", "n1", "n2", "n3", "n4"])

    return _by_shard(finish, 1)


def discounts(n: list[int]) -> list[float]:
    """Chen and Goodman's three discounts from counts of counts; 0.5, 1, 1.5 where a count of counts is 0."""
    n1, n2, n3, n4 = n
    if not (n1 and n2):
        return [0.5, 1.0, 1.5]
    y = n1 / (n1 + 2 * n2)
    d = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return [min(max(x, 0.05), k - 0.05) for x, k in zip(d, (1, 2, 3), strict=True)]


def train(docs: DataFrame, text_col: str = "text", order: int = ORDER) -> dict:
    """Counts all texts and writes the model to the shared folder; returns its place and its few global numbers.

    Each task counts the n-grams of its own tokens first, in runs. They are dealt out by centre (see above) to as many shards as
    there are tokens for, so that a shard is of one size at every size of the input and a task holds one at a time. Files are written
    whole under their final name, so a task that runs again, on whatever executor, puts the same file in place.
    """
    if order not in (2, 3):
        raise ValueError("order must be 2 or 3")
    folder = f"{shared_dir(docs.sparkSession)}/model"
    texts = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("_t"))
    parts = max(4, texts.rdd.getNumPartitions())  # shards of words: as many as the input has parts
    counted = texts.mapInArrow(K.releasing(_count_words(parts)), "shard int, blob binary").repartition(parts, "shard").sortWithinPartitions("shard")
    found = counted.mapInArrow(K.releasing(_merge_vocabulary(folder, SHARE * SHARD)), "shard int, words long, tokens long, blob binary").collect()  # a row for each shard, and HEAVY buckets
    size, total, hot, pairs = np.zeros(parts, np.int64), 0, [], np.zeros(HEAVY, bool)
    for r in found:
        some = _unpack(bytes(r.blob))[0].astype(np.int64)
        if r.shard < 0:
            pairs[some] = True
        else:
            size[r.shard], total = r.words, total + r.tokens
            hot.append((r.shard, some))
    base = 1 + K.bounds(size)
    words = np.sort(np.concatenate([base[i] + x for i, x in hot])) if hot else np.zeros(0, np.int64)  # two for each shard of n-grams at most
    words = np.union1d(words, [FIRST])  # as frequent as there are texts
    shards = max(1, -(-total // SHARD))
    deal, vocabulary = Deal(shards, words, pairs, order), Vocabulary(folder, base)
    grams = texts.mapInArrow(K.releasing(_count(deal, vocabulary)), "shard int, blob binary").repartition(shards, "shard").sortWithinPartitions("shard")
    merged = written(grams.mapInArrow(K.releasing(_merge(folder, deal, base)), DEALT), "merged")
    again = merged.filter(F.col("kind").isin(PAIRS, CONTEXTS)).select("kind", "shard", "blob").repartition(shards, "kind", "shard").sortWithinPartitions("kind", "shard")
    both = merged.unionByName(written(again.mapInArrow(K.releasing(_merge_frequent(folder, base)), DEALT), "frequent"))
    of_words = both.filter(F.col("kind") == WORDS).select("shard", "blob").repartition(parts, "shard").sortWithinPartitions("shard")
    low = of_words.mapInArrow(K.releasing(_merge_words(folder, base)), "types long, n1 long, n2 long, n3 long, n4 long").agg(*[F.sum(c).alias(c) for c in ("types", "n1", "n2", "n3", "n4")]).first().asDict()
    more = both.filter("kind = -1").agg(*[F.sum(c).alias(c) for c in ("n1", "n2", "n3", "n4", "m1", "m2", "m3", "m4")]).first().asDict()
    low, more = ({k: int(v or 0) for k, v in x.items()} for x in (low, more))
    return {
        "folder": folder, "order": order, "shards": shards, "base": base.tobytes(), "hot": words.tobytes(), "pairs": np.packbits(pairs).tobytes(), "v": int(size.sum()), "n": total, "types": low["types"],
        "low": discounts([low[f"n{k}"] for k in (1, 2, 3, 4)]), "low_n": [low["n1"], low["n2"]],
        "mid": discounts([more[f"m{k}"] for k in (1, 2, 3, 4)]), "high": discounts([more[f"n{k}"] for k in (1, 2, 3, 4)]),
    }


@lru_cache(maxsize=1 << 16)
def _file(uri: str) -> list[np.ndarray]:
    """A model file's arrays, mapped; a shard that got nothing has no file."""
    try:
        return _unzip(mapped(uri))
    except FileNotFoundError:
        return []


class Model:
    def __init__(self, m: dict):
        self.m, self.base = m, np.frombuffer(m["base"], np.int64)
        self.deal = Deal(m["shards"], np.frombuffer(m["hot"], np.int64), np.unpackbits(np.frombuffer(m["pairs"], np.uint8)).astype(bool), m["order"])
        self.vocabulary = Vocabulary(m["folder"], self.base)

    def _each(self, name: str, shard: np.ndarray, rows: np.ndarray, hash_: np.ndarray) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
        """For each shard that ``rows`` ask for: its file's arrays, and the rows in the order of their hash."""
        order = rows[np.lexsort((hash_[rows], shard[rows]))]
        for own in np.split(order, _starts(shard[order])[1:]) if len(order) else ():
            cols = _file(f"{self.m['folder']}/{name}-{int(shard[own[0]]):07d}")
            if cols:
                yield cols, own

    def words(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of sorted hashes, and six values of each: pairs, count, count as a context, next words of count 1, 2, 3 and more."""
        number, out = self.vocabulary.numbers(h), np.zeros((6, len(h)), np.int64)
        known = np.flatnonzero(number >= FIRST)
        shard = _home(number, self.base)
        for cols, own in self._each("words", shard, known, h):
            at = number[own] - (self.base[shard[own]] if shard[own[0]] else FIRST)
            for i, k in enumerate((0, 2, 3, 4, 5)):
                out[k, own] = cols[i][at]
        for cols, own in self._each("vocabulary", shard, np.flatnonzero(number > FIRST), h):
            out[1, own] = cols[1][number[own] - self.base[shard[own]]]
        return number, out

    def grams(self, u: np.ndarray, v: np.ndarray, w: np.ndarray, hot_pair: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of numbers of words: counts of pairs (v, w), of triples, and four values of the contexts (u, v) that stand more than once."""
        two, three, ctx = np.zeros(len(v), np.int64), np.zeros(len(v), np.int64), np.zeros((4, len(v)), np.int64)
        deal, far = self.deal, self.deal.frequent(v)
        shard = deal.of(u, v, w, far, hot_pair)
        u, v, w, known = u.astype(np.uint64), v.astype(np.uint64), w.astype(np.uint64), (u >= 0, v >= 0, w >= 0)
        vw, pairs = pair(v, w), known[1] & known[2]
        if deal.order == 2:
            for cols, own in self._each("grams", shard, np.flatnonzero(pairs), vw):
                two[own] = _get_counts(cols[:5], vw[own])
            return two, three, ctx
        uv = pair(u, v)
        uvw, contexts = pair(uv, w), known[0] & known[1]
        # A word that is not known follows: the context lies where its centre, or its pair, leads to.
        for cols, own in self._each("grams", shard, np.flatnonzero((pairs & known[0]) | (pairs & ~far) | (contexts & ~hot_pair)), uvw):
            some = own[pairs[own] & known[0][own]]
            three[some] = _get_counts(cols[5:10], uvw[some])
            some = own[(pairs & ~far)[own]]
            two[some] = _get_counts(cols[:5], vw[some])
            some = own[(contexts & ~hot_pair)[own]]
            ctx[:, some] = _get_contexts(cols[10:], uv[some])
        for cols, own in self._each("pairs", _spread(vw, deal.shards), np.flatnonzero(pairs & far), vw):
            two[own] = _get_counts(cols, vw[own])
        for cols, own in self._each("contexts", _spread(uv, deal.shards), np.flatnonzero(contexts & hot_pair), uv):
            ctx[:, own] = _get_contexts(cols, uv[own])
        return two, three, ctx

    def score(self, col: pa.Array) -> tuple[np.ndarray, ...]:
        """n_tokens, n_known, base_score, score of each text."""
        m = self.m
        t, n = tokens(col)
        h, back = np.unique(np.append(t, BEGIN), return_inverse=True)
        number, info = self.words(h)
        w_at, begin = back[:-1], back[-1]
        first = K.bounds(n)[:-1]
        v_at = np.concatenate([[begin], w_at[:-1]])
        v_at[first] = begin
        u_at = np.concatenate([[begin], v_at[:-1]])
        u_at[first] = begin
        low, mid, high = (np.array([0.0, *m[x]]) for x in ("low", "mid", "high"))
        less = lambda c, d: np.maximum(c - d[np.minimum(c, 3)], 0)
        left = lambda k, d: (d[1] * k[1] + d[2] * k[2] + d[3] * k[3]) / np.maximum(k[0], 1)
        types = max(m["types"], 1)
        gamma1 = (low[1] * m["low_n"][0] + low[2] * m["low_n"][1] + low[3] * max(m["v"] - m["low_n"][0] - m["low_n"][1], 0)) / types if m["types"] else 1.0
        uni = less(info[0], low) / types + gamma1 / (m["v"] + 1)
        v = number[v_at]
        hot = self.deal.frequent(v)
        hot[hot] = self.deal.pairs[_bucket(pair(h[u_at[hot]], h[v_at[hot]]))]
        two, three, ctx = self.grams(number[u_at], v, number[w_at], hot)
        k = info[2:6][:, v_at]
        p = np.where(k[0] > 0, less(two, mid) / np.maximum(k[0], 1) + left(k, mid) * uni[w_at], uni[w_at])
        if m["order"] == 3:
            # A context that the model does not list stands once, if its pair is there.
            alone = np.concatenate([[False], two[:-1] > 0]) & (ctx[0] == 0)
            alone[first] = False
            ctx[:2, alone] = 1
            p = np.where(ctx[0] > 0, less(three, high) / np.maximum(ctx[0], 1) + left(ctx, high) * p, p)
        known = info[1][w_at]
        base = np.log10((known + 1) / (m["n"] + m["v"] + 1)) if m["n"] + m["v"] + 1 else np.zeros(len(t))
        return n, np.add.reduceat((known > 0).astype(np.int64), first), np.add.reduceat(base, first), np.add.reduceat(np.log10(p), first)


def lm_score(docs: DataFrame, parts: int = 7, rest: int = 2, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER) -> DataFrame:
    """One row per input row: id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity.

    Tokens are words ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case, and one end for each text. The model is learnt from
    rows whose id's crc32 does not leave ``rest`` modulo ``parts`` (a null id is in training). score: log10 probability of all
    tokens, each given the ``order`` - 1 before. Counts of the highest order are plain, those below say how many different tokens an
    n-gram follows (at a text's begin: how often it stands there); each order has three discounts and leaves what they take to the one below, the lowest to
    a uniform share for words never seen. base_score: add-one unigram. Null text is empty (one token, the end). Repeated rows
    count as often as they stand and score alike. Without a training row all words are unknown: score is 0 (one
    outcome), as is base_score. Words are told apart by 64-bit hashes, n-grams by 40 bits inside a shard. Other columns are ignored. No rows in, no rows out.
    """
    flag = held_out(id_col, parts, rest)
    m = train(docs.filter(~flag), text_col, order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(m)
        for b in batches:
            for lo in range(0, b.num_rows, 2048):
                part = b.slice(lo, 2048)
                n, known, base, score = model.score(part.column(2))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(n), pa.array(known), pa.array(np.full(len(n), m["n"], np.int64)), pa.array(base), pa.array(score)], names=["_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("_id"), flag.alias("held_out"), F.coalesce(F.col(text_col), F.lit("")).alias("_t"))
    out = rows.mapInArrow(K.releasing(run), f"_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return out.withColumnRenamed("_id", id_col).withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
