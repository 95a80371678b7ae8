"""SentencePiece BPE with seeded merge-dropout, and its decoder.

The vocabulary is read from a .model file; segmentation is done here, for all units of a slice at once
(without dropout, for all distinct ones). A unit is a run of spaces with what follows up to the next space; line feeds stand alone. No piece
spans units unless it is made of spaces, so units can be segmented one by one.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkernel as K

U64 = np.uint64
#: Chance that a candidate merge is skipped.
DROPOUT, SEED = 0.1, 6
#: Units of more characters are segmented with a heap; texts are worked through in slices of about so many bytes.
LONG, SLICE_BYTES, SLICE_ROWS = 48, 1 << 19, 4096
#: Cells of a matrix of units x characters.
CELLS = 1 << 17
SPACE, NONE, PAD = 0x2581, np.int32(1 << 30), -9


def piece_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Pieces:
    """Tables of a vocabulary: characters, merges by (left, right), bytes of each piece."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.size = sp.vocab_size()
        special = np.array([sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) for i in range(n)])
        names = [sp.id_to_piece(i) for i in range(n)]
        ids = {p: i for i, p in enumerate(names) if not special[i]}
        if any("▁" in p.strip("▁") or "\n" in p for p in ids):
            raise ValueError("pieces that span words are not supported")
        self.byte = np.array([sp.piece_to_id(f"<0x{i:02X}>") for i in range(256)], np.int32)
        self.char = np.full(0x110000, -1, np.int32)
        loose = n  # characters that occur in pieces only get a symbol of their own
        self.loose: dict[int, int] = {}
        for p in ids:
            for c in p:
                if c in ids:
                    self.char[ord(c)] = ids[c]
                elif ord(c) not in self.loose:
                    self.loose[ord(c)] = self.char[ord(c)] = loose
                    loose += 1
        sym = {c: int(self.char[ord(c)]) for p in ids for c in p} | ids
        order = {i: r for r, i in enumerate(sorted(ids.values(), key=lambda i: (-sp.get_score(i), i)))}
        pairs: dict[int, int] = {}
        for p, i in ids.items():
            for k in range(1, len(p)):
                if p[:k] in sym and p[k:] in sym:
                    pairs[sym[p[:k]] << 20 | sym[p[k:]]] = i
        bits = 1 << 20
        while bits < 4 * len(pairs):
            bits *= 2
        self.mask = bits - 1
        self.keys, self.made = np.full(bits, -1, np.int64), np.zeros(bits, np.int32)
        for key, i in pairs.items():
            at = int(K.mix(np.array([key], np.uint64))[0]) & self.mask
            while self.keys[at] >= 0:
                at = (at + 1) & self.mask
            self.keys[at], self.made[at] = key, i
        self.pairs = pairs
        self.rank = np.full(n, NONE, np.int32)
        for i, r in order.items():
            self.rank[i] = r
        raw = [bytes([int(names[i][3:5], 16)]) if sp.is_byte(i) else b"" if special[i] else names[i].replace("▁", " ").encode() for i in range(n)]
        self.raw_len = np.array([len(x) for x in raw], np.int64)
        self.raw_at = K.bounds(self.raw_len)
        self.raw = np.frombuffer(b"".join(raw), np.uint8)

    def merge(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that two symbols make, or -1."""
        ok = (left >= 0) & (right >= 0)
        key = np.where(ok, left.astype(np.int64) << 20 | right, np.int64(-2))
        at = (K.mix(key.view(np.uint64)) & U64(self.mask)).astype(np.int64)
        out = np.full(left.shape, -1, np.int32)
        todo = np.flatnonzero(ok)
        while len(todo):
            have = self.keys[at.flat[todo]]
            hit = have == key.flat[todo]
            out.flat[todo[hit]] = self.made[at.flat[todo[hit]]]
            todo = todo[~hit & (have >= 0)]
            at.flat[todo] = (at.flat[todo] + 1) & self.mask
        return out


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def _skipped(unit: np.ndarray, at: np.ndarray, piece: np.ndarray, dropout: float) -> np.ndarray:
    """Keyed hash of unit, place of the left symbol and piece to be made: True for a share of ``dropout``."""
    h = K.mix(unit ^ (at.astype(np.uint64) << U64(32)) ^ piece.astype(np.uint64))
    return (h >> U64(11)).astype(np.float64) < dropout * float(1 << 53)


def _ranks(p: Pieces, left, right, at, unit, dropout):
    made = p.merge(left, right)
    r = np.where(made >= 0, p.rank[np.maximum(made, 0)], NONE)
    if dropout > 0:
        some = np.flatnonzero(made >= 0)
        r[some[_skipped(unit[some], at[some], made[some], dropout)]] = NONE
    return r, made


def _neighbours(p: Pieces, sym: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """sym: units x width, PAD behind the end. Rank and piece of each symbol with the next one, as if none were skipped."""
    made = np.full(sym.shape, -1, np.int32)
    made[:, :-1] = p.merge(sym[:, :-1], sym[:, 1:])
    return np.where(made >= 0, p.rank[np.maximum(made, 0)], NONE), made


def _segment_short(p: Pieces, sym: np.ndarray, rank: np.ndarray, made: np.ndarray, unit: np.ndarray, dropout: float) -> tuple[np.ndarray, np.ndarray]:
    """Symbols that are left, and where (units x width). rank, made: see _neighbours; both are written over.
    In each round every unit makes its best merge: least rank, then leftmost. Symbols stay in their columns and are linked, so a round
    looks at each rank once and else touches three symbols of a unit."""
    rows, width = sym.shape
    s = np.full((rows, width + 1), PAD, np.int32)
    s[:, :width] = sym
    alive = sym != PAD
    if dropout > 0:
        r, c = np.nonzero(made >= 0)
        out = _skipped(unit[r], c, made[r, c], dropout)
        rank[r[out], c[out]] = NONE
    nxt = np.broadcast_to(np.arange(1, width + 2, dtype=np.int32), (rows, width + 1)).copy()
    prv = np.broadcast_to(np.arange(-1, width, dtype=np.int32), (rows, width + 1)).copy()
    live = np.arange(rows)
    while len(live):
        best = rank.argmin(1)
        go = np.flatnonzero(rank[np.arange(len(live)), best] < NONE)
        if len(go) < 0.7 * len(live):
            live, rank, made, best = live[go], rank[go], made[go], best[go]
            go = np.arange(len(live))
        if not len(go):
            break
        g, i = live[go], best[go]
        j = nxt[g, i]
        k, h, m = nxt[g, j], prv[g, i], made[go, i]
        s[g, i] = m
        alive[g, j] = False
        rank[go, j] = NONE
        nxt[g, i] = k
        prv[g, k] = i
        before = np.flatnonzero(h >= 0)
        gb, hb = g[before], h[before]
        r, found = _ranks(p, np.concatenate([m, s[gb, hb]]), np.concatenate([s[g, k], m[before]]), np.concatenate([i, hb]), np.concatenate([unit[g], unit[gb]]), dropout)
        n = len(g)
        rank[go, i], made[go, i] = r[:n], found[:n]
        rank[go[before], hb], made[go[before], hb] = r[n:], found[n:]
    return s[:, :width], alive


_BITS = (1 << 64) - 1


def _mix_one(x: int) -> int:
    """K.mix of one number."""
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & _BITS
    x = (x ^ x >> 27) * 0x94D049BB133111EB & _BITS
    return x ^ x >> 31


def _segment_long(p: Pieces, sym: np.ndarray, unit: int, dropout: float) -> np.ndarray:
    """The same with an agenda: a heap of (rank, place) and linked symbols. The first candidates are found all at once."""
    n = len(sym)
    place = np.arange(n - 1)
    rank, made = _ranks(p, sym[:-1], sym[1:], place, np.full(n - 1, unit, np.uint64), dropout)
    val, alive = sym.tolist(), [True] * n
    nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
    first = np.flatnonzero(rank < NONE)
    heap = [(r, i, i + 1, val[i], val[i + 1], m) for r, i, m in zip(rank[first].tolist(), first.tolist(), made[first].tolist(), strict=True)]
    heapq.heapify(heap)
    pairs, ranks, limit = p.pairs, p.rank, dropout * float(1 << 53)

    def add(i: int) -> None:
        j = nxt[i]
        if j >= n or val[i] < 0 or val[j] < 0:
            return
        made = pairs.get(val[i] << 20 | val[j])
        if made is not None and not (limit and (_mix_one(unit ^ i << 32 ^ made) >> 11) < limit):
            heapq.heappush(heap, (int(ranks[made]), i, j, val[i], val[j], made))

    while heap:
        _, i, j, a, b, made = heapq.heappop(heap)
        if not (alive[i] and j < n and alive[j] and nxt[i] == j and val[i] == a and val[j] == b):
            continue
        val[i], alive[j], nxt[i] = made, False, nxt[j]
        if nxt[j] < n:
            prv[nxt[j]] = i
        if prv[i] >= 0:
            add(prv[i])
        add(i)
    return np.array(val, np.int64)[np.array(alive, bool)]


def _units(b: np.ndarray, o: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start and end bytes, hash, and text number of each unit."""
    sp, nl = b == 32, b == 10
    cut = nl.copy()
    cut[1:] |= nl[:-1] | (sp[1:] & ~sp[:-1])
    if len(b):
        cut[0] = True
    inner = o[:-1][o[:-1] < len(b)]
    cut[inner] = True
    start = np.flatnonzero(cut)
    end = np.append(start[1:], len(b))
    h = np.zeros(len(start), np.uint64)
    for lo in range(0, len(start), 1 << 17):  # hash runs of bytes between cuts
        hi = min(len(start), lo + (1 << 17))
        x = b[start[lo] : end[hi - 1]]
        q, qi = K._powers(len(x) + 1)
        run = np.zeros(len(x) + 1, np.uint64)
        np.cumsum(K._TABLE[x] * q[: len(x)], out=run[1:])
        s, e = start[lo:hi] - start[lo], end[lo:hi] - start[lo]
        h[lo:hi] = K.mix((run[e] - run[s]) * qi[s] + (e - s).astype(np.uint64))
    doc = np.searchsorted(o, start, "right") - 1
    first = np.ones(len(start), bool)
    first[1:] = doc[1:] != doc[:-1]
    h[first] = K.mix(h[first] ^ U64(0x5DEECE66D))
    return start, end, h, np.where(first, doc, -1 - doc)


def _symbols(p: Pieces, text: str) -> np.ndarray:
    cp = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
    s = p.char[cp].astype(np.int64)
    s[cp == SPACE] = -1
    s[cp == 32] = p.char[SPACE]
    return np.where(s < 0, -cp - 16, s)


def _bytes_of(p: Pieces, odd: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte pieces of symbols that are no pieces (characters without one), and how many each has."""
    back = {v: k for k, v in p.loose.items()}
    value, which = np.unique(odd, return_inverse=True)
    lists = [p.byte[list(chr(-v - 16 if v < 0 else back[v]).encode())] for v in value.tolist()]
    n = np.array([len(x) for x in lists], np.int64)
    at = K.bounds(n)[:-1]
    size = n[which]
    take = np.repeat(at[which] - K.bounds(size)[:-1], size) + np.arange(size.sum())
    return np.concatenate(lists)[take], size


def encode_slice(p: Pieces, b: np.ndarray, o: np.ndarray, key: np.ndarray, dropout: float) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, one after the other, and bounds. key: for each text, what makes it segment in its own way."""
    start, end, h, doc = _units(b, o)
    first = doc >= 0
    doc = np.where(first, doc, -1 - doc)
    _, pick, back = np.unique(h, return_index=True, return_inverse=True)
    s, e, lead, u = start[pick], end[pick], first[pick], h[pick]
    data = b.tobytes()
    texts = [(" " if f else "") + data[i:j].decode() for i, j, f in zip(s.tolist(), e.tolist(), lead.tolist(), strict=True)]
    size = np.array([len(t) for t in texts], np.int64)
    flat = _symbols(p, "".join(texts))
    at = K.bounds(size)[:-1]
    own = np.arange(len(texts))  # the distinct unit of each one that is segmented
    if dropout > 0:  # each occurrence is segmented by itself: its key is of the text and its place there
        opens = np.flatnonzero(first)
        place = np.arange(len(h)) - np.repeat(opens, np.diff(np.append(opens, len(h))))
        u = K.mix(h ^ K.mix(key[doc] + place.astype(np.uint64) * U64(0x9E3779B97F4A7C15)))
        own, back = back, np.arange(len(h))
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for lo, hi in ((1, 4), (5, 6), (7, 8), (9, 11), (12, 15), (16, 23), (24, LONG)):
        once = np.flatnonzero((size >= lo) & (size <= hi))
        if not len(once):
            continue
        w = np.arange(hi)
        sym = np.where(w < size[once][:, None], flat[np.minimum(at[once][:, None] + w, len(flat) - 1)], PAD).astype(np.int32)
        rank, made = _neighbours(p, sym)
        row_of = np.full(len(texts), -1, np.int64)
        row_of[once] = np.arange(len(once))
        rows_all = np.flatnonzero(row_of[own] >= 0)
        step = CELLS // hi
        for cut in range(0, len(rows_all), step):
            rows = rows_all[cut : cut + step]
            k = row_of[own[rows]]
            left, alive = _segment_short(p, sym[k], rank[k], made[k], u[rows], dropout)
            found.append((rows, alive.sum(1), left[alive].astype(np.int64)))
    for r in np.flatnonzero(size[own] > LONG):
        got = _segment_long(p, flat[at[own[r]] : at[own[r]] + size[own[r]]], int(u[r]), dropout)
        found.append((np.array([r]), np.array([len(got)]), got))
    rows = np.concatenate([x[0] for x in found]) if found else np.zeros(0, np.int64)
    syms = np.concatenate([x[2] for x in found]) if found else np.zeros(0, np.int64)
    count = np.concatenate([x[1] for x in found]) if found else np.zeros(0, np.int64)
    owner = np.repeat(rows, count)
    odd = (syms < 0) | (syms >= p.size)
    if odd.any():
        grow = np.ones(len(syms), np.int64)
        bits, grow[odd] = _bytes_of(p, syms[odd])
        place = K.bounds(grow)
        ids = np.empty(place[-1], np.int32)
        owner = np.repeat(owner, grow)
        plain = np.repeat(~odd, grow)
        ids[plain], ids[~plain] = syms[~odd], bits
    else:
        ids = syms.astype(np.int32)
    n_unit = np.bincount(owner, minlength=len(own))
    begin = np.zeros(len(own), np.int64)  # units lie in the order of ``rows``
    begin[rows] = K.bounds(n_unit[rows])[:-1]
    n_occ = n_unit[back]
    out_at = K.bounds(n_occ)
    take = np.repeat(begin[back] - out_at[:-1], n_occ) + np.arange(out_at[-1])
    per_doc = np.bincount(doc, n_occ, len(o) - 1).astype(np.int64)
    return ids[take], K.bounds(per_doc)


def decode_slice(p: Pieces, ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and their bounds; the space that encoding puts before a text is taken off."""
    n = p.raw_len[ids]
    out_at = K.bounds(n)
    take = np.repeat(p.raw_at[ids] - out_at[:-1], n)
    take += np.arange(out_at[-1])
    raw = p.raw[take]
    o = out_at[at]
    lead = o[:-1][np.diff(o) > 0]
    keep = np.ones(len(raw), bool)
    keep[lead] = False
    return raw[keep], o - np.concatenate([[0], np.cumsum(np.diff(o) > 0)])


def _slices(col: pa.Array) -> Iterator[tuple[int, int]]:
    _, o = K.buffers(col)
    at = 0
    while at < len(col):
        end = at + 1
        while end < len(col) and end - at < SLICE_ROWS and o[end + 1] - o[at] <= SLICE_BYTES:
            end += 1
        yield at, end
        at = end


def encode(docs: DataFrame, path: str, dropout: float = DROPOUT, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ids (array of int), n_tokens, n_bytes, lossless.

    Merges go by score, then from left to right, as an agenda takes them. A candidate merge is skipped where a
    keyed hash of (seed, id, text, the unit and its place in the text, place, piece) falls below ``dropout``; it stays skipped in
    that unit. So one text segments alike in every run, and a word anew wherever it occurs and under
    other seeds. dropout 0 gives the library's own segmentation. Text is not normalised; a space is put before it,
    U+2581 itself and characters without a piece become byte pieces: decode() gives the text back, and
    ``lossless`` says that it has been decoded and compared byte by byte.
    Null text is empty: no ids. Null ids are allowed, repeated rows are equal, other columns are ignored; no rows in, no
    rows out. A text without a space is one unit, segmented in n log n steps.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces(path)
        for rows in batches:
            for lo, hi in _slices(rows.column(2)):
                part = rows.slice(lo, hi - lo)
                b, o = K.buffers(part.column(2))
                key = K.mix(part.column(1).to_numpy(zero_copy_only=False).astype(np.uint64))
                ids, at = encode_slice(p, b, o, key, dropout)
                raw, ro = decode_slice(p, ids, at)
                same = np.array_equal(ro, o)
                if same and np.array_equal(raw, b):
                    good = np.ones(len(part), bool)
                else:
                    good = np.array([raw[ro[i] : ro[i + 1]].tobytes() == b[o[i] : o[i + 1]].tobytes() for i in range(len(part))])
                lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays([part.column(0), lists, pa.array(np.diff(at)), pa.array(np.diff(o)), pa.array(good)], names=["_id", "ids", "n_tokens", "n_bytes", "lossless"])

    own = F.xxhash64(F.lit(seed), F.col(id_col), F.coalesce(F.col(text_col), F.lit("")))
    rows = docs.select(F.col(id_col).alias("_id"), own.alias("_g"), F.coalesce(F.col(text_col), F.lit("")).alias("_t"))
    out = rows.mapInArrow(K.releasing(run), f"_id {kind}, ids array<int>, n_tokens long, n_bytes long, lossless boolean")
    return out.withColumnRenamed("_id", id_col)


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row per input row: id, text. A null or empty list of ids decodes to an empty text, bytes that are no UTF-8 to U+FFFD.
    Null row ids are allowed, repeated rows decode alike, other columns are ignored; no rows in, no rows out."""
    kind = encoded.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces(path)
        for rows in batches:
            for lo in range(0, rows.num_rows, 256):
                part = rows.slice(lo, 256)
                lists = [np.array(x or [], np.int64) for x in part.column(1).to_pylist()]
                at = K.bounds(np.array([len(x) for x in lists], np.int64))
                raw, o = decode_slice(p, np.concatenate(lists), at)
                data = raw.tobytes()
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([data[o[i] : o[i + 1]].decode(errors="replace") for i in range(len(lists))])], names=["_id", "text"])

    return encoded.select(F.col(id_col).alias("_id"), F.col(ids_col).alias("_ids")).mapInArrow(K.releasing(run), f"_id {kind}, text string").withColumnRenamed("_id", id_col)
