"""Toxicity by a factorization machine over hashed terms (Rendle, 2010)."""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkernel as K
from .shared import written
from .telling import examples, telling_terms

U64 = np.uint64
#: Hash space of terms; terms that the machine keeps; factors of a term; labelled rows it is fitted on at most.
BUCKETS, TERMS, FACTORS, MAX_ROWS = 1 << 20, 4096, 8, 20_000
#: Besides whole words, their first bytes are terms: they catch inflected and varied forms.
PREFIXES = (4, 5, 6)
SLICE = 512


def terms(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Text number and bucket of each word and word beginning, in lower case, of a string array."""
    b, o = K.buffers(col)
    w = K.words(b, o, lower=True, sep=K.NONLETTER, prefixes=PREFIXES)
    doc = np.repeat(np.arange(len(w["n"])), w["n"])
    ids, docs = [(w["h"] % U64(BUCKETS)).astype(np.int64)], [doc]
    for j, p in enumerate(w["p"]):
        has = p != 0
        ids.append((K.mix(p[has] + U64(j + 1)) % U64(BUCKETS)).astype(np.int64))
        docs.append(doc[has])
    return np.concatenate(docs), np.concatenate(ids)


def _chosen(ids: np.ndarray):
    """y and, of each text, the places in ``ids`` of the terms that it holds."""
    at = np.full(BUCKETS, -1, np.int32)
    at[ids] = np.arange(len(ids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, SLICE):
                part = b.slice(lo, SLICE)
                doc, term = terms(part.column(1))
                place = at[term]
                key = np.unique(doc[place >= 0] * TERMS + place[place >= 0])
                cut = np.searchsorted(key, np.arange(part.num_rows + 1) * TERMS)
                found = (key % TERMS).astype(np.uint16)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([found[cut[i] : cut[i + 1]].tobytes() for i in range(part.num_rows)], pa.binary())], names=["y", "x"])

    return run


def fit(xs: list[np.ndarray], y: np.ndarray, ids: np.ndarray, seed: int = 5, epochs: int = 40) -> dict[str, np.ndarray]:
    """Log loss, AdaGrad, mini-batches. ``ids``: the buckets of the terms that the machine keeps; xs: their places in each text."""
    n, pos = len(y), int(y.sum())
    prior = (pos + 0.5) / (n + 1)
    w0 = np.float64(np.log(prior / (1 - prior)))
    if not len(ids) or pos in (0, n):
        return {"ids": np.zeros(0, np.int64), "w": np.zeros(0, np.float32), "v": np.zeros((0, FACTORS), np.float32), "w0": w0}
    rng = np.random.Generator(np.random.PCG64(seed))
    w, v = np.zeros(len(ids), np.float32), rng.normal(0, 0.02, (len(ids), FACTORS)).astype(np.float32)
    gw, gv, g0 = np.full(len(ids), 1e-6, np.float32), np.full(v.shape, 1e-6, np.float32), 1e-6
    for _ in range(epochs):
        order = rng.permutation(n)
        for lo in range(0, n, 256):
            rows = order[lo : lo + 256]
            x = np.zeros((len(rows), len(ids)), np.float32)
            for i, j in enumerate(rows):
                x[i, xs[j]] = 1
            s = x @ v
            z = np.clip(w0 + x @ w + 0.5 * ((s * s).sum(1) - x @ (v * v).sum(1)), -30, 30)
            d = ((1 / (1 + np.exp(-z)) - y[rows]) / len(rows)).astype(np.float32)
            down = x.T @ d
            dw = down + 1e-5 * w
            dv = x.T @ (d[:, None] * s) - down[:, None] * v + 1e-5 * v
            d0 = float(d.sum())
            gw += dw * dw
            gv += dv * dv
            g0 += d0 * d0
            w -= 0.1 * dw / np.sqrt(gw)
            v -= 0.02 * dv / np.sqrt(gv)
            w0 -= 0.1 * d0 / np.sqrt(g0)
    return {"ids": ids, "w": w, "v": v, "w0": np.float64(w0)}


def predict(model: dict[str, np.ndarray], col: pa.Array) -> np.ndarray:
    out = np.full(len(col), float(model["w0"]))
    m = len(model["ids"])
    if m:
        at = np.full(BUCKETS, -1, np.int32)
        at[model["ids"]] = np.arange(m)
        sq = (model["v"].astype(np.float64) ** 2).sum(1)
        for lo in range(0, len(col), SLICE):
            doc, ids = terms(col.slice(lo, SLICE))
            t = at[ids]
            key = np.unique(doc[t >= 0] * m + t[t >= 0])
            d, t = key // m, key % m
            k = min(SLICE, len(col) - lo)
            lin = np.bincount(d, model["w"][t], k) - 0.5 * np.bincount(d, sq[t], k)
            for f in range(model["v"].shape[1]):
                lin += 0.5 * np.bincount(d, model["v"][t, f], k) ** 2
            out[lo : lo + k] += lin
    return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def pack(model: dict[str, np.ndarray]) -> bytes:
    buf = io.BytesIO()
    np.savez_compressed(buf, **model)
    return buf.getvalue()


def unpack(data: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(data)) as f:
        return {k: f[k] for k in f.files}


def held_out(id_col: str = "doc_id", parts: int = 4, rest: int = 2):
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(parts)) == rest, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_rows: int = MAX_ROWS) -> bytes:
    """The fitted model, learnt from the texts of at most ``max_rows`` labelled ids that are not held out (see telling.examples).

    Its terms are the TERMS buckets that tell most about the label; only their places go to the task that fits it, at most 2 * max_rows rows of 2 * TERMS bytes."""
    base = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_t"))
    sample = written(examples(base, labels.filter(~held_out(id_col)), id_col, label_col, max_rows, 5), "sample")
    ids = telling_terms(sample, terms, BUCKETS, TERMS)
    found = sample.select("_y", "_t").mapInArrow(K.releasing(_chosen(ids)), "y int, x binary").repartition(1)

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((y, x) for b in batches for y, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))  # the same order, however rows arrive
        model = fit([np.frombuffer(x, np.uint16).astype(np.int64) for _, x in rows], np.array([y for y, _ in rows], np.float64), ids)
        yield pa.RecordBatch.from_arrays([pa.array([pack(model)], pa.binary())], names=["model"])

    return bytes(found.mapInArrow(K.releasing(train), "model binary").first()[0])


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_rows: int = MAX_ROWS) -> DataFrame:
    """One row per input row: id, held_out, score, predicted.

    Terms are whole lower-case words (ASCII punctuation and digits separate them) and their beginnings, hashed.
    The machine has a weight for each term and, by inner products of factors, one for each pair of terms of a text, such as
    an insult and a mention of a group. Only the text is an input. held_out: crc32 of the id as text leaves 2 modulo 4; such
    rows and rows without a label or an id teach nothing (several labels of one id: the largest).
    Null and empty texts score the fitted intercept. Without labels of both kinds all score the prior (0.5 without any).
    Repeated rows get equal scores. Other columns are ignored. No rows in, no rows out.
    """
    model = learn(docs, labels, id_col, text_col, label_col, max_rows)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = unpack(model)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(predict(m, b.column(2)), pa.float64())], names=["_id", "held_out", "score"])

    rows = docs.select(F.col(id_col).alias("_id"), held_out(id_col).alias("held_out"), F.coalesce(F.col(text_col), F.lit("")).alias("_t"))
    kind = docs.schema[id_col].dataType.simpleString()
    out = rows.mapInArrow(K.releasing(score), f"_id {kind}, held_out boolean, score double")
    return out.select(F.col("_id").alias(id_col), "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, with all their columns: rows are scored where they are, without a join.

    Null and empty texts score the intercept and stay unless that reaches the threshold; their values are kept as they are. Null ids are scored like others,
    repeated rows stay or go together. Without labels of both kinds all rows have the same score. No rows in, no rows out."""
    model = learn(docs, labels, id_col, text_col, **kw)
    at = docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = unpack(model)
        for b in batches:
            yield b.filter(pa.array(predict(m, b.column(at)) < threshold))

    return docs.mapInArrow(K.releasing(keep), docs.schema)
