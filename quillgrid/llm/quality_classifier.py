"""Quality classifier by co-training of a text view and a metadata view (Blum and Mitchell, 1998)."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkernel as K
from .shared import written
from .telling import examples, telling_terms
from .toxicity import held_out, pack, unpack

U64 = np.uint64
#: Labelled rows that are collected for fitting, at most; rounds.
MAX_LABELLED, ROUNDS = 10_000, 4
#: A pseudo-label must be this sure and weighs so much; a share of labelled rows is kept for calibration.
SURE, PSEUDO, CALIBRATE = 0.95, 0.5, 0.25
#: Hash space of words and pairs of words; those of them that the text view holds; classes of page sizes, by powers of two.
BUCKETS, TERMS, SIZES = 1 << 16, 128, 32
NULL = "\0"
_UPPER, _DIGIT, _SYMBOL, _PUNCT = (np.zeros(256, bool) for _ in range(4))
_UPPER[65:91] = True
_DIGIT[48:58] = True
_SYMBOL[[ord(c) for c in "#*$%&|<>=~^_{}[]\\@"]] = True
_PUNCT[[ord(c) for c in ".,!?;:'\"()-"]] = True
#: Plain numbers of the text view, and of the page view.
TEXT_NUMBERS, PAGE_NUMBERS = 11, 1


def _share(flag: np.ndarray, o: np.ndarray) -> np.ndarray:
    c = np.concatenate([[0], np.cumsum(flag)])
    return (c[o[1:]] - c[o[:-1]]) / np.maximum(np.diff(o), 1)


def _terms(w: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Text number and bucket of each word, and of each two words that follow each other."""
    h, doc = w["h"], np.repeat(np.arange(len(w["n"])), w["n"])
    one = np.flatnonzero(doc[1:] == doc[:-1])
    two = K.mix(h[one] * U64(3) + h[one + 1])
    return np.concatenate([doc, doc[one]]), np.concatenate([h % U64(BUCKETS), two % U64(BUCKETS)]).astype(np.int64)


def text_view(b: np.ndarray, o: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """From words alone. Numbers: repetition, lengths, kinds of characters. Flags: which of ``terms`` (sorted buckets) the text holds."""
    w = K.words(b, o)
    n, h = w["n"], w["h"]
    at = K.bounds(n)
    doc = np.repeat(np.arange(len(n)), n)
    size = (w["end"] - w["start"]).astype(np.float64)
    some = np.maximum(n, 1)
    mean = np.bincount(doc, size, len(n)) / some
    var = np.bincount(doc, size * size, len(n)) / some - mean * mean
    same = np.zeros(len(h))
    if len(h):
        same[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    key = K.mix(h + doc.astype(np.uint64) * U64(0x9E3779B97F4A7C15))
    u, count = np.unique(key, return_counts=True)
    first = np.searchsorted(u, key)
    distinct = np.bincount(doc, 1.0 / count[first] if len(h) else None, len(n))
    top = np.zeros(len(n))
    np.maximum.at(top, doc, count[first] if len(h) else 0)
    three = K.mix(h + K.mix(np.append(h[1:], U64(0))) * U64(3) + K.mix(np.append(h[2:], [U64(0)] * min(2, len(h)))) * U64(7)) if len(h) else h
    inner = np.ones(len(h), bool)
    if len(h):
        ends = at[1:][n > 0]
        inner[ends - 1] = False
        inner[np.maximum(ends - 2, 0)] = False
    k3 = K.mix(three[inner] + doc[inner].astype(np.uint64) * U64(0x9E3779B97F4A7C15))
    _, back, c3 = np.unique(k3, return_inverse=True, return_counts=True)
    rep3 = np.bincount(doc[inner], (c3[back] > 1).astype(float) if len(k3) else None, len(n)) / np.maximum(n - 2, 1)
    nums = np.stack([np.log1p(n), mean, np.sqrt(np.maximum(var, 0)), np.bincount(doc, same, len(n)) / some, distinct / some, top / some, rep3, _share(_UPPER[b], o), _share(_DIGIT[b], o), _share(_SYMBOL[b], o), _share(_PUNCT[b], o)], axis=1)
    flags = np.zeros((len(n), len(terms)), bool)
    if len(h) and len(terms):
        at, ids = _terms(w)
        place = np.minimum(np.searchsorted(terms, ids), len(terms) - 1)
        hit = terms[place] == ids
        flags[at[hit], place[hit]] = True
    return nums, flags


def page_view(lang: pa.Array, source: pa.Array, size: pa.Array, langs: list, sources: list) -> tuple[np.ndarray, np.ndarray]:
    """From the columns lang, source and n_chars, never from the text. Flags: each language and source that is known, the others
    together, no size, and the size's power of two; no two share a flag."""
    n = len(lang)
    none = size.is_null().to_numpy(zero_copy_only=False)
    number = np.maximum(size.fill_null(0).to_numpy(zero_copy_only=False).astype(np.float64), 0)
    cols = []
    for col, known in ((lang, langs), (source, sources)):
        at = pc.index_in(col, value_set=pa.array(known, pa.string())).fill_null(len(known)).to_numpy(zero_copy_only=False)
        cols.append(at[:, None] == np.arange(len(known) + 1))
    cols += [none[:, None], np.minimum(np.log2(number + 1).astype(int), SIZES - 1)[:, None] == np.arange(SIZES)]
    return np.log1p(number).reshape(n, 1), np.concatenate(cols, axis=1)


def measured(part: pa.RecordBatch, known: dict) -> pa.Array:
    """part: text, lang, source, n_chars. Both views of each row as bytes: numbers as float32, then flags as bits."""
    b, o = K.buffers(part.column(0))
    t, p = text_view(b, o, known["terms"]), page_view(part.column(1), part.column(2), part.column(3), known["langs"], known["sources"])
    raw = np.concatenate([np.concatenate([t[0], p[0]], axis=1).astype(np.float32).view(np.uint8), np.packbits(np.concatenate([t[1], p[1]], axis=1), axis=1)], axis=1)
    return pa.array([r.tobytes() for r in raw], pa.binary())


def views(col: pa.Array, known: dict) -> tuple[np.ndarray, np.ndarray]:
    """Both views of a column of measured rows."""
    k, flags = TEXT_NUMBERS + PAGE_NUMBERS, len(known["terms"]) + len(known["langs"]) + len(known["sources"]) + 3 + SIZES
    raw = np.frombuffer(b"".join(col.to_pylist()), np.uint8).reshape(len(col), 4 * k + (flags + 7) // 8)
    x = np.ascontiguousarray(raw[:, : 4 * k]).view(np.float32).astype(np.float64)
    f = np.unpackbits(raw[:, 4 * k :], axis=1, count=flags).astype(np.float64)
    n = len(known["terms"])
    return np.concatenate([x[:, :TEXT_NUMBERS], f[:, :n]], axis=1), np.concatenate([x[:, TEXT_NUMBERS:], f[:, n:]], axis=1)


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, l2: float = 1e-3, steps: int = 25) -> np.ndarray:
    """Newton's method; the last coefficient is the intercept."""
    x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    w = np.zeros(x.shape[1])
    weight = weight / max(weight.sum(), 1e-9)
    reg = np.full(x.shape[1], l2 + 1 / max(len(x), 1))
    reg[-1] = 1e-9
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (p - y)) + reg * w
        hess = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.diag(reg)
        step = np.linalg.solve(hess, grad)
        w -= step / max(1.0, np.abs(step).max() / 5)
        if np.abs(step).max() < 1e-6:
            break
    return w


def _raw(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return np.clip(x @ w[:-1] + w[-1], -30, 30)


def _given(xs: tuple[np.ndarray, np.ndarray], past: list[list[np.ndarray]]) -> list[np.ndarray]:
    """What each view has been given by the other over the rounds whose models are ``past``: 1, 0, or -1 for nothing. The first label stays."""
    pseudo = [np.full(len(xs[0]), -1.0), np.full(len(xs[0]), -1.0)]
    for models in past:
        for i in (0, 1):
            p = 1 / (1 + np.exp(-_raw(xs[i], models[i])))
            free = pseudo[1 - i] < 0
            pseudo[1 - i][free & (p >= SURE)] = 1.0
            pseudo[1 - i][free & (1 - p >= SURE)] = 0.0
    return pseudo


def _sums(x: np.ndarray, y: np.ndarray, weight: float, w: np.ndarray) -> np.ndarray:
    """Gradient, Hessian, log loss, weight and number of rows for a Newton step at w, one after the other: they add up over parts of the rows."""
    x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    z = x @ w
    p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    hess = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x
    return np.concatenate([x.T @ (weight * (p - y)), hess.ravel(), [weight * (np.logaddexp(0, z) - y * z).sum(), weight * len(x), len(x)]])


def _step(sums: np.ndarray, w: np.ndarray, l2: float = 1e-3) -> tuple[float, np.ndarray]:
    """The loss at w, and the move to be taken off."""
    k = len(w)
    weight, n = max(sums[-2], 1e-9), sums[-1]
    reg = np.full(k, l2 + 1 / max(n, 1))
    reg[-1] = 1e-9
    step = np.linalg.solve(sums[k : k + k * k].reshape(k, k) / weight + np.diag(reg), sums[:k] / weight + reg * w)
    return sums[-3] / weight + 0.5 * float(reg @ (w * w)), step / max(1.0, np.abs(step).max() / 5)


def fit(xs: tuple[np.ndarray, np.ndarray], y: np.ndarray, others: Callable[[dict], list[np.ndarray]], rounds: int = ROUNDS, steps: int = 25) -> dict[str, np.ndarray]:
    """Labelled rows xs, y in order. Each round each view is fitted on labels and on what the other view has labelled, and hands over
    every row without a label of which it is sure. ``others`` gives the sums of _sums over those rows, for both views."""
    n = len(y)
    if not n or y.min() == y.max():
        p = (y.sum() + 0.5) / (n + 1)
        return {"prior": np.float64(np.log(p / (1 - p)))}
    calib = np.arange(n) % round(1 / CALIBRATE) == 0
    if len(set(y[calib].tolist())) < 2 or len(set(y[~calib].tolist())) < 2:
        calib = np.zeros(n, bool)
    mean, sd = [x.mean(0) for x in xs], [np.maximum(x.std(0), 1e-3) for x in xs]
    for k, m, d in zip((TEXT_NUMBERS, PAGE_NUMBERS), mean, sd, strict=True):  # flags stay as they are
        m[k:], d[k:] = 0, 1
    xs = tuple((x - m) / s for x, m, s in zip(xs, mean, sd, strict=True))
    # Sums of parts differ in the last bits with the parts' order; rounded weights do not.
    models = [np.round(_logistic(x[~calib], y[~calib], np.ones((~calib).sum())), 6) for x in xs]
    past: list[list[np.ndarray]] = []
    for _ in range(rounds):
        past.append(models)
        best = [(np.inf, w, w) for w in models]  # loss, place and move
        for _ in range(steps):
            own = others({"mean": mean, "sd": sd, "past": past, "at": models})
            for i in (0, 1):
                loss, move = _step(_sums(xs[i][~calib], y[~calib], 1.0, models[i]) + own[i], models[i])
                if loss <= best[i][0] + 1e-12:
                    best[i] = (loss, models[i], move)
                else:  # too far: half the way from the best place
                    best[i] = (best[i][0], best[i][1], best[i][2] / 2)
            models = [w - d for _, w, d in best]
            if max(np.abs(d).max() for _, _, d in best) < 1e-6:
                break
        models = [np.round(w, 6) for w in models]
    ref = calib if calib.any() else np.ones(n, bool)
    z = np.stack([_raw(xs[i][ref], models[i]) for i in (0, 1)], axis=1)
    platt = [_logistic(z[:, i : i + 1], y[ref], np.ones(ref.sum()), 1e-2) for i in (0, 1)]
    cal = np.stack([_raw(z[:, i : i + 1], platt[i]) for i in (0, 1)], axis=1)
    return {"m0": mean[0], "m1": mean[1], "s0": sd[0], "s1": sd[1], "w0": models[0], "w1": models[1], "p0": platt[0], "p1": platt[1], "mix": _logistic(cal, y[ref], np.ones(ref.sum()), 1e-2)}


def predict(m: dict[str, np.ndarray], xs: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Score of both views together, and calibrated score of each."""
    sig = lambda z: 1 / (1 + np.exp(-z))
    if "prior" in m:
        p = np.full(len(xs[0]), sig(float(m["prior"])))
        return p, p, p
    cal = np.stack([_raw(_raw((x - m[f"m{i}"]) / m[f"s{i}"], m[f"w{i}"])[:, None], m[f"p{i}"]) for i, x in enumerate(xs)], axis=1)
    return sig(_raw(cal, m["mix"])), sig(cal[:, 0]), sig(cal[:, 1])


def _known(sample: DataFrame) -> dict:
    """What the views look for, from the sample alone: the TERMS buckets that tell most about the label, languages and sources that occur twice."""
    often = lambda c: sorted(r[0] for r in sample.groupBy(c).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(c).collect())  # noqa: E731  fewer than half the sample's rows
    found = telling_terms(sample, lambda col: _terms(K.words(*K.buffers(col))), BUCKETS, TERMS)
    return {"terms": found, "langs": often("_lang"), "sources": often("_src")}


def quality_classifier(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", max_labelled: int = MAX_LABELLED, threshold: float = 0.5) -> DataFrame:
    """One row per input row: id, held_out, score (1: good), score_text, score_page, kept. Reads columns text, lang, source and, if there, n_chars.

    Two logistic models see different columns of a row, the text's words and pairs of words, and the page's metadata (lang, source,
    n_chars), and hand each other confident pseudo-labels; both are calibrated on labelled rows that neither was fitted on, and a third small
    model joins them. They are fitted on the rows of at most ``max_labelled`` labelled ids (those of least keyed hash) and on all rows without
    a label: these are measured once, and each Newton step adds up their gradients and Hessians where they lie. Rows with
    crc32(id) modulo 4 equal 2 teach no label. All rows are scored. Null text is empty, null lang and source are values of
    their own, a null or missing n_chars is a flag, several labels of an id: the largest. Without labels of both kinds all rows score the prior.
    Rows that repeat an id and text teach once and score alike. Other columns are ignored. No rows in, no rows out.
    """
    names = {"_t": F.coalesce(F.col("text"), F.lit("")), "_lang": F.coalesce(F.col("lang").cast("string"), F.lit(NULL)), "_src": F.coalesce(F.col("source").cast("string"), F.lit(NULL)), "_n": F.col("n_chars").cast("long") if "n_chars" in docs.columns else F.lit(None).cast("long")}
    base = docs.select(F.col(id_col).alias("_id"), *[c.alias(n) for n, c in names.items()])
    y = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_k")).agg(F.max(label_col).cast("int").alias("_y"))
    kind = docs.schema[id_col].dataType.simpleString()
    sample = written(examples(base, labels.filter(~held_out(id_col)), id_col, label_col, max_labelled, 7), "sample")
    known = _known(sample)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                part = b.slice(lo, 512)
                yield pa.RecordBatch.from_arrays([part.column(0), measured(part.select([1, 2, 3, 4]), known)], names=["_id", "f"])

    rows = base.mapInArrow(K.releasing(measure), f"_id {kind}, f binary").join(y, F.col("_id") == F.col("_k"), "left")
    rows = written(rows.select("_id", "_y", "f"), "measured")
    own = sample.select("_y", "_t", "_lang", "_src", "_n").mapInArrow(K.releasing(measure), "_id int, f binary").collect()  # 2 x max_labelled rows at most, some 100 bytes each
    own = sorted((r[0], bytes(r[1])) for r in own)
    free = rows.filter("_y IS NULL").select("f").coalesce(2 * docs.sparkSession.sparkContext.defaultParallelism)

    def others(now: dict) -> list[np.ndarray]:
        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = [np.zeros(len(w) * (len(w) + 1) + 3) for w in now["at"]]
            for b in batches:
                for lo in range(0, b.num_rows, 4096):
                    x = tuple((v - m) / s for v, m, s in zip(views(b.column(0).slice(lo, 4096), known), now["mean"], now["sd"], strict=True))
                    for i, t in enumerate(_given(x, now["past"])):
                        total[i] += _sums(x[i][t >= 0], t[t >= 0], PSEUDO, now["at"][i])
            yield pa.RecordBatch.from_arrays([pa.array([t.tobytes()], pa.binary()) for t in total], names=["a", "b"])

        parts = free.mapInArrow(K.releasing(add), "a binary, b binary").collect()  # as many as there are cores, twice
        return [sum((np.frombuffer(r[i]) for r in parts), np.zeros(len(w) * (len(w) + 1) + 3)) for i, w in enumerate(now["at"])]

    order = np.random.Generator(np.random.PCG64(7)).permutation(len(own))
    x = views(pa.array([own[i][1] for i in order], pa.binary()), known) if own else (np.zeros((0, 1)), np.zeros((0, 1)))
    model = pack(fit(x, np.array([own[i][0] for i in order], np.float64), others))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = unpack(model)
        for b in batches:
            for lo in range(0, b.num_rows, 4096):
                part = b.slice(lo, 4096)
                s = predict(m, views(part.column(2), known))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *(pa.array(x) for x in s)], names=["_id", "held_out", "score", "score_text", "score_page"])

    out = rows.select("_id", held_out("_id").alias("held_out"), "f").mapInArrow(K.releasing(score), f"_id {kind}, held_out boolean, score double, score_text double, score_page double")
    return out.withColumnRenamed("_id", id_col).withColumn("kept", F.col("score") >= threshold)
