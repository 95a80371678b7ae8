"""Connectionist temporal classification: collapsing paths, exact likelihoods, prefix beams."""

from __future__ import annotations

import itertools
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def collapse(df: DataFrame, keys: list[str], order: list[str], symbol: str, blank: str) -> DataFrame:
    """keys, path: symbols in order, each run of equal ones once, blanks out."""
    w = Window.partitionBy(*keys).orderBy(*order)
    x = df.withColumn("_prev", F.lag(symbol).over(w)).filter((F.col(symbol) != blank) & (F.col("_prev").isNull() | (F.col(symbol) != F.col("_prev"))))
    part = F.struct(*[F.col(c) for c in order], F.col(symbol).alias("_s"))
    return x.groupBy(*keys).agg(F.array_sort(F.collect_list(part)).alias("_p")).select(*keys, F.transform("_p", lambda p: p["_s"]).alias("path"))


def greedy(probs: np.ndarray, blank: int = 0) -> list[int]:
    best = probs.argmax(1)
    return [int(k) for i, k in enumerate(best) if k != blank and (i == 0 or k != best[i - 1])]


def log_likelihood(probs: np.ndarray, labels: Sequence[int], blank: int = 0) -> float:
    """Log probability of a label sequence over all its alignments, by the forward recursion in log space."""
    logp = np.log(np.maximum(probs, 1e-300))
    ext = [blank]
    for k in labels:
        ext += [int(k), blank]
    ext_a = np.array(ext)
    skip = np.zeros(len(ext), bool)
    skip[2:] = (ext_a[2:] != blank) & (ext_a[2:] != ext_a[:-2])
    a = np.full(len(ext), -np.inf)
    a[0] = logp[0, blank]
    if len(ext) > 1:
        a[1] = logp[0, ext[1]]
    for row in logp[1:]:
        one = np.concatenate([[-np.inf], a[:-1]])
        two = np.where(skip, np.concatenate([[-np.inf, -np.inf], a[:-2]])[: len(ext)], -np.inf)
        a = np.logaddexp(np.logaddexp(a, one), two) + row[ext_a]
    return float(np.logaddexp(a[-1], a[-2]) if len(ext) > 1 else a[-1])


def brute_force_likelihood(probs: np.ndarray, labels: Sequence[int], blank: int = 0) -> float:
    """The same by listing every alignment; for tests."""
    total = 0.0
    for path in itertools.product(range(probs.shape[1]), repeat=len(probs)):
        got = [k for i, k in enumerate(path) if k != blank and (i == 0 or k != path[i - 1])]
        if got == list(labels):
            total += float(np.prod([probs[i, k] for i, k in enumerate(path)]))
    return float(np.log(total)) if total else float("-inf")


def prefix_beam(probs: np.ndarray, beam: int = 16, top: int = 5, blank: int = 0) -> list[tuple[tuple[int, ...], float]]:
    """Most likely label sequences: prefixes with their probability of ending in a blank and not, the best ``beam`` kept each step."""
    logp = np.log(np.maximum(probs, 1e-300))
    inf = -np.inf
    state: dict[tuple[int, ...], tuple[float, float]] = {(): (0.0, inf)}
    for row in logp:
        nxt: dict[tuple[int, ...], list[float]] = {}

        def add(prefix: tuple[int, ...], which: int, value: float) -> None:
            cell = nxt.setdefault(prefix, [inf, inf])  # noqa: B023
            cell[which] = float(np.logaddexp(cell[which], value))

        for prefix, (b, nb) in state.items():
            both = float(np.logaddexp(b, nb))
            add(prefix, 0, both + row[blank])
            for k in range(len(row)):
                if k == blank:
                    continue
                if prefix and prefix[-1] == k:
                    add(prefix, 1, nb + row[k])
                    add((*prefix, k), 1, b + row[k])
                else:
                    add((*prefix, k), 1, both + row[k])
        ranked = sorted(nxt.items(), key=lambda e: (-np.logaddexp(*e[1]), e[0]))[:beam]
        state = {p: (v[0], v[1]) for p, v in ranked}
    return [(p, float(np.logaddexp(*v))) for p, v in sorted(state.items(), key=lambda e: (-np.logaddexp(*e[1]), e[0]))[:top]]
