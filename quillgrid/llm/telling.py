"""Terms that tell most about a label."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkernel as K

SLICE = 512


def telling_terms(sample: DataFrame, terms: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]], buckets: int, most: int, least: float = 5.0) -> np.ndarray:
    """The ``most`` buckets of greatest G (likelihood ratio test of a bucket's presence and the label), sorted; those in one row only, or with a
    G of ``least`` or less, are left out. ``sample``: _t, _y (0 or 1), a bounded sample. ``terms`` gives text number and bucket of each term.

    Rows are counted where they lie, in arrays of ``buckets`` numbers; buckets are added up and tested by Spark, and only
    ``most`` reach the driver. Without rows of both labels there are none.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((2, buckets), np.int64)
        for b in batches:
            for lo in range(0, b.num_rows, SLICE):
                part = b.slice(lo, SLICE)
                doc, ids = terms(part.column(0))
                key = np.unique(doc * buckets + ids)
                y = part.column(1).to_numpy(zero_copy_only=False)[key // buckets]
                for k in (0, 1):
                    n[k] += np.bincount(key[y == k] % buckets, minlength=buckets)
        some = np.flatnonzero(n.sum(0))
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(n[0, some]), pa.array(n[1, some])], names=["id", "a", "b"])

    total = {r._y: r.n for r in sample.groupBy("_y").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = float(total.get(0, 0)), float(total.get(1, 0))
    if not all(rows):
        return np.zeros(0, np.int64)
    c = sample.select("_t", "_y").mapInArrow(K.releasing(count), "id long, a long, b long").groupBy("id").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).filter("a + b > 1")
    there, all_rows, g = F.col("a") + F.col("b"), sum(rows), F.lit(0.0)
    for have, n in ((F.col("a"), rows[0]), (F.col("b"), rows[1])):
        for got, mean in ((have, there * n / all_rows), (n - have, (all_rows - there) * n / all_rows)):
            g += F.when((got > 0) & (mean > 0), 2 * got * F.log(got / mean)).otherwise(0.0)
    best = c.select("id", F.round(g, 9).alias("g")).filter(F.col("g") > least).orderBy(F.col("g").desc(), "id").limit(most)
    return np.array(sorted(r.id for r in best.collect()), np.int64)


def examples(docs: DataFrame, labels: DataFrame, id_col: str, label_col: str, most: int, seed: int) -> DataFrame:
    """_id, _y and the columns of ``docs`` (_id, _t, ...) of the rows of at most ``most`` labelled ids, those of least keyed hash; several labels of an id: the largest.

    Each distinct text of an id is one row, however often it is repeated. Where ids have many texts, each id has one of them, and others
    fill up to 2 * ``most`` rows by keyed hash, whatever their label, so no id pushes others out. Only ids and digests are broadcast (12 and 16 bytes each).
    """
    y = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_k")).agg(F.max(label_col).cast("int").alias("_y"))
    some = F.broadcast(y.orderBy(F.xxhash64(F.lit(seed), "_k"), "_k").limit(most))
    keyed = docs.select("*", F.xxhash64("_t").alias("_h")).join(some, F.col("_id") == F.col("_k"))
    keys = keyed.select("_id", "_h").distinct().withColumn("_r", F.xxhash64(F.lit(seed), "_id", "_h"))
    first = keys.groupBy(F.col("_id").alias("_i3")).agg(F.min_by("_h", F.struct("_r", "_h")).alias("_h3"))  # a row for each sampled id
    keys = keys.join(F.broadcast(first), F.col("_id") == F.col("_i3")).orderBy(F.col("_h") != F.col("_h3"), "_r", "_id").limit(2 * most)
    keys = keys.select(F.col("_id").alias("_i2"), F.col("_h").alias("_h2"))
    taught = keyed.join(F.broadcast(keys), (F.col("_id") == F.col("_i2")) & (F.col("_h") == F.col("_h2")))
    rest = [c for c in docs.columns if c not in ("_id", "_t")]
    more = [F.min(F.struct(*rest)).alias("_m")] if rest else []
    return taught.groupBy("_id", "_h", "_y").agg(F.min("_t").alias("_t"), *more).select("_id", "_y", "_t", *[F.col(f"_m.{c}").alias(c) for c in rest])
