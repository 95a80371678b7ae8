"""Vectors: best matches by cosine, agreement of arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Probes that are compared with a vector at once.
BLOCK = 64


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def best_match(vectors: DataFrame, probes: DataFrame, id_col: str, vector_col: str, places: int = 6) -> DataFrame:
    """probe, id, score: for each probe the other vector of greatest cosine, the least id of equals (scores rounded). Vectors of length 0 score 0.

    Probes are a stated set of queries. They lie in blocks of about BLOCK, and each vector meets each block once: an equal join on the
    block's number, which the planner does by broadcast or by shuffle, as the size allows. A probe's best is kept within tasks first.
    """
    n = -(-probes.count() // BLOCK)
    if not n:
        return vectors.select(F.col(id_col).alias("probe"), id_col, F.lit(0.0).alias("score")).limit(0)
    unit = lambda c: F.transform(c, lambda x: x.cast("double"))
    size = lambda c: F.sqrt(dot(c, c))
    q = probes.select(F.col(id_col).alias("probe"), unit(F.col(vector_col)).alias("pe")).withColumn("pn", size(F.col("pe")))
    q = q.groupBy(F.pmod(F.xxhash64("probe"), F.lit(n)).alias("_block")).agg(F.collect_list(F.struct("probe", "pe", "pn")).alias("_qs"))
    v = vectors.select(id_col, unit(F.col(vector_col)).alias("_e")).withColumn("_n", size(F.col("_e"))).withColumn("_b", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    x = v.join(q, F.col("_b") == F.col("_block")).select(id_col, "_e", "_n", F.explode("_qs").alias("_q")).filter(F.col(id_col) != F.col("_q.probe"))
    both = F.col("_n") * F.col("_q.pn")
    score = F.round(F.when(both > 0, dot(F.col("_e"), F.col("_q.pe")) / both).otherwise(0.0), places)
    x = x.select(F.col("_q.probe").alias("probe"), id_col, score.alias("score"))
    return x.groupBy("probe").agg(F.min_by(F.struct(id_col, "score"), F.struct(-F.col("score"), id_col)).alias("_m")).select("probe", "_m.*")


def agreeing_share(a: Column, b: Column) -> Column:
    """Share of places at which two arrays agree; 0 if they are of different or no length."""
    n = F.size(a)
    same = F.aggregate(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y).cast("int")), F.lit(0), lambda s, x: s + x)
    return F.when((n > 0) & (n == F.size(b)), same / n).otherwise(0.0)
