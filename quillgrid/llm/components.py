"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import written


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(r)


def components(edges: DataFrame, max_steps: int = 60) -> DataFrame:
    """``edges``: u, v (long). Returns node, root for each node that has an edge to another one; root is the least node.

    Both steps are a grouped minimum, which is reduced within tasks first, and a join of the edges with
    one row per node; a hub's edges are never gathered. Every round is written to the shared folder.
    Only the number of edges and a checksum reach the driver. Loops and repeated edges are ignored, null ends, too.
    """
    e = written(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = _state(e)
    for _ in range(max_steps):
        if not before[0]:
            break
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, F.col("u") == F.col("k")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "k")
        small = large.join(down, F.col("u") == F.col("k")).select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v")
        e = written(small.filter("u <> v").distinct(), "edges")
        now = _state(e)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {max_steps} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
