"""Ordered operators: carried layouts, continued rows, clusters by gap, runs, nearest borders, interval joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def carry_forward(df: DataFrame, keys: list[str], order: list[str], value: str, name: str) -> DataFrame:
    """The last non-null value before the row, within its key."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn(name, F.last(value, ignorenulls=True).over(w))


def continued_rows(df: DataFrame, layout: str, order: list[str], id_col: str, text: str) -> DataFrame:
    """Rows without an id continue the numbered row before them in their layout: (layout, row, id, text joined, parts).

    Rows before the first id belong to none and are left out.
    """
    w = Window.partitionBy(layout).orderBy(*order)
    x = df.withColumn("_isle", F.count(id_col).over(w.rowsBetween(Window.unboundedPreceding, 0))).filter("_isle > 0")
    part = F.struct(*[F.col(c) for c in order], F.col(text).alias("_t"))
    g = x.groupBy(layout, F.col("_isle").alias("row")).agg(F.max(id_col).alias("id"), F.array_sort(F.collect_list(part)).alias("_p"))
    return g.select(layout, "row", "id", F.array_join(F.transform("_p", lambda p: p["_t"]), "").alias("text"), F.size("_p").alias("parts"))


def gap_clusters(df: DataFrame, keys: list[str], value: str, gap: float) -> DataFrame:
    """One-dimensional clusters: a new one begins where a value lies more than ``gap`` above the one before."""
    w = Window.partitionBy(*keys).orderBy(value)
    x = df.select(*keys, value, (F.col(value) - F.lag(value).over(w)).alias("_d"))
    x = x.select(*keys, value, F.sum(F.when(F.col("_d") > gap, 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cluster"))
    return x.groupBy(*keys, "cluster").agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean"), F.min(value).alias("lo"), F.max(value).alias("hi"))


def runs(df: DataFrame, keys: list[str], order: list[str], active: Column, least: int) -> DataFrame:
    """Maximal runs of consecutive active rows of ``least`` rows or more: (keys, first, last, n) by row number."""
    w = Window.partitionBy(*keys).orderBy(*order)
    x = df.select(*keys, F.row_number().over(w).alias("_i"), active.alias("_a"))
    x = x.filter("_a").select(*keys, "_i", (F.col("_i") - F.row_number().over(Window.partitionBy(*keys).orderBy("_i"))).alias("_g"))
    return x.groupBy(*keys, "_g").agg(F.min("_i").alias("first"), F.max("_i").alias("last"), F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least).drop("_g")


def same_boundaries(a: Column, b: Column, tolerance: float) -> Column:
    return (F.size(a) == F.size(b)) & F.forall(F.zip_with(a, b, lambda x, y: F.abs(x - y) <= tolerance), lambda ok: ok)


def boundary_groups(df: DataFrame, keys: list[str], order: list[str], boundaries: str, tolerance: float, least: int) -> DataFrame:
    """Consecutive bands whose boundaries agree with the band before within a tolerance; groups of ``least`` bands or more."""
    w = Window.partitionBy(*keys).orderBy(*order)
    x = df.withColumn("_new", F.when(same_boundaries(F.col(boundaries), F.lag(boundaries).over(w), tolerance), 0).otherwise(1))
    x = x.withColumn("_g", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return x.groupBy(*keys, F.col("_g").alias("block")).agg(F.count(F.lit(1)).alias("bands")).filter(F.col("bands") >= least)


def running_depth(c: Column) -> Column:
    """struct(final, lowest, first_negative): bracket depth along a text; first_negative is the place (from 1) where it falls below 0, or null."""
    steps = F.transform(F.filter(F.split(c, ""), lambda x: x != ""), lambda x: F.when(x.isin("(", "["), 1).when(x.isin(")", "]"), -1).otherwise(0))
    zero = F.struct(F.lit(0).alias("i"), F.lit(0).alias("d"), F.lit(0).alias("low"), F.lit(None).cast("int").alias("at"))

    def step(s, v):
        d = s["d"] + v
        return F.struct((s["i"] + 1).alias("i"), d.alias("d"), F.least(s["low"], d).alias("low"), F.coalesce(s["at"], F.when(d < 0, s["i"] + 1)).alias("at"))

    return F.aggregate(steps, zero, step, lambda s: F.struct(s["d"].alias("final"), s["low"].alias("lowest"), s["at"].alias("first_negative")))


def nth_dropped(c: Column, ch: str, keep: int) -> Column:
    """The text without the occurrences of a character after the first ``keep``."""
    parts = F.split(c, "\\Q" + ch + "\\E")
    head = F.array_join(F.slice(parts, 1, keep + 1), ch)
    return F.when(F.size(parts) > keep + 1, F.concat(head, F.array_join(F.slice(parts, keep + 2, F.size(parts)), ""))).otherwise(c)


def nearest(borders: Column, x: Column, within: float) -> Column:
    """The border nearest to x within a distance, the first of equals; null if none is. ``borders``: array of numbers."""
    zero = F.struct(F.lit(None).cast("double").alias("v"), F.lit(float("inf")).alias("d"))
    return F.aggregate(borders, zero, lambda s, b: F.when(F.abs(b - x) < s["d"], F.struct(b.cast("double").alias("v"), F.abs(b - x).cast("double").alias("d"))).otherwise(s), lambda s: F.when(s["d"] <= within, s["v"]))


def interval_lookup(bounds: Column, x: Column) -> Column:
    """Number of bounds at or below x: the interval (from 0) that x lies in."""
    return F.size(F.filter(bounds, lambda b: b <= x))


def next_label(lines: DataFrame, labels: DataFrame, keys: list[str], at: str, label: str) -> DataFrame:
    """Each line with the label whose interval (label before, own place] holds it, i.e. the next label at or after it.

    Both sides are put into one ordered stream for each key and the label is carried back: no range join.
    """
    a = lines.select(*keys, F.col(at).alias("_y"), F.lit(0).alias("_is"), F.lit(None).cast(dict(labels.dtypes)[label]).alias("_l"), F.struct(*[c for c in lines.columns if c not in keys]).alias("_row"))
    b = labels.select(*keys, F.col(at).alias("_y"), F.lit(1).alias("_is"), F.col(label).alias("_l"), F.lit(None).cast(a.schema["_row"].dataType).alias("_row"))
    w = Window.partitionBy(*keys).orderBy("_y", "_is").rowsBetween(0, Window.unboundedFollowing)
    x = a.unionByName(b).withColumn("_next", F.first("_l", ignorenulls=True).over(w)).filter("_is = 0")
    return x.select(*keys, "_row.*", F.col("_next").alias("label"))


def contained(points: DataFrame, boxes: DataFrame, key: str, x: str, y: str, scale: float = 1.0) -> DataFrame:
    """Points with the boxes of their page that hold them, borders included; the page is an equi key."""
    px, py = F.col(x) * scale, F.col(y) * scale
    return points.join(boxes, (points[key] == boxes[key]) & px.between(F.col("x1"), F.col("x2")) & py.between(F.col("y1"), F.col("y2"))).drop(boxes[key])
