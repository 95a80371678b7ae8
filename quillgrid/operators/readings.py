"""Choosing among several readings of one value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

SOURCES = {"crop": 0, "line": 1, "ch": 2, "en": 3}


def _order(source: Column) -> Column:
    out = F.when(F.lit(False), 9)
    for name, k in SOURCES.items():
        out = out.when(source == name, k)
    return out.otherwise(4)


def agreeing_group(df: DataFrame, cell: str, numeric: Column) -> DataFrame:
    """One reading for each cell. df: cell, source, text, n_boxes, pos (order in which readings were made).

    Readings with one key (the number, or text without white space in upper case) are a group. Groups with a reading of
    one box at most are preferred; the largest group wins, then the one with the fewest boxes, then the first seen. A group of two or more gives
    the text of source ch, else en; otherwise the reading with the fewest boxes, by order of sources.
    """
    v = T.parse_number(F.col("text"), spaces=True)
    key = F.when(numeric & v.isNotNull(), F.concat(F.lit("n:"), v.cast("string"))).otherwise(F.concat(F.lit("t:"), T.comparison_key(F.col("text"))))
    r = df.filter(~T.blank(F.col("text"))).select(cell, key.alias("_k"), "source", "text", "n_boxes", "pos", v.alias("value"))
    rank = F.struct(F.col("n_boxes").alias("b"), _order(F.col("source")).alias("s"), F.col("pos").alias("p"))
    pick = F.struct("text", "source", "value")
    g = r.groupBy(cell, "_k").agg(
        F.count(F.lit(1)).alias("n"), F.min("n_boxes").alias("b"), F.min("pos").alias("p"), F.min_by(pick, rank).alias("few"),
        F.min_by(pick, F.when(F.col("source") == "ch", F.col("pos"))).alias("ch"), F.min_by(pick, F.when(F.col("source") == "en", F.col("pos"))).alias("en"),
    )
    chosen = F.when(F.col("n") > 1, F.coalesce(F.col("ch"), F.col("en"), F.col("few"))).otherwise(F.col("few"))
    best = g.groupBy(cell).agg(F.min_by(F.struct(chosen.alias("c"), F.col("n").alias("n")), F.struct((F.col("b") > 1).alias("e"), (-F.col("n")).alias("n"), F.col("b").alias("b"), F.col("p").alias("p"))).alias("_b"))
    return best.select(cell, F.col("_b.c.text").alias("text"), F.col("_b.c.source").alias("source"), F.col("_b.c.value").alias("value"), F.col("_b.n").alias("agreeing"))


def first_filled(*readings: Column) -> Column:
    """The first reading that is not blank."""
    return F.coalesce(*[F.when(~T.blank(c), c) for c in readings])


def first_number(*readings: Column) -> Column:
    """The first reading that is a number, else the first that is not blank."""
    return F.coalesce(*[F.when(T.parse_number(c, spaces=True).isNotNull(), c) for c in readings], first_filled(*readings))


def closed_set(candidates: Column, allowed: tuple[str, ...]) -> Column:
    """The first candidate that, stripped and in upper case, is one of the allowed values; else null."""
    ok = F.filter(F.transform(candidates, lambda c: F.upper(T.strip(c))), lambda c: c.isin(*allowed))
    return F.try_element_at(ok, F.lit(1))


def line_options(primary: Column, secondary: Column) -> Column:
    """Lines of both readings side by side, the shorter one filled with empty lines."""
    return F.transform(F.arrays_zip(primary.alias("p"), secondary.alias("s")), lambda z: F.struct(F.coalesce(z["p"], F.lit("")).alias("p"), F.coalesce(z["s"], F.lit("")).alias("s")))


def vote_one(primary: Column, secondary: Column, valid) -> Column:
    """struct(text, changed, used_primary) with one replaced line at most: the primary if valid, else the first replacement
    of a differing, non-empty line that is valid and loses no double or triple bond, else the primary."""
    z = line_options(primary, secondary)

    def votes(lines: Column) -> Column:
        whole = F.array_join(F.transform(lines, lambda x: x["p"]), "")

        def choose(text: Column) -> Column:
            tries = F.transform(
                F.filter(F.transform(lines, lambda x, i: F.struct(i.alias("i"), x["p"].alias("p"), x["s"].alias("s"))), lambda x: (x["p"] != x["s"]) & (x["s"] != "")),
                lambda c: F.array_join(F.transform(lines, lambda x, i: F.when(i == c["i"], c["s"]).otherwise(x["p"])), ""),
            )
            good = F.filter(tries, lambda u: valid(u) & (T.bond_count(u) >= T.bond_count(text)))
            hit = F.try_element_at(good, F.lit(1))
            keep = valid(text) | hit.isNull()
            return F.struct(F.when(keep, text).otherwise(hit).alias("text"), F.when(keep, 0).otherwise(1).alias("changed"), keep.alias("used_primary"))

        return T.let(whole, choose)

    return T.let(z, votes)


def longer(primary: Column, secondary: Column) -> Column:
    return F.array_join(F.transform(line_options(primary, secondary), lambda z: F.when(F.length(z["s"]) > F.length(z["p"]), z["s"]).otherwise(z["p"])), "")


def shorter(primary: Column, secondary: Column) -> Column:
    return F.array_join(F.transform(line_options(primary, secondary), lambda z: F.when((F.length(z["s"]) < F.length(z["p"])) & (z["s"] != ""), z["s"]).otherwise(z["p"])), "")


def products(primary: Column, secondary: Column) -> Column:
    """All texts that a choice of either reading in each line gives, each once, the primary's lines first. Twice as many for each line that differs."""
    empty = F.array(F.lit(""))
    return F.aggregate(line_options(primary, secondary), empty, lambda acc, z: F.array_distinct(F.flatten(F.transform(acc, lambda x: F.array(F.concat(x, z["p"]), F.concat(x, z["s"]))))))


def first_of(texts: Column, *tests) -> Column:
    """The first text that meets a test, tests in order; else the last text."""
    return F.coalesce(*[F.try_element_at(F.filter(texts, t), F.lit(1)) for t in tests], F.try_element_at(texts, F.lit(-1)))
