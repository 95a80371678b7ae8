"""Exact deduplication: group by a 128-bit content hash, compare bytes inside groups, keep one stable id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _keyed(docs: DataFrame, id_col: str, text_col: str, normalise) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("_id"), (normalise(text) if normalise else text).alias("_t"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "max", normalise=None) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    1. Rows meet by (md5 of the text, the text itself): the hash deals them out, the text as second
       key compares whole bytes, so two texts with one md5 stay apart. Each task first adds up its own
       rows, so a text that a third of all rows share reaches the shuffle once per task.
    2. What leaves that aggregation has no text: (md5, sha256, kept id, size). Rows find their group by
       both digests; a hot key's rows are small, and the join is one that adaptive execution splits.

    ``keep``: "max" or "min" id stays. ``normalise``: a function from Column to Column (default: no change).
    Null text counts as empty. A null id never stays while its group has another; a group of null ids
    keeps one row with keep_id null. Rows repeated with id and text are told apart by an ordinal: one
    of them stays. Other columns are ignored. No rows in, no rows out.
    """
    best: Column = (F.max if keep == "max" else F.min)("_id")
    keyed = _keyed(docs, id_col, text_col, normalise)
    classes = (
        keyed.groupBy(F.md5(F.encode("_t", "utf-8")).alias("_h"), "_t")
        .agg(best.alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .select("_h", F.sha2(F.col("_t"), 256).alias("text_sha256"), "keep_id", "group_size")
    )
    members = keyed.select("_id", F.md5(F.encode("_t", "utf-8")).alias("_h"), F.sha2(F.col("_t"), 256).alias("_s"))
    members = members.groupBy("_h", "_s", "_id").agg(F.count(F.lit(1)).alias("_m"))
    joined = members.join(classes.withColumnsRenamed({"_h": "_h2"}), (F.col("_h") == F.col("_h2")) & (F.col("_s") == F.col("text_sha256")))
    return joined.select(
        F.col("_id"), "keep_id", "group_size", "text_sha256", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_m"))).alias("_k")
    ).select(
        F.col("_id").alias(id_col),
        "keep_id",
        "group_size",
        (F.col("_id").eqNullSafe(F.col("keep_id")) & (F.col("_k") == 1)).alias("kept"),
        "text_sha256",
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "max") -> DataFrame:
    """The rows of ``docs`` that exact_dedup keeps, with all their columns: one shuffle of the rows, no join.

    Null text and empty text are one group; the row that stays keeps its own value.
    """
    names = docs.columns
    t = F.coalesce(F.col(text_col), F.lit(""))
    order = F.struct(F.col(id_col).isNotNull().alias("a"), F.col(id_col).alias("b"))
    if keep != "max":
        order = F.struct(F.col(id_col).isNull().alias("a"), F.col(id_col).alias("b"))
    pick = F.max_by if keep == "max" else F.min_by
    # The text is only a key; the row that stays carries the others.
    rest = [i for i, c in enumerate(names) if c != text_col]
    slim = F.struct(*[F.col(f"`{names[i]}`").alias(f"c{i}") for i in rest], F.col(text_col).isNull().alias("_null"))
    out = docs.select(slim.alias("_row"), order.alias("_o"), t.alias("_t")).groupBy(F.md5(F.encode("_t", "utf-8")).alias("_h"), "_t").agg(pick("_row", "_o").alias("_row"))
    cols = [F.when(F.col("_row._null"), F.lit(None)).otherwise(F.col("_t")).alias(c) if c == text_col else F.col(f"_row.c{i}").alias(c) for i, c in enumerate(names)]
    return out.select(*cols)


ORACLE = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS tx FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY tx) AS keep_id,
       count(*) OVER (PARTITION BY tx) AS group_size,
       row_number() OVER (PARTITION BY tx ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(tx) AS text_sha256
FROM t
"""
