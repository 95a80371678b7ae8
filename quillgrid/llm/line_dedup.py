"""Line deduplication over a suffix array of line ids, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import written

#: A run counts from so many lines on, or, if it has fewer, from so many words on.
MIN_LINES, MIN_WORDS = 4, 50


def _named(df: DataFrame) -> DataFrame:
    """df: d, h, i, a, b, ... Keeps the suffixes whose name (a, b) occurs more than once; adds first, the place of its first occurrence."""
    place = F.struct(F.col("d").isNull().alias("z"), "d", "h", "i")
    groups = df.groupBy("a", "b").agg(F.count(F.lit(1)).alias("c"), F.min(place).alias("first")).filter("c > 1")
    groups = groups.select(F.col("a").alias("a2"), F.col("b").alias("b2"), "first")
    return df.join(groups, (F.col("a") == F.col("a2")) & (F.col("b") == F.col("b2"))).drop("a2", "b2")


def repeated_runs(lines: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS) -> DataFrame:
    """``lines``: d, h (document key), i (place), a, b (128-bit line id), n (words). Returns d, h, i, run: the run lines from i on are a later copy.

    Prefix doubling: a suffix is named by its first 1, 2, 4, ... lines; the name of twice the width is made of the
    names of the suffix itself and of the one a width on. Suffixes of one name are an interval of the suffix array
    whose longest common prefix has at least that width; the order inside an interval is not needed, so names are
    digests and nothing is sorted globally. A suffix whose name is unique, or that has fewer lines left, leaves:
    only intervals with two members or more go on. An interval of a width in between has two overlapping names of the power
    of two below. At ``min_lines`` every later member of an interval is a copy, at smaller widths those with ``min_words``
    words or more. A maximal repeated run that counts is covered by such prefixes, so no wider ones are needed.
    """
    by_doc = Window.partitionBy("d", "h").orderBy("i")
    # Lines of an interval's prefix have stayed, all of them, so running sums over the lines that stayed give its words.
    upto = F.sum("n").over(by_doc.rowsBetween(Window.unboundedPreceding, 0))
    state = written(_named(lines).select("d", "h", "i", "a", "b", "first", "n", upto.alias("e")), "names1").withColumn("s", F.col("e") - F.col("n")).drop("n")
    later = F.struct(F.col("d").isNull().alias("z"), "d", "h", "i") > F.col("first")
    least = lambda width: F.lit(True) if width >= min_lines else F.col("e") - F.col("s") >= min_words
    copies = lambda names, width: names.filter(later & least(width)).select("d", "h", "i", F.lit(width).alias("run"))

    def longer(names: DataFrame, step: int) -> DataFrame:
        ahead = by_doc.rangeBetween(step, step)
        pairs = names.select("d", "h", "i", "a", "b", "s", F.max("a").over(ahead).alias("a1"), F.max("b").over(ahead).alias("b1"), F.max("e").over(ahead).alias("e")).filter("a1 IS NOT NULL")
        return _named(pairs.select("d", "h", "i", F.xxhash64("a", "a1").alias("a"), F.xxhash64(F.lit(1), "b", "b1").alias("b"), "s", "e"))

    out, power = copies(state, 1), 1
    for width in range(2, min_lines + 1):
        if width == 2 * power:
            state, power = written(longer(state, power), "names"), width
            out = out.unionByName(copies(state, width))
        else:
            out = out.unionByName(copies(longer(state, width - power), width))
    return out.groupBy("d", "h", "i").agg(F.max("run").alias("run"))


def line_dedup(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_lines, n_deleted, text (without later copies of repeated runs).

    Lines are split at \\n and compared as they stand. Lines without a word are not part of the sequence: they
    neither break runs nor go away. Documents are ordered by id (null last) and digest of the text. Of every run of
    ``min_lines`` or more lines, or of ``min_words`` or more words, that occurs before, in this document or an earlier
    one, all lines go. Work and memory are in proportion to a text's lines, however often it repeats itself.
    Rows equal in id and text are one document and get the same result. Null text is empty: one line, nothing
    deleted, text "". A document may lose all its lines. Other columns are ignored. No rows in, no rows out.
    """
    key = docs.select(F.col(id_col).alias("d"), F.coalesce(F.col(text_col), F.lit("")).alias("_t")).select("d", F.xxhash64("_t").alias("h"), "_t")
    seq = key.select("d", "h", F.posexplode(F.filter(F.split("_t", "\n"), lambda s: s.rlike(r"[^\x20\x09-\x0D]"))).alias("i", "_s"))
    seq = seq.select("d", "h", "i", F.xxhash64("_s").alias("a"), F.xxhash64(F.lit(1), "_s").alias("b"), F.regexp_count("_s", F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("n"))
    seq = seq.groupBy("d", "h", "i").agg(F.first("a").alias("a"), F.first("b").alias("b"), F.first("n").alias("n"))
    runs = repeated_runs(seq, min_lines, min_words)
    # A run has min_lines lines at most, so a text's marks are in proportion to its lines.
    gone = runs.select("d", "h", F.explode(F.expr("sequence(i, i + run - 1)")).alias("i")).groupBy("d", "h").agg(F.collect_set("i").alias("_gone"))
    gone = gone.withColumnsRenamed({"d": "d2", "h": "h2"})
    x = key.join(gone, F.col("d").eqNullSafe(F.col("d2")) & (F.col("h") == F.col("h2")), "left")
    x = x.select("d", F.split("_t", "\n").alias("_all"), "_gone", "_t")
    # _at: places of the lines with words; what goes is taken from all places as a set, so a text of many lines costs no more than in proportion.
    x = x.select("*", F.filter(F.transform("_all", lambda s, p: F.when(s.rlike(r"[^\x20\x09-\x0D]"), p).otherwise(-1)), lambda p: p >= 0).alias("_at"))
    left = F.expr("array_except(sequence(0, size(_all) - 1), transform(_gone, i -> element_at(_at, i + 1)))")
    x = x.select("*", left.alias("_left"))
    kept = F.when(F.col("_gone").isNull(), F.col("_t")).otherwise(F.array_join(F.transform("_left", lambda p: F.element_at("_all", p + 1)), "\n"))
    return x.select(F.col("d").alias(id_col), F.size("_all").cast("long").alias("n_lines"), F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("_nd"), kept.alias("text"), F.col("_gone").isNull().alias("_none")).select(
        id_col, "n_lines", F.when(F.col("_none"), F.lit(0)).otherwise(F.col("_nd")).cast("long").alias("n_deleted"), "text"
    )


_LEAD = [f"lead(s, {k}) OVER w" for k in range(1, MIN_LINES)]
_MORE = [f"coalesce(lead(n, {k}) OVER w, 0)" for k in range(1, MIN_LINES)]
_WIDTHS = "\n  UNION ALL ".join(
    f"SELECT rid, doc_id, i, {w} AS run, {' + '.join(['n'] + [f'n{k}' for k in range(1, w)])} AS n, md5(concat_ws(chr(10), {', '.join(['s'] + [f's{k}' for k in range(1, w)])})) AS t FROM win WHERE i + {w - 1} <= last" for w in range(1, MIN_LINES + 1)
)
ORACLE = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS tx FROM documents),
ls AS (SELECT rid, doc_id, unnest(string_split(tx, chr(10))) AS s, generate_subscripts(string_split(tx, chr(10)), 1) AS p FROM d),
q AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY p) AS i, count(*) OVER (PARTITION BY rid) AS last,
        len(list_filter(string_split_regex(s, '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS n FROM ls WHERE regexp_matches(s, '[^\x20\x09-\x0D]')),
win AS (SELECT rid, doc_id, i, last, s, n, {", ".join(f"{x} AS s{k}" for k, x in enumerate(_LEAD, 1))}, {", ".join(f"{x} AS n{k}" for k, x in enumerate(_MORE, 1))} FROM q WINDOW w AS (PARTITION BY rid ORDER BY p)),
x AS ({_WIDTHS}),
rep AS (SELECT rid, i, run, n, row_number() OVER (PARTITION BY run, t ORDER BY doc_id NULLS LAST, i) AS k FROM x),
gone AS (SELECT DISTINCT rid, unnest(range(i, i + run)) AS i FROM rep WHERE k > 1 AND (run >= {MIN_LINES} OR n >= {MIN_WORDS})),
keep AS (SELECT ls.rid, ls.p, ls.s FROM ls LEFT JOIN q ON ls.rid = q.rid AND ls.p = q.p LEFT JOIN gone g ON g.rid = q.rid AND g.i = q.i WHERE g.rid IS NULL),
tx AS (SELECT rid, string_agg(s, chr(10) ORDER BY p) AS tx FROM keep GROUP BY rid),
gn AS (SELECT rid, count(*) AS n FROM gone GROUP BY rid)
SELECT d.doc_id, len(string_split(d.tx, chr(10)))::BIGINT AS n_lines, coalesce(gn.n, 0)::BIGINT AS n_deleted, sha256(coalesce(tx.tx, '')) AS text_sha256
FROM d LEFT JOIN tx USING (rid) LEFT JOIN gn USING (rid)
"""
