"""Quality rules with cross-document line frequency, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A line is removed from a host's documents if more than this percentage of them hold it, and more than so many.
MAX_SHARE, MAX_DOCS = 10, 10
#: A document is depleted if less than this percentage of its words is left.
LEAST_LEFT = 50


def _measured(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    """Counts of each row, from its own text. Each select is a layer of its own, so that an array used twice is made once."""
    x = docs.select(F.col(id_col).alias("_id"), F.col(host_col).alias("_host"), F.coalesce(F.col(text_col), F.lit("")).alias("_t"))
    x = x.select("*", F.split("_t", r"[\x20\x09-\x0D]+").alias("_w0"), F.split("_t", "\n").alias("_l0"))
    x = x.select("*", F.filter("_w0", lambda w: w != "").alias("_w"), F.filter("_l0", lambda s: s.rlike(r"[^\x20\x09-\x0D]")).alias("_l"))
    x = x.select(
        "_id",
        "_host",
        F.xxhash64("_t").alias("_th"),
        F.size("_w").cast("long").alias("n_words"),
        (F.length("_t") - F.regexp_count("_t", F.lit(r"[\x20\x09-\x0D]"))).cast("long").alias("word_chars"),
        F.regexp_count("_t", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.transform("_w", lambda w: F.xxhash64(w)).alias("_h"),
    )
    # Windows of three words as hashes; hash above position in one long, so that a plain sort brings equal windows together.
    x = x.select("*", F.zip_with("_h", F.slice("_h", 2, F.greatest(F.size("_h"), F.lit(1))), lambda a, b: F.xxhash64(a, b)).alias("_h2"))
    x = x.select("*", F.slice(F.zip_with("_h2", F.slice("_h", 3, F.greatest(F.size("_h"), F.lit(1))), lambda a, b: F.xxhash64(a, b)), 1, F.greatest(F.size("_h") - 2, F.lit(0))).alias("_h3")).drop("_h", "_h2")
    x = x.select("*", F.ceil(F.log2(F.size("_h3") + 1)).cast("int").alias("_b"))
    x = x.select("*", F.sort_array(F.expr("transform(_h3, (v, i) -> shiftleft(shiftrightunsigned(v, _b), _b) | cast(i as bigint))")).alias("_s")).drop("_h3")
    x = x.select("*", F.expr("zip_with(_s, slice(_s, 2, greatest(size(_s), 1)), (a, c) -> coalesce(shiftrightunsigned(a, _b) = shiftrightunsigned(c, _b), false))").alias("_e"))
    x = x.select("*", F.expr("zip_with(_e, concat(array(false), _e), (a, c) -> coalesce(a, false) OR c)").alias("_f"))
    x = x.select("*", F.expr("sort_array(filter(zip_with(_s, slice(_f, 1, size(_s)), (v, f) -> if(f, v & (shiftleft(1L, _b) - 1L), -1L)), p -> p >= 0))").alias("_p"))
    repeat = F.expr("aggregate(zip_with(_p, slice(_p, 2, greatest(size(_p), 1)), (a, c) -> least(3L, coalesce(c - a, 3L))), 0L, (s, v) -> s + v)")
    x = x.select("_id", "_host", "_th", "n_words", "word_chars", "n_symbols", "n_dup_lines", repeat.alias("n_repeat_words"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    x = x.select("*", failed.alias("base_failed"))
    # A generator, so that a caller's filter isn't pushed below the arrays, each of which would be written out in full in it.
    return x.select(F.explode_outer(F.array(F.struct(*x.columns))).alias("_r")).select("_r.*")


def _line_rows(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    """_id, _host, _th, _i, _line (hash of the trimmed, lower-cased line), _n (its words): one row for each line with a word."""
    x = docs.select(F.col(id_col).alias("_id"), F.col(host_col).alias("_host"), F.coalesce(F.col(text_col), F.lit("")).alias("_t"))
    x = x.select("_id", "_host", F.xxhash64("_t").alias("_th"), F.posexplode(F.split("_t", "\n")).alias("_i", "_s"))
    x = x.select("*", F.regexp_count("_s", F.lit(r"[^\x20\x09-\x0D]+")).alias("_n")).filter("_n > 0")
    norm = F.lower(F.trim("_s"))
    return x.select("_id", "_host", "_th", "_i", F.xxhash64(norm).alias("_line"), F.xxhash64(F.lit(1), norm).alias("_line2"), "_n")


def quality_rules(docs: DataFrame, max_share: int = MAX_SHARE, max_docs: int = MAX_DOCS, least_left: int = LEAST_LEFT, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """One row per input row: id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, words_removed.

    Lines are trimmed, lower-cased and hashed (128 bits). A line that more than ``max_share`` percent of a host's documents
    hold, and more than ``max_docs``, is removed from all of them. A document is a pair of id and text, so rows that repeat one count
    once, and copies under other ids count each. A document is depleted if less than ``least_left`` percent of its words remain.
    kept = neither base_failed nor depleted.

    Counting reduces within tasks before each shuffle: (host, line, document), then (host, line). Only lines above the
    limits go on, and lines of documents find them by a join of small rows, which adaptive execution splits where a key is hot.
    Null text is empty (all counts 0, base_failed). Null hosts are one host, null ids are allowed; rows equal in id and
    text get equal results. Repeated windows are told apart by at least 44 bits of hash within a text. Other columns are ignored.
    """
    lines = _line_rows(docs, id_col, text_col, host_col)
    docs_of = lambda x, *by: x.groupBy(*by, "_d").agg(F.count(F.lit(1))).groupBy(*by).agg(F.count(F.lit(1)).alias("_docs"))
    own = F.xxhash64("_id", "_th").alias("_d")
    hosts = docs.select(F.col(id_col).alias("_id"), F.col(host_col).alias("_host"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("_th"))
    hosts = docs_of(hosts.select("_host", own), "_host").select(F.col("_host").alias("_h8"), F.col("_docs").alias("_all"))
    common = docs_of(lines.select("_host", "_line", "_line2", own), "_host", "_line", "_line2").filter(F.col("_docs") > max_docs)
    common = common.join(hosts, F.col("_host").eqNullSafe(F.col("_h8"))).filter(100 * F.col("_docs") > max_share * F.col("_all"))
    common = common.select(F.col("_host").alias("_h9"), F.col("_line").alias("_l9"), F.col("_line2").alias("_m9"))
    hit = lines.join(common, F.col("_host").eqNullSafe(F.col("_h9")) & (F.col("_line") == F.col("_l9")) & (F.col("_line2") == F.col("_m9")))
    # Equal rows bring equal lines: each line counts once for all of them.
    once = hit.groupBy("_id", "_th", "_host", "_i").agg(F.max("_n").alias("_n"))
    removed = once.groupBy("_id", "_th", "_host").agg(F.sum("_n").alias("words_removed")).withColumnsRenamed({"_id": "_id9", "_th": "_th9", "_host": "_h9"})
    rows = _measured(docs, id_col, text_col, host_col)
    out = rows.join(removed, F.col("_id").eqNullSafe(F.col("_id9")) & (F.col("_th") == F.col("_th9")) & F.col("_host").eqNullSafe(F.col("_h9")), "left")
    gone = F.coalesce(F.col("words_removed"), F.lit(0).cast("long"))
    kept = ~F.col("base_failed") & (100 * (F.col("n_words") - gone) >= least_left * F.col("n_words"))
    return out.select(F.col("_id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), gone.alias("words_removed"))


ORACLE = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS tx FROM documents),
ws AS (SELECT rid, list_filter(string_split_regex(tx, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM d),
w AS (SELECT rid, unnest(ws) AS a, generate_subscripts(ws, 1) AS i FROM ws),
tri AS (SELECT rid, i, a, lead(a, 1) OVER (PARTITION BY rid ORDER BY i) AS b, lead(a, 2) OVER (PARTITION BY rid ORDER BY i) AS c FROM w),
rep AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, a, b, c) AS n FROM tri WHERE c IS NOT NULL),
cov AS (SELECT rid, count(DISTINCT j) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS j FROM rep WHERE n > 1) GROUP BY rid),
ls AS (SELECT rid, unnest(string_split(tx, chr(10))) AS s FROM d),
l AS (SELECT rid, s, len(list_filter(string_split_regex(s, '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS n FROM ls WHERE regexp_matches(s, '[^\x20\x09-\x0D]')),
dup AS (SELECT rid, count(*) - count(DISTINCT s) AS n FROM l GROUP BY rid),
nl AS (SELECT l.rid, d.source, {{'i': d.doc_id, 't': d.tx}} AS k, lower(trim(l.s)) AS s, l.n FROM l JOIN d USING (rid)),
host AS (SELECT source, count(DISTINCT {{'i': doc_id, 't': tx}}) AS n FROM d GROUP BY source),
common AS (SELECT c.source, c.s FROM (SELECT source, s, count(DISTINCT k) AS n FROM nl GROUP BY source, s) c JOIN host ON host.source IS NOT DISTINCT FROM c.source
           WHERE c.n > {MAX_DOCS} AND 100 * c.n > {MAX_SHARE} * host.n),
gone AS (SELECT nl.rid, sum(nl.n) AS n FROM nl JOIN common c ON nl.s = c.s AND nl.source IS NOT DISTINCT FROM c.source GROUP BY nl.rid),
m AS (SELECT d.rid, d.doc_id, len(ws.ws) AS n_words,
        length(regexp_replace(tx, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
        length(regexp_replace(tx, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
        coalesce(dup.n, 0) AS n_dup_lines, coalesce(cov.n, 0) AS n_repeat_words, coalesce(gone.n, 0)::BIGINT AS words_removed
      FROM d JOIN ws USING (rid) LEFT JOIN dup USING (rid) LEFT JOIN cov USING (rid) LEFT JOIN gone USING (rid)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 100 * (n_words - words_removed) >= {LEAST_LEFT} * n_words AS kept, words_removed
FROM f
"""
