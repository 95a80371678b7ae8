"""Queries of aggregates, quantiles, sweeps and mass arithmetic."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import mass as M
from ..functions import text as T
from ..operators import analytics, records
from .queries_text import _DUCK, readings
from .registry import query, t


@query("SELECT lang, source, count(*) AS n, count(DISTINCT doc_id) AS ids, min(doc_id) AS first_id FROM documents GROUP BY 1, 2")
def group_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5, A7."""
    return analytics.group_summary(t(spark, sf_dir, "documents"), ["lang", "source"], "doc_id")


@query("SELECT event_type, n FROM (SELECT event_type, count(*) AS n, min(event_id) AS seen FROM events GROUP BY 1 ORDER BY n DESC, seen LIMIT 3)")
def most_common(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O2: the most frequent values, ties by first sight; a top-k report."""
    return analytics.most_common(t(spark, sf_dir, "events"), "event_type", "event_id", 3)


@query("SELECT text_hash, n FROM (SELECT md5(text) AS text_hash, count(*) AS n FROM documents GROUP BY text) WHERE n > 1")
def exact_duplicate_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t(spark, sf_dir, "documents").groupBy(F.md5(F.encode("text", "utf-8")).alias("text_hash")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


@query("""SELECT 'o_orderpriority' AS "column", count(*) FILTER (trim(CASE WHEN o_orderkey % 5 = 0 THEN ' ' ELSE o_orderpriority END) <> '') AS filled FROM orders UNION ALL SELECT 'o_orderstatus', count(*) FILTER (CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderstatus END <> '') FROM orders""")
def field_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A6."""
    x = t(spark, sf_dir, "orders").select(F.when(F.col("o_orderkey") % 5 == 0, " ").otherwise(F.col("o_orderpriority")).alias("o_orderpriority"), F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderstatus")).alias("o_orderstatus"))
    return analytics.fill_counts(x, ["o_orderpriority", "o_orderstatus"])


@query("SELECT count(*) AS total, count(*) FILTER (a) AS agree, count(*) FILTER (NOT a AND c < 0.5) AS phantom, count(*) FILTER (NOT a AND c >= 0.5) AS real_error, median(c) AS median_conf FROM (SELECT l_returnflag = 'A' AS a, l_discount * 10 AS c FROM lineitem)")
def agreement_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A8."""
    return analytics.agreement_breakdown(t(spark, sf_dir, "lineitem"), F.col("l_returnflag") == "A", F.col("l_discount") * 10)


@query("SELECT o_orderstatus AS method, count(*) AS n, count(*) FILTER (tier IN ('high', 'medium')) AS validated, count(*) FILTER (tier <> 'rejected') AS apparent, round(count(*) FILTER (tier <> 'rejected') / count(*), 4) AS apparent_share, round(count(*) FILTER (tier IN ('high', 'medium')) / count(*), 4) AS strict_share FROM (SELECT *, ['high', 'medium', 'low', 'experimental', 'rejected'][1 + o_orderkey % 5] AS tier FROM orders) GROUP BY 1")
def recovery_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A9."""
    x = t(spark, sf_dir, "orders").withColumn("tier", F.expr("element_at(array('high', 'medium', 'low', 'experimental', 'rejected'), cast(1 + o_orderkey % 5 as int))"))
    return analytics.recovery_summary(x, F.col("tier"), F.col("o_orderstatus"))


@query("SELECT l_returnflag, len(s) AS n, s[1 + least(floor(len(s) * 0.1), len(s) - 1)::INT] AS p10, s[1 + floor(len(s) * 0.5)::INT] AS upper_median, s[1 + floor(len(s) * 0.9)::INT] AS p90 FROM (SELECT l_returnflag, list_sort(list(l_extendedprice)) AS s FROM lineitem GROUP BY 1)")
def nearest_rank_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10, E22."""
    return analytics.nearest_rank(t(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_extendedprice", {"p10": 0.1, "upper_median": 0.5, "p90": 0.9})


@query("SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.25), 4) AS q25, round(quantile_cont(l_extendedprice, 0.5), 4) AS q50, round(quantile_cont(l_extendedprice, 0.95), 4) AS q95, min(l_extendedprice) AS lo, max(l_extendedprice) AS hi, round(avg(l_extendedprice), 4) AS mean FROM lineitem GROUP BY 1")
def interpolated_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A11."""
    x = analytics.interpolated_quantiles(t(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_extendedprice", {"q25": 0.25, "q50": 0.5, "q95": 0.95})
    return x.select("l_returnflag", "lo", "hi", *[F.round(c, 4).alias(c) for c in ("mean", "q25", "q50", "q95")])


@query("SELECT l_returnflag, x.tol AS tolerance, count(*) AS n, count(*) FILTER (abs(l_discount - 0.05) <= x.tol) AS hits FROM lineitem, (VALUES (0.005::DOUBLE), (0.015), (0.025), (0.045)) x(tol) GROUP BY 1, 2")
def tolerance_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A12."""
    return analytics.tolerance_sweep(t(spark, sf_dir, "lineitem"), ["l_returnflag"], F.col("l_discount") - 0.05, [0.005, 0.015, 0.025, 0.045]).select("l_returnflag", "tolerance", "n", "hits")


@query("SELECT b.lo, b.hi, (SELECT count(*) FROM events e WHERE e.value >= b.lo AND e.value < b.hi) AS n FROM (VALUES (0.0::DOUBLE, 5.0::DOUBLE), (5.0, 20.0), (20.0, 50.0), (50.0, 100.0), (100.0, 1000.0)) b(lo, hi)")
def histogram_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A13."""
    return analytics.histogram(t(spark, sf_dir, "events"), "value", [0, 5, 20, 50, 100, 1000])


@query("SELECT lang, source, count(*) AS n, count(*) FILTER (b) AS balanced, count(*) FILTER (r = 8) AS rows_recovered, count(*) FILTER (b AND r = 8) AS strict, CAST(floor(median(length(text))) AS BIGINT) AS median_len FROM (SELECT *, length(replace(text, '(', '')) = length(replace(text, ')', '')) AND length(replace(text, '[', '')) = length(replace(text, ']', '')) AS b, len(string_split(text, chr(10))) AS r FROM documents) GROUP BY 1, 2")
def arm_scorecard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A14, A15, E12."""
    return analytics.scorecard(t(spark, sf_dir, "documents"), ["lang", "source"], F.col("text"), F.size(F.split("text", "\n")), F.lit(8))


@query("SELECT source, count(*) FILTER (lang = 'en') AS en, count(*) FILTER (lang = 'de') AS de, count(*) FILTER (lang = 'fr') AS fr, count(*) FILTER (lang = 'es') AS es FROM documents GROUP BY 1")
def pivot_arms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A16."""
    return analytics.cross_counts(t(spark, sf_dir, "documents"), "source", "lang", ["en", "de", "fr", "es"])


@query("SELECT o_orderkey, gap FROM (SELECT o_orderkey, round(abs(o_totalprice - 150000), 2) AS gap FROM orders ORDER BY gap, o_orderkey LIMIT 15)")
def topk_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 15 closest; a top-k report, kept by TakeOrdered without a full sort."""
    return analytics.closest(t(spark, sf_dir, "orders"), "o_orderkey", F.round(F.abs(F.col("o_totalprice") - 150000), 2), 15)


@query("SELECT o_orderkey FROM (SELECT o_orderkey FROM orders ORDER BY CAST(o_orderkey AS VARCHAR) LIMIT 20 OFFSET 5)")
def sorted_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offset and limit after a sort by id as text."""
    return t(spark, sf_dir, "orders").select("o_orderkey").orderBy(F.col("o_orderkey").cast("string")).offset(5).limit(20)


@query("SELECT l_linenumber, count(*) FILTER (d > 0) AS over, count(*) FILTER (d < 0) AS under, count(*) FILTER (abs(d - 2) <= 1.5) AS near FROM (SELECT *, l_quantity - 25 AS d FROM lineitem) GROUP BY 1")
def direction_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A21."""
    return analytics.direction_counts(t(spark, sf_dir, "lineitem"), ["l_linenumber"], F.col("l_quantity") - 25, 2.0, 1.5)


@query("SELECT l_returnflag, count(*) FILTER (b > a) AS better, count(*) FILTER (b < a) AS worse, count(*) FILTER (b = a) AS equal, round(corr(a, b), 6) AS r FROM (SELECT l_returnflag, l_quantity::DOUBLE AS a, CASE WHEN l_linenumber = 2 THEN NULL WHEN l_linenumber = 3 THEN l_quantity ELSE l_extendedprice / 1500 END::DOUBLE AS b FROM lineitem) WHERE a IS NOT NULL AND b IS NOT NULL GROUP BY 1")
def paired_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs that became better or worse, and their correlation."""
    after = F.when(F.col("l_linenumber") == 2, None).when(F.col("l_linenumber") == 3, F.col("l_quantity")).otherwise(F.col("l_extendedprice") / 1500)
    return analytics.paired_comparison(t(spark, sf_dir, "lineitem"), ["l_returnflag"], F.col("l_quantity"), after).withColumn("r", F.round("r", 6))


@query("""WITH x AS (SELECT lang, len(string_split(text, chr(10))) - 8 AS e, length(replace(text, '(', '')) = length(replace(text, ')', '')) AND length(replace(text, '[', '')) = length(replace(text, ']', '')) AS b, doc_id % 3 = 0 AS p, ['match', 'mismatch', 'unknown'][1 + doc_id % 3] AS v FROM documents),
w AS (SELECT lang, string_agg(concat(v, '=', n), ' ' ORDER BY v) AS verdicts FROM (SELECT lang, v, count(*) AS n FROM x GROUP BY 1, 2) GROUP BY 1)
SELECT x.lang, count(*) AS n, count(*) FILTER (e = 0) AS none, count(*) FILTER (e < 0) AS less, count(*) FILTER (e > 0) AS more, quantile_cont(e, 0.5) AS median, round(avg(e), 6) AS mean, count(*) FILTER (b) AS balanced, count(*) FILTER (p) AS parses, max(w.verdicts) AS verdicts FROM x JOIN w ON w.lang IS NOT DISTINCT FROM x.lang GROUP BY 1""")
def arm_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Excess counts, median, mean, and how often each verdict was given."""
    d = t(spark, sf_dir, "documents")
    verdict = F.expr("element_at(array('match', 'mismatch', 'unknown'), cast(1 + doc_id % 3 as int))")
    x = analytics.arm_statistics(d, ["lang"], F.size(F.split("text", "\n")) - 8, T.balanced(F.col("text")), F.col("doc_id") % 3 == 0, verdict)
    shown = F.array_join(F.transform(F.array_sort(F.map_entries("verdicts")), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), " ")
    return x.withColumns({"verdicts": shown, "mean": F.round("mean", 6)})


@query("SELECT 'intercept' AS term, round(regr_intercept(l_extendedprice, l_quantity), 3) AS coefficient FROM lineitem UNION ALL SELECT 'l_quantity', round(regr_slope(l_extendedprice, l_quantity), 3) FROM lineitem")
def element_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A22 with one regressor; tests use several."""
    return analytics.least_squares(t(spark, sf_dir, "lineitem"), ["l_quantity"], "l_extendedprice").select("term", F.round("coefficient", 3).alias("coefficient"))


@query("""WITH s AS (SELECT l_linenumber, list_sort(list(l_quantity)) AS v, count(*) AS n, stddev_pop(l_quantity) AS sd FROM lineitem GROUP BY 1)
SELECT l_linenumber, n, round(sd, 6) AS sd, round(v[((n + 1) // 4)::INT] + (v[((n + 1) // 4 + 1)::INT] - v[((n + 1) // 4)::INT]) * ((n + 1) / 4 - (n + 1) // 4), 6) AS q1, round(v[((n + 1) * 3 // 4)::INT] + (v[((n + 1) * 3 // 4 + 1)::INT] - v[((n + 1) * 3 // 4)::INT]) * ((n + 1) * 3 / 4 - (n + 1) * 3 // 4), 6) AS q3 FROM s""")
def exclusive_quartiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A23."""
    x = analytics.exclusive_quartiles(t(spark, sf_dir, "lineitem"), ["l_linenumber"], "l_quantity")
    return x.select("l_linenumber", "n", F.round("sd", 6).alias("sd"), F.round("q1", 6).alias("q1"), F.round("q3", 6).alias("q3"))


@query("""SELECT rule, count(*) AS n, count(*) FILTER (x = p_name) AS exact, sum(levenshtein(x, p_name))::BIGINT AS edits, round(sum(levenshtein(x, p_name)) / sum(length(p_name)), 6) AS cer
FROM (SELECT p_name, unnest(['first', 'second', 'longer']) AS rule, unnest([a, b, CASE WHEN length(b) > length(a) THEN b ELSE a END]) AS x FROM (SELECT p_name, replace(p_name, 'e', '') AS a, upper(substr(p_name, 1, 1)) || substr(p_name, 2) AS b FROM part)) GROUP BY 1""")
def rule_scoreboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row under every rule. The rules are an array in the row, exploded, not a cross join."""
    a, b = F.replace("p_name", F.lit("e"), F.lit("")), F.concat(F.upper(F.substring("p_name", 1, 1)), F.expr("substr(p_name, 2)"))
    rules = F.array(*[F.struct(F.lit(n).alias("rule"), x.alias("x")) for n, x in (("first", a), ("second", b), ("longer", F.when(F.length(b) > F.length(a), b).otherwise(a)))])
    x = t(spark, sf_dir, "part").select("p_name", F.explode(rules).alias("r")).select("p_name", "r.*").withColumn("e", F.levenshtein("x", "p_name").cast("long"))
    return x.groupBy("rule").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("x") == F.col("p_name")).alias("exact"), F.sum("e").alias("edits"), F.round(F.sum("e") / F.sum(F.length("p_name")), 6).alias("cer"))


@query("SELECT best, count(*) AS n FROM (SELECT CASE WHEN a <= b AND a <= c AND a <= d THEN 'mono' WHEN b <= c AND b <= d THEN 'rounded' WHEN c <= d THEN 'average' ELSE 'average2' END AS best FROM (SELECT abs(l_tax - 0.02) AS a, abs(l_tax - 0.04) AS b, abs(l_tax - 0.06) AS c, abs(l_tax - 0.08) AS d FROM lineitem)) GROUP BY 1")
def closest_convention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A25."""
    errors = {n: F.col("l_tax") - v for n, v in (("mono", 0.02), ("rounded", 0.04), ("average", 0.06), ("average2", 0.08))}
    return analytics.closest_convention(t(spark, sf_dir, "lineitem"), errors)


@query("SELECT source, config, count(*) AS samples, count(*) FILTER (len > lim) AS over, round(avg(len / lim), 6) AS mean_ratio FROM (SELECT source, length(text) AS len, unnest(['small', 'large']) AS config, unnest([500, 2000]) AS lim FROM documents) GROUP BY 1, 2")
def config_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples by configurations."""
    cfg = F.array(*[F.struct(F.lit(n).alias("config"), F.lit(v).alias("lim")) for n, v in (("small", 500), ("large", 2000))])
    x = t(spark, sf_dir, "documents").select("source", F.length("text").alias("len"), F.explode(cfg).alias("c")).select("source", "len", "c.*")
    return x.groupBy("source", "config").agg(F.count(F.lit(1)).alias("samples"), F.count_if(F.col("len") > F.col("lim")).alias("over"), F.round(F.avg(F.col("len") / F.col("lim")), 6).alias("mean_ratio"))


@query("SELECT o_orderkey, source, value, CASE WHEN abs(value - 150000) <= 50000 THEN 'near' ELSE 'far' END AS verdict FROM (SELECT o_orderkey, unnest(['printed', 'model']) AS source, unnest([o_totalprice, o_totalprice * 1.1]) AS value FROM orders)")
def long_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates in long form."""
    x = t(spark, sf_dir, "orders").select("o_orderkey", F.col("o_totalprice").alias("printed"), (F.col("o_totalprice") * 1.1).alias("model")).unpivot("o_orderkey", ["printed", "model"], "source", "value")
    return x.withColumn("verdict", F.when(F.abs(F.col("value") - 150000) <= 50000, "near").otherwise("far"))


@query("SELECT l_orderkey, CAST(sum(greatest(b - a, 0)) AS BIGINT) AS invented, CAST(sum(greatest(a - b, 0)) AS BIGINT) AS deleted FROM (SELECT l_orderkey, l_returnflag, count(*) FILTER (l_linenumber <= 3) AS a, count(*) FILTER (l_linenumber > 3) AS b FROM lineitem GROUP BY 1, 2) GROUP BY 1")
def multiset_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What one multiset has more than another, as maps of counts."""
    x = t(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_returnflag").agg(F.count_if(F.col("l_linenumber") <= 3).alias("a"), F.count_if(F.col("l_linenumber") > 3).alias("b"))
    m = lambda c: F.map_from_entries(F.collect_list(F.struct("l_returnflag", F.col(c).cast("int"))))
    g = x.groupBy("l_orderkey").agg(m("a").alias("a"), m("b").alias("b"))
    return g.select("l_orderkey", M.total(M.multiset_difference(F.col("a"), F.col("b"))).cast("long").alias("invented"), M.total(M.multiset_difference(F.col("b"), F.col("a"))).cast("long").alias("deleted"))


@query("SELECT o_custkey FROM (SELECT DISTINCT o_custkey FROM orders EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F') UNION SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') AND c_mktsegment = 'BUILDING'")
def set_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U1, U3, U4."""
    o = t(spark, sf_dir, "orders")
    a = records.only_in(o.select("o_custkey"), o.filter("o_orderstatus = 'F'").select("o_custkey"))
    b = records.in_both(t(spark, sf_dir, "customer").filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey")), o.filter("o_orderstatus = 'P'").select("o_custkey"))
    return records.in_either(a, b)


_FIELDS = "CASE p_partkey % 4 WHEN 0 THEN {o}'cmpd_id', 'smiles'{c} WHEN 1 THEN {o}'cmpd_id', 'kd_nm', 'ms_mz'{c} WHEN 2 THEN {o}'cmpd_id', 'kd_nm', 'smiles', 'structure'{c} ELSE {o}'structure'{c} END"


@query(f"SELECT p_partkey, CASE WHEN list_has_all(f, ['cmpd_id', 'kd_nm']) AND NOT list_has_any(f, ['smiles']) THEN 'activity' WHEN list_has_all(f, ['smiles', 'structure']) THEN 'dense' WHEN list_has_all(f, ['cmpd_id', 'smiles']) THEN 'smiles' END AS layout, CAST(trunc(0.37 * p_size) AS INT) AS x1 FROM (SELECT p_partkey, p_size, {_FIELDS.format(o='[', c=']')} AS f FROM part)")
def layout_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first layout whose required fields are all there and whose excluded ones are not; fractions become pixels by truncation."""
    from .profiles import pick_layout

    wanted = [("activity", ["cmpd_id", "kd_nm"], ["smiles"]), ("dense", ["smiles", "structure"], []), ("smiles", ["cmpd_id", "smiles"], [])]
    x = t(spark, sf_dir, "part").select("p_partkey", "p_size", F.expr(_FIELDS.format(o="array(", c=")")).alias("f"))
    return x.select("p_partkey", pick_layout(F.col("f"), wanted).alias("layout"), (F.col("p_size") * 0.37).cast("int").alias("x1"))


@query("""SELECT event_id, concat_ws('; ', CASE WHEN k < 0.0001 THEN printf('kd_nm below range (%.4f < 0.0001)', k) WHEN k > 100000 THEN printf('kd_nm above range (%.4f > 100000.0000)', k) END, CASE WHEN value > 30 THEN printf('rt_min above range (%.4f > 30.0000)', value) END) AS flags,
 CASE WHEN k < 0.0001 OR k > 100000 OR value > 30 THEN 'partial' WHEN event_id % 9 = 0 THEN 'macrocycle_broken' ELSE 'ok' END AS data_quality FROM (SELECT event_id, value, (value - 1) * 1000 AS k FROM events)""")
def range_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P9."""
    e = t(spark, sf_dir, "events").select("event_id", "value", ((F.col("value") - 1) * 1000).alias("k"))
    x = e.select("event_id", T.range_flags({"kd_nm": F.col("k"), "rt_min": F.col("value")}).alias("f"))
    return x.select("event_id", F.concat_ws("; ", "f").alias("flags"), T.quality_word(F.col("f"), F.col("event_id") % 9 == 0).alias("data_quality"))


_ION = "CASE l_linenumber % 7 WHEN 0 THEN '[M+H]+' WHEN 1 THEN '[M+3H]3+' WHEN 2 THEN '[M-H]-' WHEN 3 THEN '[M+HCOO]-' WHEN 4 THEN '[M+Na]+' WHEN 5 THEN '[M]+' ELSE 'x' END"


@query(f"""WITH i AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(l_extendedprice / 50, 1) AS mz, {_ION} AS ion FROM lineitem),
p AS (SELECT *, CASE ion WHEN '[M+H]+' THEN 1.007276466 WHEN '[M+3H]3+' THEN 1.007276466 WHEN '[M-H]-' THEN 1.007276466 WHEN '[M+HCOO]-' THEN -44.998201 WHEN '[M+Na]+' THEN 22.98976928 WHEN '[M]+' THEN 1.007276466 END::DOUBLE AS delta, CASE ion WHEN '[M+3H]3+' THEN 3 WHEN '[M-H]-' THEN -1 WHEN '[M+HCOO]-' THEN -1 ELSE 1 END AS z FROM i),
m AS (SELECT *, abs(z) * mz - z * delta AS mass FROM p)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(mass, 5) AS mass, round(0.05 / mz * 1e6, 3) AS tolerance, round(mass - (CASE WHEN mz = trunc(mz) THEN 0.5 ELSE 0.05 END), 5) AS low,
 CASE WHEN mass IS NULL THEN 'unknown' WHEN abs((mass - 800) / 800.0 * 1e6) <= 0.05 / mz * 1e6 THEN 'match' ELSE 'mismatch' END AS verdict, round(mass, 4) AS expected FROM m""")
def polarity_mass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1 to M6: ion labels, neutral mass, tolerance, window, verdict."""
    x = t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round(F.col("l_extendedprice") / 50, 1).alias("mz"), F.expr(_ION).alias("label"))
    x = M.with_polarity(x, "label", "ion").withColumn("d", M.decimals(F.col("mz")))
    mz, ion, d = F.col("mz"), F.col("ion"), F.col("d")
    v = M.verdict(F.lit(800.0), mz, ion, M.printing_tolerance_ppm(mz, d))
    x = x.withColumn("v", v)
    return x.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round(M.neutral_mass(mz, ion), 5).alias("mass"), F.round(M.printing_tolerance_ppm(mz, d), 3).alias("tolerance"), F.round(M.mass_window(mz, ion, d)["low"], 5).alias("low"), "v.verdict", F.col("v.expected").alias("expected"))


@query(f"""WITH a AS (SELECT p_partkey, {_DUCK} AS x, p_retailprice / 4 AS target FROM part),
k AS (SELECT p_partkey, unnest(regexp_extract_all(x, '(Cl|Br|\\[[^\\]]*\\]?|[CNOSFPB])')) AS r FROM a), e AS (SELECT p_partkey, CASE WHEN starts_with(r, '[') THEN regexp_extract(r, '[CNOSFPB]') ELSE r END AS e FROM k),
h AS (SELECT p_partkey, count(*) FILTER (e = 'C') AS c, count(*) FILTER (e <> '') AS atoms, sum(CASE e WHEN 'C' THEN 12.0 WHEN 'N' THEN 14.0030740048 WHEN 'O' THEN 15.9949146196 WHEN 'Cl' THEN 34.96885271 WHEN 'Br' THEN 78.9183376 WHEN 'F' THEN 18.99840316273 WHEN 'S' THEN 31.9720711744 WHEN 'P' THEN 30.97376151 WHEN 'B' THEN 11.0093054 ELSE 0 END::DOUBLE) AS m FROM e GROUP BY 1),
j AS (SELECT a.p_partkey, coalesce(h.c, 0) AS c, coalesce(atoms, 0) AS atoms, coalesce(m, 0) AS m, CASE WHEN target - coalesce(m, 0) >= 0 THEN (target - coalesce(m, 0)) / 1.0078250319 END AS h FROM a LEFT JOIN h USING (p_partkey))
SELECT p_partkey, CAST(atoms AS INT) AS atoms, round(m, 4) AS heavy_mass, CASE WHEN h IS NULL THEN 'too_heavy' WHEN h < 0.5 * c OR h > 3 * c THEN 'implausible_h' WHEN abs(h - round_even(h, 0)) <= 0.06 / 1.0078250319 + 0.25 THEN 'on_integer_h' WHEN abs(h - round_even(h, 0)) <= 0.75 THEN 'near_integer_h' ELSE 'off_integer_h' END AS verdict FROM j""")
def mass_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The composition of a damaged text against a mass."""
    x = readings(spark, sf_dir).join(t(spark, sf_dir, "part").select("p_partkey", (F.col("p_retailprice") / 4).alias("target")), "p_partkey")
    x = x.select("p_partkey", "target", T.tally(M.element_tokens(F.col("x"))).alias("m"))
    return x.select("p_partkey", M.total(F.col("m")).alias("atoms"), F.round(M.heavy_mass(F.col("m")), 4).alias("heavy_mass"), M.gate(F.col("m"), F.col("target"), F.lit(0.06)).alias("verdict"))


@query("""WITH p AS (SELECT vec_id, embedding::DOUBLE[] AS a FROM embeddings),
q AS (SELECT vec_id, k, unnest([abs(a[4 * k + 1]), abs(a[4 * k + 2]), abs(a[4 * k + 3]), abs(a[4 * k + 4])]) AS v FROM p, range(16) x(k)),
n AS (SELECT vec_id, k, v / sum(v) OVER (PARTITION BY vec_id, k) AS v FROM q), c AS (SELECT vec_id, k, max(v) AS top, -sum(v * log2(v)) FILTER (v > 0) AS h FROM n GROUP BY 1, 2)
SELECT vec_id, round(sum(h) / 16, 4) AS avg_entropy, round(min(top), 4) AS min_top1, CAST(count(*) FILTER (top < 0.7) AS INT) AS low_count FROM c GROUP BY 1""")
def entropy_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of a lattice of alternatives."""
    a = lambda k: F.transform(F.slice("embedding", 4 * k + 1, 4), lambda x: F.abs(x.cast("double")))
    norm = lambda arr: T.let(arr, lambda v: F.transform(v, lambda x: x / F.aggregate(v, F.lit(0.0), lambda s, y: s + y)))
    return t(spark, sf_dir, "embeddings").select("vec_id", M.lattice_stats(F.array(*[norm(a(k)) for k in range(16)])).alias("s")).select("vec_id", "s.*")


@query("SELECT vec_id, round(list_min(c), 6) AS least, round(list_sum(c) / len(c), 6) AS mean, CAST(len(list_filter(c, lambda x: x < 0.05)) AS INT) AS low FROM (SELECT vec_id, list_transform(embedding, lambda x: abs(x::DOUBLE)) AS c FROM embeddings)")
def token_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M16."""
    c = F.transform("embedding", lambda x: F.abs(x.cast("double")))
    return t(spark, sf_dir, "embeddings").select("vec_id", M.token_confidence(c, 0.05).alias("s")).select("vec_id", F.round("s.min", 6).alias("least"), F.round("s.mean", 6).alias("mean"), F.size("s.low").alias("low"))


@query("SELECT tier, CAST(coalesce(list_position(['high', 'medium', 'low', 'experimental', 'rejected'], tier), 6) - 1 AS INT) AS rank, count(*) AS n FROM (SELECT ['high', 'medium', 'low', 'experimental', 'rejected', 'other'][1 + o_orderkey % 6] AS tier FROM orders) GROUP BY 1, 2")
def tier_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P20: unknown tiers come last."""
    from .policy import tier_rank

    x = t(spark, sf_dir, "orders").select(F.expr("element_at(array('high', 'medium', 'low', 'experimental', 'rejected', 'other'), cast(1 + o_orderkey % 6 as int))").alias("tier"))
    return x.groupBy("tier").agg(F.count(F.lit(1)).alias("n")).select("tier", tier_rank(F.col("tier")).alias("rank"), "n")


@query("""SELECT p_type, count(*) AS n, count(*) FILTER (top = string_split(p_name, '')) AS top1_equal, count(*) FILTER (array_to_string(top, '') = p_name) AS text_equal, count(*) FILTER (len(top) = length(p_name)) AS length_equal
FROM (SELECT p_type, p_name, CASE WHEN p_partkey % 5 = 0 THEN list_concat(['x'], string_split(p_name, '')[2:]) WHEN p_partkey % 7 = 0 THEN string_split(p_name, '')[2:] ELSE string_split(p_name, '') END AS top FROM part) GROUP BY 1""")
def row_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a lattice's best characters and the emitted text must have in common."""
    x = t(spark, sf_dir, "part").select("p_type", "p_name", "p_partkey", F.filter(F.split("p_name", ""), lambda c: c != "").alias("ch"))
    rest = F.slice("ch", 2, F.greatest(F.size("ch"), F.lit(1)))
    x = x.withColumn("top", F.when(F.col("p_partkey") % 5 == 0, F.concat(F.array(F.lit("x")), rest)).when(F.col("p_partkey") % 7 == 0, rest).otherwise(F.col("ch")))
    return x.groupBy("p_type").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("top") == F.col("ch")).alias("top1_equal"), F.count_if(F.array_join("top", "") == F.col("p_name")).alias("text_equal"), F.count_if(F.size("top") == F.length("p_name")).alias("length_equal"))


_COUNTS = "CASE p_partkey % 6 WHEN 0 THEN {m}'Ca', 1, 'C', p_size{z} WHEN 1 THEN {m}'C', p_size, 'N', 2, 'O', 3{z} WHEN 2 THEN {m}'Xx', 1, 'C', p_size{z} WHEN 3 THEN {m}'C', p_size, 'Cl', 1, 'Ca', 2{z} ELSE {m}'C', p_size{z} END"


@query("""WITH a AS (SELECT p_partkey, p_partkey % 6 AS k, p_size AS c, round(p_retailprice / 4, 1) AS target FROM part),
m AS (SELECT *, CASE WHEN k IN (0, 3) THEN CASE k WHEN 0 THEN 1 ELSE 2 END ELSE 0 END AS ca, c * 12.0::DOUBLE + CASE k WHEN 1 THEN 2 * 14.0030740048 + 3 * 15.9949146196 WHEN 3 THEN 34.96885271 ELSE 0 END::DOUBLE AS heavy FROM a),
h AS (SELECT *, (target - heavy) / 1.0078250319 AS h0, (target - heavy - 12.0 * ca) / 1.0078250319 AS h1 FROM m),
v AS (SELECT *, CASE WHEN k IN (0, 3) OR k = 2 THEN 'unknown' WHEN h0 < 0 THEN 'heavy' WHEN h0 < 0.5 * c OR h0 > 3 * c THEN 'off' WHEN abs(h0 - round_even(h0, 0)) <= 0.06 / 1.0078250319 + 0.25 THEN 'fits' ELSE 'off' END AS class,
 CASE WHEN k = 2 THEN 'unknown' WHEN h1 < 0 THEN 'heavy' WHEN h1 < 0.5 * (c + ca) OR h1 > 3 * (c + ca) THEN 'off' WHEN abs(h1 - round_even(h1, 0)) <= 0.06 / 1.0078250319 + 0.25 THEN 'fits' ELSE 'off' END AS as_carbon FROM h)
SELECT p_partkey, class, as_carbon, CAST(c + ca AS INT) AS carbon FROM v""")
def composition_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of compositions, and what they would be if each Ca were a misread C."""
    x = t(spark, sf_dir, "part").select("p_partkey", F.round(F.col("p_retailprice") / 4, 1).alias("target"), F.expr(_COUNTS.format(m="map(", z=")")).alias("m"))
    x = x.withColumn("fixed", M.calcium_as_carbon(F.col("m")))
    of = lambda c: M.composition_class(F.col(c), F.col("target"), F.lit(0.06))
    return x.select("p_partkey", of("m").alias("class"), of("fixed").alias("as_carbon"), F.col("fixed")["C"].alias("carbon"))
