"""Queries of record operators: deduplication, merging, joins, ordered operators, readings and votes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import analytics, ordered, readings, records, vectors
from .queries_text import BRACKETED
from .registry import query, t

_REC = """o_orderkey AS pos, concat('cmpd ', o_custkey) AS cmpd_id, CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS is_valid,
 CASE WHEN o_totalprice > 150000 THEN o_orderpriority ELSE '' END AS canonical_smiles, CASE WHEN o_orderkey % 3 = 0 THEN concat('img', o_orderkey) END AS structure_image, o_orderkey % 10 AS page"""
_REC_SQL = f"WITH r AS (SELECT CAST(o_custkey AS VARCHAR) AS key, {_REC} FROM orders)"


def recs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t(spark, sf_dir, "orders").selectExpr("o_orderkey AS pos", "concat('cmpd ', o_custkey) AS cmpd_id", "CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS is_valid",
        "CASE WHEN o_totalprice > 150000 THEN o_orderpriority ELSE '' END AS canonical_smiles", "CASE WHEN o_orderkey % 3 = 0 THEN concat('img', o_orderkey) END AS structure_image", "o_orderkey % 10 AS page")


@query(f"{_REC_SQL} SELECT key, pos, is_valid, canonical_smiles FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY CASE WHEN is_valid AND canonical_smiles <> '' THEN 0 ELSE 1 END, pos) AS k FROM r) WHERE k = 1")
def dedupe_first_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.dedupe_compounds(recs(spark, sf_dir)).select("key", "pos", "is_valid", "canonical_smiles")


@query(f"{_REC_SQL} SELECT key, min(pos) AS pos FROM r GROUP BY 1")
def dedupe_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.dedupe_assays(recs(spark, sf_dir)).select("key", "pos")


@query(f"""{_REC_SQL}, c AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY CASE WHEN is_valid THEN 0 ELSE 1 END, pos) AS k FROM r) WHERE k = 1),
i AS (SELECT key, arg_min(structure_image, pos) AS img FROM r WHERE structure_image IS NOT NULL GROUP BY 1) SELECT c.key, c.pos, coalesce(c.structure_image, i.img) AS structure_image FROM c LEFT JOIN i USING (key)""")
def merge_prefer_structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.merge_compounds(recs(spark, sf_dir), prefer_structure=True).select("key", "pos", "structure_image")


@query(f"{_REC_SQL} SELECT key, page, pos FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY page, CASE WHEN is_valid AND canonical_smiles <> '' THEN 0 ELSE 1 END, pos) AS k FROM r) WHERE k = 1")
def first_page_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.accumulate_pages(recs(spark, sf_dir)).select("key", "page", "pos")


@query("SELECT l_orderkey, l_linenumber, max_by(l_extendedprice, (l_partkey, l_suppkey, l_extendedprice)) AS price FROM lineitem GROUP BY 1, 2")
def last_write_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later write of a key replaces an earlier one."""
    x = t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("price"), F.struct("l_partkey", "l_suppkey", "l_extendedprice").alias("pos"))
    return records.last_of_each(x, ["l_orderkey", "l_linenumber"], "pos").select("l_orderkey", "l_linenumber", "price")


def _assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = t(spark, sf_dir, "documents").filter("doc_id IS NOT NULL")
    comp = docs.filter("doc_id % 7 <> 0").selectExpr("doc_id AS k", "lang AS smiles", "CASE WHEN doc_id % 3 <> 0 THEN source ELSE '' END AS canonical_smiles",
        "CASE WHEN doc_id % 4 = 0 THEN NULL ELSE doc_id % 10 / 10D END AS ocr_avg_entropy", "CAST(doc_id % 9 AS INT) AS ocr_low_conf_count")
    model = docs.selectExpr("doc_id AS k", "CASE WHEN doc_id % 5 = 0 THEN source WHEN doc_id % 5 = 1 THEN '' ELSE lang END AS canonical_smiles_decimer")
    assay = t(spark, sf_dir, "labels").groupBy(F.col("doc_id").alias("k")).agg(F.max("quality").alias("grade"))
    return records.assemble(comp, assay, "k", model)


@query(
    """WITH c AS (SELECT doc_id AS k, lang AS smiles, CASE WHEN doc_id % 3 <> 0 THEN source ELSE '' END AS x, CASE WHEN doc_id % 4 = 0 THEN NULL ELSE (doc_id % 10) / 10.0::DOUBLE END AS e, doc_id % 9 AS n,
  CASE WHEN doc_id % 5 = 0 THEN source WHEN doc_id % 5 = 1 THEN '' ELSE lang END AS y FROM documents WHERE doc_id % 7 <> 0),
a AS (SELECT doc_id AS k, max(quality) AS grade FROM labels GROUP BY 1),
j AS (SELECT coalesce(c.k, a.k) AS k, c.k AS ck, smiles, coalesce(x, '') AS x, coalesce(y, '') AS y, grade, (e IS NULL OR e <= 0.5) AND (n IS NULL OR n <= 5) AS sure FROM c FULL JOIN a ON c.k = a.k),
s AS (SELECT *, x <> '' AND y <> '' AND x = y AS agree FROM j),
f AS (SELECT *, CASE WHEN ck IS NULL THEN '' WHEN agree THEN 'ocr+decimer' WHEN x <> '' AND sure THEN 'ocr' WHEN x <> '' AND y <> '' THEN 'decimer_fallback' WHEN x <> '' THEN 'ocr' WHEN y <> '' THEN 'decimer' WHEN coalesce(smiles, '') <> '' THEN 'ocr_only_invalid' ELSE '' END AS src FROM s)
SELECT k, grade, agree AS smiles_agree, src AS smiles_best_source, CASE WHEN src IN ('ocr+decimer', 'ocr') THEN x WHEN src IN ('decimer_fallback', 'decimer') THEN y WHEN src = 'ocr_only_invalid' THEN smiles ELSE '' END AS smiles_best FROM f"""
)
def assemble_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1, J2, P14, P15, P17."""
    return _assembly(spark, sf_dir).select("k", "grade", "smiles_agree", "smiles_best_source", "smiles_best")


@query("SELECT o_orderkey AS k, CASE WHEN o_orderpriority LIKE '1%' THEN o_orderpriority WHEN o_orderstatus = 'F' THEN 'model' WHEN o_orderkey % 3 = 0 THEN 'fixed' ELSE '' END AS best, CASE WHEN o_orderpriority LIKE '1%' THEN 'printed_ocr' WHEN o_orderstatus = 'F' THEN 'decimer' WHEN o_orderkey % 3 = 0 THEN 'repair_syntax_fix' ELSE '' END AS source FROM orders")
def final_precedence(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = t(spark, sf_dir, "orders")
    b = records.final_precedence(F.when(F.col("o_orderpriority").startswith("1"), F.col("o_orderpriority")), F.col("o_orderstatus") == "F", F.lit("model"), F.lit("raw"), F.when(F.col("o_orderkey") % 3 == 0, "fixed"), F.lit("syntax_fix"))
    return x.select(F.col("o_orderkey").alias("k"), b.alias("b")).select("k", "b.best", "b.source")


@query("WITH l AS (SELECT l_orderkey, arg_min(l_shipdate, (l_linenumber, l_partkey, l_suppkey, l_shipdate)) AS ship FROM lineitem GROUP BY 1) SELECT coalesce(o_orderkey, l_orderkey) AS k, o_totalprice, ship FROM orders FULL JOIN l ON o_orderkey = l_orderkey")
def orders_assay_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first line of each order, joined in full."""
    first = t(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.min_by("l_shipdate", F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")).alias("ship"))
    return t(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice").join(first, F.col("o_orderkey") == F.col("l_orderkey"), "full_outer").select(F.coalesce("o_orderkey", "l_orderkey").alias("k"), "o_totalprice", "ship")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)")
def anti_join_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What no cache entry has."""
    return records.to_run(t(spark, sf_dir, "documents").select("doc_id"), t(spark, sf_dir, "labels"), "doc_id")


_V = "SELECT o_orderkey AS k, CASE WHEN o_orderkey % 11 = {a} THEN '' ELSE o_orderpriority END AS p, CASE WHEN o_orderkey % 13 = {a} THEN 'Z' ELSE o_orderstatus END AS s FROM orders WHERE o_orderkey % 17 <> {a}"


@query(
    f"""WITH a AS ({_V.format(a=1)}), b AS ({_V.format(a=2)}), j AS (SELECT coalesce(a.p, '') AS p1, coalesce(b.p, '') AS p2, coalesce(a.s, '') AS s1, coalesce(b.s, '') AS s2 FROM a FULL JOIN b ON a.k = b.k)
SELECT 'p' AS "column", count(*) FILTER (p1 <> '' AND p2 <> '' AND p1 <> p2) AS changed, count(*) FILTER (p1 <> '' AND p2 = '') AS lost, count(*) FILTER (p1 = '' AND p2 <> '') AS gained FROM j
UNION ALL SELECT 's', count(*) FILTER (s1 <> '' AND s2 <> '' AND s1 <> s2), count(*) FILTER (s1 <> '' AND s2 = ''), count(*) FILTER (s1 = '' AND s2 <> '') FROM j"""
)
def version_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions of one table, by column."""
    o = t(spark, sf_dir, "orders")
    v = lambda a: o.filter(f"o_orderkey % 17 <> {a}").selectExpr("o_orderkey AS k", f"CASE WHEN o_orderkey % 11 = {a} THEN '' ELSE o_orderpriority END AS p", f"CASE WHEN o_orderkey % 13 = {a} THEN 'Z' ELSE o_orderstatus END AS s")
    return analytics.version_diff(v(1), v(2), "k", ["p", "s"])


def _versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    o = t(spark, sf_dir, "orders")
    v = lambda a: o.filter(f"o_orderkey % 17 <> {a}").selectExpr("o_orderkey AS k", f"CASE WHEN o_orderkey % 11 = {a} THEN '' ELSE o_orderpriority END AS p", f"CASE WHEN o_orderkey % 13 = {a} THEN 'Z' ELSE o_orderstatus END AS s")
    return v(1), v(2)


@query(f"WITH a AS ({_V.format(a=1)}), b AS ({_V.format(a=2)}) SELECT CASE WHEN b.k IS NULL THEN 'lost' WHEN a.k IS NULL THEN 'gained' WHEN a.p = b.p AND a.s = b.s THEN 'match' ELSE 'differ' END AS state, count(*) AS n FROM a FULL JOIN b ON a.k = b.k GROUP BY 1")
def version_sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of two versions that match, differ or are missing on a side."""
    return records.sides(*_versions(spark, sf_dir), "k", ["p", "s"]).groupBy("state").agg(F.count(F.lit(1)).alias("n"))


_PAIR = """SELECT o_orderkey AS k, concat(' ', o_custkey, CASE WHEN o_orderkey % 2 = 0 THEN '.0' ELSE '' END) AS kd, lower(o_orderpriority) AS grade FROM orders"""
_PAIR2 = """SELECT o_orderkey AS k, CASE WHEN o_orderkey % 7 = 0 THEN '' WHEN o_orderkey % 5 = 0 THEN 'x' ELSE CAST(o_custkey AS {s}) END AS kd, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE replace(o_orderpriority, '-', ' -') END AS grade FROM orders WHERE o_orderkey % 4 <> 0"""


@query("SELECT 'kd' AS field, count(*) FILTER (k % 7 <> 0 AND k % 5 <> 0) AS match, count(*) FILTER (k % 7 <> 0 AND k % 5 = 0) AS differ, count(*) FILTER (k % 7 = 0) AS lost FROM (SELECT o_orderkey AS k FROM orders WHERE o_orderkey % 4 <> 0) UNION ALL SELECT 'grade', count(*) FILTER (k % 3 <> 0), 0, count(*) FILTER (k % 3 = 0) FROM (SELECT o_orderkey AS k FROM orders WHERE o_orderkey % 4 <> 0)")
def reading_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings against an archive by typed keys."""
    t(spark, sf_dir, "orders").createOrReplaceTempView("orders_c")
    old, new = (spark.sql(x.replace("FROM orders", "FROM orders_c")) for x in (_PAIR, _PAIR2.format(s="STRING")))
    return records.compare_readings(old, new, "k", {"kd": True, "grade": False})


@query("SELECT l_orderkey, l_linenumber, coalesce(m.state, 'ok') AS state, sum(l_quantity) AS qty FROM lineitem LEFT JOIN (SELECT o_orderkey, 1 AS line, o_orderstatus AS state FROM orders WHERE o_orderkey % 2 = 0) m ON m.o_orderkey = l_orderkey AND m.line = l_linenumber GROUP BY 1, 2, 3")
def manifest_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A manifest by two keys, with a default."""
    m = t(spark, sf_dir, "orders").filter("o_orderkey % 2 = 0").selectExpr("o_orderkey AS l_orderkey", "1 AS l_linenumber", "o_orderstatus AS state")
    x = records.with_manifest(t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity"), m, ["l_orderkey", "l_linenumber"], "state", "ok")
    return x.groupBy("l_orderkey", "l_linenumber", "state").agg(F.sum("l_quantity").alias("qty"))


@query("SELECT conv_id, max(text) FILTER (turn = 0) IS NOT NULL AS has_first, max(CASE WHEN turn = 1 THEN text END) IS NOT NULL AS has_second FROM conversations GROUP BY 1")
def sides_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which side of an expected pair is there."""
    return t(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.coalesce(F.bool_or((F.col("turn") == 0) & F.col("text").isNotNull()), F.lit(False)).alias("has_first"), F.coalesce(F.bool_or((F.col("turn") == 1) & F.col("text").isNotNull()), F.lit(False)).alias("has_second"))


@query("""WITH d AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice AS x, least(abs(x - 1000), abs(x - 20000), abs(x - 40000), abs(x - 60000), abs(x - 90000)) AS m FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN m > 900 THEN NULL WHEN abs(x - 1000) = m THEN 1000.0::DOUBLE WHEN abs(x - 20000) = m THEN 20000 WHEN abs(x - 40000) = m THEN 40000 WHEN abs(x - 60000) = m THEN 60000 ELSE 90000 END AS border FROM d""")
def nearest_border(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest of a row's borders within a distance; the borders are an array, so there is no cross join."""
    borders = F.array(*[F.lit(float(b)) for b in (1000, 20000, 40000, 60000, 90000)])
    return t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", ordered.nearest(borders, F.col("l_extendedprice"), 900.0).alias("border"))


@query("SELECT a.event_id, b.event_id AS label FROM events a ASOF LEFT JOIN (SELECT user_id, ts, event_id FROM events WHERE event_type = 'purchase') b ON a.user_id = b.user_id AND a.ts <= b.ts")
def interval_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event with the label at or after it, of the same user."""
    e = t(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type")
    labels = e.filter("event_type = 'purchase'").select("user_id", "ts", F.col("event_id").alias("label"))
    return ordered.next_label(e.drop("event_type"), labels, ["user_id"], "ts", "label").select("event_id", "label")


@query("SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_quantity BETWEEN p_size - 10 AND p_size + 10 AND l_discount BETWEEN 0.02 AND 0.06")
def containment_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points in boxes of the same page (here: part)."""
    pts = t(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("page"), "l_orderkey", "l_linenumber", "l_suppkey", F.col("l_quantity").alias("cx"), F.col("l_discount").alias("cy"))
    box = t(spark, sf_dir, "part").selectExpr("p_partkey AS page", "p_size - 10 AS x1", "p_size + 10 AS x2", "0.02D AS y1", "0.06D AS y2")
    return ordered.contained(pts, box, "page", "cx", "cy").select("l_orderkey", "l_linenumber", "l_suppkey", F.col("page").alias("l_partkey"))


@query("SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, CAST(CASE WHEN l_quantity >= 40 THEN 4 WHEN l_quantity >= 25 THEN 3 WHEN l_quantity >= 10 THEN 2 WHEN l_quantity >= 0 THEN 1 ELSE 0 END AS INT) AS bucket FROM lineitem")
def interval_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = F.array(*[F.lit(float(x)) for x in (0, 10, 25, 40)])
    return t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", ordered.interval_lookup(b, F.col("l_quantity")).alias("bucket"))


@query("""WITH s AS (SELECT p.vec_id AS probe, v.vec_id, round(list_cosine_similarity(p.embedding::DOUBLE[], v.embedding::DOUBLE[]), 6) AS score FROM embeddings v, embeddings p WHERE p.vec_id % 100 = 0 AND v.vec_id <> p.vec_id)
SELECT probe, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY probe ORDER BY score DESC, vec_id) AS k FROM s) WHERE k = 1""")
def cosine_top1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best match of each probe (the vectors whose id is divisible by 100) among all vectors, in blocks."""
    v = t(spark, sf_dir, "embeddings")
    return vectors.best_match(v, v.filter("vec_id % 100 = 0"), "vec_id", "embedding")


@query("""SELECT a.vec_id, CASE WHEN a.vec_id % 9 = 0 THEN 0.0::DOUBLE ELSE len(list_filter(list_zip(a.embedding, b.embedding), lambda z: (z[1] > 0) = (z[2] > 0))) / len(a.embedding) END AS share FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""")
def element_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E5: share of places at which two patterns agree; another shape agrees nowhere."""
    e = t(spark, sf_dir, "embeddings").select("vec_id", F.transform("embedding", lambda x: x > 0).alias("a"))
    b = e.select((F.col("vec_id") - 1).alias("_id"), F.when(F.pmod(F.col("vec_id") - 1, F.lit(9)) == 0, F.slice("a", 2, 1000)).otherwise(F.col("a")).alias("b"))
    return e.join(b, F.col("vec_id") == F.col("_id")).select("vec_id", vectors.agreeing_share(F.col("a"), F.col("b")).alias("share"))


@query("""WITH a AS (SELECT p_partkey, [concat('C(', p_size), concat('=O', CASE WHEN p_partkey % 3 = 0 THEN ')' ELSE '' END), 'N'] AS p, [concat('C(', p_size, ')'), concat('=O)', p_partkey % 7), 'N'] AS s FROM part),
c AS (SELECT p_partkey, unnest([p[1] || p[2], p[1] || s[2], s[1] || p[2], s[1] || s[2]]) || 'N' AS x, unnest([1, 2, 3, 4]) AS k FROM a),
g AS (SELECT *, length(replace(x, '(', '')) = length(replace(x, ')', '')) AS ok FROM c)
SELECT p_partkey, CAST(count(DISTINCT x) AS INT) AS n, coalesce(arg_min(x, k) FILTER (ok), arg_max(x, k)) AS first_balanced, CAST(count(DISTINCT x) FILTER (ok) AS INT) AS balanced FROM g GROUP BY 1""")
def line_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All choices of a reading in each line, and the first that is balanced, else the second reading's."""
    x = t(spark, sf_dir, "part").select(
        "p_partkey",
        F.expr("array(concat('C(', p_size), concat('=O', CASE WHEN p_partkey % 3 = 0 THEN ')' ELSE '' END), 'N')").alias("p"),
        F.expr("array(concat('C(', p_size, ')'), concat('=O)', p_partkey % 7), 'N')").alias("s"),
    )
    x = x.select("p_partkey", readings.products(F.col("p"), F.col("s")).alias("all"))
    return x.select("p_partkey", F.size("all").alias("n"), readings.first_of(F.col("all"), T.balanced).alias("first_balanced"), F.size(F.filter("all", T.balanced)).alias("balanced"))


@query("""WITH i AS (SELECT *, count(CASE WHEN role <> 'assistant' THEN 1 END) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING) AS isle FROM conversations)
SELECT conv_id, isle AS row, sha256(string_agg(text, '' ORDER BY turn, role, text)) AS text, CAST(count(*) AS INT) AS parts FROM i WHERE isle > 0 GROUP BY 1, 2""")
def continuation_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of the assistant continue the turn before."""
    c = t(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"), F.when(F.col("role") != "assistant", F.col("turn")).alias("opens"))
    c = c.withColumn("t2", F.col("text"))
    return ordered.continued_rows(c, "conv_id", ["turn", "role", "text"], "opens", "t2").select("conv_id", "row", F.sha2("text", 256).alias("text"), "parts")


@query("SELECT event_id, last_value(CASE WHEN event_type = 'purchase' THEN props END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS layout FROM events")
def layout_carry_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The layout seen last, before the row."""
    e = t(spark, sf_dir, "events").select("event_id", "user_id", "ts", F.when(F.col("event_type") == "purchase", F.col("props")).alias("p"))
    return ordered.carry_forward(e, ["user_id"], ["ts", "event_id"], "p", "layout").select("event_id", "layout")


@query("""WITH x AS (SELECT DISTINCT user_id, epoch_us(ts) / 1000000.0 AS s FROM events), d AS (SELECT *, CASE WHEN s - lag(s) OVER w > 7200 THEN 1 ELSE 0 END AS new FROM x WINDOW w AS (PARTITION BY user_id ORDER BY s)),
c AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY s ROWS UNBOUNDED PRECEDING) AS cluster FROM d) SELECT user_id, CAST(cluster AS BIGINT) AS cluster, count(*) AS n, round(max(s) - min(s), 3) AS span FROM c GROUP BY 1, 2""")
def gap_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions by gaps of more than two hours."""
    e = t(spark, sf_dir, "events").select("user_id", (F.unix_micros(F.col("ts").cast("timestamp")) / 1000000.0).alias("s")).distinct()
    return ordered.gap_clusters(e, ["user_id"], "s", 7200).select("user_id", "cluster", "n", F.round(F.col("hi") - F.col("lo"), 3).alias("span"))


@query("""WITH r AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i, value > 60 AS a FROM events), g AS (SELECT user_id, i, i - row_number() OVER (PARTITION BY user_id ORDER BY i) AS g FROM r WHERE a)
SELECT user_id, min(i) AS first, max(i) AS last, count(*) AS n FROM g GROUP BY user_id, g HAVING count(*) >= 3""")
def active_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of three or more active rows."""
    e = t(spark, sf_dir, "events").select("user_id", "ts", "event_id", "value")
    return ordered.runs(e, ["user_id"], ["ts", "event_id"], F.col("value") > 60, 3).select("user_id", "first", "last", "n")


@query("""WITH b AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity AS q, l_quantity + l_discount * 100 AS r FROM lineitem), n AS (SELECT *, CASE WHEN abs(q - lag(q) OVER w) <= 12 AND abs(r - lag(r) OVER w) <= 12 THEN 0 ELSE 1 END AS new FROM b WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, q)),
g AS (SELECT l_orderkey, sum(new) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, q ROWS UNBOUNDED PRECEDING) AS block FROM n) SELECT l_orderkey, CAST(block AS BIGINT) AS block, count(*) AS bands FROM g GROUP BY 1, 2 HAVING count(*) >= 2""")
def boundary_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consecutive bands of the same boundaries within 12."""
    x = t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").alias("q"), F.array(F.col("l_quantity"), F.col("l_quantity") + F.col("l_discount") * 100).alias("b"))
    return ordered.boundary_groups(x, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey", "q"], "b", 12, 2)


_DEPTH = f"replace({BRACKETED}, CASE WHEN page_id % 3 = 0 THEN '(p' ELSE '(/p' END, 'p')"


@query(f"""WITH s AS (SELECT page_id, {_DEPTH} AS x FROM pages), c AS (SELECT page_id, unnest(string_split(x, '')) AS ch, generate_subscripts(string_split(x, ''), 1) AS i FROM s),
d AS (SELECT page_id, i, sum(CASE WHEN ch IN ('(', '[') THEN 1 WHEN ch IN (')', ']') THEN -1 ELSE 0 END) OVER (PARTITION BY page_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS d FROM c)
SELECT page_id, CAST(arg_max(d, i) AS INT) AS final, CAST(least(0, min(d)) AS INT) AS lowest, CAST(min(i) FILTER (d < 0) AS INT) AS first_negative FROM d GROUP BY 1""")
def running_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Depth along a text as a fold over its characters."""
    return t(spark, sf_dir, "pages").select("page_id", ordered.running_depth(F.expr(_DEPTH)).alias("d")).select("page_id", "d.*")


@query("""WITH a AS (SELECT p_partkey, string_split(p_name, 'e') AS s FROM part) SELECT p_partkey, CASE WHEN len(s) > 2 THEN array_to_string(s[1:2], 'e') || array_to_string(s[3:], '') ELSE array_to_string(s, 'e') END AS x FROM a""")
def nth_occurrence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Later occurrences of a character go."""
    return t(spark, sf_dir, "part").select("p_partkey", ordered.nth_dropped(F.col("p_name"), "e", 1).alias("x"))


_READ = """SELECT o_orderkey AS cell, 'crop' AS source, CAST(o_custkey AS {s}) AS text, 1 AS n_boxes, 0 AS pos FROM orders
UNION ALL SELECT o_orderkey, 'line', CAST(CASE WHEN o_orderkey % 3 = 0 THEN o_custkey ELSE o_custkey + o_orderkey % 2 END AS {s}), 1, 1 FROM orders
UNION ALL SELECT o_orderkey, 'ch', CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE concat(CAST(o_custkey / 10 AS BIGINT), ' ', o_custkey % 10) END, 2, 2 FROM orders
UNION ALL SELECT o_orderkey, 'en', CASE WHEN o_orderkey % 4 = 0 THEN 'ab c' ELSE concat(' ', o_custkey) END, CAST(1 + o_orderkey % 2 AS INT), 3 FROM orders"""
_READ_DUCK = _READ.format(s="VARCHAR").replace("CAST(o_custkey / 10 AS BIGINT)", "o_custkey // 10")


@query(
    f"""WITH r AS ({_READ_DUCK}), v AS (SELECT *, TRY_CAST(regexp_replace(text, '[, ]', '', 'g') AS DOUBLE) AS value FROM r WHERE trim(text) <> ''),
k AS (SELECT *, CASE WHEN value IS NOT NULL THEN 'n' || value ELSE 't' || upper(regexp_replace(text, '\\s+', '', 'g')) END AS k FROM v),
g AS (SELECT cell, k, count(*) AS n, min(n_boxes) AS b, min(pos) AS p FROM k GROUP BY 1, 2), w AS (SELECT *, row_number() OVER (PARTITION BY cell ORDER BY b > 1, n DESC, b, p) AS rk FROM g),
c AS (SELECT k.*, w.n, row_number() OVER (PARTITION BY k.cell ORDER BY CASE WHEN w.n > 1 AND source = 'ch' THEN 0 WHEN w.n > 1 AND source = 'en' THEN 1 ELSE 2 END, n_boxes, CASE source WHEN 'crop' THEN 0 WHEN 'line' THEN 1 WHEN 'ch' THEN 2 ELSE 3 END) AS ck FROM k JOIN w ON k.cell = w.cell AND k.k = w.k AND w.rk = 1)
SELECT cell, text, source, value, n AS agreeing FROM c WHERE ck = 1"""
)
def agreeing_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V3: the reading that most readings of a cell agree with."""
    t(spark, sf_dir, "orders").createOrReplaceTempView("orders_q")
    r = spark.sql(_READ.format(s="STRING").replace("CAST(o_custkey / 10 AS BIGINT)", "o_custkey div 10").replace("FROM orders", "FROM orders_q"))
    return readings.agreeing_group(r, "cell", F.lit(True))


@query("SELECT o_orderkey, CASE WHEN trim(a) <> '' THEN a WHEN trim(b) <> '' THEN b END AS filled, CASE WHEN TRY_CAST(a AS DOUBLE) IS NOT NULL THEN a WHEN TRY_CAST(b AS DOUBLE) IS NOT NULL THEN b WHEN trim(a) <> '' THEN a WHEN trim(b) <> '' THEN b END AS number FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN ' ' ELSE o_orderpriority END AS a, CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_custkey AS VARCHAR) ELSE '' END AS b FROM orders)")
def priority_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings in order of trust."""
    x = t(spark, sf_dir, "orders").selectExpr("o_orderkey", "CASE WHEN o_orderkey % 3 = 0 THEN ' ' ELSE o_orderpriority END AS a", "CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_custkey AS STRING) ELSE '' END AS b")
    return x.select("o_orderkey", readings.first_filled(F.col("a"), F.col("b")).alias("filled"), readings.first_number(F.col("a"), F.col("b")).alias("number"))


@query("SELECT o_orderkey, list_filter([upper(trim(concat(' ', lower(o_orderstatus), ' '))), substr(o_orderpriority, 3, 1), 'B'], lambda x: x IN ('A', 'B', 'C', 'D', 'F'))[1] AS grade FROM orders")
def closed_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first candidate that is an allowed grade."""
    c = F.array(F.concat(F.lit(" "), F.lower("o_orderstatus"), F.lit(" ")), F.substring("o_orderpriority", 3, 1), F.lit("B"))
    return t(spark, sf_dir, "orders").select("o_orderkey", readings.closed_set(c, ("A", "B", "C", "D", "F")).alias("grade"))


@query(
    """WITH a AS (SELECT p_partkey, [concat('C(', p_type), concat('=O', CASE WHEN p_partkey % 3 = 0 THEN ')' ELSE '' END), 'N'] AS p, [concat('C(', p_type, ')'), concat('=O)', p_partkey % 7), CASE WHEN p_partkey % 2 = 0 THEN 'N' ELSE '' END] AS s FROM part),
c AS (SELECT p_partkey, array_to_string(p, '') AS x, CASE WHEN p[1] <> s[1] THEN s[1] || p[2] || p[3] END AS x1, CASE WHEN p[2] <> s[2] THEN p[1] || s[2] || p[3] END AS x2 FROM a),
v AS (SELECT *, length(replace(x, '(', '')) = length(replace(x, ')', '')) AS ok, coalesce(length(replace(x1, '(', '')) = length(replace(x1, ')', '')), false) AS ok1, coalesce(length(replace(x2, '(', '')) = length(replace(x2, ')', '')), false) AS ok2 FROM c)
SELECT p_partkey, CASE WHEN ok THEN x WHEN ok1 THEN x1 WHEN ok2 THEN x2 ELSE x END AS text, CASE WHEN ok OR NOT (ok1 OR ok2) THEN 0 ELSE 1 END AS changed FROM v"""
)
def vote_lines_bracket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1, V2, J12 with one change at most and brackets as the test."""
    x = t(spark, sf_dir, "part").select(
        "p_partkey",
        F.expr("array(concat('C(', p_type), concat('=O', CASE WHEN p_partkey % 3 = 0 THEN ')' ELSE '' END), 'N')").alias("p"),
        F.expr("array(concat('C(', p_type, ')'), concat('=O)', p_partkey % 7), CASE WHEN p_partkey % 2 = 0 THEN 'N' ELSE '' END)").alias("s"),
    )
    v = readings.vote_one(F.col("p"), F.col("s"), T.balanced)
    return x.select("p_partkey", v.alias("v")).select("p_partkey", "v.text", "v.changed")


@query("SELECT p_partkey, concat(CASE WHEN length(p_brand) > length(p_type) THEN p_brand ELSE p_type END, p_name) AS longest, concat(CASE WHEN length(p_brand) < length(p_type) THEN p_brand ELSE p_type END, p_name) AS shortest FROM part")
def longer_shorter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The longer or the shorter of two readings of each line."""
    p, s = F.array("p_type", "p_name"), F.array("p_brand")
    return t(spark, sf_dir, "part").select("p_partkey", readings.longer(p, s).alias("longest"), readings.shorter(p, s).alias("shortest"))


@query("""WITH s AS (SELECT user_id, ts, event_id, event_type AS k, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events)
SELECT user_id, sha256(string_agg(k, '|' ORDER BY ts, event_id)) AS path, CAST(count(*) AS INT) AS n FROM s WHERE k <> 'view' AND (prev IS NULL OR k <> prev) GROUP BY 1""")
def ctc_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A path without repeats and blanks ('view')."""
    from ..operators.ctc import collapse

    e = t(spark, sf_dir, "events").select("user_id", "ts", "event_id", F.col("event_type").alias("k"))
    return collapse(e, ["user_id"], ["ts", "event_id"], "k", "view").select("user_id", F.sha2(F.array_join("path", "|"), 256).alias("path"), F.size("path").alias("n"))
