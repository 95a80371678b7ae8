"""Queries of scalar operators: keys, headers, layouts, brackets, text repair, screens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from .registry import query, t

#: Structure-like text with typical reading damage, made from a part's key; the same words in Spark and DuckDB.
READING = """concat(
  CASE WHEN p_partkey % 7 = 0 THEN 'H](' WHEN p_partkey % 7 = 1 THEN '[C@H](' WHEN p_partkey % 7 = 2 THEN '@H](C' ELSE 'CC(' END,
  repeat('C(=O)N', CAST(p_partkey % 3 AS INT)),
  CASE WHEN p_partkey % 5 = 0 THEN 'C(O)N' WHEN p_partkey % 5 = 1 THEN 'C(=0)' WHEN p_partkey % 5 = 2 THEN 'C1=O)' WHEN p_partkey % 5 = 3 THEN 'C=O)=O)' ELSE 'N-O)' END,
  CASE WHEN p_partkey % 4 = 0 THEN '[C@@H' WHEN p_partkey % 4 = 1 THEN 'Ca@H]' WHEN p_partkey % 4 = 2 THEN '[Ca@@H]' ELSE '[nH]' END,
  CAST(p_partkey % 10 AS STRING), 'CCl', CASE WHEN p_partkey % 11 = 0 THEN 'é$' ELSE '' END,
  CASE WHEN p_partkey % 3 = 0 THEN '.Br(C.C)' ELSE '' END, '[13C]', CAST(p_size % 10 AS STRING), CASE WHEN p_partkey % 6 = 0 THEN '%12C%12' ELSE ')' END)"""
#: Pages as bracketed text: tags are brackets, and line breaks have lost their closing one.
BRACKETED = "translate(replace(html, '<br>', '<br'), '<>', '()')"
_DUCK = READING.replace("AS STRING", "AS VARCHAR")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t(spark, sf_dir, "part").select("p_partkey", F.expr(READING).alias("x"))


_IDS = """CASE c_custkey % 8 WHEN 0 THEN concat('Compound #', c_custkey) WHEN 1 THEN concat('  cmpd. ', c_custkey, ':') WHEN 2 THEN concat('00', c_custkey) WHEN 3 THEN concat('Compd #1,', 100 + c_custkey % 900)
  WHEN 4 THEN c_name WHEN 5 THEN '  ' WHEN 6 THEN concat('#', c_custkey, '.)') ELSE concat('-0', c_custkey % 3) END"""


@query(
    f"""WITH a AS (SELECT c_custkey, {_IDS} AS raw FROM customer),
b AS (SELECT c_custkey, raw, regexp_replace(regexp_replace(regexp_replace(trim(raw), '^(?:compound|cmpd\\.?|compd\\.?|#)\\s*#?\\s*', '', 'i'), ',', '', 'g'), '[:.) ]+$', '') AS s FROM a)
SELECT c_custkey, raw, CASE WHEN regexp_full_match(s, '[+-]?[0-9]+') THEN CAST(CAST(s AS BIGINT) AS VARCHAR) WHEN s <> '' THEN lower(s) END AS id FROM b"""
)
def key_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.expr(_IDS)
    return t(spark, sf_dir, "customer").select("c_custkey", raw.alias("raw"), T.normalise_id(raw).alias("id"))


_NUMS = "CASE o_orderkey % 6 WHEN 0 THEN concat(' 1,', 100 + o_orderkey % 900, '.5 ') WHEN 1 THEN CAST(o_orderkey AS {s}) WHEN 2 THEN '' WHEN 3 THEN 'n/a' WHEN 4 THEN concat('1 2', o_orderkey % 7) ELSE concat('-.', o_orderkey % 10, 'e1') END"


@query(f"SELECT o_orderkey, TRY_CAST(replace(trim(x), ',', '') AS DOUBLE) AS v, TRY_CAST(regexp_replace(x, '[, ]', '', 'g') AS DOUBLE) AS v_spaced FROM (SELECT o_orderkey, {_NUMS.format(s='VARCHAR')} AS x FROM orders)")
def number_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = F.expr(_NUMS.format(s="STRING"))
    return t(spark, sf_dir, "orders").select("o_orderkey", T.parse_number(x).alias("v"), T.parse_number(x, spaces=True).alias("v_spaced"))


_HEADS = "CASE p_partkey % 6 WHEN 0 THEN ' Cmpd  #' WHEN 1 THEN 'KRAS G12V GDP Kd (nM)' WHEN 2 THEN 'LCMS   RT (min)' WHEN 3 THEN 'MS (m/z)' WHEN 4 THEN p_type ELSE 'ms Polarity ' END"


@query(
    f"""WITH h AS (SELECT p_partkey, lower(regexp_replace(trim({_HEADS}), '\\s+', ' ', 'g')) AS h FROM part),
m(field, h) AS (VALUES {", ".join(f"('{f}', '{n}')" for f, ns in T.HEADER_FIELDS.items() for n in ns)})
SELECT p_partkey, m.field, m.field IS NOT NULL AS known FROM h LEFT JOIN m USING (h)"""
)
def header_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = T.canonical_field(F.expr(_HEADS))
    return t(spark, sf_dir, "part").select("p_partkey", f.alias("field"), f.isNotNull().alias("known"))


@query(
    f"""WITH b AS (SELECT page_id, {BRACKETED} AS x FROM pages),
n AS (SELECT page_id, length(x) - length(replace(x, '(', '')) - length(x) + length(replace(x, ')', '')) AS p, length(x) - length(replace(x, '[', '')) - length(x) + length(replace(x, ']', '')) AS q FROM b),
d AS (SELECT *, greatest(0, p + q) AS deficit FROM n)
SELECT page_id, deficit, greatest(0, -p) AS open_paren, greatest(0, p) AS close_paren, abs(p) + abs(q) AS total,
  CASE WHEN deficit <= 0 THEN 'balanced' WHEN deficit <= 2 THEN 'light' WHEN deficit <= 5 THEN 'medium' WHEN deficit <= 10 THEN 'heavy' ELSE 'extreme' END AS difficulty FROM d"""
)
def bracket_deficit(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = F.expr(BRACKETED)
    out = t(spark, sf_dir, "pages").select("page_id", T.bracket_deficit(x).alias("deficit"), T.bracket_deficits(x).alias("d"))
    return out.select("page_id", "deficit", "d.open_paren", "d.close_paren", "d.total", T.difficulty(F.col("deficit")).alias("difficulty"))


@query(f"SELECT CASE WHEN d <= 0 THEN 'balanced' WHEN d <= 2 THEN 'light' WHEN d <= 5 THEN 'medium' WHEN d <= 10 THEN 'heavy' ELSE 'extreme' END AS difficulty, count(*) AS n, max(d) AS most FROM (SELECT greatest(0, length(replace(x, ')', '')) - length(replace(x, '(', '')) + length(replace(x, ']', '')) - length(replace(x, '[', ''))) AS d FROM (SELECT {BRACKETED} AS x FROM pages)) GROUP BY 1")
def difficulty_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = bracket_deficit(spark, sf_dir).select("deficit", "difficulty")
    return d.groupBy("difficulty").agg(F.count(F.lit(1)).alias("n"), F.max("deficit").alias("most"))


@query(f"WITH b AS (SELECT page_id, {BRACKETED} AS x FROM pages), n AS (SELECT *, length(replace(x, ')', '')) - length(replace(x, '(', '')) AS p, length(replace(x, ']', '')) - length(replace(x, '[', '')) AS q FROM b) SELECT page_id, CASE WHEN p > 0 OR q > 0 THEN sha256(concat(x, repeat(')', greatest(0, p)::INT), repeat(']', greatest(0, q)::INT))) END AS closed FROM n")
def close_brackets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t(spark, sf_dir, "pages").select("page_id", F.sha2(T.close_brackets(F.expr(BRACKETED)), 256).alias("closed"))


def _chiral(col: str) -> str:
    for d in "0123456789":
        col = f"CASE WHEN length(z) - length(replace(z, '{d}', '')) >= 2 THEN regexp_replace({col}, '(\\[C@{{1,2}}H)({d})', '\\1]\\2', 'g') ELSE {col} END" if d == "0" else f"CASE WHEN length(z) - length(replace(z, '{d}', '')) >= 2 THEN regexp_replace(r{int(d) - 1}, '(\\[C@{{1,2}}H)({d})', '\\1]\\2', 'g') ELSE r{int(d) - 1} END"
        if d == "0":
            steps = [f"SELECT *, {col} AS r0 FROM a4"]
        else:
            steps.append(f"SELECT *, {col} AS r{d} FROM s{int(d) - 1}")
    return ", ".join(f"s{i} AS ({q})" for i, q in enumerate(steps))


@query(
    f"""WITH a0 AS (SELECT p_partkey, regexp_replace({_DUCK}, '[^\\x00-\\x7F]+', '', 'g') AS x FROM part),
a1 AS (SELECT p_partkey, regexp_replace(replace(x, 'C(O)N', 'C(=O)N'), 'C\\(=[0O]\\)?N', 'C(=O)N', 'g') AS x FROM a0),
a2 AS (SELECT p_partkey, replace(x, 'C(=0)', 'C(=O)') AS x FROM a1),
a3 AS (SELECT p_partkey, CASE WHEN length(x) - length(replace(x, '0', '')) = 1 THEN replace(x, '=0', '=O') ELSE x END AS x FROM a2),
a4 AS (SELECT p_partkey, regexp_replace(x, '(\\[C@{{1,2}}H)\\(', '\\1](', 'g') AS z FROM a3), {_chiral("z")}
SELECT p_partkey, trim(CASE WHEN starts_with(r9, 'H](') OR starts_with(r9, '@H](') THEN concat('CC[C@', r9) WHEN starts_with(r9, '[C@H](') THEN concat('CC', r9) ELSE r9 END) AS repaired FROM s9"""
)
def auto_repair_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings(spark, sf_dir).select("p_partkey", T.repair_syntax(F.col("x")).alias("repaired"))


@query(
    f"""WITH a AS (SELECT p_partkey, regexp_replace({_DUCK}, '([(0-9][-=])O\\)', '\\1' || chr(1) || 'O' || chr(2), 'g') AS x FROM part),
b AS (SELECT p_partkey, x, regexp_replace(x, '([^' || chr(2) || '\\n])[-=]O\\)', '\\1(=O)', 'g') AS y FROM a)
SELECT p_partkey, replace(replace(y, chr(1), ''), chr(2), ')') AS text, CAST(len(regexp_extract_all(x, '[^' || chr(2) || '\\n][-=]O\\)')) AS INT) AS n FROM b"""
)
def rewrite_oxo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings(spark, sf_dir).select("p_partkey", T.rewrite_oxo(F.col("x")).alias("r")).select("p_partkey", "r.text", "r.n")


@query(
    f"""WITH a AS (SELECT p_partkey, {_DUCK} AS x FROM part), b AS (SELECT *, regexp_replace(x, 'Ca(@@?)H\\]', '[C\\1H]', 'g') AS y FROM a)
SELECT p_partkey, regexp_replace(y, '\\[Ca(@@?)H\\]', '[C\\1H]', 'g') AS text, CAST(len(regexp_extract_all(x, 'Ca@@?H\\]')) AS INT) AS n_chiral, CAST(len(regexp_extract_all(y, '\\[Ca@@?H\\]')) AS INT) AS n_bracket FROM b"""
)
def lexical_prepass(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings(spark, sf_dir).select("p_partkey", T.lexical_prepass(F.col("x")).alias("r")).select("p_partkey", "r.*")


_N = lambda p: f"CAST(len(regexp_extract_all(x, '{p}')) AS INT)"


@query(
    f"""WITH a AS (SELECT p_partkey, {_DUCK} AS x FROM part),
n AS (SELECT *, {_N("[(]")} - {_N("[)]")} AS p, {_N("\\[")} - {_N("\\]")} AS q FROM a)
SELECT p_partkey, length(x) AS length, greatest(0, -p) AS open_paren, greatest(0, p) AS close_paren, greatest(0, -q) AS open_bracket, greatest(0, q) AS close_bracket, abs(p) + abs(q) AS min_total,
 {_N("-")} AS hyphen, {_N("a@H")} AS a_at_h, {_N("Ca@@?H\\]")} AS ca_chiral, {_N("-\\)")} AS hyphen_before_close, {_N("=[ONS]\\)")} AS bare_equals_close FROM n"""
)
def edit_model_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings(spark, sf_dir).select("p_partkey", T.edit_report(F.col("x")).alias("r")).select("p_partkey", "r.*")


_ILLEGAL_DUCK = T._ILLEGAL.replace("'", "''")


@query(f"SELECT ch, count(*) AS n_texts, min(doc_id) AS first_id FROM (SELECT DISTINCT doc_id, ch FROM (SELECT doc_id, unnest(regexp_extract_all(text, '{_ILLEGAL_DUCK}')) AS ch FROM documents)) GROUP BY ch")
def alphabet_census(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Characters no printed structure holds; a text counts once for each, so rows are few before they are shuffled."""
    x = t(spark, sf_dir, "documents").select("doc_id", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(f"({T._ILLEGAL})"), 1))).alias("ch"))
    return x.groupBy("ch").agg(F.count(F.lit(1)).alias("n_texts"), F.min("doc_id").alias("first_id"))


@query(
    f"""WITH a AS (SELECT p_partkey, {_DUCK} AS x FROM part), o AS (SELECT *, regexp_replace(x, '\\[[^\\]]*\\]', '', 'g') AS y FROM a),
c AS (SELECT p_partkey, replace(unnest(regexp_extract_all(y, '%[0-9][0-9]|[1-9]')), '%', '') AS d FROM o), g AS (SELECT p_partkey, d, count(*) AS n FROM c GROUP BY 1, 2),
s AS (SELECT p_partkey, count(*) AS labels, sum(n) AS uses, count(*) FILTER (n % 2 = 1) AS unclosed FROM g GROUP BY 1)
SELECT a.p_partkey, CAST(coalesce(labels, 0) AS INT) AS labels, CAST(coalesce(uses, 0) AS INT) AS uses, CAST(coalesce(unclosed, 0) AS INT) AS unclosed, CAST(len(regexp_extract_all(o.y, '%[0-9][0-9]|[0-9]')) AS INT) AS digits FROM a JOIN o USING (p_partkey) LEFT JOIN s USING (p_partkey)"""
)
def ring_digit_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = readings(spark, sf_dir).select("p_partkey", T.ring_closures(F.col("x")).alias("c"), T.ring_digits(F.col("x")).alias("d"))
    x = x.select("p_partkey", T.tally(F.col("c")).alias("m"), F.size("c").alias("uses"), F.size("d").alias("digits"))
    return x.select("p_partkey", F.size("m").alias("labels"), "uses", F.size(F.filter(F.map_values("m"), lambda v: v % 2 == 1)).alias("unclosed"), "digits")


_DAMAGE = "concat(replace(substr(p_name, 1, 3), 'a', ''), upper(substr(p_name, 4, 2)), substr(p_name, 6), CASE WHEN p_partkey % 4 = 0 THEN 'x' ELSE '' END)"


@query(f"SELECT p_partkey, CAST(levenshtein(p_name, y) AS INT) AS edits, round(levenshtein(p_name, y) / length(p_name), 6) AS cer, p_name = y AS exact FROM (SELECT *, {_DAMAGE} AS y FROM part)")
def edit_distance_cer(spark: SparkSession, sf_dir: str) -> DataFrame:
    y = F.expr(_DAMAGE)
    return t(spark, sf_dir, "part").select("p_partkey", F.levenshtein("p_name", y).alias("edits"), F.round(T.cer(F.col("p_name"), y), 6).alias("cer"), (F.col("p_name") == y).alias("exact"))


@query(f"SELECT p_type, count(*) AS n, count(*) FILTER (p_name = y) AS exact, sum(levenshtein(p_name, y))::BIGINT AS edits, round(sum(levenshtein(p_name, y)) / sum(length(p_name)), 6) AS cer FROM (SELECT *, {_DAMAGE} AS y FROM part) GROUP BY 1")
def accuracy_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accuracy over groups."""
    x = t(spark, sf_dir, "part").select("p_type", "p_name", F.expr(_DAMAGE).alias("y")).select("*", F.levenshtein("p_name", "y").cast("long").alias("e"))
    return x.groupBy("p_type").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("p_name") == F.col("y")).alias("exact"), F.sum("e").alias("edits"), F.round(F.sum("e") / F.sum(F.length("p_name")), 6).alias("cer"))


_FORMULA = "concat('C', p_size, 'H', p_size * 2, CASE WHEN p_partkey % 3 = 0 THEN 'Cl' ELSE 'N' END, 'O', p_partkey % 5, 'C2')"


@query(
    f"""WITH f AS (SELECT p_partkey, {_FORMULA} AS x FROM part), m AS (SELECT p_partkey, unnest(regexp_extract_all(x, '([A-Z][a-z]?)([0-9]*)', 1)) AS e, unnest(regexp_extract_all(x, '([A-Z][a-z]?)([0-9]*)', 2)) AS n FROM f),
c AS (SELECT p_partkey, e, CASE WHEN n = '' THEN 1 ELSE CAST(n AS INT) END AS n FROM m)
SELECT p_partkey, CAST(sum(n) FILTER (e = 'C') AS INT) AS carbon, CAST(sum(n) AS INT) AS atoms, CAST(count(DISTINCT e) AS INT) AS elements,
 round(sum(n * CASE e WHEN 'C' THEN 12.0::DOUBLE WHEN 'H' THEN 1.0078250319 WHEN 'N' THEN 14.0030740048 WHEN 'O' THEN 15.9949146196 WHEN 'Cl' THEN 34.96885271 END), 4) AS mass FROM c GROUP BY 1"""
)
def formula_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..functions import mass as M

    x = t(spark, sf_dir, "part").select("p_partkey", T.formula_counts(F.expr(_FORMULA)).alias("m"))
    return x.select("p_partkey", F.element_at("m", "C").alias("carbon"), M.total(F.col("m")).alias("atoms"), F.size("m").alias("elements"), F.round(M.heavy_mass(F.col("m")), 4).alias("mass"))


@query(
    f"""SELECT signature, first_char, count(*) AS n FROM (SELECT CASE WHEN length(regexp_replace(x, '[^(]', '', 'g')) <> length(regexp_replace(x, '[^)]', '', 'g')) THEN 'paren' WHEN length(regexp_replace(x, '[^\\[]', '', 'g')) <> length(regexp_replace(x, '[^\\]]', '', 'g')) THEN 'bracket'
 WHEN regexp_matches(x, '{_ILLEGAL_DUCK}') THEN 'character' ELSE 'none' END AS signature, CASE WHEN x = '' THEN 'missing' WHEN substr(x, 1, 1) = '=' THEN 'equals' WHEN substr(x, 1, 1) = '-' THEN 'minus' ELSE 'other' END AS first_char
 FROM (SELECT substr({_DUCK}, 1 + CAST(p_partkey % 12 AS INT)) AS x FROM part)) GROUP BY 1, 2"""
)
def error_signature(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first signature that fits, then counts."""
    x = F.col("x")
    sig = F.when(T.count(x, "(") != T.count(x, ")"), "paren").when(T.count(x, "[") != T.count(x, "]"), "bracket").when(~T.legal(x), "character").otherwise("none")
    r = readings(spark, sf_dir).select(F.expr("substr(x, 1 + cast(p_partkey % 12 as int))").alias("x"))
    return r.select(sig.alias("signature"), T.first_char_class(x).alias("first_char")).groupBy("signature", "first_char").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT page_id, link, count(*) AS n, substr(sha1(link), 1, 12) AS digest FROM (SELECT page_id, unnest(regexp_extract_all(html, 'href=\"([^\"]*)\"', 1)) AS link FROM pages) GROUP BY 1, 2")
def links_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of a page with a short digest."""
    x = t(spark, sf_dir, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), 1)).alias("link"))
    return x.groupBy("page_id", "link").agg(F.count(F.lit(1)).alias("n")).select("*", T.digest12(F.col("link")).alias("digest"))


@query("SELECT DISTINCT link FROM (SELECT unnest(regexp_extract_all(html, 'href=\"([^\"]*)\"', 1)) AS link FROM pages) l WHERE NOT EXISTS (SELECT 1 FROM region r WHERE '/' || lower(r.r_name) = l.link) AND link NOT IN ('/the', '/of')")
def links_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links that no curated list has."""
    x = t(spark, sf_dir, "pages").select(F.explode(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), 1)).alias("link")).distinct()
    known = t(spark, sf_dir, "region").select(F.concat(F.lit("/"), F.lower("r_name")).alias("link"))
    return x.join(known, "link", "left_anti").filter(~F.col("link").isin("/the", "/of"))


@query("SELECT doc_id, substr(text, greatest(0, p - 12) + 1, p + 13 - greatest(0, p - 12)) AS around FROM (SELECT doc_id, text, instr(text, '$') - 1 AS p FROM documents) WHERE p >= 0")
def context_snippet(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = t(spark, sf_dir, "documents").select("doc_id", "text", (F.instr("text", F.lit("$")) - 1).alias("p")).filter("p >= 0")
    return x.select("doc_id", T.context(F.col("text"), F.col("p"), 12).alias("around"))


@query(
    """WITH l AS (SELECT doc_id, unnest(list_filter(string_split(text, chr(10)), lambda s: s <> '')) AS s FROM documents),
a AS (SELECT doc_id, count(*) AS n_rows, min(length(s)) AS shortest, max(length(s)) AS longest, avg(length(s)) AS mean, stddev_pop(length(s)) AS sd FROM l GROUP BY 1),
b AS (SELECT d.doc_id, coalesce(n_rows, 0) AS n_rows, coalesce(shortest, 0) AS shortest, coalesce(longest, 0) AS longest, CASE WHEN mean > 0 THEN round(sd / mean, 4) END AS cv,
  length(regexp_replace(text, '[^(]', '', 'g')) = length(regexp_replace(text, '[^)]', '', 'g')) AND length(regexp_replace(text, '[^\\[]', '', 'g')) = length(regexp_replace(text, '[^\\]]', '', 'g')) AS bal, contains(text, '()') AS empty_branch FROM documents d LEFT JOIN a USING (doc_id))
SELECT doc_id, n_rows, cv, CASE WHEN NOT bal OR empty_branch OR n_rows = 0 THEN 'fail' WHEN shortest < 20 OR longest > 2000 OR n_rows NOT IN (7, 8, 10, 11) THEN 'suspect' ELSE 'pass' END AS verdict,
 concat_ws('; ', CASE WHEN NOT bal THEN 'unbalanced' END, CASE WHEN empty_branch THEN 'empty branch' END, CASE WHEN n_rows = 0 THEN 'no rows' END, CASE WHEN shortest < 20 THEN 'short row' END, CASE WHEN longest > 2000 THEN 'long row' END, CASE WHEN n_rows NOT IN (7, 8, 10, 11) THEN 'row count' END) AS reasons FROM b"""
)
def quality_screen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A screen that needs no reference. Row lengths are measured in the row's own array, without exploding."""
    from ..operators.analytics import quality_screen as screen

    return screen(t(spark, sf_dir, "documents"), "doc_id", "text", (20, 2000), (7, 8, 10, 11))


@query("SELECT conv_id, turn, upper(regexp_replace(text, '\\s+', '', 'g')) = upper(regexp_replace(lead(text) OVER w, '\\s+', '', 'g')) AS same_as_next FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)")
def comparison_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = t(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text", T.comparison_key(F.col("text")).alias("k"))
    w = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return k.select("conv_id", "turn", (F.col("k") == F.lead("k").over(w)).alias("same_as_next"))


@query("SELECT p_partkey, o.part, o.i FROM (SELECT p_partkey, unnest(string_split(concat(p_name, '.', p_brand, '.x(', p_size, ')'), '.')) AS part, generate_subscripts(string_split(concat(p_name, '.', p_brand, '.x(', p_size, ')'), '.'), 1) - 1 AS i FROM part) o")
def top_level_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = F.expr("concat(p_name, '.', p_brand, '.x(', p_size, ')')")
    return t(spark, sf_dir, "part").select("p_partkey", F.posexplode(T.top_level_parts(x)).alias("i", "part"))
