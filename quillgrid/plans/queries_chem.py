"""Queries of the chemistry kernel, votes and searches over structure strings made from keys."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..chem import molecule as M
from ..chem import prefix as P
from ..chem import repairs as R
from ..chem import search as S
from ..operators import ctc
from . import policy, schema
from .registry import query, t

#: A peptide macrocycle of 6 to 8 residues, its side chains by key; every third one is damaged in one of six ways.
_RES = ["N[C@@H](C)C(=O)", "N[C@@H](CC(C)C)C(=O)", "N(C)[C@@H](Cc2ccccc2)C(=O)", "N2CCC[C@H]2C(=O)", "NCC(=O)"]


def structures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """p_partkey, whole, damaged."""
    x = t(spark, sf_dir, "part").select("p_partkey", "p_size")
    res = F.array(*[F.lit(r) for r in _RES])
    n = (6 + F.col("p_partkey") % 3).cast("int")
    body = F.array_join(F.transform(F.sequence(F.lit(1), n), lambda i: F.element_at(res, ((F.col("p_partkey") * 7 + i * i * 3 + F.col("p_size")) % len(_RES) + 1).cast("int"))), "")
    whole = F.concat(F.lit("C1C(=O)"), body, F.lit("N1"))
    k = F.col("p_partkey") % 18
    s = F.col("whole")
    damaged = (
        F.when(k == 0, F.expr("substr(whole, 1, length(whole) - 2)"))
        .when(k == 3, F.regexp_replace(s, r"\)N1$", "N1"))
        .when(k == 6, F.concat(s, F.lit(".CC")))
        .when(k == 9, F.regexp_replace(s, r"^C1C", "C1C1C"))
        .when(k == 12, F.concat(s, F.lit(")")))
        .when(k == 15, F.replace(s, F.lit("[C@@H]("), F.lit("Ca@@H](")))
        .otherwise(s)
    )
    return x.select("p_partkey", whole.alias("whole")).select("p_partkey", "whole", damaged.alias("damaged"))


# The same strings in SQL, and what follows from how they are put together.
_SQL_RES = ", ".join(f"'{r}'" for r in _RES)
_PARTS = f"""r0 AS (SELECT p_partkey, p_size, list_transform(range(1, 7 + p_partkey % 3), lambda i: 1 + (p_partkey * 7 + i * i * 3 + p_size) % 5) AS r FROM part),
w AS (SELECT p_partkey, r, len(r) AS n, concat('C1C(=O)', array_to_string(list_transform(r, lambda x: [{_SQL_RES}][x]), ''), 'N1') AS whole FROM r0),
d AS (SELECT *, CASE p_partkey % 18 WHEN 0 THEN substr(whole, 1, length(whole) - 2) WHEN 3 THEN concat(substr(whole, 1, length(whole) - 3), 'N1') WHEN 6 THEN concat(whole, '.CC') WHEN 9 THEN concat('C1', whole) WHEN 12 THEN concat(whole, ')') WHEN 15 THEN replace(whole, '[C@@H](', 'Ca@@H](') ELSE whole END AS damaged FROM w),
e AS (SELECT *, 2 + list_sum(list_transform(r, lambda x: [3, 6, 10, 5, 2][x])) AS nc, 3 + list_sum(list_transform(r, lambda x: [5, 11, 11, 7, 3][x])) AS nh, n + 1 AS nn, len(list_filter(r, lambda x: x IN (3, 4))) AS tertiary FROM d)"""
_FORMULA = "concat('C', nc, 'H', nh, 'N', nn, 'O', nn)"


@query(f"""WITH {_PARTS} SELECT p_partkey, {_FORMULA} AS formula, CAST(nc + 2 * nn AS INT) AS heavy_atoms, round((nc * 12.0 + nh * {M.EXACT["H"]!r} + nn * {M.EXACT["N"]!r} + nn * {M.EXACT["O"]!r})::DOUBLE, 4) AS exact_mass, CAST(1 + tertiary AS INT) AS rings, CAST(3 * nn AS INT) AS largest_ring,
 CAST(nn AS INT) AS amides, CAST(len(list_filter(r, lambda x: x <> 5)) AS INT) AS stereo_centres, round(12.03 * (nn - tertiary) + 3.24 * tertiary + 17.07 * nn, 2) AS tpsa, CAST(2 * len(list_filter(r, lambda x: x IN (2, 3))) AS INT) AS rotatable, true AS same FROM e""")
def parse_chem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the parser reads off a string, and that another writing of the ring has the same canonical string."""
    x = structures(spark, sf_dir).select("p_partkey", "whole", F.concat(F.lit("N1CC(=O)"), F.expr("substr(whole, 8, length(whole) - 14)"), F.lit("C1=O")).alias("other"))
    x = policy.with_fingerprint(policy.with_fingerprint(x, "whole", "fp"), "other", "op")
    return x.select("p_partkey", "fp.formula", "fp.heavy_atoms", "fp.exact_mass", "fp.rings", "fp.largest_ring", "fp.amides", "fp.stereo_centres", "fp.tpsa", "fp.rotatable", (F.col("fp.canonical") == F.col("op.canonical")).alias("same"))


@query(f"""WITH {_PARTS} SELECT p_partkey, CAST(CASE WHEN p_partkey % 18 = 6 THEN nc + 2 * nn ELSE nc + 2 * nn END AS INT) AS heavy_atoms, {_FORMULA} AS formula FROM e WHERE p_partkey % 18 NOT IN (0, 3, 9, 12, 15)""")
def largest_fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fragment with most heavy atoms, of texts that parse."""
    x = policy.with_largest_fragment(structures(spark, sf_dir).filter("p_partkey % 18 NOT IN (0, 3, 9, 12, 15)"), "damaged", "part")
    return policy.with_fingerprint(x, "part", "fp").select("p_partkey", "fp.heavy_atoms", "fp.formula")


_KINDS = ("CASE p_partkey % 6 WHEN 0 THEN concat('C1', whole) WHEN 1 THEN concat(substr(whole, 1, length(whole) - 2), '.N1') WHEN 2 THEN concat(whole, 'C(=') WHEN 3 THEN concat('CCCCCC(=O)', substr(whole, 8, length(whole) - 9), 'NCCCCC') "
          "WHEN 4 THEN substr(whole, 1, length(whole) - 2) ELSE whole END")  # fmt: skip


@query("""SELECT p_partkey, ['syntax_fix', 'rejoin_fragments', 'strip_truncated_tail', 'terminal_bridge', NULL][1 + p_partkey % 6] AS method, ['high', 'medium', 'low', 'experimental', 'rejected'][1 + p_partkey % 6] AS tier,
['', 'check_fragment_bond_order_manually', 'truncated_0_atoms', 'invented_0_atoms', 'no_repair_found'][1 + p_partkey % 6] AS note, 0 AS atoms_invented, p_partkey % 6 < 2 AS validated FROM part WHERE p_partkey % 6 <> 5""")
def audit_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repairs of strings damaged in ways that call for different strategies, one tier each; digits that stand three times are tested apart."""
    x = structures(spark, sf_dir).select("p_partkey", F.expr(_KINDS).alias("x"))
    return policy.with_repair(x, "x", "a").filter("a.tier IS NOT NULL").select("p_partkey", "a.method", "a.tier", "a.note", "a.atoms_invented", "a.validated")


@query(f"WITH {_PARTS} SELECT p_partkey, whole AS repaired FROM w")
def auto_repair_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bracket printed as its mirror image, an amide's oxygen without its double bond."""
    x = structures(spark, sf_dir).select("p_partkey", F.expr("CASE p_partkey % 3 WHEN 0 THEN regexp_replace(whole, '^(.*?)\\\\[C@', '$1]C@') WHEN 1 THEN replace(whole, 'C(=O)N[', 'C(O)N[') ELSE whole END").alias("x"))
    return policy.with_auto_repair(x, "x", "repaired").select("p_partkey", "repaired")


@query(f"WITH {_PARTS} SELECT p_partkey, CAST(len(list_filter(r, lambda x: x IN (1, 2))) AS INT) AS n_fixes, true AS parses, {_FORMULA} AS formula FROM e")
def rewrite_and_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C11, E17."""
    x = structures(spark, sf_dir).select("p_partkey", F.regexp_replace("whole", r"\(=O\)N\[", "=O)N[").alias("x"))
    return policy.rewrite_and_parse(x, "x").select("p_partkey", "n_fixes", F.col("fp").isNotNull().alias("parses"), "fp.formula")


def combined(spark: SparkSession, sf_dir: str, search: bool = False) -> DataFrame:
    """Records of both sides, assembled, promoted, derived: the table that is delivered, as typed columns."""
    from ..operators.records import assemble

    s = structures(spark, sf_dir)
    comp = policy.with_fingerprint(s.filter("p_partkey % 11 <> 5"), "damaged", "fp").select(
        F.col("p_partkey").cast("string").alias("cmpd_id"), F.col("damaged").alias("smiles"), F.when(F.col("p_partkey") % 4 == 1, F.col("fp.canonical")).alias("canonical_smiles"),
        F.col("fp").isNotNull().alias("is_valid"), F.lit(None).cast("double").alias("ocr_avg_entropy"), (F.col("p_partkey") % 9).cast("int").alias("ocr_low_conf_count"),
    )
    model = policy.with_fingerprint(s, "damaged", "fp").select(F.col("p_partkey").cast("string").alias("cmpd_id"), F.col("damaged").alias("smiles_decimer"), F.col("fp.canonical").alias("canonical_smiles_decimer"))
    assay = policy.with_fingerprint(s.filter("p_partkey % 13 <> 7"), "whole", "fp").select(
        F.col("p_partkey").cast("string").alias("cmpd_id"), (F.col("p_partkey") % 50 * 3000.0).alias("kd_nm"), (F.col("p_partkey") % 40 * 1.0).alias("rt_min"),
        F.round(F.col("fp.exact_mass") + 1.007276466 + F.when(F.col("p_partkey") % 5 == 0, 1.0).otherwise(0.0), 1).alias("ms_mz"), F.lit("[M+H]+").alias("ms_polarity"),
    )
    rows = policy.derived_layers(policy.promote(assemble(comp, assay, "cmpd_id", model)))
    return policy.search_layer(rows) if search else rows


@query("""WITH k AS (SELECT p_partkey AS p, p_partkey % 18 AS k, p_partkey % 11 = 5 AS bare, p_partkey % 13 = 7 AS unmeasured FROM part), m AS (SELECT *, k IN (0, 3, 15) AS lost, k IN (9, 12) AS mended, p % 4 = 1 AS printed FROM k WHERE NOT (bare AND unmeasured)),
v AS (SELECT *, CASE WHEN bare OR lost OR unmeasured THEN 'unknown' WHEN k IN (6, 9) OR p % 5 = 0 THEN 'mismatch' ELSE 'match' END AS verdict FROM m)
SELECT CAST(p AS VARCHAR) AS cmpd_id, CASE WHEN bare THEN 'not_attempted' WHEN lost THEN 'rejected' WHEN k = 12 AND verdict = 'match' THEN 'validated' WHEN mended THEN 'experimental' ELSE 'not_repaired' END AS repair_review_status,
 CASE WHEN bare THEN 'no_decimer_output' WHEN lost THEN 'no_repair_found' WHEN mended THEN 'syntax_fix' ELSE '' END AS repair_method, CASE WHEN mended AND NOT bare THEN 'high' ELSE 'none' END AS repair_confidence,
 CASE WHEN mended AND NOT bare THEN 'True' ELSE 'False' END AS is_repaired, CASE WHEN bare OR lost THEN '' WHEN mended THEN 'repair_syntax_fix' WHEN printed THEN 'printed_ocr' ELSE 'decimer' END AS smiles_best_source, verdict AS ms_check_verdict,
 CASE WHEN bare OR lost THEN 'no_structure' WHEN printed AND NOT mended THEN CASE WHEN verdict = 'match' THEN 'printed_mass_verified' ELSE 'printed_text' END WHEN verdict = 'match' THEN 'mass_verified' WHEN verdict = 'mismatch' THEN 'mass_mismatch' ELSE 'no_mass_reference' END AS structure_confidence,
 CASE WHEN NOT unmeasured AND (p % 50 >= 34 OR p % 50 = 0 OR p % 40 > 30) THEN 'partial' ELSE 'ok' END AS data_quality, CASE WHEN bare THEN 'no_ocr' WHEN k = 3 THEN 'light' ELSE 'balanced' END AS ocr_difficulty,
 CASE WHEN bare THEN '' WHEN lost OR mended THEN 'False' ELSE 'True' END AS is_valid, CASE WHEN bare OR lost OR mended THEN '' ELSE 'True' END AS decimer_macrocycle_intact FROM v""")
def promotion_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the policy decides for each row of the delivered table."""
    x = schema.as_text(combined(spark, sf_dir), schema.combined_columns())
    return x.select("cmpd_id", "repair_review_status", "repair_method", "repair_confidence", "is_repaired", "smiles_best_source", "ms_check_verdict", "structure_confidence", "data_quality", "ocr_difficulty", "is_valid", "decimer_macrocycle_intact")


@query()
def promotion_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The delivered table, all columns as text."""
    return schema.as_text(combined(spark, sf_dir), schema.combined_columns())


@query()
def mass_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V7 to V9 on all readings, with the operator's own budget of states."""
    from ..functions import mass as X

    s = policy.with_fingerprint(structures(spark, sf_dir), "whole", "fp").select("p_partkey", F.col("damaged").alias("smiles"), F.round(F.col("fp.exact_mass") + X.PROTON, 1).alias("ms_mz"), F.when(F.col("p_partkey") % 10 != 0, "[M+H]+").alias("ms_polarity"))
    return policy.search_layer(s).select("p_partkey", "smiles_ocr_repaired", "ocr_repair_trace", "ocr_repair_formula", "ocr_repair_largest_ring")


@query("SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'no_ocr' WHEN 1 THEN concat('unsearchable_deficit_', 11 + p_size % 4) WHEN 2 THEN 'no_mass_reference' WHEN 3 THEN 'bad_polarity' ELSE 'ok states=0 in=0 subs=0 dels=0' END AS trace, p_partkey % 5 = 4 AS same FROM part")
def search_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V9: why a row is not searched, and a text that needs no search."""
    from ..functions import mass as X

    s = structures(spark, sf_dir).join(t(spark, sf_dir, "part").select(F.col("p_partkey").alias("_k"), "p_size"), F.col("p_partkey") == F.col("_k"))
    s = policy.with_fingerprint(s, "whole", "fp").select(
        "p_partkey", F.expr("CASE p_partkey % 5 WHEN 0 THEN ' ' WHEN 1 THEN repeat('(', cast(11 + p_size % 4 as int)) ELSE whole END").alias("smiles"),
        F.when(F.col("p_partkey") % 5 != 2, F.round(F.col("fp.exact_mass") + X.PROTON, 1)).alias("ms_mz"), F.expr("CASE WHEN p_partkey % 5 = 3 THEN 'odd' ELSE '[M+H]+' END").alias("ms_polarity"), F.col("fp.canonical").alias("c"),
    )
    return policy.search_layer(s).select("p_partkey", F.col("ocr_repair_trace").alias("trace"), F.coalesce((F.col("smiles_ocr_repaired") == F.col("c")) & (F.col("p_partkey") % 5 == 4), F.lit(False)).alias("same"))


@query(f"WITH {_PARTS} SELECT p_partkey, true AS same, {_FORMULA} AS formula, CAST(3 * nn AS INT) AS ring, 1 AS edits FROM e WHERE p_partkey % 18 IN (3, 12) AND p_partkey % 4 = 0")
def mass_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that lack a bracket, or have one too many, brought back by one edit under their mass."""
    from ..functions import mass as X

    s = policy.with_fingerprint(structures(spark, sf_dir).filter("p_partkey % 18 IN (3, 12) AND p_partkey % 4 = 0"), "whole", "fp")
    s = s.select("p_partkey", F.col("damaged").alias("smiles"), F.round(F.col("fp.exact_mass") + X.PROTON, 1).alias("ms_mz"), F.lit("[M+H]+").alias("ms_polarity"), F.col("fp.canonical").alias("c"))
    x = policy.search_layer(s)
    edits = sum((F.regexp_extract("ocr_repair_trace", f"{name}=(\\d+)", 1).cast("int") for name in ("subs", "dels")), F.regexp_extract("ocr_repair_trace", r"in=(\d+)", 1).cast("int"))
    return x.select("p_partkey", (F.col("smiles_ocr_repaired") == F.col("c")).alias("same"), F.col("ocr_repair_formula").alias("formula"), F.col("ocr_repair_largest_ring").alias("ring"), edits.alias("edits"))


#: Fixed value: values whose results a task remembers.
REMEMBERED = 20_000


def _per_row(df: DataFrame, out: str, work, keyed: bool = False) -> DataFrame:
    """Plain Python over rows in Arrow batches; ``work`` takes a row's values and gives those of the new row.

    ``keyed``: the first column is a key that goes to the new rows as it is; ``work`` takes and gives the others, once for equal values that a task still remembers.
    Such rows are dealt out over all cores first, as a file of small rows has them in one or two row groups, whatever the work on them is."""
    kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_()}
    names = [x.strip().split(" ") for x in out.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = lru_cache(REMEMBERED)(work) if keyed else None
        for b in batches:
            values = zip(*(c.to_pylist() for c in b.columns), strict=True)
            rows = [(k, *r) for k, *args in values for r in known(*args)] if known else [r for args in values for r in work(*args)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[k]) for i, (_, k) in enumerate(names)], names=[n for n, _ in names])

    return (df.repartition(df.sparkSession.sparkContext.defaultParallelism) if keyed else df).mapInArrow(run, out)


_VOTED = "p_partkey % 3 = 0 AND contains(substr(whole, 41, 40), '(')"


@query(f"WITH {_PARTS} SELECT p_partkey, whole AS text, CASE WHEN {_VOTED} THEN 1 ELSE 0 END AS changed, NOT ({_VOTED}) AS used_primary, true AS parses FROM w")
def vote_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1, V2: up to three changed lines, the parser as the test; a line of the first reading has lost its opening brackets."""
    x = structures(spark, sf_dir).select("p_partkey", F.expr("regexp_extract_all(whole, '(.{1,40})', 1)").alias("b"))
    lost = F.transform("b", lambda s, i: F.when((F.col("p_partkey") % 3 == 0) & (i == 1), F.replace(s, F.lit("("), F.lit(""))).otherwise(s))

    def one(k, a, b):
        v = S.vote(a, b)
        return [(k, v["text"], v["changed"], v["used_primary"], v["parses"])]

    return _per_row(x.select("p_partkey", lost.alias("a"), "b"), "p_partkey long, text string, changed int, used_primary boolean, parses boolean", one)


@query(f"""WITH {_PARTS}, g AS (SELECT *, p_partkey % 18 IN (0, 3, 9, 12) OR damaged <> whole AND p_partkey % 18 = 15 AS bad FROM d)
SELECT p_partkey, NOT bad AS grammatical, CAST(CASE WHEN NOT bad THEN NULL WHEN p_partkey % 18 = 15 THEN instr(damaged, 'Ca@@') WHEN p_partkey % 18 = 12 THEN length(damaged) - 1 ELSE length(damaged) END AS INT) AS violation, NOT bad AS parses FROM g""")
def grammar_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Syntax of a string and the place of its first violation."""
    x = structures(spark, sf_dir).select("p_partkey", "damaged")
    return _per_row(x, "p_partkey long, grammatical boolean, violation int, parses boolean", lambda k, s: [(k, P.grammatical(s), P.first_violation(s), M.read(s) is not None)])


@query(f"WITH {_PARTS} SELECT p_partkey, whole AS swapped, whole AS beamed FROM w")
def beam_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V5, V6: one swap, then the beam, over a lattice in which a bracket was read as its mirror image: no other change evens the brackets out."""
    x = structures(spark, sf_dir).select("p_partkey", (F.col("p_partkey") % 5).alias("nth"), "whole")

    def one(nth, s):
        at = [i for i, c in enumerate(s) if c in "()"][nth]
        lattice = [[({"(": ")", ")": "("}[c], 0.6), (c, 0.4)] if i == at else [(c, 0.99), ("C", 0.01)] for i, c in enumerate(s)]
        ok = lambda u: M.read(u) is not None
        return [(S.swap_one(lattice, ok), S.beam(lattice, ok))]

    return _per_row(x, "p_partkey long, swapped string, beamed string", one, True)


@query(f"""WITH {_PARTS}, k AS (SELECT p_partkey % 18 AS k, (length(whole) - length(replace(whole, '[C@@H](', ''))) // 7 AS n FROM d),
o AS (SELECT unnest(CASE k WHEN 0 THEN [{{'op': 'delete', 'ref': 'N1', 'got': '', 'n': 1}}] WHEN 3 THEN [{{'op': 'delete', 'ref': ')', 'got': '', 'n': 1}}] WHEN 6 THEN [{{'op': 'insert', 'ref': '', 'got': '.CC', 'n': 1}}] WHEN 9 THEN [{{'op': 'insert', 'ref': '', 'got': 'C1', 'n': 1}}]
 WHEN 12 THEN [{{'op': 'insert', 'ref': '', 'got': ')', 'n': 1}}] WHEN 15 THEN [{{'op': 'delete', 'ref': '[', 'got': '', 'n': CAST(n AS INT)}}, {{'op': 'insert', 'ref': '', 'got': 'a', 'n': CAST(n AS INT)}}] ELSE [] END) AS o FROM k)
SELECT o.op AS op, o.ref AS ref, o.got AS got, CAST(sum(o.n) AS BIGINT) AS n FROM o WHERE o.n > 0 GROUP BY 1, 2, 3""")
def alignment_census(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operations of alignments, counted."""
    x = structures(spark, sf_dir).select("p_partkey", "whole", "damaged")
    ops = _per_row(x, "op string, ref string, got string", lambda k, a, b: [o for o in R.align(a, b) if o[0] != "equal"])
    return ops.groupBy("op", "ref", "got").agg(F.count(F.lit(1)).alias("n"))


@query()
def ctc_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The likeliest label sequence of a table of probabilities, and its exact log probability."""
    x = t(spark, sf_dir, "embeddings").select("vec_id", F.transform("embedding", lambda v: v.cast("double")).alias("e"))

    def one(k, e):
        p = np.exp(8 * np.array(e).reshape(-1, 4))
        p /= p.sum(1, keepdims=True)
        best, score = ctc.prefix_beam(p)[0]
        return [(k, "".join(map(str, best)), round(score, 6), round(ctc.log_likelihood(p, best), 6), "".join(map(str, ctc.greedy(p))))]

    return _per_row(x, "vec_id long, labels string, beam_score double, exact_score double, greedy string", one)


@query(f"""WITH {_PARTS}, c AS (SELECT p_partkey, length(damaged) AS len, unnest(string_split(damaged, '')) AS c, unnest(list_concat([''], string_split(damaged, '')[1:length(damaged) - 1])) AS p FROM d),
t AS (SELECT p_partkey, max(len) AS len, CASE WHEN c IN ('(', ')', '[', ']') THEN c ELSE 'o' END AS c, count(*) AS n, count(*) FILTER (c <> p) AS runs FROM c GROUP BY p_partkey, CASE WHEN c IN ('(', ')', '[', ']') THEN c ELSE 'o' END),
k(c, x, y) AS (VALUES ('(', 1, 0), (')', -1, 0), ('[', 0, 1), (']', 0, -1), ('o', 0, 0)),
s AS (SELECT p_partkey, max(len) AS len, sum(n * x) AS x, sum(n * y) AS y, sum(runs) AS runs, sum(n) FILTER (c <> 'o') AS m FROM t JOIN k USING (c) GROUP BY 1),
de2 AS (SELECT s.p_partkey, sum(t.runs) AS n FROM s JOIN t USING (p_partkey) JOIN k USING (c) WHERE s.x = k.x AND s.y = k.y GROUP BY 1),
ins AS (SELECT s.p_partkey, sum(s.len + 1 - coalesce(t.n, 0)) AS n FROM s JOIN k ON k.c <> 'o' LEFT JOIN t ON t.p_partkey = s.p_partkey AND t.c = k.c WHERE s.x + k.x = 0 AND s.y + k.y = 0 GROUP BY 1),
sub AS (SELECT s.p_partkey, sum(t.n) AS n FROM s JOIN t USING (p_partkey) JOIN k a ON a.c = t.c JOIN k b ON b.c <> 'o' AND b.c <> a.c WHERE s.x - a.x + b.x = 0 AND s.y - a.y + b.y = 0 GROUP BY 1)
SELECT s.p_partkey, CAST(4 * (len + 1) - m + 4 * len - m + runs AS INT) AS neighbours, CAST(coalesce(de2.n, 0) + coalesce(ins.n, 0) + coalesce(sub.n, 0) AS INT) AS even FROM s LEFT JOIN de2 USING (p_partkey) LEFT JOIN ins USING (p_partkey) LEFT JOIN sub USING (p_partkey)""")
def edit_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """single edits of a damaged text, and how many of them have even brackets."""
    x = structures(spark, sf_dir).select("p_partkey", F.col("damaged").alias("s"))
    even = lambda u: u.count("(") == u.count(")") and u.count("[") == u.count("]")
    return _per_row(x, "p_partkey long, neighbours int, even int", lambda s: [(len(n := list(R.single_edits(s, "()[]"))), sum(map(even, n)))], True)
