"""The relational pipeline over assembled records: structure columns, repair and promotion, mass gate, derived layers."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..chem import molecule as M
from ..chem import repairs as R
from ..chem import search as S
from ..functions import mass as X
from ..functions import text as T
from ..operators.records import final_precedence

FINGERPRINT = "struct<formula:string,heavy_atoms:int,exact_mass:double,rings:int,largest_ring:int,amides:int,stereo_centres:int,charge:int,fragments:int,mol_weight:double,canonical:string,tpsa:double,rotatable:int>"
AUDIT = "struct<ring:int,repaired:string,repaired_mass:double,method:string,tier:string,note:string,atoms_invented:int,atoms_deleted:int,validated:boolean>"
SEARCHED = "struct<smiles:string,mass:double,formula:string,largest_ring:int,inserts:int,subs:int,dels:int,states:int,trace:string>"


def tier_rank(tier: Column) -> Column:
    """0 for the best tier; unknown tiers come last."""
    at = F.array_position(F.array(*[F.lit(x) for x in R.TIERS]), tier).cast("int")
    return F.when(at > 0, at - 1).otherwise(len(R.TIERS))


def _each_text(df: DataFrame, column: str, out: str, kind: str, work) -> DataFrame:
    """Adds a column computed from a text column by plain Python; null and empty give null.

    An Arrow function of that one column: rows stay where they are, other columns don't leave the JVM, and a text that
    a batch holds several times is worked on once.
    """
    arrow = _arrow(kind)

    @F.arrow_udf(kind)
    def run(col: pa.Array) -> pa.Array:
        d = col.dictionary_encode()
        return pa.array([work(x) if x else None for x in d.dictionary.to_pylist()], arrow).take(d.indices)

    return df.withColumn(out, run(F.col(column)))


def _arrow(kind: str) -> pa.DataType:
    names = {"string": pa.string(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_()}
    if kind in names:
        return names[kind]
    return pa.struct([(f.split(":")[0], names[f.split(":")[1]]) for f in kind[len("struct<") : -1].split(",")])


def with_fingerprint(df: DataFrame, column: str, out: str) -> DataFrame:
    """struct of invariants of a structure string, null where it does not parse."""
    return _each_text(df, column, out, FINGERPRINT, M.fingerprint)


def with_largest_fragment(df: DataFrame, column: str, out: str) -> DataFrame:
    """Canonical string of the fragment with most heavy atoms, null where the text does not parse."""
    return _each_text(df, column, out, "string", M.largest_fragment)


def _repair(text: str) -> dict:
    ring = M.largest_ring(text)
    if ring >= M.LEAST_MACROCYCLE:
        return {"ring": ring}
    got, method = R.repair_macrocycle(text)
    a, mol = R.audit(text, got, method or ""), M.read(got or "")
    return {"ring": ring, "repaired": got, "repaired_mass": mol and round(M.exact_mass(mol), 4), "method": method, **{k: a[k] for k in ("tier", "note", "atoms_invented", "atoms_deleted", "validated")}}


def with_repair(df: DataFrame, column: str, out: str) -> DataFrame:
    """Largest ring of a structure string and, where its macrocycle is broken, the repair with its audit; null for an empty string."""
    return _each_text(df, column, out, AUDIT, _repair)


def with_auto_repair(df: DataFrame, column: str, out: str) -> DataFrame:
    """Text repair: the steps that are expressions, then the mirrored bracket, which needs the parser, where its surplus shows."""
    x = df.withColumn("_pre", T.repair_syntax(F.col(column)))
    odd = F.when((T.count(F.col("_pre"), "]") - T.count(F.col("_pre"), "[") == 2) & (T.count(F.col("_pre"), "(") == T.count(F.col("_pre"), ")")), F.col("_pre"))
    x = _each_text(x.withColumn("_odd", odd), "_odd", "_fixed", "string", R.mirrored_bracket)
    return x.withColumn(out, F.coalesce("_fixed", "_pre")).drop("_pre", "_odd", "_fixed")


def rewrite_and_parse(df: DataFrame, column: str) -> DataFrame:
    """Lexical fixes, carbonyl rewriting, then what the parser makes of it: rewritten, n_fixes, fp."""
    x = df.withColumn("_r", T.let(T.lexical_prepass(F.col(column))["text"], T.rewrite_oxo)).withColumns({"rewritten": F.col("_r.text"), "n_fixes": F.col("_r.n")}).drop("_r")
    return with_fingerprint(x, "rewritten", "fp")


def promote(rows: DataFrame, require_mass_gate: bool = True) -> DataFrame:
    """The repair and confidence columns, and the final best string with its weight.

    rows: smiles_decimer, canonical_smiles_decimer, canonical_smiles, ms_mz (text or number), ms_polarity.
    """
    x = rows.drop("smiles_best", "smiles_best_source", "molecular_weight", "heavy_atom_count")
    model = T.strip(F.coalesce(F.col("smiles_decimer"), F.lit("")))
    x = with_repair(x.withColumn("_m", model), "_m", "_a").withColumn("_rep", F.col("_a.repaired"))
    x = x.withColumns({"_mz": T.parse_number(F.col("ms_mz").cast("string")), "_ion": X.polarity(F.coalesce(F.col("ms_polarity"), F.lit("")))})
    mz, ion = F.col("_mz"), F.col("_ion")
    intact = F.coalesce(F.col("_a.ring") >= M.LEAST_MACROCYCLE, F.lit(False))
    found = F.col("_rep").isNotNull()
    validated = F.coalesce(F.col("_a.validated"), F.lit(False))
    x = x.withColumn("_rv", X.verdict(F.col("_a.repaired_mass"), mz, ion))
    mass_ok = (F.col("_rv.verdict") == "match") | F.lit(not require_mass_gate)
    empty = F.col("_m") == ""
    status = (
        F.when(empty, "not_attempted").when(intact, "not_repaired").when(~found, "rejected")
        .when(validated & mass_ok, "validated").when(validated, "experimental").when(F.col("_a.tier") == "rejected", "rejected").otherwise("experimental")
    )
    x = x.withColumn("repair_review_status", status)
    status = F.col("repair_review_status")
    method = F.when(empty, "no_decimer_output").when(intact, "").when(~found, "no_repair_found").otherwise(F.coalesce("_a.method", F.lit("")))
    attempted = ~empty & ~intact & found
    x = x.withColumns(
        {
            "repair_method": method, "repair_confidence": F.when(attempted, F.col("_a.tier")).otherwise("none"),
            "repaired_smiles": F.when(attempted, F.col("_rep")), "is_repaired": attempted, "repair_atoms_invented": F.when(attempted, F.col("_a.atoms_invented")),
            "repair_atoms_deleted": F.when(attempted, F.col("_a.atoms_deleted")), "smiles_candidate_repair": F.when(attempted & (status != "validated"), F.col("_rep")),
        }
    )
    best = final_precedence(T.strip(F.coalesce(F.col("canonical_smiles"), F.lit(""))), intact, F.col("canonical_smiles_decimer"), F.col("_m"), F.when(attempted & validated, F.col("_rep")), F.col("repair_method"))
    x = x.withColumn("_b", best).withColumns({"smiles_best": F.col("_b.best"), "smiles_best_source": F.col("_b.source")})
    x = with_fingerprint(x, "smiles_best", "_bfp")
    v = X.verdict(F.col("_bfp.exact_mass"), mz, ion)
    has = F.col("smiles_best") != ""
    printed = F.col("smiles_best_source") == "printed_ocr"
    x = x.withColumn("_v", v)
    x = x.withColumns(
        {
            "ms_check_verdict": F.when(has, F.col("_v.verdict")).otherwise("unknown"), "ms_error_ppm": F.when(has, F.col("_v.error_ppm")),
            "structure_confidence": F.when(~has, "no_structure").when(printed & (F.col("_v.verdict") == "match"), "printed_mass_verified").when(printed, "printed_text").otherwise(X.confidence(F.col("_v.verdict"))),
            "molecular_weight": F.col("_bfp.mol_weight"), "heavy_atom_count": F.col("_bfp.heavy_atoms"),
        }
    )
    return x.drop("_m", "_a", "_rep", "_b", "_bfp", "_v", "_mz", "_ion", "_rv")


def structure_layer(rows: DataFrame) -> DataFrame:
    """Ring statistics of the model's canonical string; blank where there is none, 0 where it does not parse."""
    c = T.strip(F.coalesce(F.col("canonical_smiles_decimer"), F.lit("")))
    x = with_fingerprint(rows.withColumn("_c", c), "_c", "_fp")
    has = F.col("_c") != ""
    ring = F.coalesce(F.col("_fp.largest_ring"), F.lit(0))
    return x.withColumns({"decimer_largest_ring_size": F.when(has, ring), "decimer_num_rings": F.when(has, F.coalesce(F.col("_fp.rings"), F.lit(0))), "decimer_macrocycle_intact": F.when(has, ring >= M.LEAST_MACROCYCLE)}).drop("_c", "_fp")


def quality_layer(rows: DataFrame) -> DataFrame:
    x = rows.withColumn("_f", T.range_flags({k: T.parse_number(F.col(k).cast("string")) for k in T.NUMERIC_RANGES}))
    broken = F.coalesce(~F.col("decimer_macrocycle_intact"), F.lit(False))
    flags = F.concat_ws("; ", F.col("_f"), F.when(broken, F.lit("decimer_macrocycle_broken")))
    return x.withColumns({"data_quality_flags": flags, "data_quality": T.quality_word(F.col("_f"), broken)}).drop("_f")


def text_layer(rows: DataFrame) -> DataFrame:
    s = T.strip(F.coalesce(F.col("smiles"), F.lit("")))
    d = T.bracket_deficit(s)
    return rows.withColumns({"ocr_bracket_deficit": F.when(s != "", d), "ocr_difficulty": F.when(s == "", "no_ocr").otherwise(T.difficulty(d))})


def derived_layers(rows: DataFrame) -> DataFrame:
    """Structure first: the quality layer reads it."""
    return rows.transform(structure_layer).transform(quality_layer).transform(text_layer)


def search_layer(rows: DataFrame, states: int = S.STATES) -> DataFrame:
    """Mass-constrained repair of the printed text. Rows that can't be searched are told apart by expressions; only the others meet Python, dealt out evenly."""
    mz_text = F.col("ms_mz").cast("string")
    x = rows.withColumns({"_s": T.strip(F.coalesce(F.col("smiles"), F.lit(""))), "_ion": X.polarity(F.coalesce(F.col("ms_polarity"), F.lit(""))), "_mz": T.parse_number(mz_text)})
    d = T.bracket_deficits(F.col("_s"))["total"]
    gate = F.when(F.col("_s") == "", "no_ocr").when(d > S.MOST_DEFICIT, F.concat(F.lit("unsearchable_deficit_"), d.cast("string"))).when(F.col("_mz").isNull(), "no_mass_reference").when(F.col("_ion").isNull(), "bad_polarity")
    x = x.withColumns({"_gate": gate, "_win": X.mass_window(F.col("_mz"), F.col("_ion"))})
    work = x.filter("_gate IS NULL").select(F.col("_s").alias("_ws"), F.col("_win.low").alias("_lo"), F.col("_win.high").alias("_hi")).distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [S.mass_search(S.lexical(t), lo, hi, states) for t, lo, hi in zip(*(c.to_pylist() for c in b.columns), strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(got, _arrow(SEARCHED))], names=["_ws", "_lo", "_hi", "_r"])

    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # a set number: searches are long, their rows small, so they must not be put together
    done = work.repartition(n, "_ws", "_lo").mapInArrow(run, f"_ws string, _lo double, _hi double, _r {SEARCHED}")
    x = x.join(done, (F.col("_s") == F.col("_ws")) & (F.col("_win.low") == F.col("_lo")) & (F.col("_win.high") == F.col("_hi")) & F.col("_gate").isNull(), "left")
    hit = F.col("_r.smiles").isNotNull()
    trace = F.coalesce(F.col("_gate"), F.when(hit, F.format_string("ok states=%d in=%d subs=%d dels=%d", "_r.states", "_r.inserts", "_r.subs", "_r.dels")).otherwise(F.coalesce(F.col("_r.trace"), F.lit("no_answer"))))
    middle = X.neutral_mass(F.col("_mz"), F.col("_ion"))
    return x.withColumns(
        {
            "smiles_ocr_repaired": F.col("_r.smiles"), "ocr_repair_trace": trace, "ocr_repair_formula": F.when(hit, F.col("_r.formula")),
            "ocr_repair_largest_ring": F.when(hit, F.col("_r.largest_ring")), "ocr_repair_mass_ppm": F.when(hit, F.round(X.ppm(F.col("_r.mass"), middle), 1)),
        }
    ).drop("_s", "_ion", "_mz", "_gate", "_win", "_ws", "_lo", "_hi", "_r")
