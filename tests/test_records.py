"""Records, readings, ordered operators and the delivered table on small literal inputs."""

import pytest
from pyspark.sql import functions as F

from quillgrid.operators import analytics, ordered, readings, records
from quillgrid.plans import flows, policy, schema
from quillgrid.plans.profiles import PROFILES, profile

COMP = "pos int, cmpd_id string, source_image string, canonical_smiles string, is_valid boolean, structure_image string"


def test_dedupe(spark):
    rows = spark.createDataFrame([(1, "Compound 9", "x", "", False, None), (2, "9", "y", "CCO", True, None), (3, "09", "z", "CCN", True, "img"), (4, "7", "p", "", None, None), (5, "7", "q", "", False, "i7"), (6, None, "n", "C", True, None)], COMP)
    assert {(r.key, r.source_image) for r in records.dedupe_compounds(rows).collect()} == {("9", "y"), ("7", "p")}
    assert {(r.key, r.source_image) for r in records.dedupe_assays(rows).collect()} == {("9", "x"), ("7", "p")}
    assert {(r.key, r.source_image, r.structure_image) for r in records.merge_compounds(rows, True).collect()} == {("9", "y", "img"), ("7", "p", "i7")}
    paged = rows.withColumn("page", F.col("pos"))
    assert {(r.key, r.source_image) for r in records.accumulate_pages(paged).collect()} == {("9", "x"), ("7", "p")}


def tables(spark):
    comp = spark.createDataFrame([("1001", "CCO", "CCO", True, None, None), ("1002", "CCN", "CCN", True, None, None)], "cmpd_id string, smiles string, canonical_smiles string, is_valid boolean, ocr_avg_entropy double, ocr_low_conf_count int")
    assay = spark.createDataFrame([("1001", 0.062, 1.7, 1512.8, "10-80- 2min", "[M+H]+", {"mdm2": "A"}), ("1003", 0.999, None, None, None, None, {})], "cmpd_id string, kd_nm double, rt_min double, ms_mz double, lcms_method string, ms_polarity string, extra map<string,string>")
    model = spark.createDataFrame([("1001", "CCO", "CCO", 0.9), ("1002", "CCN", "CCN", 0.4)], "cmpd_id string, smiles_decimer string, canonical_smiles_decimer string, decimer_min_conf double")
    return comp, assay, model


def test_assembly(spark):
    comp, assay, model = tables(spark)
    out = {r.cmpd_id: r for r in records.assemble(comp, assay, "cmpd_id", model).collect()}
    assert set(out) == {"1001", "1002", "1003"}
    assert out["1002"].smiles_agree and out["1002"].kd_nm is None
    assert not out["1003"].smiles_agree and out["1003"].smiles_best == "" and out["1003"].kd_nm == 0.999
    assert records.to_run(comp, model.limit(0), "cmpd_id").count() == 2


def test_delivery(spark):
    for name, width in (("WO2025162428", 48), ("WO2022251372", 54)):
        out = flows.deliver(*tables(spark), profile(name))
        assert len(out.columns) == width and out.columns[:48] == list(schema.COMBINED)
        rows = {r.cmpd_id: r for r in out.collect()}
        assert rows["1001"].smiles_best_source == "printed_ocr" and rows["1001"].ms_check_verdict == "mismatch" and rows["1001"].structure_confidence == "printed_text"
        r = rows["1003"]
        assert (r.smiles_best, r.structure_confidence, r.repair_review_status, r.ocr_difficulty, r.smiles_agree) == ("", "no_structure", "not_attempted", "no_ocr", "False")
        assert width == 48 or (rows["1001"].mdm2, rows["1003"].mdm2) == ("A", "")
        s = {k: v.collect() for k, v in flows.summary(out).items()}
        assert s["agreement"][0].agree == 2 and s["agreement"][0].phantom == 0


def test_derived(spark):
    rows = spark.createDataFrame([("C1CCCCC1", "CC(", "201444", "1", "1"), ("", "", "1", "", ""), ("C(", "C", "1", "1", "1")], "canonical_smiles_decimer string, smiles string, kd_nm string, rt_min string, ms_mz string")
    out = policy.derived_layers(rows).collect()
    by = {r.canonical_smiles_decimer: r for r in out}
    r = by["C1CCCCC1"]
    assert (r.decimer_num_rings, r.decimer_largest_ring_size, r.decimer_macrocycle_intact, r.data_quality, r.ocr_bracket_deficit, r.ocr_difficulty) == (1, 6, False, "partial", 1, "light")
    assert r.data_quality_flags.endswith("; decimer_macrocycle_broken")
    assert (by[""].ocr_difficulty, by[""].ocr_bracket_deficit, by[""].data_quality) == ("no_ocr", None, "ok")
    assert (by["C("].decimer_largest_ring_size, by["C("].data_quality) == (0, "macrocycle_broken")


def test_profiles(spark):
    with pytest.raises(KeyError, match="known"):
        profile("none")
    first, second = PROFILES["WO2025162428"], PROFILES["WO2022251372"]
    with pytest.raises(KeyError):
        first.columns("none")
    cols = spark.range(1).select(first.pixels("smiles", F.lit(1000)).alias("c")).first().c
    assert [(c.name, c.x1, c.x2, c.is_image) for c in cols] == [("cmpd_id", 0, 100, False), ("structure", 110, 560, True), ("smiles", 580, 990, False)]
    with pytest.raises(ValueError):
        second.pixels("smiles3", F.lit(1000))
    assert [first.by_count(n) for n in (3, 6, 7, 8)] == ["smiles", "dense", "activity", None] and second.by_count(8) == "activity8"
    assert [first.by_fields(set(x)) for x in (["kd_nm"], ["kd_nm", "structure"], ["smiles", "kd_nm"], ["rt_min"])] == ["dense", "activity", "smiles", None] and second.by_fields({"smiles"}) is None
    assert second.extras == ("mdm2", "mdm4", "molm13", "mv4_11", "waga", "mkl1") and first.extras == () and second.goes_on("smiles3") and second.headings("activity8") == 1 and not first.goes_on("dense")
    assert second.setting("id_top") == "90" and first.setting("id_top") == "" and first.words("files") == ("*.jpg",)
    assert schema.combined_columns(("mdm2", "kd_nm", "mdm2", "smiles")) == (*schema.COMBINED, "mdm2")


def test_agreeing_group(spark):
    rows = [("a", "line", "1.72", 1, 1), ("a", "ch", "1 72", 2, 2), ("a", "en", "1 72", 2, 3), ("b", "line", "10-80-2min", 1, 1), ("b", "ch", "10-80- 2min", 1, 2), ("c", "crop", " ", 1, 0), ("c", "en", "x", 3, 3)]
    df = spark.createDataFrame(rows, "cell string, source string, text string, n_boxes int, pos int")
    out = {r.cell: r for r in readings.agreeing_group(df, "cell", F.lit(True)).collect()}
    assert (out["a"].text, out["a"].value, out["b"].text, out["c"].text) == ("1.72", 1.72, "10-80- 2min", "x")


def test_closed_set(spark):
    df = spark.createDataFrame([(["x", " b "],), (["E"],), ([],)], "c array<string>")
    assert [r[0] for r in df.select(readings.closed_set(F.col("c"), ("A", "B"))).collect()] == ["B", None, None]


def test_ordered(spark):
    rows = spark.createDataFrame([("l", 1, None, "lost"), ("l", 2, "7", "C"), ("l", 3, None, "CO"), ("l", 4, "8", "N"), ("m", 1, "9", "S")], "layout string, pos int, id string, text string")
    assert {(r.layout, r.id, r.text, r.parts) for r in ordered.continued_rows(rows, "layout", ["pos"], "id", "text").collect()} == {("l", "7", "CCO", 2), ("l", "8", "N", 1), ("m", "9", "S", 1)}
    d = spark.createDataFrame([("(a))(",), ("",)], "x string").select(ordered.running_depth(F.col("x")).alias("d")).collect()
    assert (d[0].d.final, d[0].d.lowest, d[0].d.first_negative, d[1].d.final) == (0, -1, 4, 0)
    n = spark.createDataFrame([([10.0, 20.0],)], "b array<double>").select(*[ordered.nearest(F.col("b"), F.lit(v), 6.0) for v in (15.0, 12.0, 40.0)]).first()
    assert tuple(n) == (10.0, 10.0, None)


def test_least_squares(spark):
    rows = spark.createDataFrame([(float(a), float(b), 2.0 + 3 * a - b) for a in range(5) for b in range(4)], "a double, b double, y double")
    got = {r.term: round(r.coefficient, 6) for r in analytics.least_squares(rows, ["a", "b"], "y").collect()}
    assert got == {"intercept": 2.0, "a": 3.0, "b": -1.0}


def test_search_layer(spark):
    rows = spark.createDataFrame([("", "1", "[M+H]+"), ("((((((((((((", "1", "[M+H]+"), ("CC", "", "[M+H]+"), ("CC", "31", "odd"), ("CC", "31.0", "[M+H]+")], "smiles string, ms_mz string, ms_polarity string")
    assert sorted(r.ocr_repair_trace for r in policy.search_layer(rows, 30).collect()) == ["bad_polarity", "no_mass_reference", "no_ocr", "state_budget_hit", "unsearchable_deficit_12"]
