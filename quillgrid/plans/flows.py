"""The flows a user starts: a full run over readings, a rebuild from files, a repair search, and summaries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import analytics, records
from ..sources import files
from . import extract, policy, schema
from .profiles import CANONICAL_FIELDS, Family


def ingest(compounds: DataFrame, assays: DataFrame, profile: Family) -> tuple[DataFrame, DataFrame]:
    """Records of all pages to one row for each id. compounds, assays: cmpd_id, page, pos and their fields."""
    if profile.setting("merge") == "prefer_structure":
        c = records.merge_compounds(compounds.withColumn("pos", F.struct("page", "pos")), prefer_structure=True)
    else:
        c = records.accumulate_pages(compounds)
    return c.drop("key"), records.dedupe_assays(assays.withColumn("pos", F.struct("page", "pos"))).drop("cmpd_id").withColumnRenamed("key", "cmpd_id")


def deliver(compounds: DataFrame, assays: DataFrame, models: DataFrame, profile: Family, require_mass_gate: bool = True, search: bool = False) -> DataFrame:
    """Assembly, promotion, derived layers, and the search if asked for, as the text columns of the delivered table."""
    a = assays
    if "extra" in a.columns:
        a = a.select("*", *[F.coalesce(F.try_element_at("extra", F.lit(e)), F.lit("")).alias(e) for e in profile.extras]).drop("extra")
    if "source_image" in a.columns:
        a = a.withColumnRenamed("source_image", "assay_source_image")
    j = records.assemble(compounds, a, "cmpd_id", models)
    j = j.withColumns({c: F.lit(None).cast("string") for c in CANONICAL_FIELDS if c not in j.columns})  # a family need not have all of them
    x = policy.derived_layers(policy.promote(j, require_mass_gate))
    x = policy.search_layer(x) if search else x
    return schema.as_text(x, schema.combined_columns(profile.extras))


NO_MODEL = "cmpd_id string, smiles_decimer string, canonical_smiles_decimer string, decimer_min_conf double, decimer_low_conf_count int"


def enrich(compounds: DataFrame) -> DataFrame:
    """Printed texts repaired, and what the parser makes of them: canonical string, weight, atoms, validity. Statistics of readings are null where there are none."""
    x = policy.with_fingerprint(policy.with_auto_repair(compounds, "smiles", "_mended"), "_mended", "_fp")
    x = x.drop("smiles").withColumnRenamed("_mended", "smiles")
    x = x.withColumns({"canonical_smiles": F.col("_fp.canonical"), "is_valid": F.col("_fp").isNotNull()}).drop("_fp")
    missing = {"structure_image": "string", "ocr_avg_entropy": "double", "ocr_min_top1": "double", "ocr_low_conf_count": "int"}
    return x.withColumns({c: F.lit(None).cast(k) for c, k in missing.items() if c not in x.columns})


def full_run(spark: SparkSession, folder: str, profile: Family, reader: Callable, heading: Callable | None = None, models: DataFrame | None = None, search: bool = False, require_mass_gate: bool = True) -> tuple[DataFrame, DataFrame]:
    """(delivered table, images that failed) of a folder of page images. ``reader`` and ``heading`` build the models that read a cell and a heading;
    ``models`` has the columns of the structure model, if there is one (see extract.model_stage)."""
    cells = extract.cells(files.images(spark, folder, profile.words("files"), decode=True), family=profile, heading=heading)
    compounds, assays = ingest(*(lambda c, a: (enrich(c), a))(*extract.records(extract.read(cells, reader), profile)), profile)
    return deliver(compounds.drop("page", "pos"), assays.drop("page", "pos"), models if models is not None else spark.createDataFrame([], NO_MODEL), profile, require_mass_gate, search), cells.filter("error IS NOT NULL").select("path", "error")


def rebuild(spark: SparkSession, delivered: str, out: str, profile: Family, search: bool = False) -> DataFrame:
    """Layers after assembly again, from a delivered CSV file."""
    rows = files.read_csv(spark, delivered, keep_blank=False)
    x = policy.derived_layers(policy.promote(rows))
    x = policy.search_layer(x) if search else x
    result = schema.as_text(x, schema.combined_columns(profile.extras))
    files.write_csv(result, out, result.columns)
    return result


def summary(rows: DataFrame) -> dict[str, DataFrame]:
    """The counts by which a delivery is checked: fill of each field, best sources, statuses, quality, agreement."""
    count = lambda c: rows.groupBy(c).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), c)
    both = (F.coalesce("smiles", F.lit("")) != "") & (F.coalesce("smiles_decimer", F.lit("")) != "")
    from ..functions.text import parse_number

    return {
        "fill": analytics.fill_counts(rows, rows.columns),
        "sources": count("smiles_best_source"), "status": count("repair_review_status"), "confidence": count("structure_confidence"), "quality": count("data_quality"), "difficulty": count("ocr_difficulty"),
        "agreement": analytics.agreement_breakdown(rows.filter(both), F.col("smiles_agree") == "True", parse_number(F.col("decimer_min_conf"))),
    }
