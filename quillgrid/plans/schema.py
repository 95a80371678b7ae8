"""Columns of the combined table, in the order in which they are delivered."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .profiles import CANONICAL_FIELDS

# Column names of each layer.
PIPELINE = tuple(
    "cmpd_id smiles canonical_smiles smiles_decimer canonical_smiles_decimer smiles_best smiles_best_source smiles_agree molecular_weight heavy_atom_count is_valid structure_image source_image "
    "kd_nm rt_min ms_mz lcms_method ms_polarity assay_source_image decimer_min_conf decimer_low_conf_count decimer_render_path ocr_avg_entropy ocr_min_top1 ocr_low_conf_count".split()
)
QUALITY = ("data_quality_flags", "data_quality")
STRUCTURE = ("decimer_largest_ring_size", "decimer_macrocycle_intact", "decimer_num_rings")
REPAIR = tuple("repaired_smiles is_repaired repair_method smiles_candidate_repair repair_confidence repair_review_status structure_confidence repair_atoms_invented repair_atoms_deleted ms_check_verdict ms_error_ppm".split())
SEARCH = tuple("smiles_ocr_repaired ocr_repair_trace ocr_repair_formula ocr_repair_largest_ring ocr_repair_mass_ppm".split())
TEXT = ("ocr_bracket_deficit", "ocr_difficulty")
COMBINED = PIPELINE + QUALITY + STRUCTURE + REPAIR + SEARCH + TEXT


def combined_columns(extras: Iterable[str] = ()) -> tuple[str, ...]:
    """The 48 columns, then a profile's own fields in their order, each once, none that is there already."""
    own = dict.fromkeys(e for e in extras if e not in COMBINED and e not in CANONICAL_FIELDS)
    return COMBINED + tuple(own)


def as_text(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """All columns as the text that is delivered: null is empty, booleans are True and False, a missing column is empty."""
    kinds = dict(df.dtypes)

    def cell(c: str):
        if c not in kinds:
            return F.lit("").alias(c)
        x = F.col(f"`{c}`")
        x = F.when(x, "True").when(~x, "False") if kinds[c] == "boolean" else x.cast("string")
        return F.coalesce(x, F.lit("")).alias(c)

    return df.select(*[cell(c) for c in columns])
