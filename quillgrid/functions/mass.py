"""Mass arithmetic: ion labels, tolerances, element histograms and the gate over them. All are Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import count, parse_number

# Mass that an adduct adds for each unit of charge.
PROTON = 1.007276466
ADDUCTS = {"H": 1.007276466, "Na": 22.98976928, "K": 38.9637069, "NH4": 18.033823, "CH3OH+H": 32.026215 + 1.007276466, "HCOO": -44.998201, "FA-H": -44.998201}
# Masses of the commonest isotopes.
ISOTOPES = {"H": 1.0078250319, "C": 12.0, "N": 14.0030740048, "O": 15.9949146196, "F": 18.99840316273, "P": 30.97376151, "S": 31.9720711744, "Cl": 34.96885271, "Br": 78.9183376, "I": 126.904473, "Si": 27.9769265325, "Se": 79.9165218, "B": 11.0093054}
# Standard atomic weights of the same elements.
AVERAGE = {"H": 1.008, "C": 12.011, "N": 14.007, "O": 15.999, "F": 18.998, "P": 30.974, "S": 32.06, "Cl": 35.45, "Br": 79.904, "I": 126.904, "Si": 28.086, "Se": 78.971, "B": 10.81}
H_PER_C, H_TOLERANCE, LEAST_SLACK = (0.5, 3.0), 0.25, 0.06


def table(values: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in values.items() for x in kv])


def polarity(label: Column) -> Column:
    """struct(delta, charge) of an ion label, null if unknown. The longest adduct that its body holds counts; a bare M is protonated."""
    s = F.replace(label, F.lit(" "), F.lit(""))
    sign = F.regexp_extract(s, r"\]\s*(\d*)([+-])\s*$", 2)
    n = F.regexp_extract(s, r"\]\s*(\d*)([+-])\s*$", 1)
    charge = F.coalesce(F.when(n != "", n).try_cast("int"), F.lit(1)) * F.when(sign == "-", -1).otherwise(1)
    body = F.regexp_replace(s, r"\[\s*(.*?)\s*\][^\]]*$", "$1")
    delta = F.when(body.isin("M", ""), PROTON)
    for key in sorted(ADDUCTS, key=len, reverse=True):
        delta = delta.when(body.contains(key), ADDUCTS[key])
    known = body.rlike("|".join(["^M?$", *[k.replace("+", r"\+") for k in ADDUCTS]]))
    return F.when((s != "") & known, F.struct(delta.alias("delta"), charge.alias("charge")))


def neutral_mass(mz: Column, ion: Column) -> Column:
    """|z| * m/z - z * delta; null without an ion or with charge 0."""
    return F.when(ion["charge"] != 0, F.abs(ion["charge"]) * mz - ion["charge"] * ion["delta"])


def ppm(expected: Column, observed: Column) -> Column:
    return F.when(expected != 0, (observed - expected) / F.when(expected != 0, expected) * 1e6)


def decimals(value: Column) -> Column:
    """Decimals of a double as it prints, without trailing zeros; null for null. Sums and comparisons alone: no text is made of it."""
    out = F.when(value == F.round(value, 0), 0)
    for k in range(1, 10):
        out = out.when(value == F.round(value, k), k)
    return F.when(value.isNotNull(), out.otherwise(10))


def with_polarity(df: DataFrame, label: str, out: str) -> DataFrame:
    """Adds polarity() of a label column, worked out once for each different label; few labels are joined by broadcast, as the planner finds by size."""
    known = df.select(F.col(label).alias("_label")).distinct().withColumn(out, polarity(F.col("_label")))
    return df.join(known, F.col(label).eqNullSafe(F.col("_label")), "left").drop("_label")


def printing_tolerance_ppm(mz: Column, places: Column | None = None) -> Column:
    """Half a unit of the last printed decimal, in ppm; whole numbers count as having one decimal; 5000 for null and values not above 0. ``places``: decimals(mz), if known."""
    d = F.greatest(decimals(mz) if places is None else places, F.lit(1))
    return F.when(mz > 0, 0.5 * F.pow(F.lit(10.0), -d) / mz * 1e6).otherwise(5000.0)


def mass_window(mz: Column, ion: Column, places: Column | None = None) -> Column:
    """struct(low, high) of the neutral mass: half a unit of the last decimal on either side; whole numbers have none."""
    m, half = neutral_mass(mz, ion), 0.5 * F.pow(F.lit(10.0), -(decimals(mz) if places is None else places))
    return F.when(m.isNotNull(), F.struct((m - half).alias("low"), (m + half).alias("high")))


def verdict(mass: Column, mz: Column, ion: Column, tolerance: Column | None = None) -> Column:
    """struct(verdict, error_ppm, expected); give mz and ion as columns of their own, not as expressions. Positive ppm if the printed mass is the heavier one."""
    expected = F.when(mz != 0, neutral_mass(mz, ion))
    err = ppm(mass, expected)
    tol = printing_tolerance_ppm(mz) if tolerance is None else tolerance
    return F.struct(F.when(err.isNull(), "unknown").when(F.abs(err) <= tol, "match").otherwise("mismatch").alias("verdict"), F.round(err, 1).alias("error_ppm"), F.round(expected, 4).alias("expected"))


def confidence(verdict_: Column) -> Column:
    return F.when(verdict_ == "match", "mass_verified").when(verdict_ == "mismatch", "mass_mismatch").otherwise("no_mass_reference")


def element_tokens(c: Column) -> Column:
    """Elements of a text that need not be well formed: Cl and Br, single letters of CNOSFPB; of a bracket (to its close or the end) the first such letter."""
    raw = F.regexp_extract_all(c, F.lit(r"(Cl|Br|\[[^\]]*\]?|[CNOSFPB])"), 1)
    return F.filter(F.transform(raw, lambda x: F.when(x.startswith("["), F.regexp_extract(x, r"([CNOSFPB])", 1)).otherwise(x)), lambda x: x != "")


def atom_tokens(c: Column) -> Column:
    """Elements of a well-formed text, case kept; what follows a bracket that is never closed is not read."""
    cut = F.regexp_replace(c, r"^((?:[^\[]|\[[^\]]*\])*)\[[^\]]*$", "$1")
    raw = F.regexp_extract_all(cut, F.lit(r"(\[[^\]]*\]|Cl|Br|[BCNOPSFIbcnops])"), 1)
    return F.filter(F.transform(raw, lambda x: F.when(x.startswith("["), F.regexp_extract(x, r"^\[\s*\d*\s*([A-Z][a-z]?|[a-z])", 1)).otherwise(x)), lambda x: x != "")


def heavy_mass(counts: Column) -> Column:
    """Mass of a map element -> atoms; unknown elements weigh nothing."""
    weights = table(ISOTOPES)
    return F.aggregate(F.map_entries(counts), F.lit(0.0), lambda s, e: s + F.coalesce(F.try_element_at(weights, e["key"]), F.lit(0.0)) * e["value"])


def hydrogen_budget(counts: Column, target: Column) -> Column:
    rest = target - heavy_mass(counts)
    return F.when(rest >= 0, rest / ISOTOPES["H"])


def gate_slack(mz_text: Column) -> Column:
    d = F.length(F.regexp_extract(F.replace(mz_text, F.lit(","), F.lit("")), r"^[^.]*\.([^.]*?)0*(?:\.|$)", 1))
    return F.greatest(F.lit(LEAST_SLACK), 0.5 * F.pow(F.lit(10.0), -d))


def gate_target(mz_text: Column, ion: Column) -> Column:
    return neutral_mass(parse_number(mz_text), ion)


def gate(counts: Column, target: Column, slack: Column) -> Column:
    """Verdict of a histogram against a measured mass: the first rule that holds."""
    unknown = F.filter(F.map_keys(counts), lambda k: ~k.isin(*ISOTOPES))
    implied = hydrogen_budget(counts, target)
    carbon = F.coalesce(F.try_element_at(counts, F.lit("C")), F.lit(0))
    err = F.abs(implied - F.rint(implied))
    return (
        F.when(unknown == F.array(F.lit("Ca")), "needs_ca_fix")
        .when(F.size(unknown) > 0, "unknown_elements")
        .when(implied.isNull(), "too_heavy")
        .when((implied < H_PER_C[0] * carbon) | (implied > H_PER_C[1] * carbon), "implausible_h")
        .when(err <= slack / ISOTOPES["H"] + H_TOLERANCE, "on_integer_h")
        .when(err <= 0.75, "near_integer_h")
        .otherwise("off_integer_h")
    )


def calcium_as_carbon(counts: Column) -> Column:
    """What if each Ca were a misread C: the histogram with Ca added to C."""
    n = lambda k: F.coalesce(F.try_element_at(counts, F.lit(k)), F.lit(0))
    rest = F.map_filter(counts, lambda k, v: ~k.isin("C", "Ca"))
    return F.map_concat(rest, F.create_map(F.lit("C"), n("C") + n("Ca")))


def multiset_difference(a: Column, b: Column) -> Column:
    """b - a of two maps of counts, positive counts only."""
    zero = F.lit(0)
    return F.map_filter(F.map_zip_with(a, b, lambda k, x, y: F.coalesce(y, zero) - F.coalesce(x, zero)), lambda k, v: v > 0)


def total(counts: Column) -> Column:
    return F.aggregate(F.map_values(counts), F.lit(0), lambda s, v: s + v)


def lattice_stats(lattice: Column, low: float = 0.7) -> Column:
    """struct(avg_entropy, min_top1, low_count) of an array (characters) of arrays (alternatives) of probabilities. No alternatives: sure (p 1, entropy 0)."""
    top = F.transform(lattice, lambda p: F.when(F.size(p) > 0, F.array_max(p)).otherwise(1.0))
    h = F.transform(lattice, lambda p: F.aggregate(F.filter(p, lambda x: x > 0), F.lit(0.0), lambda s, x: s - x * F.log2(x)))
    n = F.size(lattice)
    return F.when(
        n > 0,
        F.struct(F.round(F.aggregate(h, F.lit(0.0), lambda s, x: s + x) / n, 4).alias("avg_entropy"), F.round(F.array_min(top), 4).alias("min_top1"), F.size(F.filter(top, lambda x: x < low)).alias("low_count")),
    )


def token_confidence(conf: Column, low: float = 0.5) -> Column:
    """struct(min, mean, low): least and mean confidence, places (from 0) below the limit."""
    at = F.filter(F.transform(conf, lambda x, i: F.when(x < low, i).otherwise(-1)), lambda i: i >= 0)
    return F.struct(F.array_min(conf).alias("min"), F.when(F.size(conf) > 0, F.aggregate(conf, F.lit(0.0), lambda s, x: s + x) / F.size(conf)).alias("mean"), at.alias("low"))


def trusted(entropy: Column, low_count: Column, most_entropy: float = 0.5, most_low: int = 5) -> Column:
    """A reading without statistics is trusted."""
    return (entropy.isNull() | (entropy <= most_entropy)) & (low_count.isNull() | (low_count <= most_low))


def masses(counts: Column, ion: Column) -> Column:
    """struct(mono, rounded, average) of an ion's m/z from element counts with hydrogens, by three tables of masses."""
    tables = {"mono": ISOTOPES, "rounded": {e: round(m, 1) for e, m in ISOTOPES.items()}, "average": AVERAGE}
    z = F.abs(ion["charge"])

    def mz(weights: dict) -> Column:
        w = table(weights)
        m = F.aggregate(F.map_entries(counts), F.lit(0.0), lambda s, e: s + F.coalesce(F.try_element_at(w, e["key"]), F.lit(0.0)) * e["value"])
        return (m + ion["charge"] * ion["delta"]) / z

    return F.struct(*[mz(w).alias(n) for n, w in tables.items()])


def composition_class(counts: Column, target: Column, slack: Column) -> Column:
    """Four classes of a composition: unknown, heavy, fits (hydrogens near a whole number), off."""
    v = gate(counts, target, slack)
    return F.when(v.isin("needs_ca_fix", "unknown_elements"), "unknown").when(v == "too_heavy", "heavy").when(v == "on_integer_h", "fits").otherwise("off")


__all__ = [n for n in dir() if not n.startswith("_") and n not in ("Column", "DataFrame", "F", "annotations", "count")]
