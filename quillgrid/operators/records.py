"""Records: one of each key, merged over pages, assembled with assays, chosen by precedence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def _slim(df: DataFrame, drop: tuple[str, ...] = ()) -> Column:
    return F.struct(*[F.col(f"`{c}`") for c in df.columns if c not in drop])


def first_of_each(df: DataFrame, key: Column, order: list[Column], name: str = "id") -> DataFrame:
    """The row of least ``order`` for each non-null key: a grouped minimum, reduced within tasks, so a hot key is no hot task."""
    x = df.select(key.alias("_key"), F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)]).alias("_o"), _slim(df).alias("_r"))
    g = x.filter("_key IS NOT NULL").groupBy("_key").agg(F.min_by("_r", "_o").alias("_r"))
    return g.select(F.col("_key").alias(name), *[F.col(f"_r.`{c}`").alias(c) for c in df.columns if c != name])


def dedupe_compounds(df: DataFrame, id_col: str = "cmpd_id", pos: str = "pos") -> DataFrame:
    """First valid row (is_valid and a canonical string) of each normalised id, else its first row."""
    valid = F.coalesce(F.col("is_valid"), F.lit(False)) & (F.coalesce(F.col("canonical_smiles"), F.lit("")) != "")
    return first_of_each(df, T.normalise_id(F.col(id_col)), [~valid, F.col(pos)], "key")


def dedupe_assays(df: DataFrame, id_col: str = "cmpd_id", pos: str = "pos") -> DataFrame:
    """First row of each normalised id."""
    return first_of_each(df, T.normalise_id(F.col(id_col)), [F.col(pos)], "key")


def merge_compounds(df: DataFrame, prefer_structure: bool = False, id_col: str = "cmpd_id", pos: str = "pos") -> DataFrame:
    """First valid row (is_valid alone) of each id, else the first; with prefer_structure a missing image comes from the id's first row that has one."""
    key, valid = T.normalise_id(F.col(id_col)), F.coalesce(F.col("is_valid"), F.lit(False))
    image = F.when(F.coalesce(F.col("structure_image"), F.lit("")) != "", F.col("structure_image"))
    x = df.select(key.alias("_key"), F.struct((~valid).alias("a"), F.col(pos).alias("b")).alias("_o"), _slim(df).alias("_r"), image.alias("_i"), F.when(image.isNotNull(), F.col(pos)).alias("_ip"))
    g = x.filter("_key IS NOT NULL").groupBy("_key").agg(F.min_by("_r", "_o").alias("_r"), F.min_by("_i", "_ip").alias("_i"))
    have = F.col("_r.structure_image")
    filled = F.when(F.coalesce(have, F.lit("")) == "", F.col("_i")).otherwise(have) if prefer_structure else have
    return g.select(F.col("_key").alias("key"), *[(filled if c == "structure_image" else F.col(f"_r.`{c}`")).alias(c) for c in df.columns])


def accumulate_pages(df: DataFrame, id_col: str = "cmpd_id", page: str = "page", pos: str = "pos") -> DataFrame:
    """Over pages the first page with an id wins, even if its row is not valid; within that page a valid row does."""
    valid = F.coalesce(F.col("is_valid"), F.lit(False)) & (F.coalesce(F.col("canonical_smiles"), F.lit("")) != "")
    return first_of_each(df, T.normalise_id(F.col(id_col)), [F.col(page), ~valid, F.col(pos)], "key")


def last_of_each(df: DataFrame, keys: list[str], pos: str) -> DataFrame:
    """The last row of each key, as a later write replaces an earlier one."""
    g = df.groupBy(*keys).agg(F.max_by(_slim(df, tuple(keys)), pos).alias("_r"))
    return g.select(*keys, *[F.col(f"_r.`{c}`").alias(c) for c in df.columns if c not in keys])


def last_per_page(df: DataFrame, key: str, page: str, pos: str) -> DataFrame:
    return last_of_each(df, [page, key], pos)


def assemble(compounds: DataFrame, assays: DataFrame, key: str, models: DataFrame | None = None, low_entropy: float = 0.5, low_count: int = 5) -> DataFrame:
    """Compounds and assays joined in full, with the first choice of a best string.

    compounds: key, smiles, canonical_smiles, ocr_avg_entropy, ocr_low_conf_count, ...; assays: key, ...; models: key,
    smiles_decimer, canonical_smiles_decimer, ... Rows of one side only have nulls for the other; agreement is False there.
    """
    a = compounds if models is None else compounds.join(models, key, "left")
    j = a.withColumnRenamed(key, "_ck").join(assays.withColumnRenamed(key, "_ak"), F.col("_ck") == F.col("_ak"), "full_outer")
    x, y = F.coalesce(F.col("canonical_smiles"), F.lit("")), F.coalesce(F.col("canonical_smiles_decimer"), F.lit(""))
    raw = F.coalesce(F.col("smiles"), F.lit(""))
    from ..functions.mass import trusted

    sure = trusted(F.col("ocr_avg_entropy"), F.col("ocr_low_conf_count"), low_entropy, low_count)
    agree = (x != "") & (y != "") & (x == y)
    source = (
        F.when(F.col("_ck").isNull(), "")
        .when(agree, "ocr+decimer")
        .when((x != "") & sure, "ocr")
        .when((x != "") & (y != ""), "decimer_fallback")
        .when(x != "", "ocr")
        .when(y != "", "decimer")
        .when(raw != "", "ocr_only_invalid")
        .otherwise("")
    )
    best = F.when(source.isin("ocr+decimer", "ocr"), x).when(source.isin("decimer_fallback", "decimer"), y).when(source == "ocr_only_invalid", raw).otherwise("")
    rest = [c for c in j.columns if c not in ("_ck", "_ak")]
    return j.select(F.coalesce("_ck", "_ak").alias(key), *rest, agree.alias("smiles_agree"), best.alias("smiles_best"), source.alias("smiles_best_source"))


def final_precedence(printed: Column, intact: Column, model: Column, model_raw: Column, repaired: Column, method: Column) -> Column:
    """struct(best, source): the printed text if it parses, an intact model string, a repair that passed its audit, else nothing."""
    has = lambda c: F.coalesce(c, F.lit("")) != ""
    some = F.coalesce(intact, F.lit(False))
    return F.struct(
        F.when(has(printed), printed).when(some, F.when(has(model), model).otherwise(model_raw)).when(has(repaired), repaired).otherwise("").alias("best"),
        F.when(has(printed), "printed_ocr").when(some, "decimer").when(has(repaired), F.concat(F.lit("repair_"), method)).otherwise("").alias("source"),
    )


def to_run(work: DataFrame, cache: DataFrame, key: str) -> DataFrame:
    """Rows whose key no cache entry has."""
    return work.join(cache.select(key).distinct(), key, "left_anti")


def compare_readings(old: DataFrame, new: DataFrame, key: str, fields: dict[str, bool]) -> DataFrame:
    """For each field (name: whether it holds numbers) the rows of both sides that match, differ, or have lost their value: numbers are
    compared by value, text without spaces and case."""
    from ..functions import text as T

    typed = lambda c, number: F.when(~T.blank(F.col(c).cast("string")), T.typed_key(F.col(c).cast("string"), F.lit(number)))
    a = old.select(F.col(key).alias("_k1"), *[typed(f, n).alias(f"a_{f}") for f, n in fields.items()])
    b = new.select(F.col(key).alias("_k2"), *[typed(f, n).alias(f"b_{f}") for f, n in fields.items()])
    aggs = []
    for f in fields:
        x, y = F.col(f"a_{f}"), F.col(f"b_{f}")
        aggs += [F.count_if(x == y).alias(f"{f}_0"), F.count_if(y.isNotNull() & ~x.eqNullSafe(y)).alias(f"{f}_1"), F.count_if(x.isNotNull() & y.isNull()).alias(f"{f}_2")]
    rows = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"{f}_0").alias("match"), F.col(f"{f}_1").alias("differ"), F.col(f"{f}_2").alias("lost")) for f in fields])
    return a.join(b, F.col("_k1") == F.col("_k2")).agg(*aggs).select(F.explode(rows).alias("_r")).select("_r.*")


def sides(old: DataFrame, new: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """key, state of each row of two versions: match, differ, lost (only before) or gained (only now)."""
    a = old.select(F.col(key).alias("_k1"), F.struct(*fields).alias("_a"))
    b = new.select(F.col(key).alias("_k2"), F.struct(*fields).alias("_b"))
    state = F.when(F.col("_k2").isNull(), "lost").when(F.col("_k1").isNull(), "gained").when(F.col("_a").eqNullSafe(F.col("_b")), "match").otherwise("differ")
    return a.join(b, F.col("_k1") == F.col("_k2"), "full_outer").select(F.coalesce("_k1", "_k2").alias(key), state.alias("state"))


def with_manifest(rows: DataFrame, manifest: DataFrame, keys: list[str], value: str, other) -> DataFrame:
    """``rows`` with a manifest's value by several keys, ``other`` where it has none."""
    m = manifest.select(*[F.col(k).alias(f"_m{i}") for i, k in enumerate(keys)], F.col(value).alias("_v"))
    out = rows.join(m, [F.col(k) == F.col(f"_m{i}") for i, k in enumerate(keys)], "left")
    return out.withColumn(value, F.coalesce("_v", F.lit(other))).drop("_v", *[f"_m{i}" for i in range(len(keys))])


def only_in(a: DataFrame, b: DataFrame) -> DataFrame:
    """Different rows of a that b does not have."""
    return a.subtract(b)


def in_both(a: DataFrame, b: DataFrame) -> DataFrame:
    """Different rows of both."""
    return a.intersect(b)


def in_either(a: DataFrame, b: DataFrame) -> DataFrame:
    """Different rows of either."""
    return a.unionByName(b).distinct()
