"""Summaries: screens, quantiles by rank, sweeps, histograms, scorecards, version differences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def quality_screen(df: DataFrame, id_col: str, text_col: str, row_length: tuple[int, int], row_counts: tuple[int, ...]) -> DataFrame:
    """id, n_rows, cv (spread of row lengths), verdict and reasons, from the text alone."""
    x = df.select(id_col, F.col(text_col).alias("_t"), F.transform(F.filter(F.split(text_col, "\n"), lambda s: s != ""), lambda s: F.length(s)).alias("_len"))
    n = F.size("_len")
    x = x.select("*", (F.aggregate("_len", F.lit(0.0), lambda s, v: s + v) / F.when(n > 0, n)).alias("_mean"))
    sd = F.sqrt(F.aggregate("_len", F.lit(0.0), lambda s, v: s + (v - F.col("_mean")) * (v - F.col("_mean"))) / F.when(n > 0, n))
    short, long = F.coalesce(F.array_min("_len"), F.lit(0)) < row_length[0], F.coalesce(F.array_max("_len"), F.lit(0)) > row_length[1]
    bal, hollow, odd = T.balanced(F.col("_t")), F.contains("_t", F.lit("()")), ~n.isin(*row_counts)
    verdict = F.when(~bal | hollow | (n == 0), "fail").when(short | long | odd, "suspect").otherwise("pass")
    reasons = F.concat_ws("; ", F.when(~bal, "unbalanced"), F.when(hollow, "empty branch"), F.when(n == 0, "no rows"), F.when(short, "short row"), F.when(long, "long row"), F.when(odd, "row count"))
    return x.select(id_col, n.cast("long").alias("n_rows"), F.when(F.col("_mean") > 0, F.round(sd / F.col("_mean"), 4)).alias("cv"), verdict.alias("verdict"), reasons.alias("reasons"))


#: A group's values are dealt out over so many ranges between its least and greatest.
RANGES = 256


def ranked_counts(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys, value, _c (rows of that value), _upto (rows up to it), _n (rows of the group): one row for each different value.

    Values are counted first. Running counts are made range by range, then the ranges before are added, so neither
    a group nor its different values are gathered in one task.
    """
    from pyspark.sql import Window

    c = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_c"))
    ends = c.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.min(value).cast("double").alias("_lo"), F.max(value).cast("double").alias("_hi"))
    same = lambda other: [F.col(k).eqNullSafe(F.col(f"{other}{i}")) for i, k in enumerate(keys)]
    wide = F.col("_hi") - F.col("_lo")
    at = F.when(wide > 0, F.least(F.floor((F.col(value).cast("double") - F.col("_lo")) / wide * RANGES), F.lit(RANGES - 1))).otherwise(0).cast("int")
    c = c.join(ends, same("_k")).select(*keys, value, "_c", at.alias("_r"))
    part = c.groupBy(*[F.col(k).alias(f"_p{i}") for i, k in enumerate(keys)], F.col("_r").alias("_q")).agg(F.sum("_c").alias("_s"))
    group = Window.partitionBy(*[f"_p{i}" for i in range(len(keys))])  # RANGES rows at most
    part = part.select("*", (F.sum("_s").over(group.orderBy("_q")) - F.col("_s")).alias("_before"), F.sum("_s").over(group).alias("_n"))
    c = c.join(part, [*same("_p"), F.col("_r") == F.col("_q")])
    return c.select(*keys, value, "_c", (F.col("_before") + F.sum("_c").over(Window.partitionBy(*keys, "_r").orderBy(value))).alias("_upto"), "_n")


def nearest_rank(df: DataFrame, keys: list[str], value: str, qs: dict[str, float]) -> DataFrame:
    """For each group the value at place floor(n * q) of its sorted values (from 0), exactly (see ranked_counts)."""
    c = ranked_counts(df, keys, value)
    at = {k: F.least(F.floor(F.col("_n") * q), F.col("_n") - 1) for k, q in qs.items()}
    pick = [F.max(F.when((F.col("_upto") > a) & (F.col("_upto") - F.col("_c") <= a), F.col(value))).alias(k) for k, a in at.items()]
    return c.groupBy(*keys).agg(F.max("_n").alias("n"), *pick)


def tolerance_sweep(df: DataFrame, keys: list[str], error: Column, tolerances: list[float]) -> DataFrame:
    """Rows of each group whose error lies within each tolerance: one pass, one count for each tolerance, then unpivoted."""
    g = df.groupBy(*keys).agg(*[F.count_if(F.abs(error) <= x).alias(f"_{i}") for i, x in enumerate(tolerances)], F.count(error).alias("n"))
    pairs = F.array(*[F.struct(F.lit(float(x)).alias("tolerance"), F.col(f"_{i}").alias("hits")) for i, x in enumerate(tolerances)])
    return g.select(*keys, "n", F.explode(pairs).alias("_p")).select(*keys, "n", "_p.*")


def histogram(df: DataFrame, value: str, edges: list[float]) -> DataFrame:
    """Counts of [lo, hi) bins; bins without a row are there, too. Values outside all bins and nulls count nowhere."""
    n = len(edges) - 1
    agg = df.agg(*[F.count_if((F.col(value) >= edges[i]) & (F.col(value) < edges[i + 1])).alias(f"_{i}") for i in range(n)])
    bins = F.array(*[F.struct(F.lit(float(edges[i])).alias("lo"), F.lit(float(edges[i + 1])).alias("hi"), F.col(f"_{i}").alias("n")) for i in range(n)])
    return agg.select(F.explode(bins).alias("_b")).select("_b.*")


def version_diff(old: DataFrame, new: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """For each column: rows changed, lost (only before), gained (only now), by one full join on the key; null and blank are one."""
    a = old.select(F.col(key).alias("_k1"), *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(f"a_{c}") for c in columns])
    b = new.select(F.col(key).alias("_k2"), *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(f"b_{c}") for c in columns])
    j = a.join(b, F.col("_k1") == F.col("_k2"), "full_outer")
    aggs = []
    for c in columns:
        x, y = F.coalesce(F.col(f"a_{c}"), F.lit("")), F.coalesce(F.col(f"b_{c}"), F.lit(""))
        aggs += [F.count_if((x != "") & (y != "") & (x != y)).alias(f"{c}_ch"), F.count_if((x != "") & (y == "")).alias(f"{c}_lo"), F.count_if((x == "") & (y != "")).alias(f"{c}_ga")]
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"{c}_ch").alias("changed"), F.col(f"{c}_lo").alias("lost"), F.col(f"{c}_ga").alias("gained")) for c in columns])
    return j.agg(*aggs).select(F.explode(rows).alias("_r")).select("_r.*")


def fill_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Non-blank values of each column, one row for each column."""
    g = df.agg(*[F.count_if(~T.blank(F.col(c).cast("string"))).alias(c) for c in columns])
    return g.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("filled")) for c in columns])).alias("_r")).select("_r.*")


def scorecard(df: DataFrame, keys: list[str], text: Column, rows: Column, expected: Column) -> DataFrame:
    """One row for each arm: n, balanced, rows recovered, strict (both), median length (floor of the mean of the middle two)."""
    x = df.select(*keys, T.balanced(text).alias("_ok"), (rows == expected).alias("_got"), F.length(text).alias("_len"))
    g = x.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.count_if("_ok").alias("balanced"), F.count_if("_got").alias("rows_recovered"), F.count_if(F.col("_ok") & F.col("_got")).alias("strict"))
    m = interpolated_quantiles(x, keys, "_len", {"q": 0.5}).select(*[F.col(k).alias(f"_m{i}") for i, k in enumerate(keys)], F.floor("q").alias("median_len"))
    return g.join(m, [F.col(k).eqNullSafe(F.col(f"_m{i}")) for i, k in enumerate(keys)], "left").select(*keys, "n", "balanced", "rows_recovered", "strict", "median_len")


def agreement_breakdown(df: DataFrame, agree: Column, confidence: Column, threshold: float = 0.5) -> DataFrame:
    """total, agree, phantom (disagree and unsure), real_error (disagree and sure), median confidence (0 if there is none)."""
    x = df.filter(confidence.isNotNull()).select(agree.alias("_a"), confidence.alias("_conf"), F.lit(1).alias("_one"))
    sure = F.col("_conf") >= threshold
    g = x.agg(F.count(F.lit(1)).alias("total"), F.count_if("_a").alias("agree"), F.count_if(~F.col("_a") & ~sure).alias("phantom"), F.count_if(~F.col("_a") & sure).alias("real_error"))
    m = interpolated_quantiles(x, ["_one"], "_conf", {"q": 0.5}).agg(F.coalesce(F.max("q"), F.lit(0.0)).alias("median_conf"))  # one row
    return g.withColumn("_one", F.lit(1)).join(m.withColumn("_one", F.lit(1)), "_one").drop("_one")


def group_summary(df: DataFrame, keys: list[str], id_col: str) -> DataFrame:
    """Rows, different ids and least id of each group."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.count_distinct(id_col).alias("ids"), F.min(id_col).alias("first_id"))


def most_common(df: DataFrame, value: str, seen: str, k: int) -> DataFrame:
    """The k most frequent values with their counts, ties by first sight."""
    return df.groupBy(value).agg(F.count(F.lit(1)).alias("n"), F.min(seen).alias("_seen")).orderBy(F.desc("n"), "_seen").limit(k).select(value, "n")


def cross_counts(df: DataFrame, row: str, column: str, values: list[str]) -> DataFrame:
    """Rows of each ``row`` by the given values of ``column``, 0 where there is none."""
    return df.groupBy(row).pivot(column, values).agg(F.count(F.lit(1))).fillna(0, values)


def closest(df: DataFrame, id_col: str, gap: Column, k: int) -> DataFrame:
    """The k rows of least gap, ties by id: a report, kept without a full sort."""
    return df.select(id_col, gap.alias("gap")).orderBy("gap", id_col).limit(k)


def direction_counts(df: DataFrame, keys: list[str], difference: Column, near: float, within: float) -> DataFrame:
    """How many differences are above 0, below 0, and no farther than ``within`` from ``near``."""
    x = df.select(*keys, difference.alias("_d"))
    return x.groupBy(*keys).agg(F.count_if(F.col("_d") > 0).alias("over"), F.count_if(F.col("_d") < 0).alias("under"), F.count_if(F.abs(F.col("_d") - near) <= within).alias("near"))


def paired_comparison(df: DataFrame, keys: list[str], before: Column, after: Column) -> DataFrame:
    """For pairs of scores: better, worse and equal ones, and Pearson's correlation; pairs with a null side don't count."""
    x = df.select(*keys, before.cast("double").alias("_a"), after.cast("double").alias("_b")).filter("_a IS NOT NULL AND _b IS NOT NULL")
    count = lambda c: F.count_if(c)
    return x.groupBy(*keys).agg(count(F.col("_b") > F.col("_a")).alias("better"), count(F.col("_b") < F.col("_a")).alias("worse"), count(F.col("_b") == F.col("_a")).alias("equal"), F.corr("_a", "_b").alias("r"))


def closest_convention(df: DataFrame, errors: dict[str, Column]) -> DataFrame:
    """How often each of several conventions has the least absolute error; the first of equals."""
    d = F.array(*[F.struct(F.abs(e).alias("d"), F.lit(i).alias("i"), F.lit(n).alias("n")) for i, (n, e) in enumerate(errors.items())])
    return df.select(F.array_min(d)["n"].alias("best")).groupBy("best").agg(F.count(F.lit(1)).alias("n"))


def arm_statistics(df: DataFrame, keys: list[str], excess: Column, balanced: Column, parses: Column, verdict: Column) -> DataFrame:
    """For each arm: n, rows with excess 0, below 0 and above 0, its median and mean, balanced, parsing, and how often each verdict was given (a map)."""
    x = df.select(*keys, excess.alias("_e"), balanced.alias("_b"), parses.alias("_p"), verdict.alias("_v"))
    e = F.col("_e")
    g = x.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.count_if(e == 0).alias("none"), F.count_if(e < 0).alias("less"), F.count_if(e > 0).alias("more"), F.avg("_e").alias("mean"), F.count_if("_b").alias("balanced"), F.count_if("_p").alias("parses"))
    names = lambda p: [F.col(k).alias(f"{p}{i}") for i, k in enumerate(keys)]
    same = lambda p: [F.col(k).eqNullSafe(F.col(f"{p}{i}")) for i, k in enumerate(keys)]
    m = interpolated_quantiles(x, keys, "_e", {"q": 0.5}).select(*names("_m"), F.col("q").alias("median"))
    v = x.filter("_v IS NOT NULL").groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_c")).groupBy(*names("_w")).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("_v", "_c")))).alias("verdicts"))  # one entry for each verdict
    return g.join(m, same("_m"), "left").join(v, same("_w"), "left").select(*keys, "n", "none", "less", "more", "median", "mean", "balanced", "parses", "verdicts")


def recovery_summary(df: DataFrame, tier: Column, method: Column) -> DataFrame:
    """For each method: repairs, those in the two best tiers, and both as a share of all rows, rounded to 4."""
    good = tier.isin("high", "medium")
    g = df.groupBy(method.alias("method")).agg(F.count(F.lit(1)).alias("n"), F.count_if(good).alias("validated"), F.count_if(tier != "rejected").alias("apparent"))
    return g.select("*", F.round(F.col("apparent") / F.col("n"), 4).alias("apparent_share"), F.round(F.col("validated") / F.col("n"), 4).alias("strict_share"))


def exclusive_quartiles(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Quartiles at (n + 1) * p with linear interpolation between neighbours, and the population's spread. Needs two values or more."""
    c = ranked_counts(df, keys, value)
    aggs = []
    for i in (1, 2, 3):
        at = F.floor((F.col("_n") + 1) * i / 4)
        lo = F.least(F.greatest(at, F.lit(1)), F.col("_n") - 1)
        for name, k in (("a", lo), ("b", lo + 1)):
            aggs.append(F.max(F.when((F.col("_upto") >= k) & (F.col("_upto") - F.col("_c") < k), F.col(value))).alias(f"_{i}{name}"))
    sd = F.sqrt(F.greatest(F.sum(F.col(value) * F.col(value) * F.col("_c")) / F.sum("_c") - F.pow(F.sum(F.col(value) * F.col("_c")) / F.sum("_c"), F.lit(2)), F.lit(0.0)))
    g = c.groupBy(*keys).agg(F.max("_n").alias("n"), sd.alias("sd"), *aggs).filter("n > 1")

    def q(i: int) -> Column:
        pos = (F.col("n") + 1) * i
        at = F.least(F.greatest(F.floor(pos / 4), F.lit(1)), F.col("n") - 1)
        part = pos / 4 - at
        return F.col(f"_{i}a") + (F.col(f"_{i}b") - F.col(f"_{i}a")) * part

    return g.select(*keys, "n", "sd", *[q(i).alias(f"q{i}") for i in (1, 2, 3)])


def least_squares(df: DataFrame, xs: list[str], y: str) -> DataFrame:
    """Coefficients of y on xs with an intercept. The normal equations' sums are one distributed aggregation; only they are solved, in one small row."""
    names = ["_one", *xs]
    d = df.select(F.lit(1.0).alias("_one"), *[F.col(c).cast("double") for c in (*xs, y)]).dropna()
    sums = [F.sum(F.col(a) * F.col(b)).alias(f"s{i}_{j}") for i, a in enumerate(names) for j, b in enumerate([*names, y])]
    k = len(names)

    def solve(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            for r in b.to_pylist():
                m = np.array([[r[f"s{i}_{j}"] or 0.0 for j in range(k + 1)] for i in range(k)])
                beta = np.linalg.lstsq(m[:, :k], m[:, k], rcond=None)[0]
                yield pa.RecordBatch.from_arrays([pa.array(["intercept", *xs]), pa.array(beta)], names=["term", "coefficient"])

    return d.agg(*sums).mapInArrow(solve, "term string, coefficient double")


def interpolated_quantiles(df: DataFrame, keys: list[str], value: str, qs: dict[str, float]) -> DataFrame:
    """Exact quantiles of each group, linear between the values at both sides of (n - 1) * q, with least, greatest and mean.

    As in nearest_rank, values are counted before they are ranked, so what is ordered is a group's distinct values.
    """
    c = ranked_counts(df, keys, value)
    aggs = [F.max("_n").alias("n"), F.min(value).alias("lo"), F.max(value).alias("hi"), (F.sum(F.col(value) * F.col("_c")) / F.sum("_c")).alias("mean")]
    for name, q in qs.items():
        low = F.floor((F.col("_n") - 1) * F.lit(q))
        for side, at in (("a", low), ("b", F.least(low + 1, F.col("_n") - 1))):
            aggs.append(F.max(F.when((F.col("_upto") > at) & (F.col("_upto") - F.col("_c") <= at), F.col(value))).alias(f"_{name}_{side}"))
    g = c.groupBy(*keys).agg(*aggs)
    part = {name: (F.col("n") - 1) * F.lit(q) - F.floor((F.col("n") - 1) * F.lit(q)) for name, q in qs.items()}
    return g.select(*keys, "n", "lo", "hi", "mean", *[(F.col(f"_{k}_a") + (F.col(f"_{k}_b") - F.col(f"_{k}_a")) * part[k]).alias(k) for k in qs])
