"""Mixing sources to target weights by Pareto order sampling (Rosén, 1997)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import written

WORD = r"[^\x20\x09-\x0D]+"
#: Ranks are counted in so many bins for each source, twice over: the second time inside the bin that decides.
BINS = 256


def n_words(text_col: str = "text"):
    return F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD)).cast("long")


def draw(key: Column, hexes: int) -> Column:
    """A number between 0 and 1 that depends on a text alone: the first hex digits of its md5."""
    return (F.conv(F.substring(F.md5(F.encode(key, "utf-8")), 1, hexes), 16, 10).cast("double") + 0.5) / float(16**hexes)


def _placed(sources: DataFrame) -> DataFrame:
    """``sources``: _src, _s. Adds _place, from 0 in code-point order, null last. Sources are dealt out by range; only one number for each range reaches the driver."""
    spark = sources.sparkSession
    order = [F.col("_src").isNull(), F.col("_src")]
    dealt = written(sources.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "sources")
    before, n = [], 0
    for r in dealt.groupBy("_range").agg(F.count(F.lit(1)).alias("n")).orderBy("_range").collect():  # one row for each partition
        before.append((r["_range"], n))
        n += r.n
    starts = spark.createDataFrame(before, "_range2 int, _before long")
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1
    return dealt.withColumn("_inside", inside).join(starts, F.col("_range") == F.col("_range2")).select("_src", "_s", (F.col("_before") + F.col("_inside")).alias("_place"))


def targets(sources: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """``sources``: _src, _s (words). Adds _target.

    Sources in code-point order, null last, take the weights in turn. The budget is ``share`` times all words; a source's
    target is weight x level, at most ``most`` times its words. The level rises while sources stop: each round spends
    what the stopped ones leave on the others, and only three sums reach the driver. Rounds end when no other source stops.
    """
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod("_place", F.lit(len(weights))) + 1).cast("int"))
    x = written(_placed(sources).select("_src", "_s", w.alias("_w"), (F.lit(float(most)) * F.col("_s")).alias("_cap")), "weights")
    total = x.agg(F.sum("_s")).first()[0] or 0
    level, stopped = 0.0, -1
    while True:
        stops = F.col("_cap") <= F.lit(level) * F.col("_w")
        n, spent, rest = x.agg(F.count_if(stops), F.sum(F.when(stops, F.col("_cap"))), F.sum(F.when(~stops, F.col("_w")))).first()
        if n == stopped or rest is None:
            break
        stopped, level = n, (share * total - (spent or 0.0)) / rest
    return x.select("_src", "_s", F.when(stops, F.col("_cap")).otherwise(F.lit(level) * F.col("_w")).alias("_target"))


def _odds(sizes: DataFrame, goal: DataFrame) -> DataFrame:
    """For each source, _c: a text of n words is included with probability min(1, _c x n), which gives the words that whole copies leave.

    ``sizes``: _src, _n, _m (texts of that size). Sizes for which _c x n reaches 1 are the largest ones, and certain; the first size
    from the top that need not be certain sets _c. Only distinct sizes of a source are ordered, never its texts.
    """
    down = Window.partitionBy("_src").orderBy(F.col("_n").desc())
    x = sizes.join(goal.select(F.col("_src").alias("_s2"), "_s", "_target"), F.col("_src").eqNullSafe(F.col("_s2")))
    words, squares = F.col("_n") * F.col("_m"), (F.col("_n") * F.col("_n") * F.col("_m")).cast("double")
    left = F.col("_target") - F.floor(F.col("_target") / F.col("_s")) * F.col("_s")
    x = x.select("_src", "_n", words.alias("_words"), squares.alias("_sq"), left.alias("_left"))
    x = x.select("_src", "_n", "_left", (F.sum("_words").over(down) - F.col("_words")).alias("_above"), F.sum("_sq").over(Window.partitionBy("_src").orderBy("_n")).alias("_rest"))
    c = (F.col("_left") - F.col("_above")) / F.col("_rest")
    x = x.select("_src", "_n", "_left", c.alias("_c")).filter(F.col("_c") * F.col("_n") <= 1)
    return x.groupBy("_src").agg(F.max_by("_c", "_n").alias("_c"), F.max("_left").alias("_left"))


def _tie(frame: DataFrame) -> Column:
    """A digest of a row's columns, those that can be hashed."""
    return F.xxhash64(*[F.col(f"`{f.name}`") for f in frame.schema.fields if "map<" not in f.dataType.simpleString()])


def mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0, seed: int = 9, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per input row: id, _source, size, source_size, target, taken, copies, inclusion.

    size: words of the text (null: 0); target: the words its source is to give (see targets). With r = target /
    source_size, each text gets floor(r) certain whole copies. The rest of the target is a sample of unequal
    probabilities: a text's inclusion probability p is min(1, c x size), one c for the whole source (see _odds). Texts of p = 1 get one more
    copy for certain; the others are ranked by U/(1-U) x (1-p)/p, U from a keyed hash of id, size and source, and a source's
    texts of least rank are taken up to its fixed size in words: as long as the middle of a text's words is within it. taken = copies x size.

    No source is gathered to find its smallest ranks: a histogram of ranks says in which bin the size is reached, a second
    one in which part of that bin; rows of lower bins are in, and only rows of that part (1/65,536 of the ranks) are ordered.
    Equal input gives equal output. Null sources are one source. Rows that agree in id, source and size are told apart by their
    other columns; wholly equal rows are interchangeable. Ids may be null or repeat. Texts without a word have taken 0. No rows in, no rows out.
    """
    own = docs.select(F.col(id_col).alias("_id"), F.col(source_col).alias("_src"), n_words(text_col).alias("_n"), _tie(docs).alias("_tie"))
    return _mixed(written(own, "sizes"), weights, share, most, seed).select(F.col("_id").alias(id_col), F.col("_src").alias("_source"), F.col("_n").alias("size"), F.col("_s").alias("source_size"), F.col("_target").alias("target"), "taken", "copies", "inclusion")


def _mixed(sized: DataFrame, weights: tuple[float, ...], share: float, most: float, seed: int) -> DataFrame:
    sizes = written(sized.groupBy("_src", "_n").agg(F.count(F.lit(1)).alias("_m")), "histogram")
    goal = written(targets(sizes.groupBy("_src").agg(F.sum(F.col("_n") * F.col("_m")).alias("_s")), weights, share, most), "targets")
    odds = _odds(sizes.filter("_n > 0"), goal).withColumnRenamed("_src", "_s3")
    plan = goal.join(odds, F.col("_src").eqNullSafe(F.col("_s3")), "left").select(F.col("_src").alias("_s4"), "_s", "_target", F.coalesce(F.floor(F.try_divide("_target", "_s")), F.lit(0)).alias("_whole"), F.coalesce("_c", F.lit(0.0)).alias("_c"), F.coalesce("_left", F.lit(0.0)).alias("_left"))
    plan = written(plan, "plan")  # one row for each source
    u = draw(F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col("_id").cast("string"), F.lit("-")), F.col("_n").cast("string"), F.coalesce(F.col("_src"), F.lit("-"))), 13)
    rows = sized.join(plan, F.col("_src").eqNullSafe(F.col("_s4"))).select("_id", "_src", "_n", "_tie", "_s", "_target", "_whole", F.least(F.lit(1.0), F.col("_c") * F.col("_n")).alias("inclusion"), u.alias("_u"), "_left")
    p = F.col("inclusion")
    rank = F.when((p > 0) & (p < 1), F.col("_u") / (1 - F.col("_u")) * (1 - p) / p)
    rows = rows.select("*", rank.alias("_rank")).select("*", (F.col("_rank") / (1 + F.col("_rank")) * BINS).alias("_x"))
    rows = written(rows.select("*", F.floor("_x").cast("int").alias("_b1"), F.floor((F.col("_x") - F.floor("_x")) * BINS).cast("int").alias("_b2")), "ranked")
    # Words of certain texts count first, then bins of ranks, until the size is reached.
    certain = rows.filter("inclusion = 1").groupBy("_src").agg(F.sum("_n").alias("_sure")).withColumnRenamed("_src", "_s5")
    left = plan.join(certain, F.col("_s4").eqNullSafe(F.col("_s5")), "left").select("_s4", (F.col("_left") - F.coalesce("_sure", F.lit(0))).alias("_goal"))
    # Edges have one row for each source; written, they are of known size when the rows are joined, and a few sources need no shuffle by source.
    edge1 = written(_edge(rows.filter("_rank IS NOT NULL"), "_b1", left.select(F.col("_s4").alias("_s6"), "_goal")), "edges")
    at = rows.join(edge1.select(F.col("_src").alias("_s7"), F.col("_b1").alias("_e1"), F.col("_goal").alias("_goal1")), F.col("_src").eqNullSafe(F.col("_s7")), "left")
    edge2 = written(_edge(at.filter("_b1 = _e1"), "_b2", edge1.select(F.col("_src").alias("_s6"), "_goal")), "edges")
    at = at.join(edge2.select(F.col("_src").alias("_s8"), F.col("_b2").alias("_e2"), F.col("_goal").alias("_goal2")), F.col("_src").eqNullSafe(F.col("_s8")), "left")
    sure = F.when(p == 1, 1).when(F.col("_rank").isNull(), 0).when(F.col("_e1").isNull(), 1).when(F.col("_b1") != F.col("_e1"), (F.col("_b1") < F.col("_e1")).cast("int"))
    sure = sure.when(F.col("_e2").isNull(), 1).when(F.col("_b2") != F.col("_e2"), (F.col("_b2") < F.col("_e2")).cast("int"))
    at = at.select("_id", "_src", "_n", "_tie", "_s", "_target", "_whole", "inclusion", "_rank", "_goal2", sure.alias("_extra"))
    upto = F.sum("_n").over(Window.partitionBy("_src").orderBy("_rank", "_id", "_tie").rowsBetween(Window.unboundedPreceding, 0))
    drawn = at.filter("_extra IS NULL").withColumn("_extra", (upto - F.col("_n") / 2 <= F.col("_goal2")).cast("int"))
    out = at.filter("_extra IS NOT NULL").unionByName(drawn)
    copies = F.when(F.col("_n") > 0, F.col("_whole") + F.col("_extra")).otherwise(0)
    return out.select("_id", "_src", "_n", "_tie", "_s", "_target", (copies * F.col("_n")).cast("long").alias("taken"), copies.cast("int").alias("copies"), "inclusion")


def _edge(rows: DataFrame, bin_col: str, goal: DataFrame) -> DataFrame:
    """The bin of each source in which its words reach _goal, and what of _goal is left there. Sources that never reach it have no row.

    ``goal``: _s6, _goal. BINS rows at most for each source are ordered."""
    hist = rows.groupBy("_src", bin_col).agg(F.sum("_n").alias("_w"))
    hist = hist.join(goal, F.col("_src").eqNullSafe(F.col("_s6")))
    hist = hist.withColumn("_upto", F.sum("_w").over(Window.partitionBy("_src").orderBy(bin_col)))
    over = hist.filter(F.col("_upto") > F.col("_goal")).groupBy("_src").agg(F.min(F.struct(bin_col, (F.col("_goal") - F.col("_upto") + F.col("_w")).alias("_goal"))).alias("_m"))
    return over.select("_src", f"_m.{bin_col}", "_m._goal")


def take_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0, seed: int = 9) -> DataFrame:
    """``docs`` as the mix takes them, with all their columns: each row as often as its copies say.

    Rows find their copies by id, source, size and a digest of all columns; rows that agree in these are one row
    that stands several times, and give the copies of all of them. Nulls are matched, too; texts without a word are not taken. No rows in, no rows out.
    """

    def key(i, s, n, t):
        return F.concat_ws("\x01", i.isNull().cast("string"), i.cast("string"), s.isNull().cast("string"), s, n.cast("string"), t.cast("string"))

    own = docs.select(F.col(id_col).alias("_id"), F.col(source_col).alias("_src"), n_words(text_col).alias("_n"), _tie(docs).alias("_tie"))
    taken = _mixed(written(own, "sizes"), weights, share, most, seed).filter("copies > 0")
    times = taken.groupBy(key(F.col("_id"), F.col("_src"), F.col("_n"), F.col("_tie")).alias("_key2")).agg(F.sum("copies").cast("int").alias("_c"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)]).alias("_row"), key(F.col(id_col), F.col(source_col), n_words(text_col), _tie(docs)).alias("_key"))
    # Equal rows become one within tasks, before they travel.
    rows = rows.groupBy("_key").agg(F.first("_row").alias("_row")).join(times, F.col("_key") == F.col("_key2"))
    return rows.select("_row", F.explode(F.sequence(F.lit(1), F.col("_c")))).select(*[F.col(f"_row.c{i}").alias(c) for i, c in enumerate(docs.columns)])
