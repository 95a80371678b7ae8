"""N-gram Jaccard join: MinHash bands find candidates, full n-gram sets decide."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkernel as K
from .components import components
from .shared import written

U64 = np.uint64
#: A pair of similarity s meets in a band with probability 1 - (1 - s**ROWS)**BANDS: 0.9999 at s = 0.8, 0.38 at 0.5, 0.02 at 0.3.
ROWS, BANDS = 6, 30
#: Texts in a block; a verification holds two blocks.
BLOCK = 128
_rng = np.random.Generator(np.random.PCG64(8101))
_A = _rng.integers(0, 2**63, ROWS * BANDS, dtype=np.uint64) * U64(2) + U64(1)
_X = _rng.integers(0, 2**63, ROWS * BANDS, dtype=np.uint64)
_W = _rng.integers(0, 2**63, ROWS, dtype=np.uint64) * U64(2) + U64(1)


def shingle_sets(col: pa.Array, k: int) -> list[np.ndarray]:
    """The sorted distinct k-word shingles of each text."""
    b, o = K.buffers(col)
    w = K.words(b, o)
    g, n = K.shingles(w["h"], w["n"], k)
    at = K.bounds(n)
    return [np.unique(g[at[i] : at[i + 1]]) for i in range(len(n))]


def set_digest(s: np.ndarray) -> int:
    """64 bits that depend on the set alone; never 0."""
    with np.errstate(over="ignore"):
        x = np.array([K.mix(s ^ U64(0xA5A5A5A5A5A5A5A5)).sum() + U64(len(s)) * U64(0x9E3779B97F4A7C15)], np.uint64)
    return int(K.mix(x).view(np.int64)[0]) or 1


def _bands(sets: list[np.ndarray]) -> np.ndarray:
    """For each non-empty set, a hash for each band."""
    out = np.zeros((len(sets), BANDS), np.uint64)
    i = 0
    while i < len(sets):
        j, size = i, 0
        while j < len(sets) and (j == i or size + len(sets[j]) <= 32768):
            size += len(sets[j])
            j += 1
        flat = np.concatenate(sets[i:j])
        at = K.bounds(np.array([len(s) for s in sets[i:j]]))[:-1]
        buf = np.empty_like(flat)
        for k in range(BANDS):
            acc = np.full(j - i, k, np.uint64)
            for r in range(ROWS):
                np.bitwise_xor(flat, _X[k * ROWS + r], out=buf)
                np.multiply(buf, _A[k * ROWS + r], out=buf)
                acc += K.mix(np.minimum.reduceat(buf, at)) * _W[r]
            out[i:j, k] = K.mix(acc)
        i = j
    return out


def _signatures(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 1024):
                part = b.slice(at, 1024)
                sets = shingle_sets(part.column(1), k)
                full = np.array([len(s) > 0 for s in sets], bool)
                node = pa.array([set_digest(s) if len(s) else None for s in sets], pa.int64())
                bands = _bands([s for s in sets if len(s)]).view(np.int64).reshape(-1)
                lists = pa.ListArray.from_arrays(pa.array(K.bounds(full.astype(np.int64) * BANDS).astype(np.int32)), pa.array(bands))
                yield pa.RecordBatch.from_arrays([part.column(0), node, lists, part.column(2)], names=["_id", "node", "bands", "_h"])

    return run


def _pairs(sets: list[np.ndarray], weight: np.ndarray, side: np.ndarray | None, met: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links of each set, links weighted by copies, and the first member of each one's connected group.
    side: only pairs of differing side count; None: all pairs. met: a row of band hashes for each set; pairs that agree in one have been counted elsewhere."""
    m = len(sets)
    size = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(m), size)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    new = np.ones(len(flat), bool)
    new[1:] = flat[1:] != flat[:-1]
    col = np.cumsum(new) - 1
    shared = np.flatnonzero(np.bincount(col) > 1)
    keep = np.isin(col, shared, assume_unique=False) if len(shared) < col[-1] + 1 else np.ones(len(col), bool)
    col, owner = np.searchsorted(shared, col[keep]), owner[keep]
    inter = np.zeros((m, m), np.float64)
    for lo in range(0, len(shared), 4096):
        a, z = np.searchsorted(col, (lo, lo + 4096))
        x = np.zeros((m, min(4096, len(shared) - lo)), np.float32)
        x[owner[a:z], col[a:z] - lo] = 1
        inter += x @ x.T
    both = np.rint(inter).astype(np.int64)
    ok = den * both >= num * (size[:, None] + size[None, :] - both)
    np.fill_diagonal(ok, False)
    if side is not None:
        ok &= side[:, None] != side[None, :]
    for band in met.T if ok.any() else ():
        ok &= band[:, None] != band[None, :]
    root = np.arange(m)
    while True:
        low = np.where(ok, root[None, :], m).min(axis=1)
        nxt = np.minimum(root, low)
        nxt = nxt[nxt]
        if (nxt == root).all():
            break
        root = nxt
    return ok.sum(axis=1), (ok * weight[None, :]).sum(axis=1), root


def _verify(k: int, num: int, den: int):
    names = ["node", "root", "n", "w"]

    def check(rows: list[tuple]) -> pa.RecordBatch:
        nb, band = rows[0][1:3]
        sets = [r[-1] for r in rows]
        seen, own = set(), []
        for i, r in enumerate(rows):  # a row whose text is not its node's, or is there twice, adds nothing
            if r[3] not in seen and len(sets[i]) and set_digest(sets[i]) == r[3]:
                seen.add(r[3])
                own.append(i)
        nodes = np.array([rows[i][3] for i in own], np.int64)
        if len(own) < 2:
            n = w = np.zeros(len(own), np.int64)
            root = np.arange(len(own))
        else:
            side = np.array([rows[i][4] for i in own])
            cross = nb > 1 and (side != side[0]).any()
            met = np.array([rows[i][6][:band] for i in own], np.int64) if band > 0 else np.zeros((len(own), 0), np.int64)
            n, w, root = _pairs([sets[i] for i in own], np.array([rows[i][5] for i in own], np.int64), side if cross else None, met, num, den)
        return pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(nodes[root] if len(own) else nodes), pa.array(n.astype(np.int64)), pa.array(w.astype(np.int64))], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_key, rows = None, []
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                sets = shingle_sets(part.column("_t"), k)
                for c, band, lo, hi, nb, node, blk, copies, bands, s in zip(*(part.column(x).to_pylist() for x in ("comp", "band", "lo", "hi", "nb", "node", "blk", "copies", "bands")), sets, strict=True):
                    if (c, band, lo, hi) != open_key and rows:
                        yield check(rows)
                        rows = []
                    open_key = (c, band, lo, hi)
                    if not (nb > 1 and lo == hi and blk != lo):
                        rows.append((open_key, nb, band, node, blk, copies, bands, s))
        if rows:
            yield check(rows)

    return run


def ngram_join(docs: DataFrame, k: int = 5, num: int = 4, den: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, class_id, n_links, n_link_texts, copies.

    A text's set holds its distinct runs of ``k`` words (words ``[^\\x20\\x09-\\x0D]+`` as they stand; a text of
    1 to k-1 words has one run, all its words). Two rows are linked if their sets' Jaccard similarity is
    num/den or more. class_id is the least id of the row's connected group, n_links the number of other
    rows it is linked to (copies counted), n_link_texts that of differing sets, copies the rows of its own set.

    1. Rows of equal sets become one node by an aggregation that reduces within tasks, so copies are never paired.
    2. Nodes meet by band hashes (BANDS bands of ROWS MinHash values): each node is joined to the least
       node of its bucket, and the connected groups of these links are the candidate groups. No bucket is
       gathered or expanded into pairs, none is capped.
    3. A candidate group is verified as a whole, or, where that means fewer pairs, bucket by bucket: groups of real
       near copies are dense, and each of their pairs would come up in many buckets; groups that hang together by chance
       links are chains of small buckets, and grow with the corpus. Texts are dealt out by pairs of blocks of about BLOCK texts, and in each pair
       of blocks all pairs are decided exactly on full sets; a pair that meets in several buckets counts in the first.
       Every pair of a bucket is tested either way. Block pairs give back one row for each text, never a row for each pair.
    4. Links are summed, and the components of the verified links give the classes.

    Rows with a null id, and texts without a word, link to nothing: class_id is the row's own id, n_links 0,
    copies 1. Repeated rows are copies of each other. Other columns are ignored. No rows in, no rows out.
    """
    return _linked(docs, k, num, den, id_col, text_col).drop("_h")


def _linked(docs: DataFrame, k: int, num: int, den: int, id_col: str, text_col: str) -> DataFrame:
    """ngram_join's rows, and _h, a digest of the text."""
    base = docs.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_t"))
    sig = written(base.select("_id", "_t", F.xxhash64("_t").alias("_h")).mapInArrow(K.releasing(_signatures(k)), "_id long, node long, bands array<long>, _h long"), "signatures")
    good = sig.filter("node IS NOT NULL AND _id IS NOT NULL")
    nodes = written(good.groupBy("node").agg(F.min("_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("bands").alias("bands")), "nodes")
    keyed = nodes.select("node", F.posexplode("bands").alias("band", "h")).select("node", "band", F.xxhash64("band", "h").alias("h"))
    buckets = written(keyed.groupBy("h").agg(F.min("node").alias("m"), F.count(F.lit(1)).alias("c")).filter("c > 1").select(F.col("h").alias("h2"), "m", "c"), "buckets")
    meets = written(keyed.join(buckets, F.col("h") == F.col("h2")).select("node", "band", "h", "m", "c"), "meets")
    cand = components(meets.select(F.col("node").alias("u"), F.col("m").alias("v")))
    cand = cand.withColumnsRenamed({"node": "n1", "root": "comp"})
    # Pairs of a group as a whole, against pairs of its buckets.
    by_bucket = buckets.join(cand, F.col("m") == F.col("n1")).groupBy("comp").agg(F.sum(F.col("c") * F.col("c")).alias("pairs"))
    sizes = cand.groupBy(F.col("comp").alias("c2")).agg(F.count(F.lit(1)).alias("size"))
    route = sizes.join(by_bucket, F.col("c2") == F.col("comp")).select("c2", "size", (F.col("size") * F.col("size") > F.col("pairs")).alias("split"))
    placed = written(cand.join(route, F.col("comp") == F.col("c2")).select("n1", "comp", "size", "split"), "placed")
    blocks = lambda n: F.ceil(F.col(n) / BLOCK).cast("int")
    whole = placed.filter("NOT split").select("n1", "comp", F.lit(-1).alias("band"), blocks("size").alias("nb"))
    split = meets.join(placed.filter("split").select("n1"), F.col("node") == F.col("n1")).select("n1", F.col("h").alias("comp"), "band", blocks("c").alias("nb"))
    dealt = whole.unionByName(split).withColumn("blk", F.pmod(F.xxhash64("n1"), F.col("nb").cast("long")).cast("int"))
    dealt = dealt.join(nodes.select(F.col("node"), "rep", "copies", "bands"), F.col("n1") == F.col("node")).select("node", "comp", "band", "nb", "blk", "rep", "copies", F.when(F.col("band") > 0, F.col("bands")).alias("bands"))
    texts = base.join(dealt, F.col("_id") == F.col("rep")).select("comp", "band", "nb", "blk", "node", "copies", "bands", "_t")
    texts = texts.select("*", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("other"))
    texts = texts.select("comp", "band", F.least("blk", "other").alias("lo"), F.greatest("blk", "other").alias("hi"), "nb", "node", "blk", "copies", "bands", "_t")
    groups = texts.repartition("comp", "band", "lo", "hi").sortWithinPartitions("comp", "band", "lo", "hi")
    found = written(groups.mapInArrow(K.releasing(_verify(k, num, den)), "node long, root long, n long, w long"), "verified")
    links = found.groupBy("node").agg(F.sum("n").alias("n"), F.sum("w").alias("w")).filter("n > 0")
    final = components(found.select(F.col("node").alias("u"), F.col("root").alias("v")))
    rep = nodes.select(F.col("node"), "rep", "copies")
    member = rep.join(final.withColumnRenamed("node", "n2"), F.col("node") == F.col("n2"), "left").select("node", "rep", "copies", F.coalesce("root", "node").alias("root"))
    least = member.groupBy("root").agg(F.min("rep").alias("class_id")).withColumnRenamed("root", "r2")
    about = member.join(least, F.col("root") == F.col("r2")).join(links.withColumnRenamed("node", "n3"), F.col("node") == F.col("n3"), "left")
    about = about.select(F.col("node").alias("n4"), "class_id", "copies", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("w", F.lit(0)).alias("w"))
    rows = sig.select("_id", F.when(F.col("_id").isNotNull(), F.col("node")).alias("node"), "_h")
    return rows.join(about, F.col("node") == F.col("n4"), "left").select(
        F.col("_id").alias(id_col),
        F.coalesce("class_id", "_id").alias("class_id"),
        F.coalesce(F.col("w") + F.col("copies") - 1, F.lit(0)).alias("n_links"),
        F.coalesce(F.col("n"), F.lit(0)).alias("n_link_texts"),
        F.coalesce(F.col("copies"), F.lit(1)).alias("copies"),
        "_h",
    )


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose id isn't its class's, all columns kept. A row is found again by id and digest of its text,
    so an id with several texts loses only those whose class has a smaller id; rows that repeat the id and text that stay, stay. Null ids and
    texts without a word stay. No rows in, no rows out."""
    drop = _linked(docs, 5, 4, 5, id_col, text_col).filter(F.col(id_col) != F.col("class_id")).select(F.col(id_col).alias("_drop"), F.col("_h").alias("_drop_h")).distinct()
    return docs.join(drop, (F.col(id_col) == F.col("_drop")) & (F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))) == F.col("_drop_h")), "left_anti")
