"""Queries of sources, sinks, images, drawings and streams. Their files are made from keys of the tables, in the folder that driver and executors share."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..chem import draw
from ..chem import repairs as R
from ..operators import imaging as I
from ..operators import readers as D
from ..sources import files
from ..streaming import pending
from . import extract
from .profiles import profile
from .queries_chem import _per_row, structures
from .registry import query, t


def _made(df: DataFrame, folder: str, make: Callable[..., bytes]) -> str:
    """Writes a file for each row (name, ...): its content is made of the other columns."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = list(zip(*(c.to_pylist() for c in b.columns), strict=True))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([make(*r[1:]) for r in rows], pa.binary())], names=["name", "content"])

    files.write_each(df.mapInArrow(work, "name string, content binary"), folder).count()
    return folder


def _nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("int").alias("k"), "n_name")


@query("SELECT * FROM (SELECT concat('n', lpad(CAST(n_nationkey AS VARCHAR), 2, '0'), CASE n_nationkey % 3 WHEN 0 THEN '.png' WHEN 1 THEN '.pgm' ELSE '.txt' END) AS name, CAST(length(n_name) AS BIGINT) AS length FROM nation) WHERE name LIKE '%.png' OR name LIKE 'n1%'")
def image_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of a folder that match any pattern, each once."""
    n = _nations(spark, sf_dir).select(F.concat(F.lit("n"), F.lpad(F.col("k").cast("string"), 2, "0"), F.expr("CASE k % 3 WHEN 0 THEN '.png' WHEN 1 THEN '.pgm' ELSE '.txt' END")).alias("name"), "n_name")
    folder = _made(n, files.workspace(spark), lambda name: name.encode())
    return files.images(spark, folder, ("*.png", "n1*")).select("name", "length")


@query("SELECT concat('n', n_nationkey, '.txt') AS path, sha256(n_name) AS sha256 FROM nation")
def file_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every file of a folder with its digest."""
    n = _nations(spark, sf_dir).select(F.concat(F.lit("n"), F.col("k").cast("string"), F.lit(".txt")).alias("name"), "n_name")
    return files.inventory(spark, _made(n, files.workspace(spark), lambda name: name.encode()))


@query("SELECT concat('n', n_nationkey) AS path, CASE n_nationkey % 4 WHEN 0 THEN 'missing' WHEN 1 THEN 'differ' ELSE 'same' END AS state FROM nation")
def tree_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two trees by path and digest."""
    n = _nations(spark, sf_dir).select(F.concat(F.lit("n"), F.col("k").cast("string")).alias("name"), "n_name", "k")
    a = _made(n, files.workspace(spark), lambda name, k: name.encode())
    b = _made(n.filter("k % 4 <> 0"), files.workspace(spark), lambda name, k: (name + "!" * (k % 4 == 1)).encode())
    return files.compare_trees(files.inventory(spark, a), files.inventory(spark, b))


@query("SELECT CAST(c_custkey AS VARCHAR) AS cmpd_id, CASE WHEN c_custkey % 5 = 0 THEN '' ELSE concat('a \"q\", ', c_name) END AS smiles, CASE c_custkey % 3 WHEN 0 THEN 'True' WHEN 1 THEN 'False' ELSE '' END AS is_valid, '' AS kd_nm, (SELECT count(*) FROM customer) AS written FROM customer")
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table written with a byte-order mark, fixed columns and empty cells, and read again."""
    c = t(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("cmpd_id"), F.when(F.col("c_custkey") % 5 != 0, F.concat(F.lit('a "q", '), F.col("c_name"))).alias("smiles"), F.expr("CASE c_custkey % 3 WHEN 0 THEN true WHEN 1 THEN false END").alias("is_valid"), F.lit("left out").alias("other"))
    path = f"{files.workspace(spark)}/out"
    n = files.write_csv(c, path, ("cmpd_id", "smiles", "is_valid", "kd_nm"), mark=True)
    return files.read_csv(spark, path).withColumn("written", F.lit(n).cast("long"))


@query("""WITH r AS (SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS cmpd_id FROM orders), l AS (SELECT *, row_number() OVER (PARTITION BY cmpd_id ORDER BY o_orderkey DESC) AS k FROM r)
SELECT cmpd_id, o_orderkey % 2 = 0 AS is_valid, CASE WHEN o_orderkey % 4 < 2 THEN concat('cells/p', o_orderkey % 4, '.png') END AS structure_image, CAST(o_orderkey AS DOUBLE) / 8 AS molecular_weight, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(1000 + o_orderkey % 7 AS DOUBLE) END AS kd_nm, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'A' END AS mdm2 FROM l WHERE k = 1""")
def records_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: records of two files, with types, the last of an id, paths that exist, extras that are filled."""
    o = t(spark, sf_dir, "orders").orderBy("o_orderkey").select("o_orderkey", F.col("o_custkey").cast("string").alias("cmpd_id"))
    base, key = files.workspace(spark), F.col("o_orderkey")
    comp = o.select("cmpd_id", F.expr("CASE WHEN o_orderkey % 2 = 0 THEN 'true' ELSE 'False' END").alias("is_valid"), F.concat(F.lit("cells/p"), (key % 4).cast("string"), F.lit(".png")).alias("structure_image"), (key / 8).cast("string").alias("molecular_weight"))
    assay = o.select("cmpd_id", F.when(key % 5 == 0, "x").otherwise(F.format_number(1000 + key % 7, 0)).alias("kd_nm"), F.when(key % 3 != 0, "A").otherwise("").alias("mdm2"))
    files.write_csv(comp, f"{base}/c", comp.columns, single=True)
    files.write_csv(assay, f"{base}/a", assay.columns, single=True)
    known = spark.createDataFrame([("p0.png",), ("p1.png",)], "name string")
    c, a = files.reload_records(spark, f"{base}/c", f"{base}/a", ("mdm2",), known)
    return c.join(a.select(F.col("cmpd_id").alias("_k"), "kd_nm", F.try_element_at("extra", F.lit("mdm2")).alias("mdm2")), F.col("cmpd_id") == F.col("_k")).drop("_k")


@query("""WITH e AS (SELECT CAST(c_custkey AS VARCHAR) AS cmpd_id, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey DESC) AS k, c_name, c_acctbal, c_nationkey FROM customer)
SELECT CAST(n_nationkey AS VARCHAR) AS cmpd_id, n_name AS smiles, coalesce(c_name, '') AS smiles_decimer, coalesce(CAST(CAST(c_nationkey AS DOUBLE) / 4 AS VARCHAR), '') AS decimer_min_conf, '' AS decimer_render_path FROM nation LEFT JOIN (SELECT * FROM e WHERE k = 1) x ON x.c_nationkey = n_nationkey""")
def model_columns_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The model's columns of an earlier table, the last row of an id."""
    n = _nations(spark, sf_dir).select(F.col("k").cast("string").alias("cmpd_id"), F.col("n_name").alias("smiles"))
    c = t(spark, sf_dir, "customer").orderBy("c_custkey").coalesce(1)
    old = c.select(F.col("c_nationkey").cast("int").cast("string").alias("cmpd_id"), F.col("c_name").alias("smiles_decimer"), (F.col("c_nationkey") / 4).alias("decimer_min_conf"))
    return extract.reuse_columns(n, old, ("smiles_decimer", "decimer_min_conf", "decimer_render_path"))


@query("SELECT CAST(n_nationkey AS VARCHAR) AS cmpd_id, n_name AS smiles, CAST(n_nationkey AS INT) AS low_conf FROM nation WHERE n_nationkey % 3 = 2")
def cache_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON caches; another version, and a file that is no JSON, give no rows."""

    def cache(k: int, name: str) -> bytes:
        entry = {"smiles": name, "canonical": name, "min_conf": 0.5, "low_conf": k, "render": ""}
        return b"{" if k % 3 == 0 else json.dumps({"__version__": k % 3, "entries": {str(k): entry}}).encode()

    n = _nations(spark, sf_dir).select(F.concat(F.lit("c"), F.col("k").cast("string")).alias("name"), "k", "n_name")
    return files.read_cache(spark, _made(n, files.workspace(spark), cache)).select("cmpd_id", "smiles", "low_conf")


@query("SELECT n_nationkey AS k, n_name AS name FROM nation")
def cache_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cache filled in two steps; the second runs only on what the first left."""
    path, n = f"{files.workspace(spark)}/cache", t(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k"), "n_name")
    model = lambda df: df.select("k", F.col("n_name").alias("name"))
    files.append_cache(model(n.filter("k % 2 = 0")), path)
    _, fresh = extract.run_model(n, "k", spark.read.parquet(path), model)
    files.append_cache(fresh, path)
    return spark.read.parquet(path)


@query("SELECT concat('c', n_nationkey) AS key, CASE WHEN n_nationkey % 6 <> 5 THEN n_name END AS text, n_nationkey % 6 = 5 AS failed FROM nation")
def cell_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crops of a folder read by a model that is built once for each task; a crop that fails is a row."""

    def crop(k: int, name: str) -> bytes:
        g = np.full((40, 200), 255, np.uint8)
        _stamp(g, 9, 9, name)
        return b"broken" if k % 6 == 5 else I.encode_png(g)

    n = _nations(spark, sf_dir).select(F.concat(F.lit("c"), F.col("k").cast("string"), F.lit(".png")).alias("name"), "k", "n_name")
    x = I.read_cells(files.images(spark, _made(n, files.workspace(spark), crop), ("*.png",)), lambda: _stamped)
    return x.select("key", "text", F.col("error").isNotNull().alias("failed"))


@query("""SELECT CAST(n_nationkey AS VARCHAR) AS cmpd_id, CASE WHEN n_nationkey < 5 THEN 'N' ELSE concat(repeat('C', CAST(1 + n_nationkey % 4 AS INT)), 'O', CASE n_nationkey % 3 WHEN 1 THEN '.C' WHEN 2 THEN '(' ELSE '' END) END AS smiles_decimer,
CASE WHEN n_nationkey < 5 THEN 'N' WHEN n_nationkey % 3 = 2 THEN '' ELSE concat(repeat('C', CAST(1 + n_nationkey % 4 AS INT)), 'O') END AS canonical_smiles_decimer, CASE WHEN n_nationkey < 5 THEN 0.25 WHEN n_nationkey % 2 = 0 THEN 0.4 END::DOUBLE AS decimer_min_conf, CAST(CASE WHEN n_nationkey < 5 THEN 2 WHEN n_nationkey % 2 = 0 THEN 1 END AS INT) AS decimer_low_conf_count FROM nation""")
def model_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The structure model's stage with a cache of five entries: the clean-up of its texts, and confidence of its tokens."""
    work = _nations(spark, sf_dir).select(F.col("k").cast("string").alias("cmpd_id"), "k")
    cache = work.filter("k < 5").select("cmpd_id", F.lit("N").alias("raw"), F.lit("N").alias("cleaned"), F.lit("N").alias("canon"), F.lit(0.25).alias("min_conf"), F.lit(2).alias("low_conf"))
    text = F.concat(F.expr("repeat('C', cast(1 + k % 4 as int))"), F.lit("O"), F.expr("CASE k % 3 WHEN 1 THEN '.C' WHEN 2 THEN '(' ELSE '' END"))
    tokens = F.when(F.col("k") % 2 == 0, F.array(F.struct(F.lit("C").alias("token"), F.lit(0.4).alias("p")), F.struct(F.lit("O").alias("token"), F.lit(0.9).alias("p"))))
    both, _ = extract.model_stage(work, cache, lambda todo: todo.select("cmpd_id", text.alias("smiles"), tokens.alias("tokens")))
    return both


@query("SELECT CAST(r_regionkey AS VARCHAR) AS id, concat(r_name, '; ', r_regionkey) AS notes, 'csv' AS kind FROM region UNION ALL SELECT CAST(r_regionkey AS VARCHAR), concat(r_name, '; ', r_regionkey), 'json' FROM region")
def audit_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7: an audit as CSV and as JSON."""
    path = f"{files.workspace(spark)}/audit"
    files.write_audit(t(spark, sf_dir, "region").select(F.col("r_regionkey").cast("string").alias("id"), F.array("r_name", F.col("r_regionkey").cast("string")).alias("notes")), path)
    a = spark.read.csv(f"{path}/csv", header=True).select("id", "notes", F.lit("csv").alias("kind"))
    return a.unionByName(spark.read.json(f"{path}/json").select("id", F.concat_ws("; ", "notes").alias("notes"), F.lit("json").alias("kind")))


@query("SELECT CAST(n_nationkey AS VARCHAR) AS cell, 'padded' AS route, length(n_name) AS length, n_name AS smiles, 'csv' AS kind FROM nation UNION ALL SELECT CAST(n_nationkey AS VARCHAR), 'padded', length(n_name), n_name, 'json' FROM nation")
def cells_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K8: texts of cells as CSV and as JSON."""
    path = files.workspace(spark)
    files.write_cells(_nations(spark, sf_dir).select(F.col("k").cast("string").alias("key"), F.col("n_name").alias("text")), path, "padded", as_json=True)
    a = spark.read.csv(f"{path}/csv", header=True).withColumn("kind", F.lit("csv"))
    return a.withColumn("length", F.col("length").cast("long")).unionByName(spark.read.json(f"{path}/json").withColumn("kind", F.lit("json")))


@query("SELECT p_partkey, CASE p_size % 9 WHEN 3 THEN 'smiles' WHEN 6 THEN 'dense' WHEN 7 THEN 'activity' END AS layout, CAST(2 + p_size % 3 AS INT) AS bonds FROM part")
def counts_and_bonds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The layout of a number of columns, and the double and triple bonds of a text."""
    from ..functions import text as T
    from .profiles import layout_by_count

    p = t(spark, sf_dir, "part")
    s = F.concat(F.lit("C=C#N"), F.expr("repeat('=', cast(p_size % 3 as int))"))
    return p.select("p_partkey", layout_by_count((F.col("p_size") % 9).cast("int"), profile("WO2025162428")).alias("layout"), T.bond_count(s).alias("bonds"))


@query("SELECT n_nationkey AS k, concat('t', n_nationkey, CASE WHEN n_nationkey % 2 = 0 THEN '.csv' ELSE '.policy.csv' END) AS target FROM nation")
def policy_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3, K6: where a table with its policy columns goes; files that are not there can be written."""
    rows = [(r.k, files.writable_target(files.policy_target(f"t{r.k}.csv", r.k % 2 == 0))) for r in _nations(spark, sf_dir).orderBy("k").collect()]  # 25 rows
    return spark.createDataFrame(rows, "k long, target string")


# Pictures. A text is drawn as blocks of 3 x 3 pixels, a column of seven bits for each character, so that a stand-in for a model can read it.


def _stamp(grey: np.ndarray, y: int, x: int, text: str) -> None:
    for i, c in enumerate(text):
        for bit in range(7):
            if ord(c) >> bit & 1:
                grey[y + 4 * bit : y + 4 * bit + 3, x + 4 * i : x + 4 * i + 3] = 0


def _stamped(grey: np.ndarray, y: int = 9, x: int = 9) -> str:
    out = ""
    while x + 4 * len(out) < grey.shape[1] and y + 24 < grey.shape[0]:
        code = sum((int(grey[y + 4 * bit, x + 4 * len(out)]) < 128) << bit for bit in range(7))
        if not code:
            break
        out += chr(code)
    return out


_EDGES = (100, 220, 880, 1000, 1120, 1240, 1360, 1480, 1600)
_ROW, _TOP = 60, 100


def _ruled(texts: list[list[str]], edges: tuple[int, ...] = _EDGES, width: int = 1700) -> np.ndarray:
    g = np.full((_TOP + _ROW * len(texts) + 60, width), 255, np.uint8)
    for i in range(len(texts) + 1):
        g[_TOP + _ROW * i : _TOP + _ROW * i + 2, edges[0] : edges[-1] + 2] = 0
    for x in edges:
        g[_TOP : _TOP + _ROW * len(texts) + 2, x : x + 2] = 0
    for i, row in enumerate(texts):
        for x, text in zip(edges, row, strict=False):
            _stamp(g, _TOP + _ROW * i + 10, x + 10, text)
    return g


def _page(k: int) -> bytes:
    """A page of two compounds; where k % 3 = 1, a row before them goes on from the page before. Page 9 is no image."""
    if k == 9:
        return b"broken"
    grades = lambda n: ["ABCDE"[(n + j) % 5] for j in range(6)]
    rows = [["No", "S", "g1", "g2", "g3", "g4", "g5", "g6"]]
    if k % 3 == 1:
        rows.append(["", "N"])
    rows += [[str(n), "C" * (1 + k % 5) + "O", *grades(n)] for n in (2 * k + 1, 2 * k + 2)]
    return I.encode_png(_ruled(rows))


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = _nations(spark, sf_dir).select(F.concat(F.lit("page"), F.lpad(F.col("k").cast("string"), 2, "0"), F.lit(".png")).alias("name"), "k")
    return files.images(spark, _made(n, files.workspace(spark), _page), profile("WO2022251372").words("files"))


_NAME = "concat('page', lpad(CAST(n_nationkey AS VARCHAR), 2, '0'), '.png')"
_ROWS = "(3 + CASE WHEN n_nationkey % 3 = 1 THEN 1 ELSE 0 END)"


@query(f"SELECT {_NAME} AS name, CASE WHEN n_nationkey <> 9 THEN '0,120,780,900,1020,1140,1260,1380,1500' END AS columns, CASE WHEN n_nationkey <> 9 THEN CAST({_ROWS} * 60 AS INT) END AS height, n_nationkey = 9 AS failed FROM nation")
def page_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ruled tables of pages; a page that fails is a row, and the scan goes on."""
    x = I.scan_tables(_pages(spark, sf_dir))
    return x.select(F.substring_index("path", "/", -1).alias("name"), F.array_join(F.col("columns").cast("array<string>"), ",").alias("columns"), F.element_at("rows", -1).alias("height"), F.col("error").isNotNull().alias("failed"))


_COMPOUNDS = f"""WITH n AS (SELECT * FROM nation WHERE n_nationkey <> 9), c AS (SELECT n_nationkey AS k, {_NAME} AS page, 2 * n_nationkey + unnest([1, 2]) AS number FROM n),
s AS (SELECT c.*, concat(repeat('C', CAST(1 + k % 5 AS INT)), 'O', CASE WHEN number % 2 = 0 AND k IN (SELECT CASE WHEN n_nationkey = 10 THEN 8 ELSE n_nationkey - 1 END FROM n WHERE n_nationkey % 3 = 1) THEN 'N' ELSE '' END) AS smiles FROM c)"""


@query(f"{_COMPOUNDS} SELECT CAST(number AS VARCHAR) AS cmpd_id, smiles, page, CASE WHEN number % 5 <> 4 THEN substr('ABCDE', CAST(1 + number % 5 AS INT), 1) END AS mdm2, CASE WHEN (number + 5) % 5 <> 4 THEN substr('ABCDE', CAST(1 + (number + 5) % 5 AS INT), 1) END AS mkl1 FROM s")
def page_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages to compounds and grades, rows that go on over a page's end, a broken page between."""
    family = profile("WO2022251372")
    cells = extract.cells(_pages(spark, sf_dir))
    texts = extract.read(cells, lambda: lambda g: [("line", _stamped(g), 1), ("ch", _stamped(g), 1)])
    comp, assay = extract.records(texts, family)
    a = assay.select(F.col("cmpd_id").alias("_k"), "mdm2", "mkl1")
    return comp.join(a, F.col("cmpd_id") == F.col("_k"), "left").select("cmpd_id", "smiles", F.substring_index("page", "/", -1).alias("page"), "mdm2", "mkl1")


@query(f"{_COMPOUNDS} SELECT CAST(number AS VARCHAR) AS cmpd_id, smiles, 'True' AS is_valid, page AS source_image, coalesce(CASE WHEN number % 5 <> 4 THEN substr('ABCDE', CAST(1 + number % 5 AS INT), 1) END, '') AS mdm2, 'printed_ocr' AS smiles_best_source, 'balanced' AS ocr_difficulty, 'page09.png' AS failed FROM s")
def full_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole way from page images to the delivered table, with a stand-in for the reading model; the page that failed is reported."""
    from .flows import full_run as run

    n = _nations(spark, sf_dir).select(F.concat(F.lit("page"), F.lpad(F.col("k").cast("string"), 2, "0"), F.lit(".png")).alias("name"), "k")
    rows, failed = run(spark, _made(n, files.workspace(spark), _page), profile("WO2022251372"), lambda: lambda g: [("line", _stamped(g), 1), ("ch", _stamped(g), 1)])
    bad = failed.agg(F.array_join(F.array_sort(F.collect_list(F.substring_index("path", "/", -1))), ",").alias("failed")).withColumn("_one", F.lit(1))
    x = rows.select("cmpd_id", "smiles", "is_valid", F.substring_index("source_image", "/", -1).alias("source_image"), "mdm2", "smiles_best_source", "ocr_difficulty", F.lit(1).alias("_one"))
    return x.join(bad, "_one").drop("_one")


@query("SELECT n_nationkey AS k, CASE n_nationkey % 4 WHEN 0 THEN 'dense' WHEN 1 THEN 'smiles' WHEN 2 THEN 'activity' ELSE 'dense' END AS layout, CASE n_nationkey % 4 WHEN 1 THEN 3 WHEN 2 THEN 7 ELSE 6 END AS columns, CASE n_nationkey % 4 WHEN 3 THEN 3 WHEN 1 THEN 3 WHEN 2 THEN 7 ELSE 6 END AS first_row, CASE n_nationkey % 4 WHEN 1 THEN 425 WHEN 2 THEN 115 ELSE 173 END AS last_width FROM nation")
def cropped_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images of one table each: layout by heading or by rules, edges drawn to rules, a first row of its own."""
    dense = [177, 347, 507, 677, 797]

    def image(k: int) -> bytes:
        inner = [dense, [104, 570], [95, 480, 575, 675, 785, 885], dense][k % 4]
        rows = [[104, 570], dense, dense] if k % 4 == 3 else [inner] * 3
        g = np.full((300, 1000), 255, np.uint8)
        for i, xs in enumerate(rows):
            for x in [*xs, *([994] if k % 4 == 1 else [])]:
                g[100 * i : 100 * i + 100, x : x + 2] = 0
            g[100 * i + 98 : 100 * i + 100] = 0
        if k % 4 == 2:
            _stamp(g, 4, 4, "h")
        return I.encode_png(g)

    family = profile("WO2025162428")
    n = _nations(spark, sf_dir).select(F.concat(F.lit("i"), F.col("k").cast("string"), F.lit(".png")).alias("name"), "k")
    images = files.images(spark, _made(n, files.workspace(spark), image), ("*.png",))
    # A heading that names structure and Kd says activity, whatever the rules say.
    cells = extract.cells(images, family=family, heading=lambda: lambda g: ["Kd (nM)", " STRUCTURE "] if (g[8:60, 4:20] < 128).any() else [])

    def width(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            w = [I.decode(x).shape[1] for x in b.column("png").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("path"), b.column("row"), b.column("column"), b.column("n_columns"), pa.array(w, pa.int32())], names=["path", "row", "column", "n_columns", "width"])

    x = cells.select("path", "row", "column", "n_columns", "png").mapInArrow(width, "path string, row int, column int, n_columns int, width int")
    k = F.regexp_extract("path", r"/i(\d+)\.png$", 1).cast("long").alias("k")
    g = x.groupBy(k).agg(F.max_by("n_columns", "row").alias("columns"), F.min_by("n_columns", "row").alias("first_row"), F.max_by("width", F.struct("row", "column")).alias("last_width"))
    name = F.create_map(*[F.lit(v) for layout in family.layouts for v in (len(family.columns(layout)), layout)])
    return g.select("k", name[F.col("columns")].alias("layout"), "columns", "first_row", "last_width")


def _of_cells(spark: SparkSession, sf_dir: str, out: str, work: Callable[..., list[tuple]], keyed: bool = False) -> DataFrame:
    x = t(spark, sf_dir, "part").select(F.col("p_partkey").cast("long").alias("p_partkey"), F.col("p_size").cast("int").alias("p_size"))
    return _per_row(x, out, work, keyed)


@query("SELECT p_partkey, CAST(1 + p_size % 3 AS INT) AS lines, CASE WHEN p_size % 2 = 0 THEN 30 ELSE 20 END AS first_column, CAST(59 + p_size AS INT) AS last_column, p_size % 2 = 0 AS ruled, CAST(2 * p_size AS INT) AS upscaled FROM part")
def ink_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of ink, their extent, table rules taken out, enlarging."""

    def one(k: int, size: int) -> list[tuple]:
        g = np.full((120, 200), 255, np.uint8)
        left = 30 if size % 2 == 0 else 20
        for i in range(1 + size % 3):
            g[10 + 35 * i : 25 + 35 * i, left : 60 + size] = 0
        if size % 2 == 0:
            g[:, 4:6] = 0
        clean = I.strip_vertical_rules(g)
        span = I.text_span(clean)
        return [(k, len(I.ink_bands(clean)), span[0], span[1], bool((g != clean).any()), I.upscale(g[:size, :4]).shape[0])]

    return _of_cells(spark, sf_dir, "p_partkey long, lines int, first_column int, last_column int, ruled boolean, upscaled int", one)


@query("SELECT p_partkey, concat('a', p_size % 7, ' b', p_size, ' c ', CASE WHEN p_size % 2 = 0 THEN 'd e' ELSE 'e d' END) AS reading, concat('ceda', p_size % 7, 'b', p_size) AS by_middle FROM part")
def reading_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes in the order of reading, and by the middle of their height alone."""

    def one(k: int, size: int) -> list[tuple]:
        box = lambda x, y, h: [[x, y], [x + 9, y], [x + 9, y + h], [x, y + h]]
        d, e = (10, 60) if size % 2 == 0 else (60, 10)
        boxes = [box(90, 42, 10), box(0, 40, 10), box(0, 0, 8), box(d, 3 + 1, 10), box(e, 5 - 2, 10)]
        texts = [f"b{size}", f"a{size % 7}", "c", "d", "e"]
        flip = [(b, s) for b, s in zip(boxes, texts, strict=True)]
        lines = I.reading_order([[[x, 60 - y] for x, y in b] for b, _ in flip[:2]] + [[[x, y + 60] for x, y in b] for b, _ in flip[2:]], texts)
        r = D.Reader(lambda p: "", detect=lambda c: (boxes, texts))
        return [(k, " ".join(lines), r.printed(np.zeros((1, 1), np.uint8), "production"))]

    return _of_cells(spark, sf_dir, "p_partkey long, reading string, by_middle string", one)


@query("SELECT p_partkey, CASE WHEN p_size % 10 >= 1 AND p_size % 10 <= 5 THEN '124x64' END AS crop, CASE WHEN p_size % 10 BETWEEN 1 AND 7 THEN concat(p_size % 10 * 10, 'x20') END AS glyph, CASE WHEN p_size % 10 > 0 THEN substr('ABCD', 1 + p_size % 4, 1) END AS grade FROM part")
def cell_pictures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crops of drawings by their share of ink, the glyph alone, grades of a closed set."""

    def one(k: int, size: int) -> list[tuple]:
        w = size % 10 * 10
        ink = np.full((40, 100), 255, np.uint8)
        ink[:, : int(w * 1.0)] = 0
        glyph = np.full((40, 120), 255, np.uint8)
        glyph[10:30, 5 : 5 + w] = 0
        crop, cut = I.structure_crop(ink), I.isolate_glyph(glyph)
        shape = lambda g: f"{g.shape[1]}x{g.shape[0]}"
        grade = D.Reader(lambda p: "q" if not (p < 128).any() else f" {'abcd'[size % 4]} ").grade(glyph, ("A", "B", "C", "D"))
        return [(k, shape(I.decode(crop)) if crop else None, shape(cut) if cut is not None else None, grade)]

    return _of_cells(spark, sf_dir, "p_partkey long, crop string, glyph string, grade string", one)


@query("SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN 'ab' WHEN p_size % 4 = 1 THEN 'C(=O)' WHEN p_size % 4 = 2 THEN 'C(=O' ELSE 'C(=O)' END AS text, CASE WHEN p_size % 2 = 0 THEN '1 2' ELSE '12' END AS whole, 2 AS line_boxes, CAST(p_size AS VARCHAR) AS number FROM part")
def reader_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Routes over a printed cell, readings of a measured value, a row's number; stand-ins for models come in as functions."""
    cell = np.full((60, 200), 255, np.uint8)
    cell[5:18, 20:120] = 0
    cell[35:48, 20:60] = 0

    def one(size: int) -> list[tuple]:
        first = lambda p: "=O" if p.shape[1] < 150 else "C("
        second = lambda p: "=O)" if p.shape[1] < 150 else "C("
        boxes = lambda c: ([[[0, 30], [9, 30], [9, 39], [0, 39]], [[0, 5], [9, 5], [9, 14], [0, 14]]], ["b", "a"])
        r = D.Reader(first, second, boxes)
        text = r.printed(cell, ("production", "validated_vote", "validated", "padded_vote")[size % 4])
        values = dict((s, (x, n)) for s, x, n in D.Reader(lambda p: "1 2" if size % 2 == 0 else "12").activity(cell))
        number = D.Reader(lambda p: "No.", lambda p: f"Cmpd {size}").identifier(cell, r"\d{1,2}")
        return [(text, values["crop"][0], values["line"][1], number)]

    return _of_cells(spark, sf_dir, "p_partkey long, text string, whole string, line_boxes int, number string", one, True)


@query("SELECT p_partkey, p_size % 3 = 2 AS tabular, CAST(CASE WHEN p_size % 3 = 0 THEN 0 WHEN p_size % 3 = 1 OR p_size % 4 = 0 THEN 1 ELSE 2 + p_size % 4 END AS INT) AS bands FROM part")
def page_likeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How like a table a page is, and its row bands; one line inside divides nothing, on a ruled page, too."""

    def one(size: int) -> list[tuple]:
        g = np.full((300, 200), 255, np.uint8)
        n = size % 4
        if size % 3:
            for i in range(1 + n if size % 3 == 2 else 1):
                g[40 + 50 * i : 42 + 50 * i, :] = 0
        if size % 3 == 2:
            g[:, 50:52] = g[:, 120:122] = 0
        return [(I.table_likeness(g) > 0, len(I.row_bands(g)))]

    return _of_cells(spark, sf_dir, "p_partkey long, tabular boolean, bands int", one, True)


# Drawings.


@query("""WITH n AS (SELECT DISTINCT CAST(12 + p_size % 30 AS INT) AS n FROM part), r AS (SELECT n, n * 1.5 / (24 * sin(pi() / 12)) AS radius FROM n),
k AS (SELECT n, radius, unnest(range(n)) AS k FROM r), a AS (SELECT *, (k + 0.5) / n * 12 AS place FROM k), s AS (SELECT *, floor(place) AS side FROM a),
e AS (SELECT *, radius * cos(pi() / 2 - 2 * pi() * (side % 12) / 12) AS ax, radius * sin(pi() / 2 - 2 * pi() * (side % 12) / 12) AS ay, radius * cos(pi() / 2 - 2 * pi() * ((side + 1) % 12) / 12) AS bx, radius * sin(pi() / 2 - 2 * pi() * ((side + 1) % 12) / 12) AS b2 FROM s),
q AS (SELECT *, ax + (bx - ax) * (place - side) AS px, ay + (b2 - ay) * (place - side) AS py FROM e),
p AS (SELECT n, k, px + CASE WHEN k % 2 = 0 THEN 0.6 ELSE -0.6 END * px / sqrt(px * px + py * py) AS x, py + CASE WHEN k % 2 = 0 THEN 0.6 ELSE -0.6 END * py / sqrt(px * px + py * py) AS y FROM q),
j AS (SELECT p.n, o.x - p.x AS ux, o.y - p.y AS uy, m.x - p.x AS vx, m.y - p.y AS vy FROM p JOIN p o ON o.n = p.n AND o.k = (p.k + p.n - 1) % p.n JOIN p m ON m.n = p.n AND m.k = (p.k + 1) % p.n),
t AS (SELECT n, degrees(acos((ux * vx + uy * vy) / (sqrt(ux * ux + uy * uy) * sqrt(vx * vx + vy * vy)))) AS turn FROM j)
SELECT CAST(n AS BIGINT) AS n, round(avg(turn), 2) AS mean_turn, round(stddev_pop(turn), 2) AS std_turn FROM t GROUP BY 1""")
def polygon_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ring atoms on a polygon, and the angles at them."""
    sizes = t(spark, sf_dir, "part").select((12 + F.col("p_size") % 30).cast("long").alias("n")).distinct()

    def one(n: int) -> list[tuple]:
        got = draw.turns(draw.polygon(n))
        return [(n, got["mean_turn"], got["std_turn"])]

    return _per_row(sizes, "n long, mean_turn double, std_turn double", one)


#: Heavy atoms, and rings, of the five residues of queries_chem.
_RESIDUES = "list_transform(range(1, 7 + p_partkey % 3), lambda i: 1 + (p_partkey * 7 + i * i * 3 + p_size) % 5)"


@query(f"""WITH r AS (SELECT p_partkey, {_RESIDUES} AS r FROM part WHERE p_partkey % 20 = 0), s AS (SELECT p_partkey, list_sum(list_transform(r, lambda x: [5, 8, 12, 7, 4][x])) + 4 AS atoms, len(list_filter(r, lambda x: x IN (3, 4))) + 1 AS rings, len(r) AS n FROM r)
SELECT p_partkey, CAST(atoms AS INT) AS atoms, CAST(atoms + rings - 1 - 1 AS INT) AS bonds, CAST(2 * (n + 1) AS INT) AS marks, true AS opened, concat(p_partkey, '.svg') AS name FROM s""")
def render_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Macrocycles opened at an amide, drawn, and written to files."""
    x = structures(spark, sf_dir).filter("p_partkey % 20 = 0").select("p_partkey", "whole")
    folder = files.workspace(spark)
    done = files.write_each(draw.rendered(x, "p_partkey", "whole", as_svg=True), folder).select("name").distinct()

    def one(s: str) -> list[tuple]:
        got = draw.sketch(s)
        return [(got["atoms"], got["bonds"], got["marks"], got["opened"])]

    made = _per_row(x, "p_partkey long, atoms int, bonds int, marks int, opened boolean", one, True)
    return made.join(done, F.concat(F.col("p_partkey").cast("string"), F.lit(".svg")) == F.col("name"), "left")


# Texts.


@query("""WITH c AS (SELECT p_partkey, unnest(string_split(p_name, '')) AS c, generate_subscripts(string_split(p_name, ''), 1) - 1 AS i FROM part),
v AS (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY md5(concat('7|', i))) AS k FROM c WHERE c IN ('a', 'e', 'o'))
SELECT c.p_partkey, coalesce(string_agg(c.c, '' ORDER BY c.i), '') AS damaged FROM c LEFT JOIN v ON v.p_partkey = c.p_partkey AND v.i = c.i AND v.k <= 2 WHERE v.i IS NULL GROUP BY 1""")
def damaged_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """two of the named characters go, by a seed."""
    from ..functions import text as T

    return t(spark, sf_dir, "part").select("p_partkey", T.damage(F.col("p_name"), "aeo", 2, 7).alias("damaged"))


@query("""SELECT n_nationkey AS k, md5(CASE n_nationkey % 4 WHEN 0 THEN concat(n_name, chr(10), 'delivered copy', chr(10)) WHEN 1 THEN concat(n_name, chr(13), chr(10), 'delivered copy', chr(13), chr(10)) WHEN 2 THEN concat('delivered copy', chr(10), n_name) END) AS text FROM nation""")
def line_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """a wording replaced, line ends as they were; a text with neither wording gives none."""
    from ..functions import text as T

    e = F.expr("CASE k % 4 WHEN 0 THEN concat(n_name, '\\n', 'working copy', '\\n') WHEN 1 THEN concat(n_name, '\\r\\n', 'working copy', '\\r\\n') WHEN 2 THEN concat('delivered copy', '\\n', n_name) ELSE n_name END")
    return _nations(spark, sf_dir).select(F.col("k").cast("long").alias("k"), e.alias("x")).select("k", F.md5(T.substitute(F.col("x"), {"working copy": "delivered copy"})).alias("text"))


@query("SELECT p_partkey, p_name AS joined, substr(p_name, 1, 5) AS first_line, CAST(length(p_name) AS INT) AS partners, CASE WHEN length(p_name) > 3 THEN substr(p_name, 3, 1) END AS third FROM part")
def tiled_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reference cut along the lines that were read, and what was read at each of its places."""

    def one(k: int, s: str) -> list[tuple]:
        lines = [s[:5], s[5:]]
        parts, there = R.tile(s, lines), R.partners(s, s)
        return [(k, "".join(parts), parts[0], len(there), there.get(2) if len(s) > 3 else None)]

    return _per_row(t(spark, sf_dir, "part").select("p_partkey", "p_name"), "p_partkey long, joined string, first_line string, partners int, third string", one)


@query("SELECT p_partkey, CAST(CASE WHEN p_partkey % 2 = 0 THEN 3 ELSE 0 END AS INT) AS even, CAST(CASE WHEN p_partkey % 2 = 0 THEN 1 ELSE 0 END AS INT) AS valid FROM part")
def flip_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brackets whose flip evens out a text, and those that make it valid."""
    x = t(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_partkey") % 2 == 0, "N]C@@H](C)C(=O)O[NH3+]").otherwise("N[C@@H](C)C(=O)O").alias("s"))

    def one(k: int, s: str) -> list[tuple]:
        even, valid = R.flips(s)
        return [(k, len(even), len(valid))]

    return _per_row(x, "p_partkey long, even int, valid int", one)


@query("""WITH m AS (SELECT p_partkey, p_size AS c, p_partkey % 7 AS n, ['[M+H]+', '[M+2H]2+', '[M+Na]+'][1 + p_partkey % 3] AS ion FROM part),
i AS (SELECT *, CASE ion WHEN '[M+Na]+' THEN 22.98976928 ELSE 1.007276466 END::DOUBLE AS d, CASE ion WHEN '[M+2H]2+' THEN 2 ELSE 1 END AS z FROM m)
SELECT p_partkey, round((c * 12.0 + (2 * c + 1) * 1.0078250319 + n * 14.0030740048 + z * d) / z, 5) AS mono, round((c * 12.0 + (2 * c + 1) * 1.0 + n * 14.0 + z * d) / z, 5) AS rounded, round((c * 12.011 + (2 * c + 1) * 1.008 + n * 14.007 + z * d) / z, 5) AS average FROM i""")
def ion_masses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An ion's mass by three tables."""
    from ..functions import mass as X

    x = t(spark, sf_dir, "part").select("p_partkey", F.expr("map('C', cast(p_size as int), 'H', cast(2 * p_size + 1 as int), 'N', cast(p_partkey % 7 as int))").alias("m"), F.expr("element_at(array('[M+H]+', '[M+2H]2+', '[M+Na]+'), cast(1 + p_partkey % 3 as int))").alias("label"))
    x = x.withColumn("ion", X.polarity(F.col("label"))).select("p_partkey", X.masses(F.col("m"), F.col("ion")).alias("s"))
    return x.select("p_partkey", *[F.round(f"s.{c}", 5).alias(c) for c in ("mono", "rounded", "average")])


@query("SELECT vec_id, true AS equal FROM embeddings WHERE vec_id % 10 = 0")
def ctc_brute_force(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The forward recursion equals the sum over all alignments."""
    from ..operators import ctc

    def one(k: int, e: list) -> list[tuple]:
        p = np.exp(4 * np.array(e[:15], float).reshape(5, 3))
        p /= p.sum(1, keepdims=True)
        return [(k, all(abs(ctc.log_likelihood(p, x) - ctc.brute_force_likelihood(p, x)) < 1e-9 for x in ((), (1,), (1, 2), (2, 2))))]

    x = t(spark, sf_dir, "embeddings").filter("vec_id % 10 = 0").select("vec_id", F.transform("embedding", lambda v: v.cast("double")).alias("e"))
    return _per_row(x, "vec_id long, equal boolean", one)


# Streams.


@query("""WITH r AS (SELECT o_custkey % 5 AS layout, o_orderkey AS pos, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(o_orderkey AS VARCHAR) END AS id, o_orderstatus AS x FROM orders WHERE o_orderkey <= 4000),
i AS (SELECT *, count(id) OVER (PARTITION BY layout ORDER BY pos ROWS UNBOUNDED PRECEDING) AS isle, count(id) OVER (PARTITION BY layout) AS last FROM r)
SELECT CAST(layout AS VARCHAR) AS layout, max(id) AS id, string_agg(x, '' ORDER BY pos) AS text, CAST(count(*) AS INT) AS parts FROM i WHERE isle BETWEEN 1 AND last - 1 GROUP BY layout, isle""")
def continued_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that go on, as a stream with the open row of each layout as state; what is still open is not given out."""
    base = files.workspace(spark)
    o = t(spark, sf_dir, "orders").filter("o_orderkey <= 4000").select((F.col("o_custkey") % 5).cast("string").alias("layout"), F.col("o_orderkey").cast("int").alias("pos"), F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderkey").cast("string")).alias("id"), F.col("o_orderstatus").alias("text"))
    for i in range(2):  # two deliveries of pages, one after the other
        o.filter(F.col("pos") <= 2000 if i == 0 else F.col("pos") > 2000).coalesce(1).write.mode("append").parquet(f"{base}/in")
        q = pending.continued_rows(spark.readStream.schema(o.schema).parquet(f"{base}/in")).writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start()
        q.awaitTermination()
    return spark.read.schema(pending.OUT).parquet(f"{base}/out")


@query("SELECT n_nationkey AS k, upper(n_name) AS out FROM nation")
def cache_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4: a cache filled from a stream; the second run finds all entries there."""
    base = files.workspace(spark)
    n = t(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k"), "n_name")
    n.write.parquet(f"{base}/in")
    for i in range(2):
        w = pending.fill_cache(spark.readStream.schema(n.schema).parquet(f"{base}/in"), "k", f"{base}/cache", f"{base}/state{i}", lambda df: df.select("k", F.upper("n_name").alias("out")))
        w.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{base}/cache")
