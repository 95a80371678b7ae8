"""Sources and sinks: images, CSV with a byte-order mark, versioned caches, audit reports, file inventories."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from functools import reduce

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as X
from ..operators.records import last_of_each
from ..plans import schema

CACHE_VERSION = 2
# Fixed value: the name under which a delivered table is written while an editor locks it.
LOCKED_NAME = "compounds_combined.new.csv"
MARK = "\ufeff"


def images(spark: SparkSession, folder: str, patterns: Iterable[str], decode: bool = False) -> DataFrame:
    """path, name, content, length of the files of a folder that match any pattern, each name once, in order of name.

    With ``decode``, Spark's own image source reads the pictures (JPEG, TIFF, PNG, BMP and what else the Java runtime knows), and the content is their pixels
    behind a heading that operators.imaging.decode knows; a file that is no picture has no pixels, so that decoding it fails there."""
    parts = []
    for p in patterns:
        if decode:
            i = spark.read.format("image").option("pathGlobFilter", p).option("dropInvalid", "false").load(folder).select("image.*")
            head = F.concat(F.lit("Q"), *[x for c in ("nChannels", "width", "height") for x in (F.lit(" "), F.col(c).cast("string"))], F.lit("\n"))
            parts.append(i.select(F.col("origin").alias("path"), F.concat(F.encode(head, "utf-8"), F.col("data")).alias("content"), F.length("data").cast("long").alias("length")))
        else:
            parts.append(spark.read.format("binaryFile").option("pathGlobFilter", p).load(folder).select("path", "content", "length"))
    x = reduce(DataFrame.unionByName, parts).select("path", F.element_at(F.split("path", "/"), -1).alias("name"), "content", "length")
    return x.dropDuplicates(["name"]).orderBy("name")


def read_csv(spark: SparkSession, path: str, keep_blank: bool = True) -> DataFrame:
    """All columns as text. Blank cells are empty text, or null where ``keep_blank`` is off. A byte-order mark is dropped."""
    x = spark.read.csv(path, header=True, multiLine=True, escape='"')
    x = x.toDF(*[c.lstrip(MARK) for c in x.columns])
    return x.fillna("") if keep_blank else x


def write_csv(df: DataFrame, path: str, columns: Iterable[str], single: bool = False, mark: bool = False) -> int:
    """The named columns as text, missing ones empty, others left out; returns the number of rows. ``single`` makes one file, for tables
    meant to be opened by hand; ``mark`` puts a byte-order mark before the heading of each file."""
    x = schema.as_text(df, columns)
    if mark:
        x = x.withColumnRenamed(x.columns[0], MARK + x.columns[0])
    seen = Observation()
    x = x.observe(seen, F.count(F.lit(1)).alias("n"))
    (x.coalesce(1) if single else x).write.mode("overwrite").csv(path, header=True, emptyValue="", nullValue="", escape='"')
    return seen.get["n"]


def writable_target(path: str, other: str = LOCKED_NAME) -> str:
    """``path`` if it is not there yet or can be written to, else ``other`` beside it: an editor may hold a lock on a delivered file."""
    if not os.path.exists(path):
        return path
    try:
        with open(path, "r+b"):
            return path
    except PermissionError:
        return os.path.join(os.path.dirname(path), other)


def policy_target(path: str, in_place: bool = False) -> str:
    """Where a table with its policy columns goes: beside the table, as ``<name>.policy.csv``, or over it."""
    return path if in_place else f"{path.removesuffix('.csv')}.policy.csv"


def write_cells(df: DataFrame, folder: str, route: str, as_json: bool = False) -> int:
    """Texts of cells (key, text) as CSV of cell, route, length, smiles, and as JSON lines of the same; returns the number of rows."""
    x = df.select(F.col("key").alias("cell"), F.lit(route).alias("route"), F.length(F.coalesce("text", F.lit(""))).alias("length"), F.coalesce("text", F.lit("")).alias("smiles"))
    if as_json:
        x.write.mode("overwrite").json(f"{folder}/json")
    return write_csv(x, f"{folder}/csv", x.columns)


def kept(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read again, before the files that it comes from are written over."""
    path = f"{workspace(df.sparkSession)}/kept"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_each(df: DataFrame, folder: str) -> DataFrame:
    """Writes each row's ``content`` to a file ``name`` of a folder that driver and executors share; rows (name, path). A file is written
    whole under another name first, so a task that runs again leaves no half file. The result is to be used: it is what does the work."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names = b.column("name").to_pylist()
            paths = [put(f"{folder.rstrip('/')}/{n}", c) for n, c in zip(names, b.column("content").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(paths, pa.string())], names=["name", "path"])

    return df.select("name", "content").mapInArrow(work, "name string, path string")


def put(uri: str, data: bytes) -> str:
    """One file, on a local path or in a store."""
    store, path = fs.FileSystem.from_uri(uri if ":" in uri else f"file://{uri}")
    store.create_dir(os.path.dirname(path), recursive=True)
    part = f"{path}.{uuid.uuid4().hex}.part"
    with store.open_output_stream(part) as f:
        f.write(data)
    store.move(part, path)
    return uri


def workspace(spark: SparkSession) -> str:
    """A new folder under ``spark.checkpoint.dir``, which driver and executors share; on a single machine without that setting a temporary one."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = f"file://{tempfile.mkdtemp(prefix='quillgrid-files-')}"
    return f"{base.rstrip('/')}/files-{uuid.uuid4().hex}"


def reload_records(spark: SparkSession, compounds: str, assays: str, extras: tuple[str, ...] = (), images_known: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Records of two CSV files with their types back. The last of several rows of an id counts; an image path that no listing has is dropped."""
    c = read_csv(spark, compounds, keep_blank=False).withColumn("_pos", F.monotonically_increasing_id())
    a = read_csv(spark, assays, keep_blank=False).withColumn("_pos", F.monotonically_increasing_id())
    none = lambda df: df.select(*[F.when(~F.col(x).isin("", "None"), F.col(x)).alias(x) if k == "string" else F.col(x) for x, k in df.dtypes])
    c, a = none(c), none(a)
    for df, name in ((c, "molecular_weight"), (c, "ocr_avg_entropy"), (c, "ocr_min_top1")):
        if name in df.columns:
            c = c.withColumn(name, X.parse_number(F.col(name)))
    for name in ("heavy_atom_count", "ocr_low_conf_count"):
        if name in c.columns:
            c = c.withColumn(name, F.col(name).try_cast("int"))
    if "is_valid" in c.columns:
        c = c.withColumn("is_valid", F.when(F.col("is_valid").isNotNull(), F.lower("is_valid") == "true"))
    if images_known is not None and "structure_image" in c.columns:
        known = images_known.select(F.col("name").alias("_known")).distinct()
        c = c.join(known, F.element_at(F.split("structure_image", "/"), -1) == F.col("_known"), "left").withColumn("structure_image", F.when(F.col("_known").isNotNull(), F.col("structure_image"))).drop("_known")
    for name in ("kd_nm", "rt_min", "ms_mz"):
        if name in a.columns:
            a = a.withColumn(name, X.parse_number(F.col(name)))
    there = [e for e in extras if e in a.columns]
    if there:
        pairs = F.map_from_entries(F.array(*[F.struct(F.lit(e), F.col(e)) for e in there]))
        a = a.withColumn("extra", F.map_filter(pairs, lambda k, v: v.isNotNull())).drop(*there)
    return last_of_each(c, ["cmpd_id"], "_pos").drop("_pos"), last_of_each(a, ["cmpd_id"], "_pos").drop("_pos")


MODEL_ENTRY = "struct<smiles:string,canonical:string,min_conf:double,low_conf:int,render:string>"


def read_cache(spark: SparkSession, path: str, version: int = CACHE_VERSION) -> DataFrame:
    """cmpd_id and entry of a JSON cache; another version or a file that is no JSON gives no rows."""
    raw = spark.read.text(path, wholetext=True).select(F.from_json("value", f"__version__ int, entries map<string,{MODEL_ENTRY}>").alias("c"))
    return raw.filter(F.col("c.__version__") == version).select(F.explode("c.entries").alias("cmpd_id", "entry")).select("cmpd_id", "entry.*")


def append_cache(df: DataFrame, path: str) -> None:
    """New model results go to a Parquet cache; each call is one atomic append."""
    df.write.mode("append").parquet(path)


def write_audit(df: DataFrame, path: str) -> None:
    """An audit as JSON lines and as CSV."""
    df.write.mode("overwrite").json(f"{path}/json")
    flat = [F.concat_ws("; ", c).alias(c) if k.startswith("array") else F.col(c) for c, k in df.dtypes if not k.startswith(("struct", "map"))]
    df.select(*flat).write.mode("overwrite").csv(f"{path}/csv", header=True, emptyValue="")


def inventory(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """path below the folder and sha256 of each file."""
    x = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder)
    root = folder.rstrip("/").split(":", 1)[-1].lstrip("/")
    return x.select(F.regexp_replace("path", r"^file:/+\Q" + root + r"\E/", "").alias("path"), F.sha2("content", 256).alias("sha256"))


def compare_trees(source: DataFrame, copy: DataFrame) -> DataFrame:
    """path, state: same, differ or missing for each file of a source inventory."""
    b = copy.select(F.col("path").alias("_p"), F.col("sha256").alias("_s"))
    state = F.when(F.col("_s").isNull(), "missing").when(F.col("_s") == F.col("sha256"), "same").otherwise("differ")
    return source.join(b, F.col("path") == F.col("_p"), "left").select("path", state.alias("state"))


RECORDED = T.StructType([T.StructField("cell_id", T.StringType()), T.StructField("source", T.StringType()), T.StructField("text", T.StringType()), T.StructField("n_boxes", T.IntegerType()), T.StructField("pos", T.IntegerType())])


def recorded_readings(spark: SparkSession, path: str) -> DataFrame:
    """Readings recorded earlier, instead of a model's."""
    return spark.read.schema(RECORDED).parquet(path)
