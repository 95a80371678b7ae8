"""The folder that driver and executors share, and tables written there to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession


#: Bytes of a row group: what a task holds while it writes.
ROW_GROUP = 16 << 20


def shared_dir(spark: SparkSession) -> str:
    """A new folder name under ``spark.checkpoint.dir``. Where the setting is absent on a single machine (tests), a
    folder of this process is made and set as checkpoint directory; on a cluster its absence is an error."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("quillgrid.shared.dir", None)
    if not base:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="quillgrid-")
        spark.conf.set("quillgrid.shared.dir", base)
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/quillgrid-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str = "table") -> DataFrame:
    """``df`` written to the shared folder and read again: later stages don't depend on executors' local files."""
    path = f"{shared_dir(df.sparkSession)}/{name}"
    df.write.option("parquet.block.size", ROW_GROUP).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(scan: DataFrame) -> DataFrame:
    """A table just read, dealt out to all cores if its files make fewer partitions than there are cores. Large tables stay as they are."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


def _local(uri: str) -> str | None:
    if uri.startswith("file:"):
        return "/" + uri[5:].lstrip("/")
    return uri if uri.startswith("/") else None


def put(uri: str, data: bytes | memoryview) -> None:
    """Write a file whole: under another name first, so a task that dies or runs twice leaves no half file."""
    path = _local(uri)
    if path:
        os.makedirs(os.path.dirname(path), exist_ok=True)
        part = f"{path}.{uuid.uuid4().hex}.part"
        with open(part, "wb") as f:
            f.write(data)
        os.replace(part, path)
        return
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri)
    store.create_dir(os.path.dirname(path), recursive=True)
    part = f"{path}.{uuid.uuid4().hex}.part"
    with store.open_output_stream(part) as f:
        f.write(data)
    store.move(part, path)


def mapped(uri: str) -> np.ndarray:
    """The file's bytes, memory-mapped. A file of a remote store is fetched first and unlinked at once, so nothing stays behind."""
    path = _local(uri)
    if path:
        return np.memmap(path, np.uint8, "r") if os.path.getsize(path) else np.zeros(0, np.uint8)
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri)
    with tempfile.NamedTemporaryFile() as own:
        with store.open_input_stream(path) as f:
            while block := f.read(1 << 22):
                own.write(block)
        own.flush()
        return np.memmap(own.name, np.uint8, "r") if own.tell() else np.zeros(0, np.uint8)
