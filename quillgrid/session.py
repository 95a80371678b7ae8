"""Session defaults, and the package's own code for Python workers."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

#: Settings the engine is tuned for; a cluster's own values win where they are set.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(master: str = "local[*]", name: str = "quillgrid", **conf: str) -> SparkSession:
    b = SparkSession.builder.master(master).appName(name)
    for k, v in (DEFAULTS | conf).items():
        b = b.config(k, v)
    return b.getOrCreate()


#: Rows of texts are long, so fewer go to a Python worker at once than Spark's default of 10,000.
ARROW_ROWS = ("spark.sql.execution.arrow.maxRecordsPerBatch", "10000", "2000")


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once for each Spark context; make Arrow batches smaller unless they are set."""
    sc = spark.sparkContext
    key, default, ours = ARROW_ROWS
    if spark.conf.get(key) == default:
        spark.conf.set(key, ours)
    if getattr(sc, "_quillgrid_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="quillgrid-code-")
    path = os.path.join(folder, "quillgrid_code.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for at, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(at, f)
                    z.write(full, os.path.join("quillgrid", os.path.relpath(full, root)))
    sc.addPyFile(path)
    sc._quillgrid_shipped = True
