"""Rows that continue over pages, as a stream, and caches filled batch by batch."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

OUT = "layout string, id string, text string, parts int"
STATE = "id string, text string, parts int"


def continued_rows(stream: DataFrame, layout: str = "layout", order: str = "pos", id_col: str = "id", text: str = "text", flush_ms: int = 0) -> DataFrame:
    """Rows without an id add their text to the open row of their layout; the next numbered row closes it.

    The state of a layout is its open row only. Rows of one layout in one batch are taken in order; batches are to
    arrive in order of pages. With ``flush_ms`` an open row is given out after so long without news, as at the end of a
    document. In batch, operators.ordered.continued_rows gives the same rows, and those still open.
    """

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            i, t, n = state.get
            state.remove()
            yield pd.DataFrame([(key[0], i, t, n)], columns=["layout", "id", "text", "parts"])
            return
        open_row = list(state.get) if state.exists else None
        rows = pd.concat(list(frames)).sort_values(order)
        done = []
        for i, t in zip(rows[id_col], rows[text], strict=True):
            if i is not None and i == i:
                if open_row:
                    done.append((key[0], *open_row))
                open_row = [str(i), t or "", 1]
            elif open_row:
                open_row = [open_row[0], open_row[1] + (t or ""), open_row[2] + 1]
        if open_row:
            state.update(tuple(open_row))
            if flush_ms:
                state.setTimeoutDuration(flush_ms)
        yield pd.DataFrame(done, columns=["layout", "id", "text", "parts"])

    wait = GroupStateTimeout.ProcessingTimeTimeout if flush_ms else GroupStateTimeout.NoTimeout
    return stream.groupBy(layout).applyInPandasWithState(step, OUT, STATE, "append", wait)


def fill_cache(stream: DataFrame, key: str, cache_path: str, checkpoint: str, model: Callable[[DataFrame], DataFrame]):
    """Runs a model on what no cache entry has, batch by batch, and appends its results. A batch that comes again finds its entries there."""

    def batch(df: DataFrame, _: int) -> None:
        spark = df.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(cache_path)
        work = df.dropDuplicates([key])
        if path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            work = work.join(spark.read.parquet(cache_path).select(key), key, "left_anti")
        model(work).write.mode("append").parquet(cache_path)

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)


def windowed_counts(stream: DataFrame, at: str, late: str, width: str, keys: list[str]) -> DataFrame:
    """Rows in tumbling windows, given out once no later row may come."""
    from pyspark.sql import functions as F

    return stream.withWatermark(at, late).groupBy(F.window(at, width).alias("window"), *keys).count()
