"""From page images to records: cells cut along ruled lines, read by readers, put together by layout."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import imaging as I
from ..operators import ordered, readings
from ..operators.readers import snap, widen_last
from . import policy
from .profiles import Family, layout_by_count, pick_layout

CELL = "path string, table int, row int, column int, n_columns int, y int, png binary, error string"
READING = "path string, table int, row int, column int, n_columns int, source string, pos int, text string, n_boxes int, error string"
#: A reader gives texts with the number of boxes it took: ink-band lines, whole crop, and two detectors.
Reader = Callable[[np.ndarray], list[tuple[str, str, int]]]


# A heading's least height and share of a page, where a page's body begins, edges that count no column, least height of a first row.
HEAD_LEAST, HEAD_SHARE, BODY_FROM, EDGE, FIRST_ROW = 40, 0.12, 0.15, 50, 50


def _inner(grey: np.ndarray, share: float) -> list[int]:
    """Vertical rules that span more than a share of a picture, without those at its sides."""
    return [x for x in I.vertical_lines(grey, share) if EDGE < x < grey.shape[1] - EDGE]


def _columns(grey: np.ndarray, family: Family, layout: str) -> list[tuple[int, int]]:
    """A layout's columns in pixels: its fractions, drawn to rules near by; a text column at the end reaches the rule that closes the table."""
    w, body = grey.shape[1], grey[int(grey.shape[0] * BODY_FROM) :]
    spec = family.columns(layout)
    out = snap([(int(w * a), int(w * b)) for _, _, (a, b) in spec], _inner(body, 0.4))
    return widen_last(out, I.vertical_lines(body, 0.4), w) if spec[-1][0] == "smiles" else out


def _of_image(grey: np.ndarray, family: Family, fields: set[str]) -> Iterator[tuple]:
    """Cells of an image that is one table: (0, row, column, columns, y, picture). The layout is the one that the heading tells, else the one
    of as many columns as rules divide, else the family's default. A first row divided in another way has a layout of its own."""
    if min(grey.shape) < HEAD_LEAST:
        return
    count = len(_inner(grey[int(grey.shape[0] * BODY_FROM) :], 0.5)) + 1
    layout = family.by_fields(fields) or family.by_count(count) or family.setting("default")
    bands, spans = I.row_bands(grey), _columns(grey, family, layout)
    for r, (top, bottom) in enumerate(bands):
        own = spans
        if r == 0 and len(bands) > 1 and bottom - top >= FIRST_ROW:
            inner = _inner(grey[top:bottom], 0.4)
            other = family.by_count(len(inner) + 1) if inner else None
            if other and other != layout:
                own = [(int(grey.shape[1] * a), int(grey.shape[1] * b)) for _, _, (a, b) in family.columns(other)]
        for c, (left, right) in enumerate(own):
            yield 0, r, c, len(own), top, grey[top:bottom, left:right]


def _of_page(grey: np.ndarray, run: int, line: int) -> Iterator[tuple]:
    """Cells of the ruled tables of a full page."""
    for k, t in enumerate(I.locate_tables(grey, 2, run, line)):
        for r, (top, bottom) in enumerate(t.bands()):
            for c, (left, right) in enumerate(zip(t.columns, t.columns[1:], strict=False)):
                yield k, r, c, len(t.columns) - 1, t.y1 + top, I.strip_vertical_rules(grey[t.y1 + top + 2 : t.y1 + bottom, t.x1 + left + 2 : t.x1 + right])


def cells(images: DataFrame, decoder: Callable[[bytes], np.ndarray] = I.decode, run: int = I.LONG_RUN, line: int = I.LONG_LINE, family: Family | None = None, heading: Callable[[], Callable[[np.ndarray], list[str]]] | None = None) -> DataFrame:
    """One row for each cell of each image (path, content), its picture as PNG. An image that fails gives one row with the error.

    Images of a family whose input is ``table_image`` are one table each, cut by the family's layouts; ``heading`` builds a model that reads
    the texts of a heading, once for each task. All others are pages, whose ruled tables are located first.
    """
    names = [x.split(" ")[0] for x in CELL.split(", ")]
    kinds = [pa.string(), *[pa.int32()] * 5, pa.binary(), pa.string()]
    whole = family is not None and family.setting("input") == "table_image"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = None
        for b in batches:
            for path, content in zip(b.column("path").to_pylist(), b.column("content").to_pylist(), strict=True):
                try:
                    grey, fields = decoder(content), set()
                    if whole and heading:
                        model = model or heading()
                        fields = {f for x in model(I.upscale(grey[: max(HEAD_LEAST, int(grey.shape[0] * HEAD_SHARE))])) if (f := T.field_named(x))}
                    found = _of_image(grey, family, fields) if whole else _of_page(grey, run, line)
                    out = [(path, *x[:5], I.encode_png(x[5]), None) for x in found if x[5].size]
                except Exception as e:  # one bad page must not end the scan
                    out = [(path, None, None, None, None, None, None, f"{type(e).__name__}: {e}")]
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], kind) for i, kind in enumerate(kinds)], names=names)

    return images.select("path", "content").mapInArrow(work, CELL)


def read(cell_rows: DataFrame, reader: Callable[[], Reader]) -> DataFrame:
    """All readings of each cell. ``reader`` builds the model, once for each task."""
    names = [x.split(" ")[0] for x in READING.split(", ")]
    kinds = [pa.string(), *[pa.int32()] * 4, pa.string(), pa.int32(), pa.string(), pa.int32(), pa.string()]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = None
        for b in batches:
            out = []
            for path, table, row, column, n, png in zip(*(b.column(c).to_pylist() for c in ("path", "table", "row", "column", "n_columns", "png")), strict=True):
                where = (path, table, row, column, n)
                try:
                    model = model or reader()
                    out += [(*where, s, i, t, k, None) for i, (s, t, k) in enumerate(model(I.decode(png)))]
                except Exception as e:
                    out.append((*where, "none", 0, None, 0, f"{type(e).__name__}: {e}"))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], kind) for i, kind in enumerate(kinds)], names=names)

    return cell_rows.filter("png IS NOT NULL").mapInArrow(work, READING)


def _column(family: Family, layout: Column, at: Column) -> Column:
    """Name of a layout's column by its place."""
    pairs = [F.lit(x) for name in family.layouts for i, c in enumerate(family.columns(name)) for x in (f"{name}/{i}", c[0])]
    return F.try_element_at(F.create_map(*pairs), F.concat_ws("/", layout, at.cast("string")))


def layouts_of(x: DataFrame, family: Family) -> DataFrame:
    """path, table, n_columns, layout. A table's layout: what its first row's texts tell as headings, if it has so many columns; else that of
    its number of columns; else that of the table before in its folder; else the default. x: path, table, row, n_columns, text."""
    heads = F.collect_set(F.when(F.col("row") == 0, T.canonical_field(F.col("text"))))
    tables = x.groupBy("path", "table", "n_columns").agg(F.min("row").alias("first"), heads.alias("fields"))
    told = pick_layout(F.col("fields"), family.wanted())
    size = F.try_element_at(F.create_map(*[F.lit(v) for name in family.layouts for v in (name, len(family.columns(name)))]), told)
    tables = tables.withColumn("own", F.coalesce(F.when(size == F.col("n_columns"), told), layout_by_count(F.col("n_columns"), family)))
    tables = ordered.carry_forward(tables.withColumn("folder", _folder("path")), ["folder"], ["path", "table", "first"], "own", "before")
    return tables.select("path", "table", "n_columns", F.coalesce("own", "before", F.lit(family.setting("default"))).alias("layout"))


def _folder(path: str) -> Column:
    """A document's pages lie in one folder; order over pages matters inside it alone."""
    return F.regexp_replace(path, "[^/]*$", "")


def records(all_readings: DataFrame, family: Family) -> tuple[DataFrame, DataFrame]:
    """(compounds, assays) of readings: one value for each cell by agreement, a layout for each table (see layouts_of),
    heading rows left out, rows without a number joined to the row before in their folder and layout."""
    r = all_readings.withColumn("cell", F.concat_ws("\x01", "path", "table", "row", "column"))
    places = r.groupBy("cell").agg(*[F.first(c).alias(c) for c in ("path", "table", "row", "column", "n_columns")])
    value = readings.agreeing_group(r.select("cell", "source", "text", "n_boxes", "pos"), "cell", F.lit(False)).select("cell", "text")
    x = places.join(value, "cell", "left").drop("cell")
    tables = layouts_of(x, family).withColumnsRenamed({"path": "_p", "table": "_t", "n_columns": "_n"})
    x = x.join(tables, (F.col("path") == F.col("_p")) & (F.col("table") == F.col("_t")) & (F.col("n_columns") == F.col("_n"))).drop("_p", "_t", "_n")
    heads = F.create_map(*[F.lit(v) for name in family.layouts for v in (name, family.headings(name))])
    x = x.filter(F.col("row") >= F.element_at(heads, F.col("layout"))).withColumn("name", _column(family, F.col("layout"), F.col("column")))
    names = sorted({c[0] for name in family.layouts for c in family.columns(name)})
    wide = x.groupBy("path", "table", "row", "layout").pivot("name", names).agg(F.first("text"))
    number = T.strip(F.coalesce(F.col("cmpd_id"), F.lit("")))
    wide = wide.withColumn("cmpd_id", F.when(number.rlike(f"^(?:{family.setting('number')})$"), number)).withColumn("_folder", _folder("path"))
    goes_on = [name for name in family.layouts if family.goes_on(name)]
    w = Window.partitionBy("_folder", "layout").orderBy("path", "table", "row")
    isle = F.count("cmpd_id").over(w.rowsBetween(Window.unboundedPreceding, 0))
    joined = wide.withColumn("_isle", F.when(F.col("layout").isin(*goes_on), isle).when(F.col("cmpd_id").isNotNull(), isle)).filter("_isle > 0")
    texts = [n for n in names if n not in ("cmpd_id", "structure")]
    first = {n: F.first(n, ignorenulls=True) for n in texts if n != "smiles"}
    aggs = [F.max("cmpd_id").alias("cmpd_id"), F.min(F.struct("path", "table", "row")).alias("_at"), *[a.alias(n) for n, a in first.items()]]
    if "smiles" in texts:
        aggs.append(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("path", "table", "row", F.coalesce("smiles", F.lit("")).alias("s")))), lambda p: p["s"]), "").alias("smiles"))
    rows = joined.groupBy("_folder", "layout", "_isle").agg(*aggs).select("*", F.col("_at.path").alias("source_image"), F.struct("_at.table", "_at.row").alias("pos")).drop("_at", "_isle", "_folder")
    comp = rows.filter(T.strip(F.coalesce(F.col("smiles"), F.lit(""))) != "").select("cmpd_id", "smiles", "source_image", F.col("source_image").alias("page"), "pos") if "smiles" in texts else rows.limit(0)
    assay_cols = []
    for field, how in family.readers().items():
        c = F.col(field) if field in texts else F.lit(None).cast("string")
        if how == "number":
            c = T.parse_number(c, spaces=True)
        elif how.startswith("["):
            c = readings.closed_set(F.array(c), tuple(how.strip("[]")))
        assay_cols.append(c.alias(field))
    a = rows.select("cmpd_id", *assay_cols, "source_image", F.col("source_image").alias("page"), "pos")
    some = F.lit(False)
    for n in family.words("opens"):
        some = some | F.col(n).isNotNull()
    return comp, a.filter(some)


def run_model(work: DataFrame, key: str, cache: DataFrame, model: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(results of all, results that are new): a model runs only on keys that no cache entry has."""
    fresh = model(work.join(cache.select(key), key, "left_anti"))
    return cache.join(work.select(key), key, "left_semi").unionByName(fresh, allowMissingColumns=True), fresh


def model_columns(predicted: DataFrame, unsure: float = 0.5) -> DataFrame:
    """Cache entries of predictions (cmpd_id, smiles, tokens: array of struct(token, p)): raw, cleaned, canon, min_conf, low_conf.

    cleaned: the largest fragment of a text that parses, else the text with its brackets closed, else the text. canon: what the parser
    makes of it. min_conf: the least probability of a token, to 4 places; low_conf: tokens below ``unsure``; both null without tokens.
    Predictions without a text are none.
    """
    x = predicted.filter(~T.blank(F.col("smiles")))
    x = policy.with_largest_fragment(x, "smiles", "_part")
    x = x.withColumn("cleaned", F.coalesce("_part", T.close_brackets(F.col("smiles")), "smiles")).drop("_part")
    x = policy.with_fingerprint(x, "cleaned", "_fp")
    some = F.size("tokens") > 0
    low = F.size(F.filter("tokens", lambda t: t["p"] < unsure))
    return x.select("cmpd_id", F.col("smiles").alias("raw"), "cleaned", F.coalesce("_fp.canonical", F.lit("")).alias("canon"), F.when(some, F.round(F.array_min(F.transform("tokens", lambda t: t["p"])), 4)).alias("min_conf"), F.when(some, low).alias("low_conf"))


def model_stage(structures: DataFrame, cache: DataFrame, model: Callable[[DataFrame], DataFrame], unsure: float = 0.5) -> tuple[DataFrame, DataFrame]:
    """The model's columns for all structures (cmpd_id, ...), and the entries that are new and to be appended to the cache.

    ``cache``: cmpd_id, raw, cleaned, canon, min_conf, low_conf. ``model`` gives cmpd_id, smiles, tokens for rows without an entry.
    """
    both, fresh = run_model(structures, "cmpd_id", cache, lambda todo: model_columns(model(todo), unsure))
    names = {"raw": "smiles_decimer", "canon": "canonical_smiles_decimer", "min_conf": "decimer_min_conf", "low_conf": "decimer_low_conf_count"}
    return both.select("cmpd_id", *[F.col(k).alias(v) for k, v in names.items()]), fresh


def reuse_columns(rows: DataFrame, earlier: DataFrame, columns: tuple[str, ...] = ("smiles_decimer", "canonical_smiles_decimer", "decimer_min_conf", "decimer_low_conf_count", "decimer_render_path"), key: str = "cmpd_id") -> DataFrame:
    """``rows`` with the model's columns of an earlier delivery, by id; its last row of an id counts, ids without one get empty texts."""
    there = [c for c in columns if c in earlier.columns]
    old = earlier.filter(~T.blank(F.col(key))).withColumn("_pos", F.monotonically_increasing_id())
    old = old.groupBy(F.col(key).alias("_key")).agg(F.max_by(F.struct(*there), "_pos").alias("_old"))
    out = rows.drop(*columns).join(old, F.col(key) == F.col("_key"), "left")
    return out.select(*[c for c in rows.columns if c not in columns], *[(F.coalesce(F.col(f"_old.{c}").cast("string"), F.lit("")) if c in there else F.lit("")).alias(c) for c in columns])
