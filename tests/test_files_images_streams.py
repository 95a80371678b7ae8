"""Sources, sinks, image operators and streams."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillgrid.operators import imaging as I
from quillgrid.plans import extract, schema
from quillgrid.plans.profiles import profile
from quillgrid.sources import files
from quillgrid.streaming import pending


def page():
    g = np.full((400, 600), 255, np.uint8)
    for y in (50, 120, 190, 260):
        g[y : y + 2, 30:570] = 0
    for x in (40, 200, 400, 550):
        g[50:262, x : x + 2] = 0
    g[70:90, 220:260] = 0
    return g


def test_png_round_trip():
    g = np.random.default_rng(1).integers(0, 256, (13, 17)).astype(np.uint8)
    assert (I.decode(I.encode_png(g)) == g).all()
    assert (I.decode(b"P5 17 13 255\n" + g.tobytes()) == g).all()
    with pytest.raises(ValueError):
        I.decode(b"no image")


def test_rules_and_tables():
    assert I.horizontal_rules(page(), 300, 300) == [50, 120, 190, 260]
    t = I.locate_tables(page(), 2, 300, 300)
    assert len(t) == 1 and t[0].columns == (0, 160, 360, 510) and t[0].rows == (0, 70, 140, 210) and t[0].bands() == [(0, 70), (70, 140), (140, 210)]
    assert I.locate_tables(np.full((50, 50), 255, np.uint8)) == []
    assert len(I.row_bands(page())) == 5
    assert I.table_likeness(page()) > 0 == I.table_likeness(np.full((90, 90), 255, np.uint8))


def test_cells():
    g = np.full((40, 120), 255, np.uint8)
    g[10:25, 30:80] = 0
    assert I.ink_bands(g) == [(10, 24)]
    g[:, 5:7] = 0
    assert I.text_span(g) == (30, 79)
    assert I.strip_vertical_rules(g)[0, 5] == 255 and I.strip_vertical_rules(g)[12, 40] == 0
    g[30] = 0
    assert (I.strip_horizontal_rules(g)[30] == 255).all()
    assert I.isolate_glyph(g[:28]).shape == (15, 50)
    assert I.isolate_glyph(np.full((5, 5), 255, np.uint8)) is None
    crop = I.structure_crop(g)
    assert crop and I.decode(crop).shape == (64, 144) and I.structure_crop(np.full((9, 9), 255, np.uint8)) is None
    assert I.upscale(g).shape == (80, 240)


def test_reading_order():
    box = lambda x, y, h=10: [[x, y], [x + 9, y], [x + 9, y + h], [x, y + h]]
    assert I.reading_order([box(50, 2), box(0, 0), box(0, 30), None], ["b", "a", "c", " "]) == ["a", "b", "c"]


def test_scan(spark, tmp_path):
    (tmp_path / "b.png").write_bytes(I.encode_png(page()))
    (tmp_path / "a.png").write_bytes(b"broken")
    (tmp_path / "c.txt").write_text("no")
    x = files.images(spark, str(tmp_path), ("*.png", "b.*"))
    assert [r.name for r in x.collect()] == ["a.png", "b.png"]
    out = {r.path.rsplit("/", 1)[-1]: r for r in I.scan_tables(x, run=300, line=300).collect()}
    assert out["a.png"].error and out["b.png"].columns == [0, 160, 360, 510]
    cells = I.read_cells(x, lambda: lambda g: f"{g.shape}").collect()
    assert {(r.key, r.text) for r in cells} == {("a", None), ("b", "(400, 600)")}
    inv = files.inventory(spark, str(tmp_path))
    other = inv.filter("path <> 'c.txt'").withColumn("sha256", F.when(F.col("path") == "a.png", "0").otherwise(F.col("sha256")))
    assert {(r.path, r.state) for r in files.compare_trees(inv, other).collect()} == {("a.png", "differ"), ("b.png", "same"), ("c.txt", "missing")}


def test_csv(spark, tmp_path):
    rows = spark.createDataFrame([("1", True, 'a "q", b', None), ("2", False, "x\ny", 1.5)], "cmpd_id string, is_valid boolean, smiles string, kd_nm double")
    files.write_csv(rows, str(tmp_path / "out"), schema.COMBINED, single=True)
    back = files.read_csv(spark, str(tmp_path / "out"))
    assert back.columns == list(schema.COMBINED)
    got = {r.cmpd_id: r for r in back.collect()}
    assert (got["1"].is_valid, got["1"].smiles, got["1"].kd_nm, got["2"].smiles, got["2"].kd_nm, got["2"].source_image) == ("True", 'a "q", b', "", "x\ny", "1.5", "")
    (tmp_path / "bom.csv").write_text("﻿cmpd_id,is_valid,structure_image\n1,True,c/a.png\n1,False,c/b.png\n2,None,c/a.png\n", encoding="utf-8")
    (tmp_path / "assay.csv").write_text("cmpd_id,kd_nm,mdm2\n1,\"1,000\",A\n2,x,\n")
    known = spark.createDataFrame([("a.png",)], "name string")
    c, a = files.reload_records(spark, str(tmp_path / "bom.csv"), str(tmp_path / "assay.csv"), ("mdm2",), known)
    assert {(r.cmpd_id, r.is_valid, r.structure_image) for r in c.collect()} == {("1", False, None), ("2", None, "c/a.png")}
    assert {(r.cmpd_id, r.kd_nm, tuple(r.extra)) for r in a.collect()} == {("1", 1000.0, ("mdm2",)), ("2", None, ())}


def test_cache(spark, tmp_path):
    entry = {"smiles": "C", "canonical": "C", "min_conf": 0.5, "low_conf": 1, "render": ""}
    for name, version in (("good", 2), ("old", 1)):
        (tmp_path / name).write_text(json.dumps({"__version__": version, "entries": {"7": entry}}))
    (tmp_path / "bad").write_text("{")
    assert [r.cmpd_id for r in files.read_cache(spark, str(tmp_path / "good")).collect()] == ["7"]
    assert files.read_cache(spark, str(tmp_path / "old")).count() == 0 == files.read_cache(spark, str(tmp_path / "bad")).count()
    files.write_audit(spark.createDataFrame([("1", ["a", "b"])], "id string, notes array<string>"), str(tmp_path / "audit"))
    assert spark.read.csv(str(tmp_path / "audit/csv"), header=True).first().notes == "a; b"


def test_streams(spark, tmp_path):
    rows = [[("l", 1, "7", "C"), ("l", 2, None, "O")], [("l", 3, None, "N"), ("l", 4, "8", "S")], [("l", 5, "9", "P")]]
    kinds = "layout string, pos int, id string, text string"
    for i, r in enumerate(rows):
        spark.createDataFrame(r, kinds).coalesce(1).write.mode("append").parquet(str(tmp_path / f"in{i}"))
    src = tmp_path / "src"
    src.mkdir()

    def add(i):
        for f in (tmp_path / f"in{i}").glob("*.parquet"):
            (src / f"{i}-{f.name}").write_bytes(f.read_bytes())

    q = pending.continued_rows(spark.readStream.schema(kinds).parquet(str(src))).writeStream.format("memory").queryName("closed_rows").option("checkpointLocation", str(tmp_path / "ck")).start()
    try:
        for i in range(3):
            add(i)
            q.processAllAvailable()
        assert sorted(tuple(r) for r in spark.sql("SELECT * FROM closed_rows").collect()) == [("l", "7", "CON", 3), ("l", "8", "S", 1)]
    finally:
        q.stop()
    cache = str(tmp_path / "cache")
    for _ in range(2):
        w = pending.fill_cache(spark.readStream.schema(kinds).parquet(str(src)), "pos", cache, str(tmp_path / f"ck{_}"), lambda df: df.select("pos", F.upper("text").alias("out"))).start()
        w.processAllAvailable()
        w.stop()
    assert spark.read.parquet(cache).count() == 5


def test_extraction(spark, tmp_path):
    """Two pages of a ruled table with three columns; a recorded reader stands in for a model."""
    for name in ("p1.png", "p2.png"):
        (tmp_path / name).write_bytes(I.encode_png(page()))
    (tmp_path / "p3.png").write_bytes(b"broken")
    images = files.images(spark, str(tmp_path), ("*.png",))
    found = extract.cells(images, run=300, line=300)
    assert found.filter("error IS NOT NULL").count() == 1 and found.filter("png IS NOT NULL").count() == 18
    texts = {("p1", 0): ("No.", "S", ""), ("p1", 1): ("7", "CC", ""), ("p1", 2): ("8", "CO", ""), ("p2", 0): ("No.", "S", ""), ("p2", 1): (" ", "N", ""), ("p2", 2): ("9", "CCl", "")}
    readings = found.filter("png IS NOT NULL").select("path", "table", "row", "column", "n_columns")
    rows = [(r.path, r.table, r.row, r.column, r.n_columns, s, i, texts[r.path[-6:-4], r.row][r.column], 1, None) for r in readings.collect() for i, s in enumerate(("line", "ch"))]
    comp, assay = extract.records(spark.createDataFrame(rows, extract.READING), profile("WO2022251372"))
    assert {(r.cmpd_id, r.smiles) for r in comp.collect()} == {("7", "CC"), ("8", "CON"), ("9", "CCl")}
    assert assay.count() == 0
    read = extract.read(found, lambda: lambda g: [("line", str(g.shape[0] > 0), 1)])
    assert {r.text for r in read.collect()} == {"True"}


def ruled(columns, rows=((0, 100), (100, 200), (200, 300)), width=1000, height=300):
    """An image that is one table, divided at ``columns`` (one list for each row)."""
    g = np.full((height, width), 255, np.uint8)
    for (top, bottom), xs in zip(rows, columns):
        for x in xs:
            g[top:bottom, x : x + 2] = 0
        g[bottom - 2 : bottom, :] = 0
    return g


def test_cropped_tables(spark, tmp_path):
    """Layout by count of columns, by the heading's texts before that; edges drawn to rules; a first row of its own."""
    family = profile("WO2025162428")
    dense = [175, 345, 505, 675, 795]
    (tmp_path / "a.png").write_bytes(I.encode_png(ruled([dense] * 3)))
    (tmp_path / "b.png").write_bytes(I.encode_png(ruled([[105, 570, 995]] * 3)))
    (tmp_path / "c.png").write_bytes(I.encode_png(ruled([[105, 570]] + [dense] * 2)))
    (tmp_path / "d.png").write_bytes(b"broken")
    (tmp_path / "e.png").write_bytes(I.encode_png(np.full((20, 500), 255, np.uint8)))
    images = files.images(spark, str(tmp_path), ("*.png",))
    found = extract.cells(images, family=family)
    out = found.filter("error IS NULL").groupBy(F.substring_index("path", "/", -1).alias("f"), "row").agg(F.max("n_columns").alias("n"), F.count("png").alias("c")).orderBy("f", "row").collect()
    assert [(r.f, r.row, r.n, r.c) for r in out] == [("a.png", i, 6, 6) for i in range(3)] + [("b.png", i, 3, 3) for i in range(3)] + [("c.png", 0, 3, 3), ("c.png", 1, 6, 6), ("c.png", 2, 6, 6)]
    wide = {r["column"]: I.decode(r.png).shape[1] for r in found.filter("path LIKE '%b.png' AND row = 1").collect()}
    assert wide[0] == 105 and wide[2] == 1000 - 4 - 570 + 1 or wide[2] == 996 - 570  # from the rule to the rule that closes the table
    named = extract.cells(images, family=family, heading=lambda: lambda g: ["Kd  (nM)", "Structure"] if g.shape[0] else [])
    assert {r.n_columns for r in named.filter("path LIKE '%a.png' AND row > 0").collect()} == {7}
    assert found.filter("error IS NOT NULL").count() == 1 and found.filter("path LIKE '%e.png'").count() == 0


def test_layouts_of_tables(spark):
    """Headings, number of columns, the table before in the folder, the default."""
    rows = [("x/1", 0, 0, 6, "KD (nM)"), ("x/1", 0, 1, 6, "5"), ("x/2", 0, 0, 9, "?"), ("x/3", 0, 0, 7, "smiles"), ("y/1", 0, 0, 5, None)]
    out = extract.layouts_of(spark.createDataFrame(rows, "path string, table int, row int, n_columns int, text string"), profile("WO2025162428"))
    assert {(r.path, r.layout) for r in out.collect()} == {("x/1", "dense"), ("x/2", "dense"), ("x/3", "activity"), ("y/1", "activity")}


def test_model_columns_and_reuse(spark):
    tok = "array<struct<token:string,p:double>>"
    rows = [("1", "CCO.C", [("C", 0.9), ("O", 0.4)]), ("2", "CC(", []), ("3", "??", None), ("4", " ", None)]
    work = spark.createDataFrame([(k,) for k, *_ in rows] + [("9",)], "cmpd_id string")
    cache = spark.createDataFrame([("9", "N", "N", "N", 0.5, 0)], "cmpd_id string, raw string, cleaned string, canon string, min_conf double, low_conf int")
    df = spark.createDataFrame(rows, f"cmpd_id string, smiles string, tokens {tok}")
    both, fresh = extract.model_stage(work, cache, lambda todo: df.join(todo, "cmpd_id"))
    assert {(r.cmpd_id, r.raw, r.cleaned, r.canon, r.min_conf, r.low_conf) for r in fresh.collect()} == {("1", "CCO.C", "CCO", "CCO", 0.4, 1), ("2", "CC(", "CC()", "", None, None), ("3", "??", "??", "", None, None)}
    assert {r.cmpd_id for r in both.collect()} == {"1", "2", "3", "9"} and both.columns == ["cmpd_id", "smiles_decimer", "canonical_smiles_decimer", "decimer_min_conf", "decimer_low_conf_count"]
    old = spark.createDataFrame([("1", "C", 0.5), ("1", "CC", 0.25), (None, "x", 1.0)], "cmpd_id string, smiles_decimer string, decimer_min_conf double")
    got = extract.reuse_columns(spark.createDataFrame([("1", "a"), ("2", "b")], "cmpd_id string, smiles string"), old).orderBy("cmpd_id").collect()
    assert [(r.smiles, r.smiles_decimer, r.decimer_min_conf, r.decimer_render_path) for r in got] == [("a", "CC", "0.25", ""), ("b", "", "", "")]


def test_model_stage(spark):
    work = spark.createDataFrame([("1",), ("2",)], "k string")
    cache = spark.createDataFrame([("1", "old"), ("9", "x")], "k string, v string")
    both, new = extract.run_model(work, "k", cache, lambda df: df.withColumn("v", F.lit("new")))
    assert {tuple(r) for r in both.collect()} == {("1", "old"), ("2", "new")} and new.count() == 1


def test_targets_and_single_files(spark, tmp_path, monkeypatch):
    assert files.policy_target("a/t.csv") == "a/t.policy.csv" and files.policy_target("a/t.csv", True) == "a/t.csv"
    path = tmp_path / "compounds_combined.csv"
    assert files.writable_target(str(path)) == str(path)
    path.write_text("x")
    assert files.writable_target(str(path)) == str(path)

    def locked(*a, **k):
        raise PermissionError

    monkeypatch.setattr("builtins.open", locked)
    target = files.writable_target(str(path))
    monkeypatch.undo()
    assert target == str(tmp_path / "compounds_combined.new.csv")
    rows = spark.createDataFrame([("a.bin", b"1"), ("b.bin", b"22")], "name string, content binary")
    done = files.write_each(rows, f"file://{tmp_path}/each").collect()
    assert {r.name for r in done} == {"a.bin", "b.bin"} and (tmp_path / "each/b.bin").read_bytes() == b"22" and len(list((tmp_path / "each").iterdir())) == 2
    assert files.write_csv(rows.select("name"), str(tmp_path / "n"), ("name",)) == 2


def test_command_line(spark, tmp_path, monkeypatch, capsys):
    """cells, and policy beside and over the table, from the command line; the session of the tests is used."""
    from quillgrid import __main__ as cli

    monkeypatch.setattr(cli, "session", lambda master: spark)
    monkeypatch.setattr(cli, "named", lambda what: lambda: lambda g: f"{what}{g.shape[0]}")
    (tmp_path / "img").mkdir()
    (tmp_path / "img/7.png").write_bytes(I.encode_png(page()))
    cli.main(["cells", f"{tmp_path}/img", "--out", f"{tmp_path}/cells", "--reader", "m:f", "--json", "--profile", "WO2022251372"])
    assert [(r.cell, r.route, r.smiles) for r in spark.read.csv(f"{tmp_path}/cells/csv", header=True).collect()] == [("7", "padded_vote", "m:f400")]
    table = spark.createDataFrame([("1", "CCO", "CCO", "", "", "", "")], "cmpd_id string, smiles string, canonical_smiles string, smiles_decimer string, canonical_smiles_decimer string, ms_mz string, ms_polarity string")
    files.write_csv(table, f"{tmp_path}/t.csv", table.columns)
    cli.main(["policy", f"{tmp_path}/t.csv"])
    assert files.read_csv(spark, f"{tmp_path}/t.policy.csv").first().smiles_best == "CCO"
    cli.main(["policy", f"{tmp_path}/t.csv", "--in-place"])
    assert files.read_csv(spark, f"{tmp_path}/t.csv").first().smiles_best_source == "printed_ocr"
    with pytest.raises(SystemExit):
        cli.main(["run", "x", "--out", "y"])


def test_other_formats(spark, tmp_path):
    """JPEG, TIFF and PNG by the Java runtime's readers; what is no picture fails when it is decoded."""
    jvm = spark.sparkContext._jvm
    g = page()
    for kind in ("jpg", "tif", "png"):
        picture = jvm.java.awt.image.BufferedImage(g.shape[1], g.shape[0], jvm.java.awt.image.BufferedImage.TYPE_INT_RGB)
        paint = picture.createGraphics()
        paint.setColor(jvm.java.awt.Color.WHITE)
        paint.fillRect(0, 0, g.shape[1], g.shape[0])
        paint.setColor(jvm.java.awt.Color(10, 0, 200))
        paint.fillRect(220, 70, 40, 20)
        assert jvm.javax.imageio.ImageIO.write(picture, kind, jvm.java.io.File(str(tmp_path / f"a.{kind}")))
    (tmp_path / "b.jpg").write_bytes(b"broken")
    rows = files.images(spark, str(tmp_path), ("*.jpg", "*.tif", "*.png"), decode=True).collect()
    assert [r.name for r in rows] == ["a.jpg", "a.png", "a.tif", "b.jpg"]
    for r in rows[:3]:
        x = I.decode(bytes(r.content))
        assert x.shape == (400, 600) and abs(int(x[80, 240]) - 26) < 6 and x[200, 50] > 250  # 0.299 x 10 + 0.114 x 200
    with pytest.raises(ValueError):
        I.decode(bytes(rows[3].content))
    found = extract.cells(files.images(spark, str(tmp_path), ("*.jpg", "*.tif"), decode=True))
    assert found.filter("error IS NOT NULL").count() == 1


def test_full_run(spark, tmp_path):
    from quillgrid.plans import flows

    for name in ("p1.png", "p2.png"):
        (tmp_path / name).write_bytes(I.encode_png(page()))
    (tmp_path / "p3.png").write_bytes(b"broken")
    family = profile("WO2022251372")
    real = extract.cells

    def small(images, **k):
        return real(images, run=300, line=300, **k)

    try:
        extract.cells = small
        rows, failed = flows.full_run(spark, str(tmp_path), family, lambda: lambda g: [("line", "CCO" if g.shape[1] > 180 else str(5), 1)])
        got = rows.select("cmpd_id", "smiles", "is_valid", "smiles_best").collect()
    finally:
        extract.cells = real
    assert failed.count() == 1 and [(r.cmpd_id, r.smiles_best) for r in got] == [("5", "CCO")] and rows.columns[-6:] == ["mdm2", "mdm4", "molm13", "mv4_11", "waga", "mkl1"]


def test_drawings(spark):
    from quillgrid.chem import draw
    from quillgrid.chem import molecule as M

    ring = "C1C(=O)" + "NCC(=O)" * 5 + "N1"
    found = draw.sketch(ring)
    assert (found["atoms"], found["bonds"], found["opened"]) == (24, 23, True) and not draw.sketch("CCO")["opened"] and draw.sketch("C(") is None
    mol = M.read(ring)
    order = draw.macrocycle(mol)
    assert len(order) == 18 and all(b in mol.near[a] for a, b in zip(order, order[1:] + order[:1]))
    xy = draw.places(mol, order)
    assert np.isfinite(xy).all() and np.allclose(xy[order], draw.polygon(18))
    size = [np.linalg.norm(xy[a] - xy[b]) for a, b in mol.bonds]
    assert 0.5 < min(size) and max(size) < 3.5
    assert draw.turns(draw.polygon(24, zigzag=0.0))["std_turn"] < draw.turns(draw.polygon(24))["std_turn"] and draw.turns(np.zeros((2, 2)))["n"] == 2
    assert draw.svg(ring).count("<line") == 23 + 6 and draw.svg(ring, chain=False).count("<text") == 12 and draw.svg("") is None
    assert draw.picture("CCO").shape == (360, 520) and (draw.picture("CCO") == 0).any()


def test_polar_surface_and_rotatable_bonds():
    """Published values of common molecules."""
    from quillgrid.chem import molecule as M

    for s, tpsa, turns in (("CCO", 20.23, 0), ("CC(=O)Oc1ccccc1C(=O)O", 63.6, 3), ("Cn1c(=O)c2c(ncn2C)n(C)c1=O", 61.82, 0), ("NCCc1ccc(O)c(O)c1", 66.48, 2), ("CC(=O)Nc1ccc(O)cc1", 49.33, 1), ("CC#N", 23.79, 0), ("C1CO1", 12.53, 0)):
        mol = M.read(s)
        assert abs(M.polar_surface(mol) - tpsa) < 0.02, (s, M.polar_surface(mol))
        assert M.rotatable_bonds(mol) == turns, (s, M.rotatable_bonds(mol))


def test_drawings_look_for_rings_once_more_and_are_dealt_out(spark, monkeypatch):
    from quillgrid.chem import draw
    from quillgrid.chem import molecule as M

    mol, asked, real = M.read("CC(=O)NCC(=O)NCC(=O)NC1CCCCCCCCCC(=O)NCC1"), [], M.smallest_rings
    monkeypatch.setattr(M, "smallest_rings", lambda m: asked.append(m) or real(m))
    cut = draw.open_amide(mol)
    assert set(mol.bonds) - set(cut.bonds) == {(22, 24)} and len(asked) == 2  # the ring's own amide; the three of the chain are not tried
    both = M.read("C1CCCCCCCCCC(=O)NCC1.C2CCCCCCCCCC(=O)NCC2")
    assert draw.open_amide(both) is None and len(asked) == 3  # no bond lies in both largest rings

    monkeypatch.undo()
    x = spark.createDataFrame([(i, ("CCO", "C1CCCC1", "C(", None)[i % 4]) for i in range(4000)], "k long, s string").coalesce(1)
    out = draw.rendered(x, "k", "s", as_svg=True)
    assert out.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert {(r.name, bytes(r.content).decode()) for r in out.collect()} == {(f"{i}.svg", draw.svg(("CCO", "C1CCCC1")[i % 4])) for i in range(4000) if i % 4 < 2}


def test_long_runs_in_little_memory():
    import tracemalloc

    r = np.random.default_rng(0)
    for shape in ((0, 9), (7, 0), (1, 1), (9, 30), (30, 9)):
        for share in (0.0, 0.5, 0.9, 1.0):
            dark = r.random(shape) < share
            for least in (1, 2, 5):
                want = [[any(all(row[a : a + least]) for a in range(max(0, x - least + 1), min(x, len(row) - least) + 1)) for x in range(len(row))] for row in dark.tolist()]
                assert I.long_runs(dark, least).tolist() == want
    page = np.zeros((2000, 2000), bool)
    page[::2] = True
    tracemalloc.start()
    got = I.long_runs(page, 1500)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (got == page).all() and peak < 4 * page.size


def test_upscale_takes_each_row_once():
    import tracemalloc

    g = np.random.default_rng(0).integers(0, 256, (7, 5)).astype(np.uint8)
    at = lambda i, n: min(max((i + 0.5) / 3 - 0.5, 0), n - 1)
    for y, x in np.ndindex(21, 15):
        v, u = at(y, 7), at(x, 5)
        a, b, c, d = (float(g[min(int(v) + p, 6), min(int(u) + q, 4)]) for p, q in ((0, 0), (0, 1), (1, 0), (1, 1)))
        assert abs(I.upscale(g, 3)[y, x] - ((a * (1 - u % 1) + b * (u % 1)) * (1 - v % 1) + (c * (1 - u % 1) + d * (u % 1)) * (v % 1))) <= 0.5 + 1e-9
    flat = np.zeros((20, 20_000), np.uint8)
    tracemalloc.start()
    I.upscale(flat, 8)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 3.5 * 8 * flat.size * 64


@pytest.mark.parametrize("name", ["reader_routes", "page_likeness", "beam_repair", "edit_neighbours"])
def test_rows_of_one_file_go_to_all_cores(spark, name):
    from quillgrid.plans import catalog

    assert catalog.queries()[name](spark, "/root/testdata/sf0.001").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_row_bands_by_every_step():
    """Grey 200 is ink, lines count from the ninth pixel, rows from 30 pixels; a line that runs off the picture needs half the length."""

    def cut(ys, h=200, w=200, left=0, right=200, ink=0):
        g = np.full((h, w), 255, np.uint8)
        for y in ys:
            g[y, left:right] = ink
        return I.row_bands(g)

    assert cut([60, 92]) == [(0, 59), (61, 91), (93, 200)] and cut([60, 91]) == [(0, 59), (92, 200)]
    assert cut([9, 100]) == [(10, 99), (101, 200)] and cut([8, 100]) == [(0, 200)]
    assert cut([100, 191]) == [(0, 99), (101, 190)] and cut([100, 192]) == [(0, 200)]
    assert len(cut([60, 120], ink=200)) == 3 and cut([60, 120], ink=201) == []
    assert len(cut([60, 120], left=50, right=130)) == 3 and cut([60, 120], left=50, right=129) == []
    assert len(cut([60, 120], right=40)) == 3 and cut([60, 120], right=39) == []
    assert len(cut([60, 120], left=159)) == 3 and cut([60, 120], left=160) == []
    r, run = np.random.default_rng(0), 24
    for _ in range(200):  # an opening by its definition: a window is kept if its pixels inside the picture are dark
        g = np.full((200, 60), 255, np.uint8)
        for y in (60, 120):
            g[y] = np.repeat(np.where(r.random(6) < 0.6, 0, 255), 10) if r.random() < 0.5 else np.repeat(np.where(r.random(20) < 0.8, 0, 255), 3)
        lines = [y for y in (60, 120) if any((g[y, max(0, x - run // 2) : x - run // 2 + run] == 0).all() for x in range(60))]
        assert I.row_bands(g) == ([] if not lines else [(0, 59), (61, 119), (121, 200)] if len(lines) == 2 else [(0, 200)])


def test_page_likeness_takes_the_bands_as_they_are(spark):
    """A ruled page with one line across inside is one band; the query had said two."""
    from quillgrid.plans import catalog

    sf = "/root/testdata/sf0.001"
    x = catalog.queries()["page_likeness"](spark, sf).join(spark.read.parquet(f"{sf}/part.parquet"), "p_partkey")
    got = {(r.tabular, r.bands) for r in x.filter("p_size % 12 = 8").select("tabular", "bands").collect()}
    assert got == {(True, 1)}
