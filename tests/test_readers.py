"""Cell readers with models that are stand-ins."""

import numpy as np
import pytest

from quillgrid.operators import imaging as I
from quillgrid.operators.readers import ROUTES, Reader, line_pictures, snap, widen_last


def cell():
    g = np.full((60, 200), 255, np.uint8)
    g[5:18, 20:120] = 0
    g[35:48, 20:60] = 0
    g[:, 190:192] = 0
    return g


def width(texts):
    """Reads a line by how wide its picture is."""
    return lambda p: texts[p.shape[1] > 150]


def test_lines():
    a, b = line_pictures(cell())
    assert a.shape[1] > b.shape[1] and line_pictures(cell(), 10)[0].shape[0] == a.shape[0] + 20
    assert Reader(width(["N", "C("])).lines(cell()) == ["C(", "N"]


def test_routes():
    box = lambda y: [[0, y], [9, y], [9, y + 9], [0, y + 9]]
    r = Reader(width(["C)N", "CC"]), width(["C)N", "C("]), lambda g: ([box(30), box(5)], ["b", "a"]))
    assert r.printed(cell(), "production") == "ab"
    assert r.printed(cell(), "validated") == "CCC)N"
    assert r.printed(cell(), "validated_vote") == "C(C)N" == r.printed(cell(), "padded_vote")
    with pytest.raises(ValueError):
        r.printed(cell(), "other")
    assert len(ROUTES) == 5
    assert [(s, n) for s, _, n in r.activity(cell())] == [("crop", 1), ("line", 2), ("ch", 2)]


def test_grade():
    assert Reader(lambda p: "q", lambda p: " b ").grade(cell(), ("A", "B")) == "B"
    assert Reader(lambda p: "q").grade(cell(), ("A", "B")) is None


def test_columns():
    assert snap([(10, 100)], [0, 95, 400]) == [(0, 95)]
    assert widen_last([(0, 5), (10, 100)], [90, 180, 300], 400) == [(0, 5), (10, 301)]
    assert widen_last([(0, 5), (10, 100)], [90], 400) == [(0, 5), (10, 100)] == widen_last([(0, 5), (10, 100)], [], 400)
    assert I.COLUMN_GAP == 25


def test_identifier():
    r = Reader(lambda p: "No. x", lambda p: f"Cmpd 1234 {p.shape[0]}")
    assert r.identifier(cell(), r"\d{4}") == "1234" and r.identifier(cell(), r"\d{5}") is None
    assert Reader(lambda p: "7").identifier(cell(), r"\d{1,2}", 30, 4) == "7"
    assert Reader(lambda p: "7").identifier(np.zeros((0, 0), np.uint8), r"\d") is None
    g = np.full((60, 300), 255, np.uint8)
    g[:, 2:5] = g[:, 294:297] = 0
    g[20:30, 200:240] = 0
    assert I.trim_to_content(g).shape == (60, 48) and I.trim_to_content(g[:, 10:290]).shape == (18, 48) and I.trim_to_content(np.full((5, 5), 255, np.uint8)).shape == (5, 5)
