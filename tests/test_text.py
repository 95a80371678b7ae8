"""Scalar functions on literal inputs, rules with cases in which they must not fire."""

import random
import re

import pytest
from pyspark.sql import functions as F

from quillgrid.functions import mass as M
from quillgrid.functions import text as T


def ask(spark, values, f, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}").select("i", f(F.col("x")).alias("y")).orderBy("i").collect()
    return [r.y for r in rows]


def test_ids(spark):
    cases = {"01001": "1001", "1038:": "1038", "Compd #42": "42", "abc": "abc", "  compound  7 ": "7", "CMPD. 1,200": "1200", "": None, None: None, "  ": None, "-0": "0", "+5": "5", "A-12": "a-12"}
    assert ask(spark, list(cases), T.normalise_id) == list(cases.values())


def test_numbers(spark):
    cases = {"1,234.5": 1234.5, " 7 ": 7.0, "": None, "1d": None, "x": None, "-.5e1": -5.0, "1 2": None, None: None}
    assert ask(spark, list(cases), T.parse_number) == list(cases.values())
    assert ask(spark, ["1 2"], lambda c: T.parse_number(c, spaces=True)) == [12.0]


def test_headers(spark):
    assert ask(spark, [" Cmpd  #", "LCMS RT (min)", "Structure", "other", None], T.canonical_field) == ["cmpd_id", "rt_min", "structure", None, None]


def test_brackets(spark):
    assert ask(spark, ["C(C", "C)C(", "[C((", None, "", "))"], T.bracket_deficit) == [1, 0, 3, 0, 0, 0]
    d = ask(spark, ["C)[C"], T.bracket_deficits)[0]
    assert (d.open_paren, d.close_paren, d.open_bracket, d.close_bracket, d.total) == (1, 0, 0, 1, 2)
    assert ask(spark, ["C(C[N", "CC", "C))"], T.close_brackets) == ["C(C[N)]", None, None]
    assert ask(spark, [0, 1, 2, 3, 5, 6, 10, 11], T.difficulty, "int") == ["balanced", "light", "light", "medium", "medium", "heavy", "heavy", "extreme"]


REPAIRS = {
    "CC(O)NCC": "CC(=O)NCC", "CC[C@H(CC": "CC[C@H](CC", "CC(=O)N╬▓": "CC(=O)N", "C1=0)": "C1=O)", "CC(=O)NC1=0)C": "CC(=O)NC1=O)C", "C0CCCCC0": "C0CCCCC0",
    "[C@@H4C(=O)NC1CCC4": "[C@@H]4C(=O)NC1CCC4", "[C@@H]4C(=O)NC1CCC4": "[C@@H]4C(=O)NC1CCC4", "[C@@H4C(=O)NC": "[C@@H4C(=O)NC",
}


def test_repair(spark):
    assert ask(spark, list(REPAIRS), T.repair_syntax) == list(REPAIRS.values())


def test_rewrite(spark):
    cases = {"C(=O)": ("C(=O)", 0), "C-O)": ("C(=O)", 1), "C=O)": ("C(=O)", 1), "C1=O)": ("C1=O)", 0), "C(=O)NC1=O)": ("C(=O)NC1=O)", 0), "(=O)=O)": ("(=O)=O)", 0), "C=O)=O)": ("C(=O)=O)", 1)}
    assert [(r.text, r.n) for r in ask(spark, list(cases), T.rewrite_oxo)] == list(cases.values())


def test_rewrite_equals_a_plain_regex_walk(spark):
    r = random.Random(3)
    words = ["".join(r.choice("C(=O)-1N") for _ in range(r.randint(0, 25))) for _ in range(300)]

    def walk(text):
        n = [0]

        def sub(m):
            if m.group(1) in "(0123456789":
                return m.group(0)
            n[0] += 1
            return m.group(1) + "(=O)"

        return re.sub(r"(.)[-=]O\)", sub, text), n[0]

    assert [(x.text, x.n) for x in ask(spark, words, T.rewrite_oxo)] == [walk(w) for w in words]


def test_lexical_order(spark):
    r = ask(spark, ["Ca@H]", "[Ca@@H]", "[Ca]"], T.lexical_prepass)
    assert [x.text for x in r] == ["[C@H]", "[[C@@H]", "[Ca]"]
    assert [x.n_chiral for x in r] == [1, 1, 0]


def test_alphabet(spark):
    assert ask(spark, ["CC(=O)", "C$", "C q", "é"], T.legal) == [True, False, False, False]


def test_alphabet_is_the_pattern():
    assert {c for c in map(chr, range(1, 300)) if not re.search(T._ILLEGAL, c)} == set(T.ALPHABET)


def test_rings(spark):
    assert ask(spark, ["C1CC1%12C%12[13C]0"], lambda c: T.tally(T.ring_closures(c))) == [{"1": 2, "12": 2}]
    assert ask(spark, ["C0C0%10"], T.ring_digits) == [["0", "0", "%10"]]


def test_parts_context_classes(spark):
    assert ask(spark, ["a.b(c.d).[e.f]", ".x.", ""], T.top_level_parts) == [["a", "b(c.d)", "[e.f]"], ["x"], []]
    assert ask(spark, ["abcdefgh"], lambda c: T.context(c, F.lit(4), 2)) == ["cdefg"]
    assert ask(spark, ["abc"], lambda c: T.context(c, F.lit(0), 2)) == ["abc"]
    assert ask(spark, ["=C", "-C", "", None, "C"], T.first_char_class) == ["equals", "minus", "missing", "missing", "other"]
    assert ask(spark, ["C2H6OC"], T.formula_counts) == [{"C": 3, "H": 6, "O": 1}]


def test_ranges(spark):
    rows = spark.createDataFrame([(201444.0, 1.0), (0.0, 31.0), (float("nan"), None)], "k double, r double")
    out = [r.f for r in rows.select(T.range_flags({"kd_nm": F.col("k"), "rt_min": F.col("r")}).alias("f")).collect()]
    assert out == [["kd_nm above range (201444.0000 > 100000.0000)"], ["kd_nm below range (0.0000 < 0.0001)", "rt_min above range (31.0000 > 30.0000)"], []]


ION = [("[M+H]+", (1.007276466, 1)), ("[M+3H]3+", (1.007276466, 3)), ("[M-H]-", (1.007276466, -1)), ("[M+HCOO]-", (-44.998201, -1)), ("[M + Na]+", (22.98976928, 1)), ("[M]+", (1.007276466, 1)), ("nonsense", None), ("", None), ("[M+]", None)]


@pytest.mark.parametrize("label,want", ION)
def test_ions(spark, label, want):
    got = ask(spark, [label], M.polarity)[0]
    assert (got and (round(got.delta, 9), got.charge)) == want


def test_mass_rules(spark):
    assert [round(x, 6) for x in ask(spark, [1610.9, 1610.0, 1610.93], lambda c: M.printing_tolerance_ppm(c), "double")] == [round(0.05 / 1610.9 * 1e6, 6), round(0.05 / 1610 * 1e6, 6), round(0.005 / 1610.93 * 1e6, 6)]
    assert ask(spark, [0.0, None], M.printing_tolerance_ppm, "double") == [5000.0, 5000.0]
    w = ask(spark, [500.0], lambda c: M.mass_window(c, M.polarity(F.lit("[M+H]+"))), "double")[0]
    assert round(w.high - w.low, 6) == 1.0
    assert ask(spark, ["1610.9", "1,610", "1610.930"], M.gate_slack) == [0.06, 0.5, 0.06]
    counts = ask(spark, ["C[C@H](Br)[nH]Cl[C", "C[Cl"], lambda c: T.tally(M.element_tokens(c)))
    assert counts == [{"Br": 1, "C": 3, "Cl": 1}, {"C": 2}]
    assert ask(spark, ["C[C@H](n)[13C][Na+]C[O"], lambda c: T.tally(M.atom_tokens(c))) == [{"C": 4, "Na": 1, "n": 1}]
