"""Parser, repairs, audit, automaton and searches."""

import random

import numpy as np
import pytest

from quillgrid.chem import molecule as M
from quillgrid.chem import prefix as P
from quillgrid.chem import repairs as R
from quillgrid.chem import search as S
from quillgrid.operators import ctc



def grown(seed):
    """A structure string of a random tree of atoms with some ring bonds, within valences."""
    r = random.Random(seed)
    atoms, kids, tag, bond = ["C"], {0: []}, {0: ""}, {}
    free = [4]
    for i in range(1, r.randint(2, 14)):
        up = r.choice([j for j, f in enumerate(free) if f] or [None])
        if up is None:
            break
        a, v = r.choice([("C", 4), ("C", 4), ("N", 3), ("O", 2), ("S", 2), ("F", 1), ("Cl", 1)])
        double = v > 1 and free[up] > 1 and r.random() < 0.25
        atoms.append(a)
        free.append(v - 1 - double)
        free[up] -= 1 + double
        kids[up].append(i)
        kids[i], tag[i], bond[i] = [], "", "=" if double else ""
    for d in range(1, r.randint(1, 3)):
        open_ = [j for j, f in enumerate(free) if f]
        x, y = (r.choice(open_), r.choice(open_)) if open_ else (0, 0)
        if x != y and x not in kids[y] and y not in kids[x] and not set(tag[x]) & set(tag[y]):
            tag[x], tag[y] = tag[x] + str(d), tag[y] + str(d)
            free[x], free[y] = free[x] - 1, free[y] - 1

    def write(i):
        parts = [bond[k] + write(k) for k in kids[i]]
        return atoms[i] + tag[i] + "".join(f"({p})" for p in parts[:-1]) + "".join(parts[-1:])

    return write(0)


GROWN = [grown(i) for i in range(40)]
#: What the generator has no rule for: bracket atoms, charges, isotopes, aromatic rings, two-digit ring bonds, marks at double bonds, several parts.
WRITTEN = ["[Mg+2]", "[15NH3]", "[OH-]", "[SiH4]", "o1cccc1", "c1ccc2ccccc2c1", "[nH]1c2ccccc2cc1", "N%12CCOCC%12", "F/C=C/F", "Cl\\C=C/Cl", "O[C@H](N)C", "S(=O)(=O)(O)O", "[Na+].[Cl-]", "N#Cc1ccncc1", "*CO"]


def broken(s):
    """Writings of a string that no parser may take."""
    return [s + "(", s + ")", s + "]", "[" + s, s + "=", s + "..O", "." + s, s + "8", s + "(=)C", "C((" + s]


PEPTIDE = "C1C(=O)N[C@@H](C)C(=O)N[C@@H](CC(C)C)C(=O)NCC(=O)N[C@@H](C)C(=O)NCC(=O)N1"


@pytest.mark.parametrize("s", [*GROWN, *WRITTEN])
def test_valid(s):
    assert P.grammatical(s) and P.first_violation(s) is None
    mol = M.read(s)
    assert mol is not None
    again = M.canonical_text(s)
    assert M.canonical_text(again) == again and M.formula(M.read(again)) == M.formula(mol)


@pytest.mark.parametrize("s", ["", *[x for s in (*GROWN[:6], *WRITTEN[:3]) for x in broken(s)]])
def test_malformed(s):
    assert not P.grammatical(s) and M.read(s) is None


def test_chemistry_is_checked():
    for bad in ("C(C)(C)(C)(C)C", "c1cccc1", "FC(F)(F)(F)F", "C1CC", "[Xx]"):
        assert M.read(bad) is None


def test_invariants():
    f = M.fingerprint("CN1CCC[C@H]1c1cccnc1")
    assert (f["formula"], f["rings"], f["largest_ring"], f["stereo_centres"], f["exact_mass"]) == ("C10H14N2", 2, 6, 1, 162.1157)
    assert M.fingerprint(PEPTIDE)["largest_ring"] == 18 and M.intact(PEPTIDE) and not M.intact("C1CCCCC1")
    assert M.largest_fragment("CCO.C") == "CCO"
    assert M.fingerprint("[13CH4]")["exact_mass"] == 17.0347


def test_canonical_does_not_depend_on_writing():
    same = [("C1=CC=CC=C1", "c1ccccc1"), ("OCC", "CCO"), ("N[C@@H](C)C(=O)O", "OC(=O)[C@@H](N)C"), ("C1CC2CCC1CC2", "C12CCC(CC1)CC2"), ("Cc1ccccc1O", "Oc1ccccc1C")]
    for a, b in same:
        assert M.canonical_text(a) == M.canonical_text(b)
    assert M.canonical_text("N[C@@H](C)C(=O)O") != M.canonical_text("N[C@H](C)C(=O)O")


def test_geometry_of_double_bonds():
    same = [("F/C=C/F", "F\\C=C\\F"), ("F/C=C\\F", "C(/F)=C/F"), ("C/C=C/C=C/O", "O/C=C/C=C/C"), ("OC/C(N)=C/Cl", "Cl/C=C(\\N)CO"), ("C/1=C/CCCCCCCC1", "C1CCCC/C=C\\CCC1")]
    for a, b in same:
        assert M.canonical_text(a) == M.canonical_text(b), (a, b, M.canonical_text(a), M.canonical_text(b))
    other = [("F/C=C/F", "F/C=C\\F"), ("C/C=C/C=C/O", "C/C=C/C=C\\O"), ("C/C=C/C=C/O", "C/C=C\\C=C/O"), ("Cl/C=C(/N)CO", "Cl/C=C(\\N)CO"), ("C/1=C/CCCCCCCC1", "C1CCCC/C=C/CCC1")]
    for a, b in other:
        assert M.canonical_text(a) != M.canonical_text(b)
    for s in {x for p in same + other for x in p}:
        again = M.canonical_text(s)
        assert M.canonical_text(again) == again
    assert M.canonical_text("C/C(C)=C/C") == M.canonical_text("CC(C)=CC") and M.canonical_text("C1/C=C\\CCC1") == M.canonical_text("C1C=CCCC1")


def test_shuffled_writings():
    mol, r = M.read(PEPTIDE), random.Random(1)
    n = len(mol.atoms)
    for _ in range(5):
        start = r.randrange(n)
        rank = list(range(n))
        r.shuffle(rank)
        arom, ab = M.aromatic_atoms(mol, M.smallest_rings(mol))
        text = M._write(mol, start, rank, M._ranks(mol, arom, ab, False), arom, ab, set())
        assert M.canonical_text(text) == M.canonical(mol)


def test_repairs():
    assert R.repair_macrocycle(PEPTIDE) == (None, None)
    assert R.repair_macrocycle(PEPTIDE[:-2])[1] is not None or R.repair_macrocycle(PEPTIDE[:-2]) == (None, None)
    got, method = R.repair_macrocycle(PEPTIDE + ")")
    assert method == "syntax_fix" and got == M.canonical_text(PEPTIDE)
    assert R.repair_macrocycle(PEPTIDE[:7] + "." + PEPTIDE[7:])[1] == "rejoin_fragments"
    assert R.repair_macrocycle("CCO") == (None, None)
    chain = "N" + "C" * 14 + "O"
    assert R.repair_macrocycle(chain)[1] == "terminal_bridge"


def test_audit():
    assert R.audit("C1CC", None, "")["note"] == "no_repair_found"
    assert R.audit("C1CC", "C1CCCCC1", "syntax_fix")["tier"] == "rejected"
    a = R.audit(PEPTIDE, PEPTIDE + "C", "syntax_fix")
    assert a["tier"] == "experimental" and a["atoms_invented"] == 1 and not a["validated"]
    assert R.audit(PEPTIDE, PEPTIDE, "terminal_bridge")["tier"] == "experimental"
    long = "CC(=O)N1CCCCC(=O)N(C)CCCCC(=O)N(C)CCCCC(=O)N(C)CCCCCCCCCCCC1"
    short = "CC(=O)N1CCCCC(=O)N(C)CCCCC(=O)N(C)CCCCC(=O)N(C)CCCC1"
    assert R.audit(long, short, "strip_truncated_tail")["tier"] == "low"
    assert R.audit(PEPTIDE, PEPTIDE, "syntax_fix")["tier"] == "high"


def test_mirrored_bracket():
    broken = "C]C@@H](C)C(=O)NC"
    assert R.mirrored_bracket(broken) == "C[C@@H](C)C(=O)NC"
    assert R.mirrored_bracket("CC(=O)N") == "CC(=O)N"


def test_search_recovers_damage():
    m = M.fingerprint(PEPTIDE)["exact_mass"]
    for broken, edits in ((PEPTIDE, 0), (PEPTIDE.replace("(=O)", "=O)", 1), 1), (PEPTIDE.replace("(=O)", "-O)", 1), 1)):
        got = S.mass_search(broken, m - 0.05, m + 0.05, 20_000)
        assert got["smiles"] == M.canonical_text(PEPTIDE), broken
        assert got["inserts"] + got["subs"] == edits
    assert S.mass_search("", 1, 2)["trace"] == "empty_input"
    assert S.mass_search(PEPTIDE + ")", m + 50, m + 51, 50)["trace"] == "state_budget_hit"
    assert S.searchable("((((((((((((", True, True) == "unsearchable_deficit_12"


def test_vote():
    lines = [PEPTIDE[:20], PEPTIDE[20:40], PEPTIDE[40:]]
    bad = [lines[0], lines[1].replace("(", "", 1), lines[2]]
    assert S.vote(bad, lines) == {"text": PEPTIDE, "changed": 1, "used_primary": False, "parses": True}
    assert S.vote(lines, bad)["used_primary"]
    assert not S.vote(["C("], ["C)"])["parses"]
    assert S.vote(["C=C", "("], ["CC", ""])["text"] == "C=C("  # a replacement that loses a bond does not count
    assert S.combinations([("a", "b"), ("c",), ("d", "e")], 1) == [["b", "c", "d"], ["a", "c", "e"]]


def test_lattices():
    lattice = [[("C", 0.9)], [(")", 0.6), ("(", 0.4)], [("C", 0.9)], [(")", 0.9)]]
    ok = lambda t: M.read(t) is not None
    assert S.swap_one(lattice, ok) == "C(C)"
    assert S.swap_one(lattice[:2], ok) is None
    assert S.beam([[("C", 0.9)], [("(", 0.6), ("C", 0.4)], [("C", 0.9)]], ok) == "CCC"
    assert S.swap_one([[("C", 0.9)], [("(", 0.6), ("C", 0.4)]], ok) == "CC"


def test_ctc():
    r = np.random.default_rng(4)
    for _ in range(20):
        p = r.dirichlet(np.ones(3), 5)
        for labels in ([], [1], [1, 1], [2, 1]):
            assert ctc.log_likelihood(p, labels) == pytest.approx(ctc.brute_force_likelihood(p, labels))
        best, score = ctc.prefix_beam(p, beam=200)[0]
        assert score == pytest.approx(ctc.log_likelihood(p, best))


def test_neighbours():
    assert set(R.single_edits("ab", "x")) == {"xab", "xb", "b", "axb", "ax", "a", "abx"}


def test_alignments():
    assert R.partners("CC(=O)N", "CC=ON") == {0: "C", 1: "C", 3: "=", 4: "O", 6: "N"}
    assert R.tile("CC(=O)N", ["CC=", "ON"]) == ["CC(=", "O)N"]
    assert R.flips("C]C@@H](C)C(=O)NC") == ([1, 6], [1]) and R.flips("CC") == ([], [])


def test_search_query_has_the_operators_budget(spark, monkeypatch):
    """A lost bracket at the end, which takes more than 500 states."""
    from quillgrid.plans import queries_chem

    side = ["N[C@@H](C)C(=O)", "N[C@@H](CC(C)C)C(=O)", "N(C)[C@@H](Cc2ccccc2)C(=O)", "N2CCC[C@H]2C(=O)", "NCC(=O)"]
    p, size = 3, 29
    whole = "C1C(=O)" + "".join(side[(p * 7 + i * i * 3 + size) % 5] for i in range(1, 7 + p % 3)) + "N1"
    monkeypatch.setattr(queries_chem, "structures", lambda spark, sf_dir: spark.createDataFrame([(p, whole, whole.removesuffix(")N1") + "N1")], "p_partkey long, whole string, damaged string").repartition(1))
    r = queries_chem.mass_search(spark, "").first()
    assert r.ocr_repair_trace.startswith("ok") and M.fingerprint(r.smiles_ocr_repaired)["formula"] == M.fingerprint(whole)["formula"] == r.ocr_repair_formula


def test_edits_are_given_one_by_one():
    import tracemalloc

    tracemalloc.start()
    n = sum(1 for _ in R.single_edits("ab" * 1000, "()"))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 2 * 2001 + 2 * 2000 + 2000 and peak < 1e6


def test_keyed_rows_are_dealt_out_and_equal_values_worked_once(spark, tmp_path):
    import os

    from quillgrid.plans.queries_chem import _per_row

    def one(a, b):
        with open(f"{tmp_path}/{os.getpid()}", "a") as f:
            f.write("x")
        return [(f"{a}{b}",)] * (a % 3)

    x = spark.range(0, 5000, 1, 1).selectExpr("id", "id % 3 as a", "if(id % 2 = 0, 'p', null) as b")
    out = _per_row(x, "id long, t string", one, True)
    got = sorted(tuple(r) for r in out.collect())
    assert got == sorted((i, f"{i % 3}{'p' if i % 2 == 0 else None}") for i in range(5000) for _ in range(i % 3))
    assert out.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert sum(f.stat().st_size for f in tmp_path.iterdir()) <= 6 * spark.sparkContext.defaultParallelism


def test_beam_makes_pairs_only_when_single_edits_fail(monkeypatch):
    made, real = [], S.itertools.combinations
    monkeypatch.setattr(S.itertools, "combinations", lambda *a: made.append(a) or real(*a))
    ok = lambda t: M.read(t) is not None
    assert S.beam([[("C", 0.9)], [("(", 0.6), ("C", 0.4)], [("C", 0.9)]], ok) == "CCC" and not made
    assert S.beam([[("C", 0.9)], [(")", 0.6), ("C", 0.4)], [(")", 0.6), ("C", 0.4)]], ok) == "CCC" and len(made) == 1
