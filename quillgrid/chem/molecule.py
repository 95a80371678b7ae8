"""SMILES to a molecular graph, and what is read off that graph.

Canonical strings are consistent within this engine (equal graphs give equal strings); they are not
those of any other toolkit. Geometry of double bonds is kept where it is written, outside rings of fewer than eight atoms.
"""

from __future__ import annotations

import re
from collections import Counter, deque
from dataclasses import dataclass, field
from functools import lru_cache

from ..functions.mass import ISOTOPES

# Standard atomic weights.
WEIGHTS = {"H": 1.008, "C": 12.011, "N": 14.007, "O": 15.999, "F": 18.998, "P": 30.974, "S": 32.06, "Cl": 35.45, "Br": 79.904, "I": 126.904, "Si": 28.086, "Se": 78.971, "B": 10.81, "Na": 22.990, "K": 39.098, "Li": 6.94, "Ca": 40.078, "Mg": 24.305, "Zn": 65.38, "Fe": 55.845, "As": 74.922}
EXACT = ISOTOPES | {"Na": 22.98976928, "K": 38.96370649, "Li": 7.0160034, "Ca": 39.9625909, "Mg": 23.9850417, "Zn": 63.9291420, "Fe": 55.9349363, "As": 74.9215946}
HEAVIER = {("H", 2): 2.0141017778, ("C", 13): 13.0033548378, ("N", 15): 15.0001088982, ("O", 18): 17.999161}
VALENCES = {"B": (3,), "C": (4,), "N": (3, 5), "O": (2,), "P": (3, 5, 7), "S": (2, 4, 6), "F": (1,), "Cl": (1,), "Br": (1,), "I": (1, 5)}
AROMATIC = {"b", "c", "n", "o", "p", "s", "se", "as"}
ORDERS = {"-": 1, "=": 2, "#": 3, "$": 4, ":": 1.5, "/": 1, "\\": 1, "~": 1}
BRACKET = re.compile(r"^(\d*)(se|as|[A-Z][a-z]?|[bcnops]|\*)(@{0,2})(?:(?:TH|AL|SP|TB|OH)\d{1,2})?(?:H(\d*))?(\+{1,4}|-{1,4}|[+-]\d+)?(?::\d+)?$")
LEAST_MACROCYCLE = 12


class Bad(ValueError):
    """The text is no valid SMILES."""


@dataclass
class Atom:
    symbol: str
    aromatic: bool = False
    charge: int = 0
    isotope: int = 0
    h: int | None = None  # hydrogens written in brackets; None: by valence
    chiral: int = 0  # 1: @, 2: @@
    around: list[int] = field(default_factory=list)  # neighbours in written order, -1 for a written hydrogen
    hydrogens: int = 0


@dataclass
class Mol:
    atoms: list[Atom]
    bonds: dict[tuple[int, int], float]  # (low, high) -> order, 1.5 where written as aromatic
    near: list[list[int]]
    #: Double bond (low, high) -> a neighbour of each end, and whether both lie on the same side.
    geometry: dict[tuple[int, int], tuple[int, int, bool]] = field(default_factory=dict)

    def order(self, a: int, b: int) -> float:
        return self.bonds[min(a, b), max(a, b)]


def parse(text: str) -> Mol:
    atoms: list[Atom] = []
    bonds: dict[tuple[int, int], float | None] = {}
    rings: dict[int, tuple[int, float | None, int, str]] = {}
    slants: dict[tuple[int, int], int] = {}
    stack: list[int] = []
    last, bond, i, n, slash = -1, None, 0, len(text), ""
    just_opened = False

    def join(a: int, b: int, order: float | None) -> None:
        if a == b or (min(a, b), max(a, b)) in bonds:
            raise Bad("bond repeated")
        bonds[min(a, b), max(a, b)] = order

    def lean(a: int, b: int, mark: str) -> None:
        """mark: how the bond from a to b was written; "/" goes up."""
        if mark and (a, b) not in slants:
            slants[a, b], slants[b, a] = (1, -1) if mark == "/" else (-1, 1)

    def attach(atom: Atom) -> None:
        nonlocal last, bond, just_opened, slash
        atoms.append(atom)
        k = len(atoms) - 1
        if last >= 0:
            join(last, k, bond)
            lean(last, k, slash)
            atoms[last].around.append(k)
            atom.around.append(last)
        elif bond is not None:
            raise Bad("bond without an atom")
        if atom.h:
            atom.around.append(-1)
        last, bond, just_opened, slash = k, None, False, ""

    while i < n:
        ch = text[i]
        if ch == "[":
            j = text.find("]", i)
            m = BRACKET.match(text[i + 1 : j]) if j > 0 else None
            if not m:
                raise Bad("bracket atom")
            iso, sym, chi, h, q = m.groups()
            charge = 0 if not q else (len(q) if q[-1] == "+" else -len(q)) if not q[1:].isdigit() else int(q)
            name = sym.capitalize()
            if name != "*" and name not in WEIGHTS and name not in EXACT:
                raise Bad(f"element {name}")
            hs = 0 if h is None else int(h) if h else 1
            attach(Atom(name, sym[0].islower(), charge, int(iso or 0), hs, len(chi)))
            i = j + 1
        elif text[i : i + 2] in ("Cl", "Br"):
            attach(Atom(text[i : i + 2]))
            i += 2
        elif ch in "BCNOPSFI":
            attach(Atom(ch))
            i += 1
        elif ch == "*":
            attach(Atom("*"))
            i += 1
        elif ch in "bcnops":
            attach(Atom(ch.upper(), True))
            i += 1
        elif ch in ORDERS:
            if bond is not None or last < 0:
                raise Bad("bond")
            bond, slash = ORDERS[ch], ch if ch in "/\\" else ""
            i += 1
        elif ch == "(":
            if last < 0 or bond is not None:
                raise Bad("branch")
            stack.append(last)
            just_opened = True
            i += 1
        elif ch == ")":
            if not stack or bond is not None or just_opened:
                raise Bad("branch end")
            last = stack.pop()
            i += 1
        elif ch == ".":
            if last < 0 or bond is not None or stack:
                raise Bad("dot")
            last = -1
            i += 1
        elif ch.isdigit() or ch == "%":
            label = text[i + 1 : i + 3] if ch == "%" else ch
            if not label.isdigit() or (ch == "%" and len(label) < 2) or last < 0:
                raise Bad("ring label")
            k = int(label)
            if k in rings:
                a, first, at, mark = rings.pop(k)
                if first is not None and bond is not None and first != bond:
                    raise Bad("ring bond")
                join(a, last, first if first is not None else bond)
                lean(a, last, mark)
                lean(last, a, slash)
                atoms[a].around[at] = last
                atoms[last].around.append(a)
            else:
                rings[k] = (last, bond, len(atoms[last].around), slash)
                atoms[last].around.append(-2)
            bond, slash = None, ""
            i += 3 if ch == "%" else 1
        else:
            raise Bad(f"character {ch!r}")
    if rings or stack or bond is not None or not atoms or last < 0:
        raise Bad("unfinished")
    near: list[list[int]] = [[] for _ in atoms]
    whole: dict[tuple[int, int], float] = {}
    for (a, b), o in bonds.items():
        near[a].append(b)
        near[b].append(a)
        whole[a, b] = o if o is not None else 1.5 if atoms[a].aromatic and atoms[b].aromatic else 1
    mol = Mol(atoms, whole, near)
    _sanitise(mol)
    for (a, b), o in mol.bonds.items() if slants else ():
        x, y = (next((j for j in near[p] if j != q and (p, j) in slants), None) for p, q in ((a, b), (b, a)))
        if o == 2 and x is not None and y is not None:
            mol.geometry[a, b] = (x, y, slants[a, x] == slants[b, y])
    return mol


def _sanitise(mol: Mol) -> None:
    """Kekulé orders for written aromatics, hydrogens by valence; raises where either can't be."""
    in_ring = ring_bonds(mol)
    for (a, b), o in mol.bonds.items():
        if o == 1.5 and (a, b) not in in_ring:  # between two aromatic systems
            mol.bonds[a, b] = 1
    ring_atoms = {x for e in in_ring for x in e}
    need: set[int] = set()
    for k, at in enumerate(mol.atoms):
        if not at.aromatic:
            continue
        if k not in ring_atoms:
            raise Bad("aromatic atom outside rings")
        sigma = len(mol.near[k]) + (at.h or 0)
        double = any(mol.order(k, j) >= 2 for j in mol.near[k])
        if double:
            continue
        if at.symbol in ("C", "B"):
            if (at.charge == 0 or at.symbol == "C") and sigma <= 3 and at.charge >= 0 and not (at.charge == 1):
                need.add(k)
        elif at.symbol in ("N", "P", "As"):
            if (sigma == 2 and at.charge == 0 and not at.h) or (sigma == 3 and at.charge == 1):
                need.add(k)
        elif at.charge == 1 and sigma == 2:
            need.add(k)
    match: dict[int, int] = {}
    usable = {k: [j for j in mol.near[k] if j in need and mol.order(k, j) == 1.5] for k in need}
    for k in sorted(need, key=lambda k: len(usable[k])):
        if k not in match:
            free = [j for j in usable[k] if j not in match]
            if free:
                j = min(free, key=lambda j: sum(x not in match for x in usable[j]))
                match[k], match[j] = j, k
    for k in need:
        if k not in match and not _augment(k, usable, match):
            raise Bad("no Kekulé form")
    for (a, b), o in list(mol.bonds.items()):
        if o == 1.5:
            mol.bonds[a, b] = 2 if match.get(a) == b else 1
    for k, at in enumerate(mol.atoms):
        used = sum(mol.order(k, j) for j in mol.near[k])
        if at.h is not None:
            at.hydrogens = at.h
            top = VALENCES.get(at.symbol)
            if top and at.charge == 0 and used + at.h > max(top):
                raise Bad("valence")
            if at.symbol == "N" and used + at.h > 4 + (at.charge == 0):
                raise Bad("valence")
            if at.symbol == "C" and used + at.h > 4:
                raise Bad("valence")
            if at.symbol == "O" and used + at.h > 2 + max(at.charge, 0):
                raise Bad("valence")
            continue
        if at.symbol == "*":
            continue
        fit = [v for v in VALENCES[at.symbol] if v >= used]
        if not fit:
            raise Bad("valence")
        if at.symbol == "N" and used > 3:
            raise Bad("valence")
        at.hydrogens = int(fit[0] - used)


def _augment(root: int, usable: dict[int, list[int]], match: dict[int, int]) -> bool:
    """An alternating path from ``root`` to a free atom, by search over simple paths."""
    stack = [(root, (root,))]
    tries = 0
    while stack and tries < 20_000:
        k, path = stack.pop()
        tries += 1
        for j in usable[k]:
            if j in path:
                continue
            if j not in match:
                chain = [*path, j]
                for a, b in zip(chain[::2], chain[1::2], strict=True):
                    match[a], match[b] = b, a
                return True
            if match[j] not in path:
                stack.append((match[j], (*path, j, match[j])))
    return False


def ring_bonds(mol: Mol) -> set[tuple[int, int]]:
    """Bonds that lie in a ring: those that are no bridge (depth-first numbering)."""
    n = len(mol.atoms)
    seen, low, bridges = [0] * n, [0] * n, set()
    clock = 0
    for root in range(n):
        if seen[root]:
            continue
        clock += 1
        seen[root] = low[root] = clock
        stack = [(root, -1, iter(mol.near[root]))]
        while stack:
            v, parent, it = stack[-1]
            for w in it:
                if w == parent:
                    continue
                if seen[w]:
                    low[v] = min(low[v], seen[w])
                else:
                    clock += 1
                    seen[w] = low[w] = clock
                    stack.append((w, v, iter(mol.near[w])))
                    break
            else:
                stack.pop()
                if parent >= 0:
                    low[parent] = min(low[parent], low[v])
                    if low[v] > seen[parent]:
                        bridges.add((min(v, parent), max(v, parent)))
    return set(mol.bonds) - bridges


def smallest_rings(mol: Mol) -> list[list[int]]:
    """A minimum cycle basis: cycles through an atom and a bond along shortest paths, shortest first, kept while independent."""
    edges = sorted(ring_bonds(mol))
    if not edges:
        return []
    number = {e: i for i, e in enumerate(edges)}
    near: dict[int, list[int]] = {}
    for a, b in edges:
        near.setdefault(a, []).append(b)
        near.setdefault(b, []).append(a)
    want = len(edges) - len(near) + len({r for r in _roots(near).values()})
    found: dict[int, tuple[int, list[int]]] = {}
    for v in near:
        back, dist = {v: -1}, {v: 0}
        q = deque([v])
        while q:
            x = q.popleft()
            for y in near[x]:
                if y not in dist:
                    dist[y], back[y] = dist[x] + 1, x
                    q.append(y)
        for a, b in edges:
            if a not in dist or back[a] == b or back[b] == a:
                continue
            pa, pb = [a], [b]
            while pa[-1] != v:
                pa.append(back[pa[-1]])
            while pb[-1] != v:
                pb.append(back[pb[-1]])
            if set(pa) & set(pb) != {v}:
                continue
            ring = pa + pb[-2::-1]
            mask = 0
            for x, y in zip(ring, ring[1:] + ring[:1], strict=True):
                mask |= 1 << number[min(x, y), max(x, y)]
            found.setdefault(mask, (len(ring), ring))
    basis: dict[int, int] = {}
    out = []
    for mask, (_, ring) in sorted(found.items(), key=lambda e: e[1][0]):
        x = mask
        while x:
            top = x.bit_length()
            if top not in basis:
                basis[top] = x
                out.append(ring)
                break
            x ^= basis[top]
        if len(out) == want:
            break
    return out


def _roots(near: dict[int, list[int]]) -> dict[int, int]:
    root: dict[int, int] = {}
    for s in near:
        if s in root:
            continue
        root[s] = s
        q = [s]
        while q:
            for y in near[q.pop()]:
                if y not in root:
                    root[y] = s
                    q.append(y)
    return root


def fragments(mol: Mol) -> list[list[int]]:
    groups: dict[int, list[int]] = {}
    for a, r in _roots({i: x for i, x in enumerate(mol.near)}).items():
        groups.setdefault(r, []).append(a)
    return list(groups.values())


def aromatic_atoms(mol: Mol, rings: list[list[int]]) -> tuple[set[int], set[tuple[int, int]]]:
    """Atoms and bonds of rings of 5 to 7 that hold 4n + 2 electrons."""
    atoms: set[int] = set()
    bonds: set[tuple[int, int]] = set()
    for ring in rings:
        if not 5 <= len(ring) <= 7:
            continue
        inside, electrons = set(ring), 0
        for a in ring:
            at = mol.atoms[a]
            doubles = [j for j in mol.near[a] if mol.order(a, j) == 2]
            if any(mol.order(a, j) > 2 for j in mol.near[a]) or len(doubles) > 1:
                break
            if doubles:
                j = doubles[0]
                if j in inside or any(j in r and a in r for r in rings):
                    electrons += 1
                elif mol.atoms[j].symbol in ("O", "S", "N") and at.symbol == "C":
                    continue
                else:
                    break
            elif at.symbol in ("N", "O", "S", "P", "Se") and at.charge <= 0:
                electrons += 2
            elif at.symbol == "C" and at.charge == -1:
                electrons += 2
            elif at.symbol == "C" and at.charge == 1 or at.symbol == "B":
                continue
            else:
                break
        else:
            if electrons % 4 == 2:
                atoms |= inside
                bonds |= {(min(x, y), max(x, y)) for x, y in zip(ring, ring[1:] + ring[:1], strict=True)}
    return atoms, bonds


def _ranks(mol: Mol, arom: set[int], arom_bonds: set[tuple[int, int]], split: bool) -> list[int]:
    """Ranks of atoms by refinement of invariants; with ``split``, ties are broken one at a time."""
    n = len(mol.atoms)
    start = [(a.symbol, a.charge, a.isotope, a.hydrogens, len(mol.near[k]), k in arom) for k, a in enumerate(mol.atoms)]

    def dense(keys: list) -> list[int]:
        order = {x: i for i, x in enumerate(sorted(set(keys)))}
        return [order[x] for x in keys]

    kind = lambda a, b: 1.5 if (min(a, b), max(a, b)) in arom_bonds else mol.order(a, b)

    def refine(rank: list[int]) -> list[int]:
        while True:
            nxt = dense([(rank[a], tuple(sorted((rank[b], kind(a, b)) for b in mol.near[a]))) for a in range(n)])
            if len(set(nxt)) == len(set(rank)):
                return nxt
            rank = nxt

    rank = refine(dense(start))
    while split and len(set(rank)) < n:
        count = Counter(rank)
        low = min(r for r, c in count.items() if c > 1)
        one = next(a for a in range(n) if rank[a] == low)
        rank = refine(dense([2 * r - (a == one) for a, r in enumerate(rank)]))
    return rank


def _parity(a: list[int], b: list[int]) -> bool:
    """True if b is an odd permutation of a."""
    at = [a.index(x) for x in b]
    return sum(at[i] > at[j] for i in range(len(at)) for j in range(i + 1, len(at))) % 2 == 1


def canonical(mol: Mol, only: list[int] | None = None) -> str:
    rings = smallest_rings(mol)
    arom, arom_bonds = aromatic_atoms(mol, rings)
    rank = _ranks(mol, arom, arom_bonds, True)
    same = _ranks(mol, arom, arom_bonds, False)
    tight = {frozenset(e) for r in rings if len(r) < 8 for e in zip(r, r[1:] + r[:1], strict=True)}
    differ = lambda p, q: len({same[j] for j in mol.near[p] if j != q}) == len(mol.near[p]) - 1
    firm = {e for e in mol.geometry if e not in arom_bonds and frozenset(e) not in tight and differ(*e) and differ(*e[::-1])}
    parts = []
    for frag in fragments(mol) if only is None else [only]:
        parts.append(_write(mol, min(frag, key=lambda a: (len(mol.near[a]) > 1, rank[a])), rank, same, arom, arom_bonds, firm))
    return ".".join(sorted(parts))


def _slants(mol: Mol, firm: set[tuple[int, int]], parent: dict[int, int], children: dict[int, list[int]], root: int) -> dict[tuple[int, int], int]:
    """For bonds beside double bonds whose geometry counts, 1 where the way from the first to the second atom is written "/", -1 for the other mark.

    Double bonds are taken in the order in which they are written; the first mark of each group is "/"."""
    place, todo = {}, [root]
    while todo:
        a = todo.pop()
        place[a] = len(place)
        todo += reversed(children.get(a, []))
    slant: dict[tuple[int, int], int] = {}

    def beside(p: int, q: int) -> int:
        """The neighbour of p whose bond carries a mark: one that has it, else that before p, else the first behind it."""
        around = [j for j in [parent[p], *children.get(p, []), *mol.near[p]] if j >= 0 and j != q and mol.order(p, j) == 1]
        return next((j for j in around if (p, j) in slant), around[0])

    for a, b in sorted((e for e in firm if e[0] in place), key=lambda e: sorted((place[e[0]], place[e[1]]))):
        x, y, cis = mol.geometry[a, b]
        if place[a] > place[b]:
            a, b, x, y = b, a, y, x
        p, q = beside(a, b), beside(b, a)
        if (a, p) not in slant:
            up = -1 if p == parent[a] else 1
            slant[a, p], slant[p, a] = up, -up
        if (b, q) not in slant:
            up = slant[a, p] * (1 if p == x else -1) * (1 if cis else -1) * (1 if q == y else -1)
            slant[b, q], slant[q, b] = up, -up
    return slant


def _write(mol: Mol, root: int, rank: list[int], same: list[int], arom: set[int], arom_bonds: set[tuple[int, int]], firm: set[tuple[int, int]]) -> str:
    closures: dict[int, list[int]] = {}
    children: dict[int, list[int]] = {}
    seen: set[int] = set()
    parent = {root: -1}
    on: list[int] = []
    state = {root: iter(sorted(mol.near[root], key=lambda b: rank[b]))}
    seen.add(root)
    on.append(root)
    while on:
        a = on[-1]
        for b in state[a]:
            if b == parent[a]:
                continue
            if b in seen:
                if b not in closures.get(a, []) and a not in closures.get(b, []) and b not in children.get(a, []):
                    closures.setdefault(b, []).append(a)
                    closures.setdefault(a, []).append(b)
                continue
            seen.add(b)
            parent[b] = a
            children.setdefault(a, []).append(b)
            state[b] = iter(sorted(mol.near[b], key=lambda c: rank[c]))
            on.append(b)
            break
        else:
            on.pop()
    slant = _slants(mol, firm, parent, children, root) if firm else {}
    label: dict[tuple[int, int], int] = {}
    free = list(range(99, 0, -1))
    out: list[str] = []

    def symbol(a: int, order: list[int]) -> str:
        at = mol.atoms[a]
        name = at.symbol.lower() if a in arom else at.symbol
        mark = ""
        if at.chiral and len({same[b] for b in mol.near[a]}) == len(mol.near[a]) and len(mol.near[a]) + at.hydrogens >= 3 and at.hydrogens <= 1:
            written = [x for x in at.around]
            if sorted(written) == sorted(order):
                mark = "@" if (at.chiral == 1) != _parity(written, order) else "@@"
        if at.symbol == "*" and not at.charge and not at.isotope and not at.hydrogens:
            return "*"
        plain = at.symbol in VALENCES and not at.charge and not at.isotope and not mark
        if plain and (a not in arom or at.symbol in ("C", "O", "S") or at.hydrogens == 0):
            used = sum(mol.order(a, b) for b in mol.near[a])
            fit = [v for v in VALENCES[at.symbol] if v >= used]
            if fit and fit[0] - used == at.hydrogens:
                return name
        h = "" if not at.hydrogens else "H" if at.hydrogens == 1 else f"H{at.hydrogens}"
        q = "" if not at.charge else ("+" if at.charge > 0 else "-") + (str(abs(at.charge)) if abs(at.charge) > 1 else "")
        return f"[{at.isotope or ''}{name}{mark}{h}{q}]"

    def bond(a: int, b: int) -> str:
        e = (min(a, b), max(a, b))
        if e in arom_bonds:
            return ""
        o = mol.order(a, b)
        if (a, b) in slant:
            return "/" if slant[a, b] > 0 else "\\"
        return {1: "-" if a in arom and b in arom else "", 2: "=", 3: "#", 4: "$"}[int(o)]

    todo: list = [root]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            out.append(x)
            continue
        a = x
        rings = sorted(closures.get(a, []), key=lambda b: ((min(a, b), max(a, b)) not in label, rank[b]))
        kids = children.get(a, [])
        order = ([parent[a]] if parent[a] >= 0 else []) + ([-1] if mol.atoms[a].h else []) + rings + kids
        out.append(symbol(a, order))
        done = []
        for b in rings:
            e = (min(a, b), max(a, b))
            k = label.get(e)
            if k is None:
                k = label[e] = free.pop()
                out.append(bond(a, b))
            else:
                done.append(k)
            out.append(str(k) if k < 10 else f"%{k}")
        free += sorted(done, reverse=True)
        for i, b in reversed(list(enumerate(kids))):
            if i < len(kids) - 1:
                todo += [")", b, bond(a, b), "("]
            else:
                todo += [b, bond(a, b)]
    return "".join(out)


@lru_cache(maxsize=20_000)
def read(text: str) -> Mol | None:
    """The molecule, or None if the text is not valid; remembered."""
    try:
        return parse(text) if text else None
    except Bad:
        return None


def formula(mol: Mol) -> str:
    """Carbon, hydrogen, then by letter; the charge at the end."""
    c = elements(mol)
    names = [e for e in ("C", "H") if e in c] + sorted(e for e in c if e not in ("C", "H")) if "C" in c else sorted(c)
    q = sum(a.charge for a in mol.atoms)
    return "".join(e + (str(c[e]) if c[e] > 1 else "") for e in names) + ("" if not q else ("+" if q > 0 else "-") + (str(abs(q)) if abs(q) > 1 else ""))


def elements(mol: Mol) -> Counter:
    c = Counter(a.symbol for a in mol.atoms)
    h = sum(a.hydrogens for a in mol.atoms)
    if h:
        c["H"] += h
    return c


def exact_mass(mol: Mol) -> float:
    electron = 0.00054857990946
    base = sum(HEAVIER.get((a.symbol, a.isotope), float(a.isotope)) if a.isotope else EXACT.get(a.symbol, 0.0) for a in mol.atoms)
    return base + EXACT["H"] * sum(a.hydrogens for a in mol.atoms) - electron * sum(a.charge for a in mol.atoms)


def weight(mol: Mol) -> float:
    return sum(WEIGHTS.get(e, 0.0) * n for e, n in elements(mol).items())


def amides(mol: Mol) -> int:
    """Single bonds between a nitrogen and a carbon that has a double bond to oxygen."""
    n = 0
    for (a, b), o in mol.bonds.items():
        pair = {mol.atoms[a].symbol: a, mol.atoms[b].symbol: b}
        if o == 1 and set(pair) == {"C", "N"}:
            c = pair["C"]
            n += any(mol.order(c, j) == 2 and mol.atoms[j].symbol == "O" for j in mol.near[c])
    return n


def rotatable_bonds(mol: Mol) -> int:
    """Single bonds outside rings between atoms that have other heavy neighbours; bonds beside a triple bond, and of amides, do not turn."""
    inside = ring_bonds(mol)
    stiff = lambda k: any(mol.order(k, j) == 3 for j in mol.near[k])
    n = 0
    for (a, b), order in mol.bonds.items():
        if order == 1 and (a, b) not in inside and min(len(mol.near[a]), len(mol.near[b])) > 1 and not stiff(a) and not stiff(b):
            ends = {mol.atoms[a].symbol: a, mol.atoms[b].symbol: b}
            amide = set(ends) == {"C", "N"} and any(mol.order(ends["C"], j) == 2 and mol.atoms[j].symbol == "O" for j in mol.near[ends["C"]])
            n += not amide
    return n


# Surface of polar atoms (Ertl, Rohde and Selzer, 2000), by element, charge, hydrogens, and bonds as single, double, triple, aromatic.
POLAR = {
    ("N", 0, 0): {(0, 0, 1, 0): 23.79, (1, 1, 0, 0): 12.36, (0, 1, 1, 0): 13.60, (0, 0, 0, 2): 12.89, (3, 0, 0, 0): 3.24, (1, 2, 0, 0): 11.68, (0, 0, 0, 3): 4.41, (1, 0, 0, 2): 4.93, (0, 1, 0, 2): 8.39},
    ("N", 0, 1): {(0, 1, 0, 0): 23.85, (2, 0, 0, 0): 12.03, (0, 0, 0, 2): 15.79},
    ("N", 0, 2): {(1, 0, 0, 0): 26.02},
    ("N", 1, 0): {(1, 0, 1, 0): 4.36, (2, 1, 0, 0): 3.01, (0, 0, 0, 3): 4.10, (1, 0, 0, 2): 3.88, (4, 0, 0, 0): 0.0},
    ("N", 1, 1): {(1, 1, 0, 0): 13.97, (0, 0, 0, 2): 14.14, (3, 0, 0, 0): 4.44},
    ("N", 1, 2): {(0, 1, 0, 0): 25.59, (2, 0, 0, 0): 16.61},
    ("N", 1, 3): {(1, 0, 0, 0): 27.64},
    ("O", 0, 0): {(0, 1, 0, 0): 17.07, (2, 0, 0, 0): 9.23, (0, 0, 0, 2): 13.14},
    ("O", 0, 1): {(1, 0, 0, 0): 20.23},
    ("O", -1, 0): {(1, 0, 0, 0): 23.06},
}
# The same for nitrogen and oxygen in rings of three atoms.
POLAR_SMALL_RING = {("N", 0, 0): 3.01, ("N", 0, 1): 21.94, ("O", 0, 0): 12.53}


def polar_surface(mol: Mol) -> float:
    """Topological polar surface of nitrogen and oxygen atoms; environments that the table lacks count by their number of bonds and hydrogens."""
    rings = smallest_rings(mol)
    arom, bonds = aromatic_atoms(mol, rings)
    small = {x for r in rings if len(r) == 3 for x in r}
    total = 0.0
    for i, a in enumerate(mol.atoms):
        if a.symbol not in ("N", "O"):
            continue
        kinds = [0, 0, 0, 0]
        for j in mol.near[i]:
            order = mol.order(i, j)
            kinds[3 if (min(i, j), max(i, j)) in bonds or order == 1.5 else int(order) - 1] += 1
        key = (a.symbol, a.charge, a.hydrogens)
        if i in small and key in POLAR_SMALL_RING and not any(kinds[1:]):
            total += POLAR_SMALL_RING[key]
        elif tuple(kinds) in POLAR.get(key, {}):
            total += POLAR[key][tuple(kinds)]
        else:
            base, step = (30.5, 8.2) if a.symbol == "N" else (28.5, 8.6)
            total += max(0.0, base - len(mol.near[i]) * step + a.hydrogens * 1.5)
    return total


def stereo_centres(mol: Mol) -> int:
    """Atoms written as chiral whose neighbours all differ."""
    if not any(a.chiral for a in mol.atoms):
        return 0
    arom, ab = aromatic_atoms(mol, smallest_rings(mol))
    same = _ranks(mol, arom, ab, False)
    return sum(bool(a.chiral) and a.hydrogens <= 1 and len(mol.near[k]) + a.hydrogens == 4 and len({same[b] for b in mol.near[k]}) == len(mol.near[k]) for k, a in enumerate(mol.atoms))


def largest_ring(text: str) -> int:
    mol = read(text)
    return max((len(r) for r in smallest_rings(mol)), default=0) if mol else 0


def intact(text: str, least: int = LEAST_MACROCYCLE) -> bool:
    return largest_ring(text) >= least


def canonical_text(text: str) -> str | None:
    mol = read(text)
    return canonical(mol) if mol else None


def largest_fragment(text: str) -> str | None:
    """Canonical string of the fragment with most heavy atoms; the first of equals."""
    mol = read(text)
    if mol is None:
        return None
    parts = fragments(mol)
    return canonical(mol, max(parts, key=len)) if len(parts) > 1 else canonical(mol)


@lru_cache(maxsize=20_000)
def fingerprint(text: str) -> dict | None:
    """Invariants by which two strings are compared."""
    mol = read(text)
    if mol is None:
        return None
    sizes = [len(r) for r in smallest_rings(mol)]
    return {
        "formula": formula(mol), "heavy_atoms": len(mol.atoms), "exact_mass": round(exact_mass(mol), 4), "rings": len(sizes), "largest_ring": max(sizes, default=0),
        "amides": amides(mol), "stereo_centres": stereo_centres(mol), "charge": sum(a.charge for a in mol.atoms), "fragments": len(fragments(mol)),
        "mol_weight": round(weight(mol), 3), "canonical": canonical(mol), "tpsa": round(polar_surface(mol), 2), "rotatable": rotatable_bonds(mol),
    }
