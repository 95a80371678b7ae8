"""A prefix automaton for structure strings: says after each character whether the text can still become valid.

It knows syntax only (brackets, branches, bonds, ring labels), not valence. States are small tuples, so a
search can keep thousands of them.
"""

from __future__ import annotations

import re
from typing import NamedTuple

BONDS = set("-=#$:/\\~")
ORGANIC1 = set("BCNOPSFIbcnops*")
_SYMBOL = r"(?:[A-Z][a-z]?|[bcnops]|se|as|\*)"
_INSIDE = re.compile(rf"^\d*(?:$|[as]$|{_SYMBOL}@{{0,2}}(?:$|(?:TH?|AL?|SP?|TB?|OH?)\d{{0,2}}$|(?:(?:TH|AL|SP|TB|OH)\d{{1,2}})?(?:H\d*)?(?:\+{{1,4}}|-{{1,4}}|[+-]\d*)?(?::\d*)?$))")
_WHOLE = re.compile(rf"^\d*{_SYMBOL}@{{0,2}}(?:(?:TH|AL|SP|TB|OH)\d{{1,2}})?(?:H\d*)?(?:\+{{1,4}}|-{{1,4}}|[+-]\d+)?(?::\d+)?$")


class State(NamedTuple):
    """prev: '' at the start, 'atom', 'bond', 'open', 'close', 'dot'; inside: text of an open square bracket, or None."""

    prev: str = ""
    depth: int = 0
    inside: str | None = None
    rings: frozenset[str] = frozenset()
    percent: str | None = None
    letter: str = ""  # a C or B that an l or r may follow


START = State()


def advance(s: State, ch: str) -> State | None:
    if s.inside is not None:
        if ch == "]":
            return s._replace(prev="atom", inside=None, letter="") if _WHOLE.match(s.inside) else None
        text = s.inside + ch
        return s._replace(inside=text) if _INSIDE.match(text) else None
    if s.percent is not None:
        if not ch.isdigit():
            return None
        if len(s.percent) == 0:
            return s._replace(percent=ch)
        return _ring(s._replace(percent=None), s.percent + ch)
    if s.letter and (s.letter, ch) in (("C", "l"), ("B", "r")):
        return s._replace(letter="")
    atomic = s.prev in ("", "atom", "bond", "open", "close", "dot")
    if ch == "[":
        return s._replace(inside="", letter="") if atomic else None
    if ch in ORGANIC1:
        return s._replace(prev="atom", letter=ch if ch in "CB" else "")
    if ch in BONDS:
        return s._replace(prev="bond", letter="") if s.prev in ("atom", "close", "open") else None
    if ch.isdigit():
        return _ring(s, ch) if s.prev in ("atom", "close", "bond") else None
    if ch == "%":
        return s._replace(percent="", letter="") if s.prev in ("atom", "bond", "close") else None
    if ch == "(":
        return s._replace(prev="open", depth=s.depth + 1, letter="") if s.prev in ("atom", "close") else None
    if ch == ")":
        return s._replace(prev="close", depth=s.depth - 1, letter="") if s.depth > 0 and s.prev in ("atom", "close") else None
    if ch == ".":
        return s._replace(prev="dot", letter="") if s.depth == 0 and s.prev in ("atom", "close") else None
    return None


def _ring(s: State, label: str) -> State:
    key = str(int(label))
    return s._replace(prev="atom", rings=s.rings ^ {key}, letter="")


def complete(s: State) -> bool:
    return s.inside is None and s.percent is None and s.depth == 0 and not s.rings and s.prev in ("atom", "close")


def run(text: str, s: State | None = START) -> State | None:
    for ch in text:
        if s is None:
            return None
        s = advance(s, ch)
    return s


def first_violation(text: str) -> int | None:
    """Place of the first character that cannot be; the length if the text is merely unfinished; None if it is complete."""
    s: State | None = START
    for i, ch in enumerate(text):
        s = advance(s, ch)  # type: ignore[arg-type]
        if s is None:
            return i
    return None if complete(s) else len(text)


def grammatical(text: str) -> bool:
    s = run(text)
    return s is not None and complete(s)
