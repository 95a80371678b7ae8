"""Reading cells with models that come from outside: recognisers of one line, detectors of boxes, routes over them.

A recogniser takes the grey picture of one printed line and gives its text; a detector gives boxes with texts for a whole cell.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np

from ..chem.search import vote
from . import imaging as I

Recognise = Callable[[np.ndarray], str]
Detect = Callable[[np.ndarray], tuple[list, list]]
ROUTES = ("production", "validated", "padded", "validated_vote", "padded_vote")


def line_pictures(cell: np.ndarray, pad: int = 0) -> list[np.ndarray]:
    """Each printed line of a cell, without table rules, cut to its ink, enlarged, with a white margin of ``pad``."""
    clean = I.strip_vertical_rules(cell)
    out = []
    for top, bottom in I.ink_bands(clean):
        band = clean[max(0, top - 2) : bottom + 3]
        left, right = I.text_span(band, height=cell.shape[0])
        cut = I.upscale(band[:, max(0, left - 2) : right + 3])
        out.append(np.pad(cut, pad, constant_values=255) if pad else cut)
    return out


@dataclass
class Reader:
    """``first`` and ``second`` read lines; ``detect`` and ``detect2`` find boxes in a cell. What is missing gives no reading."""

    first: Recognise
    second: Recognise | None = None
    detect: Detect | None = None
    detect2: Detect | None = None
    padding: int = 12

    def lines(self, cell: np.ndarray, recognise: Recognise | None = None, pad: int = 0) -> list[str]:
        return [(recognise or self.first)(p).strip() for p in line_pictures(cell, pad)]

    def activity(self, cell: np.ndarray) -> list[tuple[str, str, int]]:
        """(source, text, boxes) of a measured value: the whole crop, its lines, and what each detector finds, in reading order."""
        out = []
        left, right = I.text_span(I.strip_vertical_rules(cell))
        whole = self.first(np.pad(I.upscale(I.strip_horizontal_rules(cell[:, left : right + 1])), self.padding, constant_values=255)).strip()
        out.append(("crop", whole, 1))
        lines = [x for x in self.lines(cell) if x]
        out.append(("line", " ".join(lines), len(lines)))
        for name, detect in (("ch", self.detect), ("en", self.detect2)):
            if detect:
                parts = I.reading_order(*detect(cell))
                out.append((name, " ".join(parts), len(parts)))
        return [(s, t, n) for s, t, n in out if t]

    def printed(self, cell: np.ndarray, route: str = "validated_vote") -> str:
        """A string printed over several lines. production: boxes by the middle of their height; validated and padded: ink lines; _vote: a second recogniser settles what makes the text invalid."""
        if route not in ROUTES:
            raise ValueError(f"unknown route {route!r}; known: {', '.join(ROUTES)}")
        if route == "production":
            if not self.detect:
                return ""
            boxes, texts = self.detect(cell)
            middle = [float(np.mean([p[1] for p in b])) for b in boxes]
            return "".join(texts[i].strip() for i in sorted(range(len(texts)), key=lambda i: middle[i]))
        pad = self.padding if route.startswith("padded") else 0
        one = self.lines(cell, pad=pad)
        if not route.endswith("_vote") or not self.second:
            return "".join(one)
        return vote(one, self.lines(cell, self.second, pad))["text"]

    def identifier(self, cell: np.ndarray, pattern: str, top: int | None = None, inset: int = 0) -> str | None:
        """The first word of a cell that is a row's number: the ink alone, then the whole cell, by one recogniser and then the other.
        ``top`` rows are looked at, without ``inset`` columns at either side."""
        cell = cell[:top, inset : cell.shape[1] - inset]
        if not cell.size:
            return None
        for picture in (I.trim_to_content(cell), cell):
            for read in (self.first, self.second):
                for word in read(I.upscale(picture)).split() if read else ():
                    if re.fullmatch(pattern, word):
                        return word
        return None

    def grade(self, cell: np.ndarray, allowed: tuple[str, ...]) -> str | None:
        """A value of a closed set: the glyph alone, then the whole cell; a reading outside the set is none."""
        glyph = I.isolate_glyph(cell)
        for picture in ([np.pad(I.upscale(glyph), self.padding, constant_values=255)] if glyph is not None else []) + [cell]:
            for read in (self.first, self.second):
                text = read(picture).strip().upper() if read else ""
                if text in allowed:
                    return text
        return None


def widen_last(columns: list[tuple[int, int]], borders: list[int], width: int) -> list[tuple[int, int]]:
    """The last column's right edge goes out to the last border, and over it, if that lies beyond."""
    if not columns or not borders or max(borders) <= columns[-1][1]:
        return columns
    return [*columns[:-1], (columns[-1][0], min(width, max(borders) + 1))]


def snap(columns: list[tuple[int, int]], borders: list[int], within: int = 90) -> list[tuple[int, int]]:
    """Each edge goes to the nearest border within a distance, the first of equals."""

    def near(x: int) -> int:
        best = min(borders, key=lambda b: abs(b - x), default=x)
        return best if abs(best - x) <= within else x

    return [(near(a), near(b)) for a, b in columns]
