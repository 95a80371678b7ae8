"""Table families: what differs from one family of scanned tables to the next, as two text tables and views of them."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fields that the table of every family has.
CANONICAL_FIELDS = ("kd_nm", "rt_min", "ms_mz", "lcms_method", "ms_polarity")

# Fixed values. One line for each layout: family, layout, heading rows, whether rows go on over pages, fields that a heading must name and must not
# name, and the columns from left to right as name@left-right in fractions of the width ("!": a picture; no fractions: measured from rules).
LAYOUTS = """
WO2025162428 smiles    0 no  smiles -         cmpd_id@0.00-0.10 structure!@0.11-0.56 smiles@0.58-0.99
WO2025162428 dense     0 no  kd_nm  structure cmpd_id@0.00-0.17 rt_min@0.19-0.34 ms_mz@0.35-0.50 lcms_method@0.51-0.67 ms_polarity@0.68-0.79 kd_nm@0.80-0.97
WO2025162428 activity  0 no  kd_nm  -         cmpd_id@0.00-0.09 structure!@0.10-0.48 rt_min@0.48-0.57 ms_mz@0.58-0.67 lcms_method@0.67-0.78 ms_polarity@0.79-0.88 kd_nm@0.89-1.00
WO2022251372 activity8 1 yes -      -         cmpd_id smiles mdm2 mdm4 molm13 mv4_11 waga mkl1
WO2022251372 smiles3   1 yes -      -         cmpd_id smiles structure!
"""
# Fixed values. One line for each setting of a family; a field is name=how it is read, a closed set of values stands in brackets.
SETTINGS = r"""
WO2025162428 files    *.jpg
WO2025162428 input    table_image
WO2025162428 default  activity
WO2025162428 number   \d{4}
WO2025162428 fields   kd_nm=number rt_min=number ms_mz=number lcms_method=text ms_polarity=text
WO2025162428 opens    kd_nm rt_min ms_mz
WO2025162428 route    validated_vote
WO2025162428 merge    first_valid
WO2022251372 files    *.tif *.tiff *.jpg *.jpeg *.png
WO2022251372 input    full_page
WO2022251372 default  activity8
WO2022251372 number   \d{1,2}
WO2022251372 fields   mdm2=[ABCD] mdm4=[ABCD] molm13=[ABCD] mv4_11=[ABCD] waga=[ABCD] mkl1=[ABCD]
WO2022251372 opens    mdm2 mdm4 molm13 mv4_11 waga mkl1
WO2022251372 route    padded_vote
WO2022251372 merge    prefer_structure
WO2022251372 id_top   90
WO2022251372 id_inset 4
"""


def _words(text: str, at: int) -> list[list[str]]:
    return [line.split(None, at) for line in text.strip().splitlines()]


def pick_layout(fields: Column, wanted: list[tuple[str, list[str], list[str]]]) -> Column:
    """The first of ``wanted`` (layout, fields that must be there, fields that must not) that an array of field names meets, else null."""
    arr = lambda xs: F.array(*[F.lit(x) for x in xs]).cast("array<string>")
    fits = [F.when((F.size(F.array_except(arr(need), fields)) == 0) & ~F.arrays_overlap(fields, arr(bar)), name) for name, need, bar in wanted]
    return F.coalesce(*fits, F.lit(None).cast("string"))


class Family:
    """A family's lines of both tables. ``lines`` may bring other tables of the same form."""

    def __init__(self, name: str, layouts: str = LAYOUTS, settings: str = SETTINGS):
        self.name = name
        self._lines = {x[1]: x for x in _words(layouts, 6) if x[0] == name}
        self._set = {key: value for own, key, value in _words(settings, 2) if own == name}
        if not self._lines or not self._set:
            raise KeyError(f"unknown family {name!r}; known: {', '.join(sorted({x[0] for x in _words(layouts, 6)}))}")

    def setting(self, key: str, other: str = "") -> str:
        return self._set.get(key, other)

    def words(self, key: str) -> tuple[str, ...]:
        return tuple(self.setting(key).split())

    @cached_property
    def layouts(self) -> tuple[str, ...]:
        return tuple(self._lines)

    def columns(self, layout: str) -> list[tuple[str, bool, tuple[float, float] | None]]:
        """(name, whether a picture, fractions or None) from left to right."""
        if layout not in self._lines:
            raise KeyError(f"family {self.name!r} has no layout {layout!r}, only {sorted(self._lines)}")
        out = []
        for spec in self._lines[layout][6].split():
            name, _, span = spec.partition("@")
            out.append((name.rstrip("!"), name.endswith("!"), tuple(float(x) for x in span.split("-")) if span else None))
        return out

    def headings(self, layout: str) -> int:
        return int(self._lines[layout][2])

    def goes_on(self, layout: str) -> bool:
        return self._lines[layout][3] == "yes"

    def wanted(self) -> list[tuple[str, list[str], list[str]]]:
        """Layouts that a heading can tell, in the order in which they are tried."""
        listed = lambda x: [] if x == "-" else x.split(",")
        return [(name, listed(x[4]), listed(x[5])) for name, x in self._lines.items() if x[4] != "-"]

    def readers(self) -> dict[str, str]:
        """How each measured field is read: number, text, or the letters of a closed set in brackets."""
        return dict(x.split("=") for x in self.words("fields"))

    @property
    def extras(self) -> tuple[str, ...]:
        return tuple(f for f in self.readers() if f not in CANONICAL_FIELDS)

    def by_count(self, count: int) -> str | None:
        """The layout of so many columns."""
        return next((x for x in self.layouts if len(self.columns(x)) == count), None)

    def by_fields(self, fields: set[str]) -> str | None:
        """The layout that a heading's fields tell."""
        return next((name for name, need, bar in self.wanted() if set(need) <= fields and not fields & set(bar)), None)

    def pixels(self, layout: str, width: Column) -> Column:
        """Array of struct(name, x1, x2, is_image) in pixels of a page's width; a layout measured from rules has no fractions and can't be scaled."""
        cols = self.columns(layout)
        if any(span is None for *_, span in cols):
            raise ValueError(f"layout {layout!r} is measured from ruled lines")
        return F.array(*[F.struct(F.lit(n).alias("name"), (width * span[0]).cast("int").alias("x1"), (width * span[1]).cast("int").alias("x2"), F.lit(p).alias("is_image")) for n, p, span in cols])


def layout_by_count(count: Column, family: Family) -> Column:
    """The layout of a number of columns, else null."""
    return F.try_element_at(F.create_map(*[F.lit(x) for name in family.layouts for x in (len(family.columns(name)), name)]), count)


PROFILES = {name: Family(name) for name in dict.fromkeys(x[0] for x in _words(LAYOUTS, 6))}


def profile(name: str) -> Family:
    return PROFILES[name] if name in PROFILES else Family(name)
