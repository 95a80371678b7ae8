"""Scalar functions over printed text: keys, numbers, brackets, repairs, censuses. All are Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Header spellings and the fields they stand for.
HEADER_FIELDS = {
    "cmpd_id": ("cmpd #", "cmpd#", "cmpd", "compound #", "compound#", "compound", "compd #", "compd"),
    "smiles": ("smiles",),
    "structure": ("structure",),
    "kd_nm": ("g12v gdp kd nm", "g12v gdp kd (nm)", "kras g12v gdp kd nm", "kras g12v gdp kd (nm)", "kd nm", "kd (nm)"),
    "rt_min": ("lcms rt (min)", "lcms rt min", "rt (min)", "rt min"),
    "ms_mz": ("ms (m/z)", "ms m/z"),
    "lcms_method": ("lcms method",),
    "ms_polarity": ("ms polarity",),
}
# Valid ranges of measurements, and names of deficit ranges by their upper bound.
NUMERIC_RANGES = {"kd_nm": (0.0001, 100000.0), "rt_min": (0.0, 30.0), "ms_mz": (0.0, 5000.0)}
DIFFICULTY = ((0, "balanced"), (2, "light"), (5, "medium"), (10, "heavy"))
DIFFICULTY_REST = "extreme"
# Characters a printed structure string may hold.
ALPHABET = "ABCDEFGHIKLMNOPRSTUVWXYZabcdefghiklmnoprstuvy=#@[]()+-/\\%.:~0123456789"
_ILLEGAL = r"[^ABCDEFGHIKLMNOPRSTUVWXYZa-ik-pr-vy=#@\[\]()+\-/\\%.:~0-9]"
_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def blank(c: Column) -> Column:
    """True for null and for text that is empty once stripped."""
    return F.coalesce(strip(c), F.lit("")) == ""


def count(c: Column, ch: str) -> Column:
    """Occurrences of one character."""
    return F.length(c) - F.length(F.replace(c, F.lit(ch), F.lit("")))


def normalise_id(c: Column) -> Column:
    """Any writing of a row key: prefix words, commas and trailing marks go; numbers lose zeros; other text is lower-cased; empty is null."""
    s = F.regexp_replace(strip(c.cast("string")), r"(?i)^(?:compound|cmpd\.?|compd\.?|#)\s*#?\s*", "")
    s = strip(F.regexp_replace(F.replace(s, F.lit(","), F.lit("")), r"[:.) ]+$", ""))
    digits = F.regexp_replace(F.regexp_replace(s, "_", ""), r"^\+?(-?)0*(\d)", "$1$2")
    number = F.when(digits == "-0", "0").otherwise(digits)
    return F.when(s.rlike(r"^[+-]?\d+(_\d+)*$"), number).when(s != "", F.lower(s))


def parse_number(c: Column, spaces: bool = False) -> Column:
    """Double from printed text: thousands commas (and spaces) are dropped; what is no number is null."""
    s = F.regexp_replace(strip(c.cast("string")), "[, ]" if spaces else ",", "")
    return F.when(s.rlike(_NUMBER), s.try_cast("double"))


def canonical_field(c: Column) -> Column:
    """Field that a header cell names, or null."""
    pairs = [F.lit(x) for field, names in HEADER_FIELDS.items() for n in names for x in (n, field)]
    return F.try_element_at(F.create_map(*pairs), F.lower(F.regexp_replace(strip(c), r"\s+", " ")))


def field_named(text: str) -> str | None:
    """canonical_field of a text outside a query."""
    key = " ".join(text.split()).lower()
    return next((f for f, names in HEADER_FIELDS.items() if key in names), None)


def bracket_deficit(c: Column) -> Column:
    """Surplus of opening over closing brackets, both kinds added up, 0 at least. Null and empty: 0."""
    s = F.coalesce(c, F.lit(""))
    return F.greatest(F.lit(0), count(s, "(") - count(s, ")") + count(s, "[") - count(s, "]"))


def bracket_deficits(c: Column) -> Column:
    """What each kind of bracket lacks, and the total of all four; differs from bracket_deficit in that kinds don't cancel."""
    p, b = count(c, "(") - count(c, ")"), count(c, "[") - count(c, "]")
    parts = [F.greatest(F.lit(0), x) for x in (-p, p, -b, b)]
    return F.struct(*[x.alias(n) for x, n in zip([*parts, sum(parts[1:], parts[0])], ("open_paren", "close_paren", "open_bracket", "close_bracket", "total"), strict=True)])


def difficulty(deficit: Column) -> Column:
    out = F.when(deficit <= DIFFICULTY[0][0], DIFFICULTY[0][1])
    for limit, name in DIFFICULTY[1:]:
        out = out.when(deficit <= limit, name)
    return out.when(deficit.isNotNull(), DIFFICULTY_REST)


def close_brackets(c: Column) -> Column:
    """The text with missing closing brackets put behind it, round ones first; null if none is missing."""
    p, b = count(c, "(") - count(c, ")"), count(c, "[") - count(c, "]")
    zero = F.lit(0)
    return F.when((p > 0) | (b > 0), F.concat(c, F.repeat(F.lit(")"), F.greatest(zero, p)), F.repeat(F.lit("]"), F.greatest(zero, b))))


def restore_chiral_bracket(c: Column) -> Column:
    """``[C@@H4`` becomes ``[C@@H]4`` for each digit that occurs elsewhere, too: a ring closure has a partner."""
    digits = F.array(*[F.lit(d) for d in "0123456789"])

    def fold(whole: Column) -> Column:
        paired = F.filter(digits, lambda d: F.length(whole) - F.length(F.replace(whole, d, F.lit(""))) >= 2)
        return F.aggregate(paired, whole, lambda s, d: F.regexp_replace(s, F.concat(F.lit(r"(\[C@{1,2}H)("), d, F.lit(")")), F.lit("$1]$2")))

    return let(c, fold)


def repair_syntax(c: Column) -> Column:
    """The steps of text repair that need no parser: stray characters, amide carbonyls, a lone zero, chiral brackets, a cut-off start."""
    s = F.regexp_replace(c, r"[^\x00-\x7F]+", "")
    s = F.replace(s, F.lit("C(O)N"), F.lit("C(=O)N"))
    s = F.regexp_replace(s, r"C\(=[0O]\)?N", "C(=O)N")
    s = F.replace(s, F.lit("C(=0)"), F.lit("C(=O)"))
    s = let(s, lambda x: F.when(count(x, "0") == 1, F.replace(x, F.lit("=0"), F.lit("=O"))).otherwise(x))
    s = restore_chiral_bracket(F.regexp_replace(s, r"(\[C@{1,2}H)\(", "$1]("))
    s = let(s, lambda x: F.when(x.startswith("H](") | x.startswith("@H]("), F.concat(F.lit("CC[C@"), x)).when(x.startswith("[C@H]("), F.concat(F.lit("CC"), x)).otherwise(x))
    return strip(s)


def rewrite_oxo(c: Column) -> Column:
    """struct(text, n): ``X-O)`` and ``X=O)`` become ``X(=O)`` unless X is ``(`` or a digit. A match that is left alone still uses up its characters."""
    safe = F.regexp_replace(c, r"([(0-9][-=])O\)", "$1\u0001O\u0002")
    damaged = r"([^\u0002\n])[-=]O\)"
    n = F.regexp_count(safe, F.lit(damaged))
    done = F.regexp_replace(safe, damaged, "$1(=O)")
    return F.struct(F.replace(F.replace(done, F.lit("\u0001"), F.lit("")), F.lit("\u0002"), F.lit(")")).alias("text"), n.alias("n"))


def lexical_prepass(c: Column) -> Column:
    """struct(text, n_chiral, n_bracket): a misread ``Ca@H]`` becomes ``[C@H]``; the rule for ``[Ca@H]`` runs on what the first leaves."""
    first = F.regexp_replace(c, r"Ca(@@?)H\]", "[C$1H]")
    return F.struct(F.regexp_replace(first, r"\[Ca(@@?)H\]", "[C$1H]").alias("text"), F.regexp_count(c, F.lit(r"Ca@@?H\]")).alias("n_chiral"), F.regexp_count(first, F.lit(r"\[Ca@@?H\]")).alias("n_bracket"))


def edit_report(c: Column) -> Column:
    """What a repair search has to know: length, insertions each bracket needs, sites of merged glyphs."""
    d = bracket_deficits(c)
    n = lambda p: F.regexp_count(c, F.lit(p))
    return F.struct(
        F.length(c).alias("length"), d["open_paren"].alias("open_paren"), d["close_paren"].alias("close_paren"), d["open_bracket"].alias("open_bracket"), d["close_bracket"].alias("close_bracket"), d["total"].alias("min_total"),
        count(c, "-").alias("hyphen"), n("a@H").alias("a_at_h"), n(r"Ca@@?H\]").alias("ca_chiral"), n(r"-\)").alias("hyphen_before_close"), n(r"=[ONS]\)").alias("bare_equals_close"),
    )


def bond_count(c: Column) -> Column:
    return count(c, "=") + count(c, "#")


def legal(c: Column) -> Column:
    """Every character may occur in a printed structure string."""
    return ~c.rlike(_ILLEGAL)


def illegal_characters(c: Column) -> Column:
    """Distinct characters that may not occur, in order of code point."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(c, F.lit(f"({_ILLEGAL})"), 1)))


def balanced(c: Column) -> Column:
    return (count(c, "(") == count(c, ")")) & (count(c, "[") == count(c, "]"))


def outside_brackets(c: Column) -> Column:
    return F.regexp_replace(c, r"\[[^\]]*\]", "")


def ring_closures(c: Column) -> Column:
    """Labels of ring closures outside square brackets, %nn as one, digits 1 to 9, in order."""
    return F.transform(F.regexp_extract_all(outside_brackets(c), F.lit(r"(%\d\d|[1-9])"), 1), lambda x: F.replace(x, F.lit("%"), F.lit("")))


def ring_digits(c: Column) -> Column:
    """As ring_closures, with 0, and % and two digits kept as one token."""
    return F.regexp_extract_all(outside_brackets(c), F.lit(r"(%\d\d|[0-9])"), 1)


def tally(labels: Column) -> Column:
    """Map from each value of a short array to how often it is there."""
    keys = F.array_sort(F.array_distinct(labels))
    return F.map_from_arrays(keys, F.transform(keys, lambda k: F.size(F.filter(labels, lambda x: x == k))))


def cer(reference: Column, reading: Column) -> Column:
    """Edits for each character of the reference; an empty reference: 0 if nothing was read, else 1."""
    n = F.length(reference)
    return F.when(n > 0, F.levenshtein(reference, reading) / n).otherwise(F.when(F.length(reading) > 0, 1.0).otherwise(0.0))


def context(c: Column, index: Column, width: int) -> Column:
    """Up to ``width`` characters on either side of a place (from 0)."""
    lo = F.greatest(F.lit(0), index - width)
    return F.substring(c, lo + 1, index + width + 1 - lo)


def comparison_key(c: Column) -> Column:
    """Readings that differ in white space or case only are the same."""
    return F.upper(F.regexp_replace(c, r"\s+", ""))


def typed_key(c: Column, numeric: Column) -> Column:
    """The number, if the field is numeric and the text is one; else the comparison key."""
    v = parse_number(c, spaces=True)
    return F.when(numeric & v.isNotNull(), F.concat(F.lit("number:"), v.cast("string"))).otherwise(F.concat(F.lit("text:"), comparison_key(c)))


def formula_counts(c: Column) -> Column:
    """Map element -> atoms of a formula; a repeated element adds up."""
    symbols = F.regexp_extract_all(c, F.lit(r"([A-Z][a-z]?)(\d*)"), 1)
    numbers = F.transform(F.regexp_extract_all(c, F.lit(r"([A-Z][a-z]?)(\d*)"), 2), lambda x: F.when(x == "", 1).otherwise(x.try_cast("int")))
    keys = F.array_distinct(symbols)
    pairs = F.arrays_zip(symbols.alias("s"), numbers.alias("n"))
    return F.map_from_arrays(keys, F.transform(keys, lambda k: F.aggregate(F.filter(pairs, lambda p: p["s"] == k), F.lit(0), lambda s, p: s + p["n"])))


def top_level_parts(c: Column) -> Column:
    """Split at dots that lie outside round and square brackets: a fold over characters with the depth."""
    chars = F.filter(F.split(c, ""), lambda x: x != "")
    zero = F.struct(F.lit(0).alias("d"), F.lit("").alias("cur"), F.expr("cast(array() as array<string>)").alias("out"))

    def step(s, x):
        d = s["d"] + F.when(x.isin("(", "["), 1).when(x.isin(")", "]"), -1).otherwise(0)
        cut = (x == ".") & (s["d"] == 0)
        return F.struct(d.alias("d"), F.when(cut, "").otherwise(F.concat(s["cur"], x)).alias("cur"), F.when(cut, F.concat(s["out"], F.array(s["cur"]))).otherwise(s["out"]).alias("out"))

    return F.aggregate(chars, zero, step, lambda s: F.filter(F.concat(s["out"], F.array(s["cur"])), lambda p: p != ""))


def first_char_class(c: Column) -> Column:
    x = F.substring(c, 1, 1)
    return F.when(F.coalesce(c, F.lit("")) == "", "missing").when(x == "=", "equals").when(x == "-", "minus").otherwise("other")


def digest12(c: Column) -> Column:
    return F.substring(F.sha1(F.encode(c, "utf-8")), 1, 12)


def range_flags(values: dict[str, Column]) -> Column:
    """Array of flag texts of the fields whose number lies outside its range; null and NaN raise none."""
    flags = []
    for name, v in values.items():
        lo, hi = NUMERIC_RANGES[name]
        ok = v.isNotNull() & ~F.isnan(v)
        flags.append(F.when(ok & (v < lo), F.format_string(f"{name} below range (%.4f < {lo:.4f})", v)).when(ok & (v > hi), F.format_string(f"{name} above range (%.4f > {hi:.4f})", v)))
    return F.array_compact(F.array(*flags))


def quality_word(range_flags_: Column, broken: Column) -> Column:
    return F.when(F.size(range_flags_) > 0, "partial").when(broken, "macrocycle_broken").otherwise("ok")


def damage(c: Column, drop: str, count_: int, seed: int = 0) -> Column:
    """The text without ``count_`` of the characters that ``drop`` names: those whose places have the least keyed digests."""
    chars = F.filter(F.split(c, ""), lambda x: x != "")

    def cut(all_: Column) -> Column:
        places = F.filter(F.transform(all_, lambda x, i: F.when(F.lit(drop).contains(x), i).otherwise(-1)), lambda i: i >= 0)
        ranked = F.array_sort(F.transform(places, lambda i: F.struct(F.md5(F.concat_ws("|", F.lit(str(seed)), i.cast("string"))).alias("r"), i.alias("i"))))
        gone = F.transform(F.slice(ranked, 1, max(count_, 0)), lambda x: x["i"]) if count_ > 0 else F.array().cast("array<int>")
        kept = F.filter(F.transform(all_, lambda x, i: F.struct(x.alias("x"), i.alias("i"))), lambda s: ~F.array_contains(gone, s["i"]))
        return F.array_join(F.transform(kept, lambda s: s["x"]), "")

    return let(chars, cut)


def substitute(c: Column, variants: dict[str, str]) -> Column:
    """Each wording replaced by its other one, with the text's line ends kept: compared with plain ones, written back as they were. A text that
    holds the other wording already stays; one that holds neither gives null."""
    windows = c.contains("\r\n")
    out, ok = F.replace(c, F.lit("\r\n"), F.lit("\n")), F.lit(True)
    for old, new in variants.items():
        ok = ok & (out.contains(old) | out.contains(new))
        out = F.replace(out, F.lit(old), F.lit(new))
    return F.when(ok, F.when(windows, F.replace(out, F.lit("\n"), F.lit("\r\n"))).otherwise(out))
