"""Normalisers for extracted values, as Column expressions: units, temperatures, strains, names, phases."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Factors to the target unit.
GRAIN_UM = {"nm": 1e-3, "µm": 1.0, "μm": 1.0, "um": 1.0, "mm": 1e3, "m": 1e6}
STRENGTH_MPA = {"pa": 1e-6, "kpa": 1e-3, "mpa": 1.0, "gpa": 1e3, "psi": 0.00689476, "ksi": 6.89476, "n/mm2": 1.0, "nmm2": 1.0, "bar": 0.1}
SOLID, INTERMETALLIC = ("FCC", "BCC", "HCP"), ("L12", "B2", "Laves", "IM")
#: The patterns of values with units, and of the units themselves.
_UNIT = r"\s*([a-zA-Zµμ°]+.*?)$"
_NUM = r"(\d+\.?\d*)"
_PM = r"\s*\+-\s*\d+\.?\d*"
#: Tried in this order; the first that matches decides.
VALUE_PATTERNS = [("pm", _NUM + _PM + _UNIT), ("ineq", r"[<>]=?\s*" + _NUM + _UNIT), ("approx", r"~\s*" + _NUM + _UNIT), ("plain", _NUM + _UNIT)]
STRENGTH_UNIT = "(?i)(pa|kpa|mpa|gpa|psi|ksi|n/?mm2|bar)"
GRAIN_UNIT = "(?i)(µm|nm|μm|mm|um|m)"
RANGE = _NUM + r"\s*-\s*" + _NUM + _UNIT


def _number(c: Column, pattern: str, group: int) -> Column:
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit("")).try_cast("double")


def plain_characters(c: Column) -> Column:
    """Dashes, approximation, plus-minus and comparison signs in ASCII."""
    c = F.translate(F.trim(c), "−–—‐‑‒―≈≃∼⁓＞＜×·⋅÷", "-------~~~~><***/")
    for sign, text in (("±", "+-"), ("≥", ">="), ("≧", ">="), ("≤", "<="), ("≦", "<=")):
        c = F.replace(c, F.lit(sign), F.lit(text))
    return c


def _value(value: Column, unit: Column) -> Column:
    return F.named_struct(F.lit("value"), value, F.lit("unit"), unit)


def once(c: Column, then) -> Column:
    """then(c) with c worked out once, however often then names it; written out, the expression would be repeated, and the code made
    of it grows beyond what one method can hold."""
    return F.transform(F.array(c), then)[0]


def value_unit(c: Column) -> Column:
    """struct(value, unit) of "10-20 nm" (mean), "15 ± 2 nm", "> 30 nm", "~15 µm", "3.5µm"; null if nothing parses."""
    return once(plain_characters(c), _parsed)


def _parsed(s: Column) -> Column:
    low, high = _number(s, RANGE, 1), _number(s, RANGE, 2)
    tries = [F.when(low.isNotNull() & high.isNotNull(), _value((low + high) / 2, F.trim(F.regexp_extract(s, RANGE, 3))))]
    for _, p in VALUE_PATTERNS:
        v = _number(s, p, 1)
        tries.append(F.when(v.isNotNull(), _value(v, F.trim(F.regexp_extract(s, p, 2)))))
    return F.coalesce(*tries)


def _factor(unit: Column, table: dict[str, float]) -> Column:
    return F.try_element_at(F.create_map(*(F.lit(x) for kv in table.items() for x in kv)), unit)


def grain_size_um(c: Column) -> Column:
    """Grain size in µm; the unit found is looked up with its own case, so "NM" gives null."""
    unit = lambda v: F.nullif(F.regexp_extract(v["unit"], GRAIN_UNIT, 1), F.lit(""))
    return once(value_unit(c), lambda v: v["value"] * _factor(unit(v), GRAIN_UM))


def strength_mpa(c: Column) -> Column:
    unit = lambda v: F.nullif(F.lower(F.regexp_extract(v["unit"], STRENGTH_UNIT, 1)), F.lit(""))
    return once(value_unit(c), lambda v: v["value"] * _factor(unit(v), STRENGTH_MPA))


def temperature_c(c: Column) -> Column:
    """°C from C, K or F; room temperature and ambient are 25; a number with a unit comes first."""
    p = r"(?i)(-?\d+\.?\d*)\s*(°?\s*[ckf])"
    v, unit = _number(c, p, 1), F.lower(F.regexp_replace(F.regexp_extract(c, p, 2), r"[°\s]", ""))
    return F.when(unit == "c", v).when(unit == "k", v - 273.15).when(unit == "f", (v - 32) * 5.0 / 9.0).when(c.rlike("(?i)room temperature|ambient"), 25.0)


def temperature_int(c: Column) -> Column:
    """The other temperature rule: first number, first run of other characters as unit, K less 273, truncated."""
    v, unit = _number(c, r"(\d+(\.\d+)?)", 1), F.trim(F.regexp_extract(c, r"([^\d.]+)", 1))
    return F.when(F.regexp_extract(c, r"([^\d.]+)", 1) != "", F.when(unit == "K", v - 273).otherwise(v).cast("int"))


def strain(c: Column) -> Column:
    """Per cent stay per cent; bare numbers above 1 are taken times 100."""
    v = _number(c, r"(-?\d+\.?\d*)\s*%?", 1)
    return F.when(c.contains("%"), v).when(v > 1.0, v * 100.0).otherwise(v)


def strain_rate(c: Column, mode: str = "compat") -> Column:
    """compat takes the first plain number ("1 x 10^-4" is 1.0, a dot sign is an exponent sign); fixed reads the power of ten."""
    s = F.replace(F.replace(F.trim(c), F.lit("×"), F.lit("x")), F.lit("·"), F.lit("e" if mode == "compat" else "x"))
    plain = _number(s, r"([+-]?\d+(?:\.\d+)?(?:[eE][+-]?\d+)?)", 1)
    if mode == "compat":
        return plain
    power = r"([+-]?\d+(?:\.\d+)?)\s*[xX]\s*10\^?([+-]?\d+)"
    return F.coalesce(_number(s, power, 1) * F.pow(F.lit(10.0), _number(s, power, 2)), plain)


def composition_key(c: Column) -> Column:
    return F.regexp_replace(F.trim(F.coalesce(c, F.lit(""))), r"\s+", "")


def label_key(c: Column) -> Column:
    return F.regexp_replace(F.trim(F.regexp_replace(F.trim(F.coalesce(c, F.lit(""))), ",+$", "")), r"\s+", " ")


def first_spellings(words: Column) -> Column:
    """Case-insensitive distinct, first spelling and order kept."""
    keep = lambda acc, x: F.when(F.exists(acc, lambda y: F.lower(y) == F.lower(x)), acc).otherwise(F.concat(acc, F.array(x)))
    return F.aggregate(words, F.array().cast("array<string>"), keep)


def processing_key(words: Column) -> Column:
    """Processing keywords: degree sign and blanks before C, h and min removed, blanks collapsed, distinct."""
    def one(x: Column) -> Column:
        x = F.regexp_replace(F.replace(F.trim(x), F.lit("°"), F.lit("")), r"(\d)\s+(C|h|min)\b", "$1$2")
        return F.regexp_replace(x, r"\s+", " ")

    return first_spellings(F.filter(F.transform(F.coalesce(words, F.array().cast("array<string>")), one), lambda x: x != ""))


#: Fixed values: (name, pattern), in order.
PHASES = [
    ("FCC", r"(?i)a1|fcc|f\.c\.c|face(\s|-)?centered(\s|-)?cubic|𝛾(?!')|austenitic"), ("BCC", r"(?i)a2|bcc|b\.c\.c|body(\s|-)?centered(\s|-)?cubic|𝛽"),
    ("HCP", r"(?i)hcp|h\.c\.p|hexagonal(\s|-)?close(\s|-)?packed"), ("Laves", "(?i)laves"), ("B2", "(?i)b2"), ("L12", "(?i)l12"),
    ("AM", "(?i)amorphous|am"), ("IM", "(?i)im|𝜎|TiC|b2|laves|l12|intermetallic|sigma|𝜇"),
]


def phase_name(c: Column) -> Column:
    """Standard phase name; ordered FCC and BCC are L12 and B2; unknown names stay."""
    out = None
    for name, pattern in PHASES:
        value = F.lit(name)
        if name in ("FCC", "BCC"):
            other, mark = ("L12", "l12") if name == "FCC" else ("B2", "b2")
            value = F.when(c.rlike(f"(?i)order|{mark}"), other).otherwise(name)
        out = F.when(c.rlike(pattern), value) if out is None else out.when(c.rlike(pattern), value)
    return out.otherwise(c)


def _any_of(phases: Column, names: tuple[str, ...]) -> Column:
    return F.exists(phases, lambda p: p.isin(*names))


def phase_class(phases: Column) -> Column:
    """SS, IM, SS+IM or null."""
    ss, im = _any_of(phases, SOLID), _any_of(phases, INTERMETALLIC)
    return F.when(ss & im, "SS+IM").when(ss, "SS").when(im, "IM")


def solid_signature(phases: Column) -> Column:
    """Solid-solution phases joined in the order FCC, BCC, HCP, repeats kept; null with any other phase."""
    only = lambda name: F.filter(phases, lambda p: p == name)
    parts = F.flatten(F.array(*(only(name) for name in SOLID)))
    return F.when(F.forall(phases, lambda p: p.isin(*SOLID)), F.array_join(parts, "+"))


def row_class(phases: Column) -> Column:
    """ss, im, ss+im or unknown; falls through to null."""
    unknown = phases.isNull() | (F.size(phases) == 0) | F.exists(phases, lambda p: p.isin("Other", "AM"))
    kind = phase_class(F.transform(phases, lambda p: F.when(p == "SS", "FCC").otherwise(p)))
    return F.when(unknown, "unknown").otherwise(F.lower(kind))


def melted_route(steps: Column, melting: list[str], allowed: list[str] | None = None) -> Column:
    """First step is a melting method and every later one allowed, by containment either way, lower-cased (allowed None: first step only)."""
    def among(x: Column, names: list[str]) -> Column:
        out = F.lit(False)
        for n in names:
            out = out | x.contains(n.lower()) | F.contains(F.lit(n.lower()), x)
        return out

    low = F.transform(steps, lambda s: F.lower(s))
    first = F.coalesce(among(F.try_element_at(low, F.lit(1)), melting), F.lit(False))
    if allowed is None:
        return first
    return first & F.forall(F.slice(low, 2, F.greatest(F.size(low), F.lit(1))), lambda s: among(s, allowed))


#: Melting routes.
MELTING, CASTING = "(?i)(induction|arc|levitation) melting", "(?i)cast"


def any_melting(steps: Column, casting: bool = True) -> Column:
    """Whether any step is melting by induction, arc or levitation, or (casting) a cast; null and empty lists have none."""
    one = lambda p: p.rlike(MELTING) | (p.rlike(CASTING) if casting else F.lit(False))
    return F.coalesce(F.exists(steps, one), F.lit(False))


def only_melting(steps: Column, casting: bool = True) -> Column:
    """any_melting of a route of exactly one step."""
    return F.coalesce(F.size(steps) == 1, F.lit(False)) & any_melting(steps, casting)


#: Spellings of gases. The look-up is lower-cased, so the upper-case keys never match; kept as they are.
GASES = {"methane": "CH4", "C1": "CH4", "ethane": "C2H6", "C2": "C2H6", "ethylene": "C2H4", "propane": "C3H6", "C3": "C3H6"}


def gas_name(c: Column) -> Column:
    return F.coalesce(_factor(F.lower(c), GASES), c)


def atomic_composition(c: Column) -> Column:
    """The formula of a composition marked "@at"; composites and weight compositions give null."""
    parts = F.split(c, "@at")
    return F.when(c.contains("@at") & (F.element_at(parts, 2) == ""), F.element_at(parts, 1))


def title_level(c: Column) -> Column:
    """h2 for "1 Introduction", h3 for "1.1 Samples"."""
    return F.when(c.rlike(r"^\d(?!\.)"), "h2").when(c.rlike(r"^\d\.\d"), "h3")
