"""Chemical formulas: groups with multipliers to shares of elements."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_PART = re.compile(r"([A-Z][a-z]?)|([(\[{])|([)\]}])")
_AMOUNT = re.compile(r"\d+(?:\.\d+)?|\.\d+")
_LEADING = re.compile(r"(\d+(?:\.\d+)?)([A-Z][a-z]?)")
_SIMPLE = re.compile(r"([A-Z][a-z]?\d*)+")
#: The elements.
ELEMENTS = frozenset(
    "H He Li Be B C N O F Ne Na Mg Al Si P S Cl Ar K Ca Sc Ti V Cr Mn Fe Co Ni Cu Zn Ga Ge As Se Br Kr Rb Sr Y Zr Nb Mo Tc Ru Rh Pd Ag Cd In Sn Sb Te I Xe Cs Ba La Ce Pr Nd Pm Sm Eu Gd Tb Dy "
    "Ho Er Tm Yb Lu Hf Ta W Re Os Ir Pt Au Hg Tl Pb Bi Po At Rn Fr Ra Ac Th Pa U Np Pu Am Cm Bk Cf Es Fm Md No Lr Rf Db Sg Bh Hs Mt Ds Rg Cn Nh Fl Mc Lv Ts Og D T".split()
)


class BadFormula(ValueError):
    pass


def _as_amounts(own: dict[str, float], times: float | None, body: str) -> dict[str, float]:
    """A group of an alloy: a multiplier after elements with whole numbers is the group's share, else it multiplies."""
    if times is None or not _SIMPLE.fullmatch(body):
        return {e: v * (1.0 if times is None else times) for e, v in own.items()}
    total = sum(own.values())
    return {e: round(v / total * times, 3) for e, v in own.items()} if total else own


def _as_shares(own: dict[str, float], times: float | None, body: str) -> dict[str, float]:
    """A group whose elements share its multiplier, 1 if it has none, at every level."""
    total = sum(own.values())
    return {e: v / total * (1.0 if times is None else times) for e, v in own.items()} if total else own


def parse(formula: str, group=_as_shares) -> dict[str, float]:
    """Amounts by element; `group` says what a bracket with its multiplier amounts to."""
    stack: list[tuple[dict[str, float], int]] = [({}, 0)]
    at = 0
    while at < len(formula):
        m = _PART.match(formula, at)
        if not m or m[1] and m[1] not in ELEMENTS:
            raise BadFormula(formula)
        at = m.end()
        if m[2]:
            stack.append(({}, at))
            continue
        number = _AMOUNT.match(formula, at)
        times = float(number[0]) if number else None
        if m[1]:
            own = {m[1]: 1.0 if times is None else times}
        else:
            if len(stack) == 1:
                raise BadFormula(formula)
            inner, start = stack.pop()
            own = group(inner, times, formula[start : m.start()])
        at = number.end() if number else at
        for element, amount in own.items():
            stack[-1][0][element] = stack[-1][0].get(element, 0.0) + amount
    if len(stack) != 1:
        raise BadFormula(formula)
    return stack[0][0]


def _text(own: dict[str, float], target: float) -> str | None:
    total = sum(own.values())
    return " ".join(f"{e}{round(own[e] / total * target, 3):g}" for e in sorted(own)) if total else None


def normalise(formula: str | None, target: float = 100.0, least: int = 1) -> str | None:
    """Amounts to `target` (atomic per cent), three places, by symbol: "(CoCrNi)94Al6" is "Al6 Co31.333 Cr31.333 Ni31.333".

    Dashes go; a formula that begins with a number has its amounts before the symbols ("5Al10Ti"); null if it does not
    parse or has fewer than `least` elements.
    """
    plain = re.sub(r"[\s–-]", "", formula or "")
    try:
        own = parse(_LEADING.sub(r"\2\1", plain) if plain[:1].isdigit() else plain, _as_amounts)
    except BadFormula:
        return None
    return _text(own, target) if len(own) >= least else None


def normalise_share(formula: str | None, least: int = 3) -> str | None:
    """Shares of 1, with nested groups; null for what a single hyphen parts (doped), for fewer than `least` elements or if it does not parse."""
    parts = re.sub(r"\s", "", formula or "").split("-")
    if len(parts) == 2:
        return None
    try:
        own = parse("".join(parts))
    except BadFormula:
        return None
    return _text(own, 1.0) if len(own) >= least else None


@F.pandas_udf(T.StringType())
def normalise_formula(formulas: pd.Series) -> pd.Series:
    known = {f: normalise(f) for f in formulas.unique()}
    return formulas.map(known).astype(object)


@F.pandas_udf(T.StringType())
def normalise_material(formulas: pd.Series) -> pd.Series:
    known = {f: normalise_share(f) for f in formulas.unique()}
    return formulas.map(known).astype(object)


def n_elements(normalised: Column) -> Column:
    """Elements of a normalised composition; null stays null."""
    return F.when(normalised.isNotNull(), F.size(F.split(normalised, " ")))
