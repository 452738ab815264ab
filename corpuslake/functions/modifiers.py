"""Named string modifiers of token columns; a modifier is a function from Column to Column."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

Modifier = Callable[[Column], Column]

# Penn Treebank tag -> one-letter word class; any other tag is X.
PENN_CLASS = {
    "CC": "J",
    "CD": "C",
    "DT": "X",
    "EX": "X",
    "FW": "X",
    "IN": "R",
    "JJ": "A",
    "JJR": "A",
    "JJS": "A",
    "LS": "X",
    "MD": "X",
    "NN": "N",
    "NNS": "N",
    "NNP": "X",
    "NNPS": "X",
    "PDT": "X",
    "POS": "X",
    "PRP": "P",
    "PRP$": "P",
    "RB": "D",
    "RBR": "D",
    "RBS": "D",
    "RP": "T",
    "SYM": "X",
    "TO": "X",
    "UH": "I",
    "VB": "V",
    "VBD": "V",
    "VBG": "V",
    "VBN": "V",
    "VBP": "V",
    "VBZ": "V",
    "WDT": "V",
    "WP": "P",
    "WP$": "P",
    "WRB": "D",
}


def first_char(c: Column) -> Column:
    return F.substring(c, 1, 1)


def penn_class(c: Column) -> Column:
    table = F.create_map(*[F.lit(v) for pair in PENN_CLASS.items() for v in pair])
    return F.coalesce(F.try_element_at(table, c), F.lit("X"))


def identity(c: Column) -> Column:
    return c


_registry: dict[str, Modifier] = {
    "": identity,
    "identity": identity,
    "toLower": F.lower,
    "firstChar": first_char,
    "cs_cnc2020": first_char,
    "cs_cnc2000": first_char,
    "cs_cnc2000_spk": first_char,
    "penn": penn_class,
}


def register_modifier(name: str, fn: Modifier) -> None:
    if ":" in name:
        raise ValueError("a modifier name may not contain ':'")
    _registry[name] = fn


def modifier_chain(spec: str | None) -> Modifier:
    """``"a:b"`` applies ``a``, then ``b``. An unknown name is an error here, before anything runs."""
    names = (spec or "").split(":")
    unknown = [n for n in names if n not in _registry]
    if unknown:
        raise ValueError(f"unknown modifier(s): {', '.join(unknown)}")
    return lambda c: reduce(lambda acc, n: _registry[n](acc), names, c)
