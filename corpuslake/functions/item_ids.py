"""Generators of ``item_id`` from structural attributes; NULL where the arguments do not allow one."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

Generator = Callable[[Sequence[Column]], Column]


def _all_present(args: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, [a.isNotNull() for a in args], F.lit(True))


def identity(args: Sequence[Column]) -> Column:
    return F.when(_all_present(args), F.concat_ws("_", *args))


def intercorp(args: Sequence[Column]) -> Column:
    """The first argument without its two-letter language prefix."""
    return F.when(_all_present(args) & (F.length(args[0]) >= 2), args[0].substr(F.lit(3), F.length(args[0])))


def empty(args: Sequence[Column]) -> Column:
    return F.lit("")


_registry: dict[str, Generator] = {"identity": identity, "intercorp": intercorp, "empty": empty}


def register_item_id(name: str, fn: Generator) -> None:
    _registry[name] = fn


def item_id_names() -> list[str]:
    return sorted(_registry)


def item_id(name: str, args: Sequence[Column]) -> Column:
    """NULL marks arguments the generator refuses; the empty string is a valid id, stored as NULL."""
    if name not in _registry:
        raise ValueError(f"unknown item id generator: {name}")
    return _registry[name](list(args))
