"""Plain arguments of the jobs, checked when they are made."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field


@dataclass(frozen=True)
class VertColumn:
    """A token column to count: its position in the line, a modifier chain and an optional role."""

    idx: int
    modifier: str = ""
    role: str = ""

    @property
    def name(self) -> str:
        return f"col{self.idx}"


@dataclass(frozen=True)
class NgramSpec:
    size: int
    columns: Sequence[VertColumn]
    arf: bool = False

    def __post_init__(self):
        if self.size < 1:
            raise ValueError("n-gram size must be at least 1")
        if not self.columns:
            raise ValueError("at least one token column is needed")
        if len({c.idx for c in self.columns}) != len(self.columns):
            raise ValueError("each token column may be listed once")

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    def by_role(self, role: str) -> VertColumn | None:
        return next((c for c in self.columns if c.role == role), None)


@dataclass(frozen=True)
class StructureSpec:
    """Structural attributes to keep, and the structures that give one metadata row each.

    ``nested=True`` asks for properly nested structures; otherwise they may overlap, but a structure
    may not be open twice.
    """

    structures: Mapping[str, Sequence[str]]
    atom: str
    parent: str | None = None
    nested: bool = False

    def __post_init__(self):
        if not self.atom:
            raise ValueError("an atom structure is needed")
        if self.parent == self.atom:
            raise ValueError("atom and parent must differ")

    @property
    def columns(self) -> list[tuple[str, str, str]]:
        """(structure, attribute, output column) in the given order."""
        return [(s, a, f"{s}_{a}") for s, attrs in self.structures.items() for a in attrs]

    @property
    def names(self) -> list[str]:
        return [c for _, _, c in self.columns]


@dataclass(frozen=True)
class SelfJoin:
    """How to make ``item_id``, the key on which rows of aligned corpora meet."""

    generator: str
    args: Sequence[str] = field(default_factory=tuple)


@dataclass(frozen=True)
class TokenAttr:
    name: str
    idx: int
    ud_feats: bool = False


def plain_attrs(attrs: Sequence[TokenAttr]) -> list[TokenAttr]:
    return [a for a in attrs if not a.ud_feats]


def feats_attr(attrs: Sequence[TokenAttr]) -> TokenAttr | None:
    found = [a for a in attrs if a.ud_feats]
    if len(found) > 1:
        raise ValueError("only one attribute may hold UD features")
    return found[0] if found else None
