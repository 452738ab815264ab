"""Corpus analytics as Spark jobs: text-unit metadata, n-gram frequencies and token attribute counts."""

from corpuslake.config import NgramSpec, SelfJoin, StructureSpec, TokenAttr, VertColumn

__all__ = ["NgramSpec", "SelfJoin", "StructureSpec", "TokenAttr", "VertColumn"]
