"""Small column expressions shared by the tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: longest stored n-gram text in bytes.
MAX_NGRAM_BYTES = 127


def empty_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def long_to_null(c: Column) -> Column:
    return F.when(F.octet_length(c) <= MAX_NGRAM_BYTES, c)


def initial_cap(c: Column) -> Column:
    return c.rlike(r"^\p{Lu}")


def ngram_hash(texts: Sequence[Column]) -> Column:
    """SHA-1 over the column texts put together without a separator."""
    return F.sha1(F.concat(*texts))
