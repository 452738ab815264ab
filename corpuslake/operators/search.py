"""Filtered search and faceted values over the livetokens tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Filters = Mapping[str, str | Sequence[str]]


def _values(v: str | Sequence[str]) -> list[str]:
    return [v] if isinstance(v, str) else list(v)


def named_values(filters: Filters | Sequence[tuple[str, str]] | None) -> list[tuple[str, list[str]]]:
    """Names with the values they may have; a name without values tests nothing."""
    pairs = filters.items() if isinstance(filters, Mapping) else (filters or [])
    return [(name, _values(v)) for name, v in pairs if _values(v)]


def attr_filter(filters: Filters | None) -> Column:
    """All attributes must match; an attribute matches any of its values, and anything if it has none."""
    tests = [F.col(a).isin(v) for a, v in named_values(filters)]
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def _feat_tests(filters: Filters | Sequence[tuple[str, str]] | None) -> list[Column]:
    return [(F.col("feat") == f) & F.col("value").isin(v) for f, v in named_values(filters)]


def _filtered(tokens: DataFrame, feats: DataFrame, attrs: Filters | None, feat_filter) -> DataFrame:
    """Tokens that pass. Each test reads only the features it names, which the stored order of ``feats`` lets a scan find."""
    kept = tokens.where(attr_filter(attrs))
    for test in _feat_tests(feat_filter):
        kept = kept.join(feats.where(test).select("token_id"), "token_id", "left_semi")
    return kept


def with_feats(tokens: DataFrame, feats: DataFrame) -> DataFrame:
    """Tokens with ``feats``, the sorted array of their features; those without any go. A token has few features."""
    attrs = [c for c in tokens.columns if c != "token_id"]
    return tokens.join(feats, "token_id").groupBy("token_id").agg(
        *[F.first(a).alias(a) for a in attrs], F.array_sort(F.collect_list(F.struct("feat", "value"))).alias("feats")
    )


def search_tokens(
    tokens: DataFrame,
    feats: DataFrame,
    attrs: Filters | None = None,
    feat_filter: Filters | Sequence[tuple[str, str]] | None = None,
) -> DataFrame:
    """Matching tokens with ``cnt``, attributes, ``udfeats`` (``A=x|B=y``) and ``feats``.

    Tokens without features do not match. Features are put together for the matching tokens only.
    """
    found = with_feats(_filtered(tokens, feats, attrs, feat_filter), feats)
    text = F.array_join(F.transform("feats", lambda p: F.concat(p["feat"], F.lit("="), p["value"])), "|")
    return found.withColumn("udfeats", text).drop("token_id")


def feats_map(feats: Column) -> Column:
    """Features as a map; of a repeated name the last value counts."""
    names = F.transform(feats, lambda p: p["feat"])
    last = F.filter(feats, lambda p, i: ~F.array_contains(F.slice(names, i + 2, F.size(names)), p["feat"]))
    return F.map_from_entries(last)


def total(matches: DataFrame) -> DataFrame:
    return matches.agg(F.count("*").alias("total"))


def attr_values(
    tokens: DataFrame, feats: DataFrame, names: Sequence[str], attrs: Filters | None = None, feat_filter=None
) -> DataFrame:
    """``name, value``: distinct values of each attribute under the filters, sorted.

    Values stay rows, since an attribute such as the word form has no bound on them.
    """
    kept = _filtered(tokens, feats, attrs, feat_filter)
    pairs = F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).alias("value")) for n in names])
    return kept.select(F.inline(pairs)).where("value is not null").distinct().orderBy("name", "value")


def feat_values(tokens: DataFrame, feats: DataFrame, attrs: Filters | None = None, feat_filter=None) -> DataFrame:
    """``feat, value``: distinct features under the filters, sorted."""
    kept = _filtered(tokens, feats, attrs, feat_filter).select("token_id")
    return feats.join(kept, "token_id", "left_semi").select("feat", "value").distinct().orderBy("feat", "value")


def available_values(
    tokens: DataFrame, feats: DataFrame, names: Sequence[str], attrs: Filters | None = None, feat_filter=None, keep=None
) -> DataFrame:
    """``kind, name, value`` over attributes (``attr``) and features (``feat``); ``keep`` may store the filtered tokens."""
    kept = _filtered(tokens, feats, attrs, feat_filter)
    kept = keep(kept) if keep else kept
    a = attr_values(kept, feats, names).select(F.lit("attr").alias("kind"), "name", "value")
    f = feat_values(kept, feats).select(F.lit("feat").alias("kind"), F.col("feat").alias("name"), "value")
    return a.unionByName(f)
