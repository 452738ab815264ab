"""Counted combinations of token attributes and their Universal Dependencies features."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslake.functions.udfeats import feat_sets, feats_key

# What unparsed features and number-like values look like.
FEATURE_TEXT = r"^[a-zA-Z0-9]+=[a-zA-Z0-9]+(\|[a-zA-Z0-9]+=[a-zA-Z0-9]+)*$"
NUMBER_LIKE = r"([-+])?[0-9]+(/[0-9]*)?"


def raw_counts(
    tokens: DataFrame, attrs: Sequence[str], feats: str, line: str | None = None, times: str | None = None
) -> DataFrame:
    """``attrs.., feats, cnt`` (, ``last_line``) by raw values: a frequent combination reaches the shuffle as one row per task.

    ``times`` names how often a row occurs, if rows have been counted.
    """
    last = [F.max(line).alias("last_line")] if line else []
    count = F.coalesce(F.sum(times), F.lit(0)) if times else F.count("*")
    return tokens.groupBy(*attrs, feats).agg(count.alias("cnt"), *last)


def parsed_counts(
    raw: DataFrame, attrs: Sequence[str], feats: str, line: str | None = None, keep_featless: bool = False
) -> DataFrame:
    """``attrs.., feats, feats_key, cnt`` (, ``last_line``) of raw counts, whose features are parsed once per distinct value."""
    sets = feat_sets(F.col(feats))
    if keep_featless:
        sets = F.coalesce(sets, F.array(F.array().cast("array<struct<feat:string,value:string>>")))
    parsed = raw.select(*attrs, "cnt", *(["last_line"] if line else []), F.explode(sets).alias("feats"))
    return parsed.groupBy(*attrs, "feats").agg(
        F.sum("cnt").alias("cnt"), *([F.max("last_line").alias("last_line")] if line else [])
    ).withColumn("feats_key", feats_key(F.col("feats")))


def count_combinations(
    tokens: DataFrame,
    attrs: Sequence[str],
    feats: str,
    line: str | None = None,
    keep_featless: bool = False,
    times: str | None = None,
) -> DataFrame:
    """``attrs.., feats, feats_key, cnt`` (, ``last_line``): one row per combination.

    A token with several feature sets counts once for each; one whose features do not parse counts only with
    ``keep_featless``, as one without features.
    """
    return parsed_counts(raw_counts(tokens, attrs, feats, line, times), attrs, feats, line, keep_featless)


def looks_valid(attrs: Sequence[str], strict_numeric: bool = False) -> Column:
    """False for combinations with unparsed features or digits in a value, or with blank values only.

    ``strict_numeric`` refuses values that are numbers as a whole instead of any value with a digit.
    """
    values = [F.coalesce(F.col(a), F.lit("")) for a in attrs]
    number = f"^{NUMBER_LIKE}$" if strict_numeric else NUMBER_LIKE
    wrong = [v.rlike(FEATURE_TEXT) | F.trim(v).rlike(number) for v in values]
    blank = reduce(lambda a, b: a & b, [v.rlike(r"^\s*$") for v in values])
    return ~reduce(lambda a, b: a | b, wrong) & ~blank


def valid_only(combinations: DataFrame, attrs: Sequence[str], strict_numeric: bool = False) -> DataFrame:
    """Combinations that seem valid. Naming ``cnt`` keeps the test after the counting, once for each."""
    return combinations.where(F.when(F.col("cnt") > 0, looks_valid(attrs, strict_numeric)))


def token_tables(combinations: DataFrame, attrs: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """``livetokens(token_id, cnt, attrs..)`` and ``udfeats(token_id, feat, value)``.

    ``token_id`` is a hash of the combination, so repeated runs and retried tasks agree on it.
    """
    # A length before each value keeps (a, bc) and (ab, c) apart.
    values = [F.coalesce(F.col(c), F.lit("")) for c in [*attrs, "feats_key"]]
    token_id = F.sha2(F.concat(*[F.concat(F.length(v).cast("string"), F.lit(":"), v) for v in values]), 256)
    rows = combinations.withColumn("token_id", token_id)
    feats = rows.select("token_id", F.explode("feats").alias("f")).select("token_id", "f.feat", "f.value")
    return rows.select("token_id", "cnt", *attrs), feats
