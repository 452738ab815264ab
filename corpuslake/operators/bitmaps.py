"""An inverted index of token attributes and features: bitmaps over dense ids, so that filters and facets read no token.

The bitmap of an attribute's or a feature's value is cut into words of 64 ids. A word is a row, and words without a bit are none, so
a value of one token takes one row and a value of all tokens a 64th of theirs. Filters are bit operations on words of equal number,
totals and facets are counts of bits; all of it combines in each task before a shuffle by word.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslake.operators.dense import dense_ids
from corpuslake.operators.search import Filters, named_values

_WORD_BITS = 6
ATTR, FEAT = "attr", "feat"
# Two bitmaps beside those of values: all tokens, and those that have features.
_EVERY, _ALL, _FEATURED = "every", "tokens", "featured"


def _word(at: Column) -> Column:
    return F.shiftright(at, _WORD_BITS)


def _place(at: Column) -> Column:
    return at.bitwiseAND((1 << _WORD_BITS) - 1).cast("int")


def entries_of(combinations: DataFrame, attrs: Sequence[str], keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``id, cnt, attrs.., feats_key, feats``: counted combinations, numbered in the order of their attributes and features.

    Features stay with their row, so that matching rows need no join to be put together.
    """
    rows = combinations.select("cnt", *attrs, "feats_key", "feats")
    return dense_ids(rows, [*attrs, "feats_key"], keep).select("id", "cnt", *attrs, "feats_key", "feats")


def bitmaps_of(entries: DataFrame, attrs: Sequence[str]) -> DataFrame:
    """``kind, name, value, word, bits``. A null attribute has no bitmap."""

    def pair(kind: str, name: Column, value: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), name.alias("name"), value.alias("value"))

    every = [pair(_EVERY, F.lit(_ALL), F.lit(""))]
    feats = F.coalesce("feats", F.array().cast("array<struct<feat:string,value:string>>"))
    featured = F.when(F.size(feats) > 0, F.lit(_FEATURED))
    fixed = F.array(*every, pair(_EVERY, featured, F.lit("")), *[pair(ATTR, F.lit(a), F.col(a)) for a in attrs])
    pairs = F.concat(fixed, F.transform(feats, lambda f: pair(FEAT, f["feat"], f["value"])))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), _place(F.col("id")))
    rows = entries.select(_word(F.col("id")).alias("word"), bit.alias("bit"), F.inline(pairs))
    rows = rows.where("name is not null and value is not null")
    return rows.groupBy("kind", "name", "value", "word").agg(F.bit_or("bit").alias("bits"))


def sorted_bitmaps(bitmaps: DataFrame) -> DataFrame:
    """Bitmaps as they should be stored: a filter finds its values by the statistics of row groups, a frequent value is in many files."""
    order = ["kind", "name", "value", "word"]
    return bitmaps.repartitionByRange(*order).sortWithinPartitions(*order)


@dataclass(frozen=True)
class SearchIndex:
    """Stored ``entries_of`` and ``bitmaps_of``. Filters mean the same as in ``search``: all must match, each one of its values."""

    entries: DataFrame
    bitmaps: DataFrame

    def matches(self, attrs: Filters | None = None, feat_filter=None, featured: bool = False) -> DataFrame:
        """``word, bits`` of the tokens that pass; with ``featured``, of those that have any feature."""
        tests = [self._test(ATTR, n, v) for n, v in named_values(attrs)]
        by_feat = [self._test(FEAT, n, v) for n, v in named_values(feat_filter)]
        if featured and not by_feat:
            tests.append(self._test(_EVERY, _FEATURED, [""]))
        tests = tests + by_feat or [self._test(_EVERY, _ALL, [""])]
        read = self.bitmaps.where(reduce(lambda a, b: a | b, tests))
        # The words of one test's values are united; a word that a test lacks is null and so is what it meets.
        united = read.groupBy("word").agg(*[F.bit_or(F.when(t, F.col("bits"))).alias(f"b{i}") for i, t in enumerate(tests)])
        common = reduce(lambda a, b: a.bitwiseAND(b), [F.col(f"b{i}") for i in range(len(tests))])
        return united.select("word", common.alias("bits")).where("bits != 0")

    @staticmethod
    def _test(kind: str, name: str, values: Sequence[str]) -> Column:
        return (F.col("kind") == kind) & (F.col("name") == name) & F.col("value").isin(list(values))

    def search(self, attrs: Filters | None = None, feat_filter=None) -> DataFrame:
        """Matching entries; as in ``search.search_tokens``, tokens without features do not match."""
        found = self.matches(attrs, feat_filter, featured=True).withColumnRenamed("word", "__word")
        # How many words match decides whether they are broadcast (Spark's own threshold) or joined by sorting.
        at = F.col("id")
        hit = F.call_function("getbit", F.col("bits"), _place(at)) == 1
        return self.entries.join(found, (_word(at) == F.col("__word")) & hit).drop("__word", "bits")

    def total(self, attrs: Filters | None = None, feat_filter=None) -> DataFrame:
        """``total``: how many entries ``search`` would find."""
        count = F.coalesce(F.sum(F.bit_count("bits")), F.lit(0).cast("long"))
        return self.matches(attrs, feat_filter, featured=True).agg(count.alias("total"))

    def _facet(self, wanted: Column, matches: DataFrame) -> DataFrame:
        found = matches.withColumnRenamed("bits", "__found")
        hit = self.bitmaps.where(wanted).join(found, "word").withColumn("hit", F.col("bits").bitwiseAND(F.col("__found")))
        return hit.where("hit != 0").groupBy("kind", "name", "value").agg(F.sum(F.bit_count("hit")).alias("n"))

    def facets(self, names: Sequence[str], attrs: Filters | None = None, feat_filter=None, feats: bool = True) -> DataFrame:
        """``kind, name, value, n`` under the filters: values of attributes (``attr``) and, with ``feats``, of features (``feat``),
        with the number of matching entries that have them."""
        wanted = (F.col("kind") == ATTR) & F.col("name").isin(list(names))
        if feats:
            wanted = wanted | (F.col("kind") == FEAT)
        return self._facet(wanted, self.matches(attrs, feat_filter))
