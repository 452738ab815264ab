"""Gaps between the occurrences of an n-gram: a summary that adds up, so that an ARF needs no token that was read before.

A part of a corpus gives, for each n-gram, how often each gap occurs between neighbours, and the ends of its runs. The gaps of
a longer corpus are those of its parts and the ones between their runs. Gaps of one n-gram that differ add up to less than the
tokens of the part, so there are at most sqrt(2 x tokens) of them, however frequent it is.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslake.operators.ngrams import HOT_RUN, rounded_arf, sorted_at_once
from corpuslake.operators.postings import Merged, summed_by_ngram


def gap_rows(occurrences: DataFrame, keys: Sequence[str], total: int | None = None, hot_run: int = HOT_RUN) -> DataFrame:
    """The summary of occurrences with ``idx``: ``keys``, ``gap``, ``n``, ``first`` and ``last``.

    A row with a gap says that it occurs ``n`` times. A row without one is a run of ``n`` occurrences from ``first`` to ``last``; an
    n-gram has one. For ``total`` and ``hot_run`` see ``count_with_arf``.
    """
    longs = [T.StructField(n, T.LongType()) for n in ("gap", "n", "first", "last")]
    schema = T.StructType([*occurrences.select(*keys).schema.fields, *longs])
    return summed_by_ngram(occurrences, keys, sorted_at_once(total, hot_run), schema, _gaps_of_many, _gaps_of_one)


def _gaps_of_many(keys: pa.Table, places: np.ndarray, of: np.ndarray) -> pa.Table:
    count = np.bincount(of, minlength=keys.num_rows)
    ends = np.cumsum(count)
    inside = of[1:] == of[:-1]
    gap, whose = np.diff(places)[inside], of[1:][inside]
    order = np.lexsort((gap, whose))
    gap, whose = gap[order], whose[order]
    begins = np.flatnonzero(np.concatenate([[True], (gap[1:] != gap[:-1]) | (whose[1:] != whose[:-1])])[: len(gap)])
    times = np.diff(np.append(begins, len(gap)))
    return _rows(keys, whose[begins], gap[begins], times, count, places[ends - count], places[ends - 1])


def _gaps_of_one(keys: pa.Table, one: Merged) -> pa.Table:
    gap, times = one.gaps()
    ends = [np.array([x], np.int64) for x in (one.count, one.first, one.last)]
    return _rows(keys, np.zeros(len(gap), np.int64), gap, times, *ends)


def _rows(
    keys: pa.Table, whose: np.ndarray, gap: np.ndarray, times: np.ndarray, count: np.ndarray, first: np.ndarray, last: np.ndarray
) -> pa.Table:
    """The run of each n-gram and the gaps of n-grams, those of one beside each other."""
    runs, gaps = keys.num_rows, len(gap)
    of = np.concatenate([np.arange(runs), whose])
    order = np.argsort(of, kind="stable")
    is_run = np.arange(runs + gaps)[order] < runs
    made = keys.take(pa.array(of[order]))
    columns = {
        "gap": (np.concatenate([np.zeros(runs, np.int64), gap]), is_run),
        "n": (np.concatenate([count, times]), None),
        "first": (np.concatenate([first, np.zeros(gaps, np.int64)]), ~is_run),
        "last": (np.concatenate([last, np.zeros(gaps, np.int64)]), ~is_run),
    }
    for name, (values, none) in columns.items():
        made = made.append_column(name, pa.array(values[order].astype(np.int64), mask=none))
    return made


def moved(rows: DataFrame, by: str) -> DataFrame:
    """The same summary further on in the corpus, by the number of tokens in the column ``by``, which goes."""
    return rows.withColumns({c: F.col(c) + F.col(by) for c in ("first", "last")}).drop(by)


def count_of_gaps(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``count`` and ``arf`` per n-gram, as ``count_with_arf`` has them, of the summaries of all parts, with ``corpus_size``.

    All rows of an n-gram come together once: as many runs as there are parts, and its gaps. Whether a gap is near
    is the same for it in each part, so it need not be summed first.
    """
    ids = ["__h", *keys]
    # The hash is made after the shuffle, for the sort alone.
    rows = rows.select(*keys, "corpus_size", "gap", "n", "first", "last").repartition(*keys).withColumn("__h", F.xxhash64(*keys))
    # Runs come before gaps, as they lie in the corpus.
    every = Window.partitionBy(*ids).orderBy(F.col("gap").isNotNull(), "first")
    whole = every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    is_run = F.col("gap").isNull()
    told = rows.select(
        *ids,
        "corpus_size",
        F.sum(F.when(is_run, F.col("n"))).over(whole).alias("count"),
        F.when(is_run, 1).otherwise(F.col("n")).alias("n"),
        # Before the first run lies the gap around the end of the corpus.
        F.coalesce(
            "gap",
            F.col("first") - F.lag("last").over(every),
            F.col("first") + F.col("corpus_size") - F.max("last").over(whole),
        ).alias("gap"),
    )
    near = F.col("gap") < F.col("corpus_size") / F.col("count")
    sums = told.groupBy(*ids).agg(
        F.first("count").alias("count"),
        F.first("corpus_size").alias("corpus_size"),
        F.coalesce(F.sum(F.when(near, F.col("gap") * F.col("n"))), F.lit(0)).alias("__near"),
        F.coalesce(F.sum(F.when(~near, F.col("n"))), F.lit(0)).alias("__far"),
    )
    return sums.select(*keys, "count", rounded_arf(F.col("__far"), F.col("__near")).alias("arf"))
