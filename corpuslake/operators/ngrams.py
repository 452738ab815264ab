"""N-grams over token columns: occurrences, counts, average reduced frequency, the frequency table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslake.config import NgramSpec
from corpuslake.functions.modifiers import Modifier, modifier_chain
from corpuslake.functions.text import initial_cap, long_to_null, ngram_hash
from corpuslake.operators.postings import Merged, summed_by_ngram
from corpuslake.sources.tables import BREAK, bare

ARF_OFF = -1.0
# Tokens in one window of the row form below; each block also sees the last tokens of the one before.
BLOCK = 1 << 16
# Occurrences of one n-gram that are put in order at once.
HOT_RUN = 1 << 23
# At most this many n-grams can have more than a 1/HOT_KEYS share of all occurrences.
HOT_KEYS = 200_000


def _words(texts: DataFrame, size: int, keep: Sequence[str], tokens: str) -> DataFrame:
    """``w0, w1, ..`` of each occurrence in token arrays and ``at``, the place of its first token, beside ``keep``."""
    arr, names = F.col(tokens), [f"w{j}" for j in range(size)]
    starts = F.slice(arr, 1, F.greatest(F.size(arr) - (size - 1), F.lit(0)))
    rows = texts.select(*keep, arr.alias("__arr"), F.posexplode(starts).alias("at", "w0"))
    rows = rows.withColumns({n: F.get("__arr", F.col("at") + j) for j, n in enumerate(names) if j})
    for n in names[1:]:
        rows = rows.where(~F.col(n).startswith(BREAK))
    return rows.select(*keep, "at", bare(F.col("w0")).alias("w0"), *names[1:])


def _column_texts(size: int, columns: Mapping[str, Modifier]) -> list[Column]:
    return [F.concat_ws(" ", *[fn(F.col(f"w{j}")) for j in range(size)]).alias(c) for c, fn in columns.items()]


def from_arrays(
    texts: DataFrame,
    size: int,
    columns: Mapping[str, Modifier],
    keep: Sequence[str] = ("corpus_id",),
    base: str | None = None,
    tokens: str = "tokens",
) -> DataFrame:
    """Occurrences from token arrays (see ``text_tokens``), each text where it lies: nothing is moved.

    ``columns`` maps an output column to how its value is made of a token. With ``base`` (the tokens
    before the text) an occurrence gets ``idx``, the corpus index of its last token.
    """
    rows = _words(texts, size, [*keep, *([base] if base else [])], tokens)
    idx = [(F.col(base) + F.col("at") + (size - 1)).alias("idx")] if base else []
    return rows.select(*keep, *_column_texts(size, columns), *idx)


def count_from_arrays(
    texts: DataFrame, size: int, columns: Mapping[str, Modifier], keep: Sequence[str] = ("corpus_id",), tokens: str = "tokens"
) -> DataFrame:
    """``count_ngrams`` of ``from_arrays``. Words are counted first, so the columns' values are made once for n-grams of the same words."""
    words = [f"w{j}" for j in range(size)]
    raw = count_ngrams(_words(texts, size, keep, tokens), [*keep, *words])
    made = raw.select(*keep, *_column_texts(size, columns), "count")
    return made.groupBy(*keep, *columns).agg(F.coalesce(F.sum("count"), F.lit(0)).alias("count"))


def from_rows(
    tokens: DataFrame, size: int, columns: Mapping[str, Column], keep: Sequence[str] = ("corpus_id",), block: int = BLOCK
) -> DataFrame:
    """Occurrences from token rows ``tok_idx`` (dense in a corpus), ``segment`` and their columns.

    Windows are blocks of ``tok_idx``, so a segment of any length is cut; the last tokens of a block
    are also given to the next one.
    """
    if size > block:
        raise ValueError("a block must hold an n-gram")
    idx = F.col("tok_idx")
    home = F.floor(idx / block)
    shared = F.pmod(idx, F.lit(block)) >= block - (size - 1)
    rows = tokens.select(
        *keep,
        "tok_idx",
        "segment",
        *[e.alias(c) for c, e in columns.items()],
        F.explode(F.when(shared, F.array(home, home + 1)).otherwise(F.array(home))).alias("__block"),
    )
    w = Window.partitionBy("__block", "corpus_id").orderBy("tok_idx")
    parts = {
        c: F.concat_ws(" ", *[F.lag(c, j).over(w) for j in range(size - 1, 0, -1)], F.col(c)) for c in columns
    }
    # Segments only grow, so the first token tells whether all are of one segment.
    whole = F.lag("segment", size - 1).over(w) == F.col("segment") if size > 1 else F.lit(True)
    grams = rows.select(
        *keep, *[e.alias(c) for c, e in parts.items()], idx.alias("idx"), "__block", whole.alias("__whole")
    )
    return grams.where(F.col("__whole") & (F.floor(F.col("idx") / block) == F.col("__block"))).drop("__block", "__whole")


def count_ngrams(occurrences: DataFrame, keys: Sequence[str]) -> DataFrame:
    return occurrences.groupBy(*keys).agg(F.count("*").alias("count"))


def hot_ngrams(occurrences: DataFrame, keys: Sequence[str], more_than: int) -> DataFrame:
    """N-grams with over so many occurrences, and their ``count``.

    Hashes are counted first, as they are much shorter than the keys. Fewer than occurrences / ``more_than`` of them are over the bound, so
    the n-grams they stand for are told by a broadcast and counted exactly.
    """
    hashed = occurrences.select(*keys, F.xxhash64(*keys).alias("__h"))
    often = hashed.groupBy("__h").agg(F.count("*").alias("__n")).where(F.col("__n") > more_than).select("__h")
    return count_ngrams(hashed.join(F.broadcast(often), "__h", "left_semi"), keys).where(F.col("count") > more_than)


def rounded_arf(far: Column, near: Column) -> Column:
    """ARF from the number of gaps of at least v and the sum of the others, beside ``count`` and ``corpus_size``."""
    arf = far + near.cast("double") * F.col("count") / F.col("corpus_size")
    return F.floor(arf * 1000 + 0.5) / F.lit(1000.0)


def sorted_at_once(total: int | None, hot_run: int) -> int:
    """Occurrences up to which those of one n-gram are put in order at once: fewer than HOT_KEYS n-grams can have more."""
    return max(hot_run, (total or 0) // HOT_KEYS)


def _arf_of_many(keys: pa.Table, places: np.ndarray, of: np.ndarray) -> pa.Table:
    size, count = keys.column("corpus_size").to_numpy(), np.bincount(of, minlength=keys.num_rows)
    ends = np.cumsum(count)
    first, last = places[ends - count], places[ends - 1]
    inside = of[1:] == of[:-1]
    gap, whose = np.diff(places)[inside], of[1:][inside]
    near = gap < (size / count)[whose]
    # Sums of whole numbers below 2**53 are exact.
    sums = np.bincount(whose[near], gap[near], keys.num_rows).astype(np.int64)
    return _arf_rows(keys, count, sums, np.bincount(whose[~near], minlength=keys.num_rows), first + size - last)


def _arf_of_one(keys: pa.Table, one: Merged) -> pa.Table:
    gap, times = one.gaps()
    near = gap < keys.column("corpus_size")[0].as_py() / one.count
    sums, far = (gap * times)[near].sum(), times[~near].sum()
    around = one.first + keys.column("corpus_size")[0].as_py() - one.last
    return _arf_rows(keys, *[np.array([x], np.int64) for x in (one.count, sums, far, around)])


def _arf_rows(keys: pa.Table, count: np.ndarray, near: np.ndarray, far: np.ndarray, around: np.ndarray) -> pa.Table:
    """``around`` is the gap that closes the circle."""
    closing = around < keys.column("corpus_size").to_numpy() / count
    made = {"count": count, "__near": near + np.where(closing, around, 0), "__far": far + ~closing}
    for name, values in made.items():
        keys = keys.append_column(name, pa.array(values.astype(np.int64)))
    return keys


def count_with_arf(
    occurrences: DataFrame, keys: Sequence[str], total: int | None = None, hot_run: int = HOT_RUN
) -> DataFrame:
    """``count`` and ``arf`` per n-gram of occurrences with ``idx`` and ``corpus_size``, which is the same for equal keys.

    With v = corpus_size / count, ARF is the mean over the gaps d between occurrences, taken as a
    circle, of min(v, d) / v. It is put together from two whole numbers, the gaps d >= v and the sum
    of the others, so the result does not depend on the order of summing.

    The gaps need the occurrences of an n-gram in order. They are shuffled as lists of places (``postings``). An n-gram with over
    ``hot_run`` of them (or over a 1/HOT_KEYS share of ``total``, so fewer than HOT_KEYS n-grams) is split, and its lists are merged.
    """
    ids, longs = [*keys, "corpus_size"], ("count", "__near", "__far")
    rows = occurrences.withColumn("corpus_size", F.col("corpus_size").cast("long"))
    fields = [*rows.select(*ids).schema.fields, *[T.StructField(n, T.LongType()) for n in longs]]
    sums = summed_by_ngram(rows, ids, sorted_at_once(total, hot_run), T.StructType(fields), _arf_of_many, _arf_of_one)
    return sums.select(*keys, "count", rounded_arf(F.col("__far"), F.col("__near")).alias("arf"))


def frequency_table(counts: DataFrame, spec: NgramSpec) -> DataFrame:
    """The stored form of counts: over-long texts as NULL, hash, initial capital, n-gram size.

    ``hash_id`` has no separator between columns and does not cover the corpus; the key of the table
    is (``corpus_id``, ``ngram_size``, columns).
    """
    texts = [F.col(n) for n in spec.names]
    lemma = spec.by_role("lemma")
    return counts.select(
        *[long_to_null(t).alias(n) for t, n in zip(texts, spec.names)],
        ngram_hash(texts).alias("hash_id"),
        "corpus_id",
        "count",
        (F.col("arf") if "arf" in counts.columns else F.lit(ARF_OFF)).alias("arf"),
        (initial_cap(F.col(lemma.name)) if lemma else F.lit(False)).alias("initial_cap"),
        F.lit(spec.size).cast("int").alias("ngram_size"),
    )


def modified(spec: NgramSpec, column: Mapping[int, Modifier]) -> dict[str, Modifier]:
    """Output column -> how its value is made of a token: the column's own rule, then its modifiers."""

    def through(made: Modifier, chain: Modifier) -> Modifier:
        return lambda token: chain(made(token))

    return {c.name: through(column[c.idx], modifier_chain(c.modifier)) for c in spec.columns}


def per_million(count: Column, corpus_size: Column) -> Column:
    return count * 1e6 / corpus_size


def long_columns(counts: DataFrame, names: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """One row per n-gram and column: ``col_idx`` and ``text``."""
    entries = F.array(*[F.struct(F.lit(i).alias("col_idx"), F.col(n).alias("text")) for i, n in enumerate(names)])
    return counts.select(*keep, F.inline(entries))


def fold_columns(names: Sequence[str], start: Column, step) -> Column:
    """Fold ``step(acc, text, i)`` over the column texts of an n-gram."""
    acc = start
    for i, n in enumerate(names):
        acc = step(acc, F.col(n), i)
    return acc


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct values; the sort is by ranges, over all partitions."""
    return df.select(column).distinct().orderBy(column)
