"""Column helpers and connected components, shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslake.stages import Stages

#: ASCII white space: the blank, and tab to carriage return.
BLANKS = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BLOCK = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, also where ``body`` uses it inside a lambda."""
    return F.transform(F.array(value), body)[0]


def whole_text(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def up_to(n: Column) -> Column:
    """0, 1, ... n - 1; empty for no n over 0."""
    return F.when(n > 0, F.sequence(F.lit(0), (n - 1).cast("int"))).otherwise(F.array().cast("array<int>"))


_LOWER_BYTES = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], np.uint8)


def words_of(texts: pa.Array, inside: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """(the words of all texts in order with A-Z in lower case, the number of the text that each is in).

    A word is a run of bytes that ``inside`` (256 booleans) marks. The texts hold no nulls.
    """
    texts = texts.cast(pa.large_binary())
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data else np.empty(0, np.uint8)
    ends = ends - ends[0]
    within = np.zeros(len(data) + 2, bool)
    within[1:-1] = inside[data]
    cut = np.zeros(len(data) + 1, bool)  # between two texts
    cut[ends] = True
    first = np.flatnonzero(within[1:-1] & (~within[:-2] | cut[:-1]))
    last = np.flatnonzero(within[1:-1] & (~within[2:] | cut[1:]))
    offsets = np.concatenate([[0], np.cumsum(last - first + 1)]).astype(np.int64)
    packed = _LOWER_BYTES[data[within[1:-1]]]
    words = pa.Array.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(packed)])
    return words, np.searchsorted(ends, first, side="right") - 1


def running(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """What ``combine`` (a sum or a maximum of bigints from 0 up) makes of all values before each one.

    Within blocks first and then over the blocks, so that the growing arrays stay short.
    """
    none = F.array().cast("array<bigint>")

    def scan(block):
        def step(acc, v):
            return F.struct(
                combine(acc["last"], v).alias("last"), F.concat(acc["out"], F.array(acc["last"])).alias("out")
            )

        return F.aggregate(block, F.struct(F.lit(0).cast("bigint").alias("last"), none.alias("out")), step)

    def blocks(v):
        return F.transform(
            up_to(F.ceil(F.size(v) / F.lit(_BLOCK))), lambda b: scan(F.slice(v, b * _BLOCK + 1, F.lit(_BLOCK)))
        )

    def joined(parts):
        before = scan(F.transform(parts, lambda p: p["last"]))["out"]
        return let(
            before,
            lambda base: F.flatten(
                F.transform(parts, lambda p, i: F.transform(p["out"], lambda x: combine(F.get(base, i), x)))
            ),
        )

    return let(values, lambda v: F.when(F.size(v) == 0, none).otherwise(let(blocks(v), joined)))


def connected(edges: DataFrame, stages: Stages, hot: int = 100_000) -> DataFrame:
    """``node, root`` for every node of ``edges`` (bigints a, b): the smallest node that links reach from it.

    Large-star and small-star steps in turn, each an aggregation and a join; the edges are written after each
    round. Rounds grow with the logarithm of the longest path. No edges: no rows.

    A node with over ``hot`` neighbours (or over a 1/100,000 share of all, so that there are few of them) gets its smallest
    neighbour by a broadcast, so that its edges stay where they are.
    """

    def towards_smallest(pairs: DataFrame, own: bool, limit: int | None) -> DataFrame:
        """Each pair's ``v`` is tied to the smallest neighbour of ``u`` (or ``u`` itself)."""
        least = pairs.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        least = least.select("u", F.least("u", "m").alias("m"), "n")
        if limit is None:
            tied = pairs.join(least, "u")
        else:
            # Fewer than 200,000 rows, by the choice of the limit.
            few = F.broadcast(least.where(F.col("n") > limit).select("u", F.col("m").alias("hot_m")))
            told = pairs.join(few, "u", "left")
            rest = told.where("hot_m is null").join(least, "u").select("u", "v", "m")
            tied = told.where("hot_m is not null").select("u", "v", F.col("hot_m").alias("m")).union(rest)
        if own:
            return tied.select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select("u", "m"))
        return tied.where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))

    now = stages.keep(
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    n, mark = now.count(), None
    while True:
        limit = max(hot, n // 50_000) if n > hot else None
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(now.select("b", "a"))
        large = towards_smallest(both, False, limit)
        down = large.select(F.col("a").alias("u"), F.col("b").alias("v"))
        small = towards_smallest(down, True, limit).where(F.col("a") != F.col("b")).distinct()
        now = stages.keep(small)
        found = now.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")
        ).first()
        if mark == found:
            break
        n, mark = found["n"], found
    roots = now.select(F.col("b").alias("node")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        roots.select("node", F.col("node").alias("root"))
    )
