"""SimHash fingerprints, and exact linking of those that differ in few bits over a vantage-point tree.

A node of the tree has a vantage fingerprint and a median distance: fingerprints nearer than the median go one way, the
others the other way. Two fingerprints that differ in at most r bits have distances to the vantage that differ by at most r
(triangle inequality), so a fingerprint in the further half is also sent to the nearer one as a guest if it lies within r
of the median, and a guest follows both ways where it must. Each leaf is a shard that is searched on its own, by a tree of its own
vantage points.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from corpuslake.llm.common import connected, whole_text
from corpuslake.llm.linking import grid, roots, unite
from corpuslake.stages import Stages

_CHUNK = 1 << 15  # shingles whose bits are counted at once
_TILE = 1 << 20  # pairs compared at once
_SMALL = 64  # members of a branch that is not cut further


def shingle_hashes(text: str, size: int) -> np.ndarray:
    """XXH64 (seed 42) of every shingle of ASCII-lowered words, repeats included."""
    words = text.encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined, n = b" ".join(words), max(1, len(words) - size + 1)
    stop = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    start = np.concatenate(([0], stop[: n - 1] + 1)).tolist()
    stop = stop[min(size, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], 42) for a, b in zip(start, stop, strict=True)], np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """A bit is 1 if it is set in over half of the hashes; none: 0."""
    if not len(hashes):
        return 0
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), _CHUNK):
        octets = hashes[i : i + _CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<i8")[0])


@dataclass(frozen=True)
class Cut:
    """Distances to the vantage of at most ``at`` go left."""

    vantage: np.uint64
    at: float
    left: object = None
    right: object = None

    def value(self, fps: np.ndarray) -> np.ndarray:
        return np.bitwise_count(fps ^ self.vantage).astype(np.float64)


@dataclass(frozen=True)
class Leaf:
    number: int
    blocks: int


def best_cut(fps: np.ndarray, distance: int) -> tuple[Cut | None, float]:
    """The cut at a median with the smallest share of distances within ``distance`` of it, and that share."""
    best, least = None, 1.0
    for vantage in fps[np.linspace(0, len(fps) - 1, 5).astype(int)]:
        values = Cut(vantage, 0.0).value(fps)
        at = float(np.median(values))
        share = float((np.abs(values - at) <= distance).mean())
        if share < least and 0 < (values <= at).sum() < len(values):
            best, least = Cut(vantage, at), share
    return best, least


def tree(fps, scale: float, distance: int, leaf_rows: int, block_rows: int, most_copies: float):
    """A tree over a sample in which each fingerprint stands for ``scale`` of all.

    Branches are cut until they have ``leaf_rows``, are too few in the sample, can't be told apart, or the expected
    copies of a fingerprint reach ``most_copies``. Leaves expected to have over ``block_rows`` are split into a grid.
    """
    leaves = []

    def grow(own: np.ndarray, guests: np.ndarray, copies: float):
        cut = None
        if len(own) * scale > leaf_rows and len(own) >= 64 and copies < most_copies:
            cut, share = best_cut(fps[own], distance)
            if share > 0.9:
                cut = None
        if cut is None:
            leaves.append(Leaf(len(leaves), grid(int((len(own) + len(guests)) * scale * 1.2), block_rows)))
            return leaves[-1]
        sides = sent(cut, distance, fps, own, guests)
        more = (len(sides[0][1]) + len(sides[1][1]) + len(own)) / max(1, len(own) + len(guests))
        left, right = (grow(*side, copies * max(1.0, more)) for side in sides)
        return Cut(cut.vantage, cut.at, left, right)

    everyone = np.arange(len(fps))
    return grow(everyone, everyone[:0], 1.0)


def sent(cut: Cut, distance: int, fps, own, guests):
    """(own, guests) of the left and of the right branch, as indices."""
    a, b = cut.value(fps[own]), cut.value(fps[guests])
    left = np.concatenate([own[(a > cut.at) & (a <= cut.at + distance)], guests[b <= cut.at + distance]])
    return (own[a <= cut.at], left), (own[a > cut.at], guests[b > cut.at - distance])


def search(fps, own, others, distance, found) -> None:
    """Calls ``found(i, j)`` with index arrays of all pairs of ``own`` and ``others`` within the distance."""
    todo = [(own, others)]
    while todo:
        own, others = todo.pop()
        if not len(own) or not len(others):
            continue
        cut = share = None
        if len(own) > _SMALL:
            cut, share = best_cut(fps[own], distance)
        if cut is not None and share < 0.9:
            a, b = cut.value(fps[own]), cut.value(fps[others])
            todo.append((own[a <= cut.at], others[b <= cut.at + distance]))
            todo.append((own[a > cut.at], others[b > cut.at - distance]))
            continue
        step = max(1, _TILE // len(others))
        for k in range(0, len(own), step):
            rows = own[k : k + step]
            i, j = np.nonzero(np.bitwise_count(fps[rows][:, None] ^ fps[others][None, :]) <= distance)
            if len(i):
                found(rows[i], others[j])


_SHARD = pa.schema(
    [("leaf", pa.int32()), ("i", pa.int32()), ("j", pa.int32()), ("side", pa.int8()), ("rep", pa.int64()),
     ("fp", pa.int64())]
)
_SHARD_SQL = "leaf int, i int, j int, side tinyint, rep long, fp long"
_OWN, _OTHER, _GUEST = 0, 1, 2
_LINK = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _dealt(top, distance: int):
    """Sends classes to shards: ``own`` rows to (i, j) for all j, and as ``other`` to (k, i) for all k; guests likewise."""

    def deal(batches):
        for batch in batches:
            fps = batch.column("fp").to_numpy().view(np.uint64)
            todo, parts = [(top, np.arange(len(fps)), np.arange(0))], []
            while todo:
                node, own, guests = todo.pop()
                if not len(own) + len(guests):
                    continue
                if isinstance(node, Cut):
                    left, right = sent(node, distance, fps, own, guests)
                    todo += [(node.left, *left), (node.right, *right)]
                    continue
                n = node.blocks
                block = ((fps * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) % n
                for k in range(n):
                    parts.append((own, node.number, block[own], np.full(len(own), k), _OWN))
                    if n > 1:
                        parts.append((own, node.number, np.full(len(own), k), block[own], _OTHER))
                    parts.append((guests, node.number, np.full(len(guests), k), block[guests], _GUEST))
            for rows, leaf, i, j, side in parts:
                if len(rows):
                    taken = batch.take(pa.array(rows))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(rows), leaf, np.int32)), pa.array(i.astype(np.int32)),
                         pa.array(j.astype(np.int32)), pa.array(np.full(len(rows), side, np.int8)),
                         *(taken.column(x) for x in ("rep", "fp"))],
                        schema=_SHARD,
                    )

    return deal


def _linked(distance: int):
    """Links of a shard: the edges that tie each member to its class's root."""

    def link(shard: pa.Table) -> pa.Table:
        fps = shard.column("fp").to_numpy().view(np.uint64)
        rep, side = shard.column("rep").to_numpy(), shard.column("side").to_numpy()
        order = np.argsort(rep, kind="stable")  # so that roots don't depend on the order of rows
        fps, rep, side = fps[order], rep[order], side[order]
        own = np.flatnonzero(side == _OWN)
        whole = not (side == _OTHER).any() and (shard.column("i")[0].as_py() == shard.column("j")[0].as_py())
        others = np.arange(len(fps)) if whole else np.flatnonzero(side != _OWN)
        parent = np.arange(len(fps))
        search(fps, own, others, distance, lambda i, j: unite(parent, i, j))
        roots(parent)
        tied = np.flatnonzero((parent != np.arange(len(fps))) & (rep != rep[parent]))
        return pa.table([pa.array(rep[tied]), pa.array(rep[parent[tied]])], schema=_LINK)

    return link


@dataclass(frozen=True)
class VantageTree:
    """Bounds: ``sample`` fingerprints are collected to build the tree (about that many, chosen by hash); a shard aims at
    ``leaf_rows`` and is split into a grid beyond ``block_rows``; a branch is not cut once its
    fingerprints go to ``most_copies`` shards, so that rows grow with the input, not with the depth of the tree."""

    sample: int = 1 << 14
    leaf_rows: int = 1 << 12
    block_rows: int = 1 << 21
    most_copies: float = 3.0


def simhash_classes(
    docs: DataFrame,
    stages: Stages,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = 4,
    distance: int = 4,
    bounds: VantageTree = VantageTree(),
) -> DataFrame:
    """``doc_id, fingerprint`` (bigint)``, component_id`` (the smallest doc_id that links reach) for every row.

    Equal fingerprints are one class and are never paired with each other; classes link at ``distance`` or fewer differing bits.

    Null and empty texts have the fingerprint 0 and link like others. Rows without a doc_id take the component of their class; a class
    of only such rows is linked with none and its component is null. Repeated rows and ids are rows of one class. An
    empty table gives an empty one. Only doc_id and text are read, so other columns can't clash.
    """
    docs = docs.select(F.col(doc_id).alias("doc_id"), whole_text(F.col(text)).alias("text"))

    @pandas_udf("long")
    def printed(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(shingle_hashes(t, shingle)) for t in texts], dtype="int64")

    prints = stages.keep(docs.select("doc_id", printed("text").alias("fp")))
    classes = prints.groupBy("fp").agg(F.min("doc_id").alias("rep"))
    classes = stages.keep(classes.where(F.col("rep").isNotNull()))

    n = classes.count()
    step = max(1, -(-n // bounds.sample))
    taken = classes.where(F.pmod(F.xxhash64("fp"), F.lit(step)) == 0).select("fp").toPandas().sort_values("fp")
    top = tree(
        taken["fp"].to_numpy(np.int64).view(np.uint64), n / max(1, len(taken)), distance,
        bounds.leaf_rows, bounds.block_rows, bounds.most_copies,
    )
    shards = classes.select("rep", "fp").mapInArrow(_dealt(top, distance), _SHARD_SQL)
    links = shards.groupBy("leaf", "i", "j").applyInArrow(_linked(distance), "a long, b long")
    joined = connected(links, stages)
    member = classes.alias("c").join(joined.alias("j"), F.col("c.rep") == F.col("j.node"), "left")
    # Written, so that the last join has a plain shuffle on both sides, and Spark can split what one fingerprint brings.
    member = stages.keep(member.select("c.fp", F.coalesce("j.root", "c.rep").alias("component_id")))
    on = F.col("c.fp") == F.col("p.fp")
    return prints.alias("p").join(member.alias("c"), on, "left").select(
        "p.doc_id", F.col("p.fp").alias("fingerprint"), "c.component_id"
    )
