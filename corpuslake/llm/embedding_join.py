"""Exact join of vectors within a cosine, by pivots.

On unit vectors the cosine is a metric's range: cosine >= c is a distance of at most eps = sqrt(2 - 2c). Each vector
belongs to the cell of its nearest pivot. By the triangle inequality a vector y can only be linked with a vector of cell p if
d(y, p) - d(y, own pivot) <= 2 eps, and if d(y, p) <= eps + the cell's radius; only then y is sent to cell p as a guest, and only
to cells before its own, which find the pair. Cells are joined on their own, large ones as a grid of blocks.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslake.llm.common import connected
from corpuslake.llm.linking import grid, roots, unite
from corpuslake.stages import Stages

_OWN, _OTHER, _GUEST = 0, 1, 2
_SLACK = 1e-4  # of single-precision cosines and distances, which only choose what is tested in double precision
_SHARD = pa.schema(
    [("cell", pa.int32()), ("i", pa.int32()), ("j", pa.int32()), ("side", pa.int8()), ("rep", pa.int64()),
     ("h", pa.int64()), ("n", pa.int64()), ("vector", pa.list_(pa.float64()))]
)
_SHARD_SQL = "cell int, i int, j int, side tinyint, rep long, h long, n long, vector array<double>"
_FOUND_SQL = "rep long, h long, links long, root long"


@dataclass(frozen=True)
class Pivots:
    """Bounds: about ``sample`` vectors (chosen by hash) are collected to choose at most ``most`` pivots; a cell aims at ``cell_rows``
    and is split into a grid of blocks beyond ``block_rows``; a vector goes to about ``most_copies`` cells."""

    sample: int = 1 << 12
    most: int = 256
    cell_rows: int = 1 << 11
    block_rows: int = 1 << 15
    most_copies: float = 4.0


def usable(vector: Column) -> Column:
    """Neither null nor empty nor zero, and every component is finite."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")).cast("double"))
    )
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled first, so that very large or small components don't overflow."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def distances(units: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (units @ pivots.T)))


def sent(dist: np.ndarray, eps: float, radius: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Each row's own cell, and a mask of the cells before it that it goes to as a guest."""
    own = dist.argmin(axis=1)
    guest = dist - dist.min(axis=1)[:, None] <= 2 * eps + _SLACK
    if radius is not None:
        guest &= dist <= radius[None, :] + eps + _SLACK
    return own, guest & (np.arange(dist.shape[1])[None, :] < own[:, None])


def choose_pivots(sample: np.ndarray, scale: float, eps: float, bounds: Pivots) -> np.ndarray:
    """Spread pivots (each next one drawn by squared distance), as many as keep the expected copies within bounds."""
    want = int(np.clip(len(sample) * scale // bounds.cell_rows, 1, min(bounds.most, len(sample))))
    rng = np.random.default_rng(0)
    chosen = [int(rng.integers(len(sample)))]
    near = distances(sample, sample[chosen])[:, 0]
    while len(chosen) < want and near.max() > 0:
        chosen.append(int(rng.choice(len(sample), p=near**2 / (near**2).sum())))
        near = np.minimum(near, distances(sample, sample[chosen[-1:]])[:, 0])
    while len(chosen) > 1:
        own, guest = sent(distances(sample, sample[chosen]), eps, None)
        if 1 + guest.sum() / len(sample) <= bounds.most_copies:
            break
        chosen = chosen[: len(chosen) * 3 // 4]
    return sample[chosen]


def _dealt(pivots: np.ndarray, radius: np.ndarray, blocks: dict[int, int], eps: float, first: int):
    """Rows of one length to their cells; ``first`` is the number of the first cell."""

    def deal(batches):
        for batch in batches:
            units = np.array(batch.column("vector").to_pylist(), np.float64)
            if not len(units):
                continue
            own, guest = sent(distances(units, pivots), eps, radius)
            block = (batch.column("h").to_numpy().view(np.uint64) >> np.uint64(33)).astype(np.int64)
            parts = []
            for p in range(len(pivots)):
                n = blocks[p]
                mine, visits = np.flatnonzero(own == p), np.flatnonzero(guest[:, p])
                for k in range(n):
                    parts.append((p, mine, block[mine] % n, np.full(len(mine), k), _OWN))
                    if n > 1:
                        parts.append((p, mine, np.full(len(mine), k), block[mine] % n, _OTHER))
                    parts.append((p, visits, np.full(len(visits), k), block[visits] % n, _GUEST))
            for p, rows, i, j, side in parts:
                if len(rows):
                    taken = batch.take(pa.array(rows))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(rows), first + p, np.int32)), pa.array(i.astype(np.int32)),
                         pa.array(j.astype(np.int32)), pa.array(np.full(len(rows), side, np.int8)),
                         *(taken.column(x) for x in ("rep", "h", "n")),
                         taken.column("vector").cast(_SHARD.field("vector").type)],
                        schema=_SHARD,
                    )

    return deal


def _joined(least: float):
    """Links of a block: for each vector how many it found here, and the root of its class here."""

    def join(shard: pa.Table) -> pa.Table:
        shard = shard.take(pa.compute.sort_indices(shard, sort_keys=[("rep", "ascending"), ("h", "ascending")]))
        side = shard.column("side").to_numpy()
        rep, h, n = (shard.column(x).to_numpy() for x in ("rep", "h", "n"))
        flat = shard.column("vector").combine_chunks()
        units = np.asarray(flat.flatten()).reshape(len(side), -1)
        single = units.astype(np.float32)
        own = np.flatnonzero(side == _OWN)
        whole = not (side == _OTHER).any() and shard.column("i")[0].as_py() == shard.column("j")[0].as_py()
        others = np.arange(len(side)) if whole else np.flatnonzero(side != _OWN)
        links, parent = np.zeros(len(side), np.int64), np.arange(len(side))
        step = max(1, (1 << 22) // max(1, len(others)))
        for k in range(0, len(own), step):
            rows = own[k : k + step]
            i, j = np.nonzero(single[rows] @ single[others].T >= np.float32(least - _SLACK))
            i, j = rows[i], others[j]
            for m in range(0, len(i), 1 << 16):
                a, b = i[m : m + (1 << 16)], j[m : m + (1 << 16)]
                good = (np.einsum("ij,ij->i", units[a], units[b]) >= least) & ((rep[a] != rep[b]) | (h[a] != h[b]))
                a, b = a[good], b[good]
                np.add.at(links, a, n[b])
                back = side[b] == _GUEST
                np.add.at(links, b[back], n[a[back]])
                unite(parent, a, b)
        roots(parent)
        out = np.flatnonzero((links > 0) | (parent != np.arange(len(side))))
        return pa.table({"rep": rep[out], "h": h[out], "links": links[out], "root": rep[parent[out]]})

    return join


def cosine_links(
    vectors: DataFrame,
    stages: Stages,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    least: float = 0.9,
    bounds: Pivots = Pivots(),
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row: other vectors with a cosine of ``least`` or more (double
    precision), the smallest vec_id that links reach, and whether that is the row's own.

    Equal vectors are one class, whose members link with each other and are never paired. Null, empty and zero vectors, those
    with a null or non-finite component, and rows without a vec_id link with nothing: 0 links, own component. Vectors of different
    lengths never link. Rows that repeat an id count as vectors of their own and share its component. Only the two
    columns are read, so others can't clash. An empty table gives an empty one.
    """
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    rows = rows.withColumn("ok", usable(F.col("vector")) & F.col("vec_id").isNotNull())
    rows = rows.withColumn("h", F.xxhash64("vector")).withColumn("h2", F.xxhash64(F.lit(1), "vector"))
    good = rows.where("ok").groupBy("h", "h2").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("n"), F.first("vector").alias("vector")
    )
    lengths = F.size("vector")

    def scaled(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            col = batch.column("vector")
            sizes = np.diff(np.asarray(col.offsets))
            flat = np.asarray(col.flatten())
            which = np.repeat(np.arange(len(sizes)), sizes)
            starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            flat = flat / np.maximum.reduceat(np.abs(flat), starts)[which]
            flat = flat / np.sqrt(np.add.reduceat(flat * flat, starts))[which]
            made = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)), flat)
            yield batch.set_column(batch.schema.get_field_index("vector"), "vector", made)

    classes = stages.keep(
        good.select("h", "h2", "rep", "n", "vector").mapInArrow(
            scaled, "h long, h2 long, rep long, n long, vector array<double>"
        )
    )
    eps = math.sqrt(2.0 - 2.0 * least)
    shards, first = None, 0
    # One row for each length of vectors, usually one.
    for length, count in sorted(tuple(r) for r in classes.groupBy(lengths).count().collect()):
        part = classes.where(lengths == length)
        every = max(1, -(-count // bounds.sample))
        chosen = part.where(F.pmod("h2", F.lit(every)) == 0).select("h", "vector").toPandas().sort_values("h")
        if chosen.empty:
            chosen = part.select("h", "vector").orderBy("h").limit(1).toPandas()
        pivots = choose_pivots(np.stack(chosen["vector"].to_numpy()), count / len(chosen), eps, bounds)

        def measured(batches, pivots=pivots):
            for batch in batches:
                if batch.num_rows:
                    d = distances(np.array(batch.column("vector").to_pylist(), np.float64), pivots)
                    yield pa.RecordBatch.from_pydict({"cell": d.argmin(1).astype(np.int32), "d": d.min(1)})

        # At most ``bounds.most`` rows.
        cells = part.select("vector").mapInArrow(measured, "cell int, d double").groupBy("cell")
        cells = {r["cell"]: r for r in cells.agg(F.max("d").alias("r"), F.count("*").alias("n")).collect()}
        radius = np.array([cells[p]["r"] if p in cells else -np.inf for p in range(len(pivots))])
        copies = sent(distances(np.stack(chosen["vector"].to_numpy()), pivots), eps, radius)[1].mean(axis=0) * count
        blocks = {
            p: grid(int((cells[p]["n"] if p in cells else 0) + copies[p]), bounds.block_rows) for p in range(len(pivots))
        }
        some = part.select("rep", "h", "n", "vector").mapInArrow(
            _dealt(pivots, radius, blocks, eps, first), _SHARD_SQL
        )
        shards = some if shards is None else shards.union(some)
        first += len(pivots)
    if shards is None:
        found = classes.select("rep", "h", F.lit(0).cast("long").alias("links"), F.col("rep").alias("root"))
    else:
        found = shards.groupBy("cell", "i", "j").applyInArrow(_joined(least), _FOUND_SQL)
    found = stages.keep(found)
    joined = connected(found.select(F.col("rep").alias("a"), F.col("root").alias("b")), stages)
    counted = found.groupBy("rep", "h").agg(F.sum("links").alias("links"))
    made = (
        classes.select("h", "h2", "rep", "n")
        .join(counted, ["rep", "h"], "left")
        .join(joined.withColumnRenamed("node", "rep"), "rep", "left")
        .select("h", "h2", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("root", "rep").alias("c"))
        .withColumn("ok", F.lit(True))
    )
    # Written, so that the last join has a plain shuffle on both sides, and Spark can split what one vector brings.
    made = stages.keep(made)
    component = F.coalesce("c", "vec_id")
    return rows.drop("vector").join(made, ["h", "h2", "ok"], "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        component.alias("component_id"),
        (F.col("vec_id") == component).alias("kept"),
    )
