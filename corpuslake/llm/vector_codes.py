"""Product codes of vectors: integer k-means for each part of the vectors, with adaptive distance bounds between rounds.

Components become whole numbers, vectors are cut into equal parts, and each part position has a codebook. A round assigns each
part to its nearest entry and moves each entry to the mean of its parts. Between rounds each part keeps its closest
entries with a lower bound of the distance to each, ordered, and one outer bound for all other entries. When entries have moved,
the bounds tell which entries can have come nearer than the own one; only these are measured again, in whole numbers.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslake.llm.common import let
from corpuslake.stages import Stages

#: Components must stay below: the square of the distance between parts of up to 256 of them is then below 2**62.
_MOST = 1 << 26
_STATE_SQL = "code binary, near binary, lower binary, outer binary, used binary"


@dataclass(frozen=True)
class Codes:
    """``entries``: at most so many in a codebook (256 at most). ``closest``: entries with a bound of their own in the first round, and ``fewest`` later.

    ``served``: bounds that this share of the parts did not need go in the next round; a part that needs more is measured against all entries.
    """

    parts: int = 16
    entries: int = 64
    rounds: int = 2
    scale: int = 256
    closest: int = 16
    fewest: int = 4
    served: float = 0.99


@dataclass
class Report:
    """Of each assignment: bounds kept, and how many parts needed how many of them (last: all entries)."""

    bounds: list[int] = field(default_factory=list)
    needed: list[np.ndarray] = field(default_factory=list)


def usable(vector: Column) -> Column:
    """Neither null nor with null or non-finite components; an empty vector is usable."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")).cast("double")))
    return F.coalesce(finite, F.lit(False))


def whole_numbers(vector: Column, length: int, scale: int) -> Column:
    """floor(scale * x) of each component; zeros fill a shorter vector up."""
    made = F.transform(vector, lambda x: F.floor(x.cast("double") * scale))
    return let(made, lambda v: F.concat(v, F.array_repeat(F.lit(0).cast("bigint"), F.lit(length) - F.size(v))))


# --- one part position in numpy ---------------------------------------------------------------


def _down(x: np.ndarray) -> np.ndarray:
    """Single precision, never above x."""
    return np.nextafter(x.astype(np.float32), np.float32(-np.inf))


def squared(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of each point (n, d) to its entries (k, d) or (n, k, d)."""
    gap = points[:, None, :] - entries
    return np.einsum("nkd,nkd->nk", gap, gap)


def nearest(points: np.ndarray, book: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(own entry, b closest others, their lower bounds, the outer bound), from all distances."""
    dist = squared(points, book)
    order = np.argsort(dist, axis=1, kind="stable")  # ties: lower index first
    bounds = _down(np.sqrt(np.take_along_axis(dist, order, 1).astype(np.float64)))
    outer = bounds[:, b + 1] if b + 1 < len(book) else np.full(len(points), np.inf, np.float32)
    return order[:, 0], order[:, 1 : b + 1], bounds[:, 1 : b + 1], outer


def again(
    points: np.ndarray, book: np.ndarray, moved: np.ndarray, own: np.ndarray, near: np.ndarray, lower: np.ndarray, outer: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The state after entries moved by ``moved`` at most, and how many bounds each point needed (all entries: one more than there are).

    An entry whose lower bound exceeds the exact distance to the own entry is farther, strictly. Bounds are ordered, so the
    entries that are left to test are the first ones of the list, and all entries if the outer bound does not exceed it.
    """
    b = near.shape[1]
    lower = _down(lower.astype(np.float64) - moved[near]) if b else lower
    # Single precision rounds the difference down again, below what double precision may have rounded up.
    outer = _down(outer.astype(np.float64) - (moved.max() if len(moved) else 0.0))
    both = np.concatenate([lower, outer[:, None]], axis=1)
    both = np.minimum.accumulate(both[:, ::-1], axis=1)[:, ::-1]  # ordered: a bound also holds for all behind it
    gap = points - book[own]
    here = np.einsum("nd,nd->n", gap, gap)
    upper = np.nextafter(np.sqrt(here.astype(np.float64)), np.inf)
    needed = (both <= upper[:, None]).sum(axis=1)
    lower, outer = both[:, :b].copy(), both[:, b].copy()
    own, near = own.copy(), near.copy()
    some = np.flatnonzero((needed > 0) & (needed <= b))
    if len(some):
        width = int(needed[some].max())
        tested = np.concatenate([own[some, None], near[some, :width]], axis=1)
        dist = squared(points[some], book[tested])
        beyond = np.arange(width)[None, :] >= needed[some, None]
        # By distance, then index; untested ones stay behind the tested in their old order.
        key = np.concatenate([np.zeros((len(some), 1), bool), beyond], axis=1)
        rank = np.lexsort((np.where(key, 0, tested), np.where(key, np.arange(width + 1)[None, :], dist), key), axis=1)
        bounds = _down(np.sqrt(dist.astype(np.float64)))
        bounds[:, 1:] = np.where(beyond, lower[some, :width], bounds[:, 1:])
        tested, bounds = np.take_along_axis(tested, rank, 1), np.take_along_axis(bounds, rank, 1)
        own[some] = tested[:, 0]
        near[some, :width], lower[some, :width] = tested[:, 1:], bounds[:, 1:]
    full = np.flatnonzero(needed > b)
    if len(full):
        own[full], near[full], lower[full], outer[full] = nearest(points[full], book, b)
    return own, near, lower, outer, needed


# --- rounds in Spark --------------------------------------------------------------------------


def _matrix(column: pa.Array, length: int) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), length)
    if values.size and np.abs(values).max() >= _MOST:
        raise ValueError(f"a component is {_MOST} or more after scaling; whole numbers cannot hold its distances")
    return values


def _binary(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in np.ascontiguousarray(rows)], pa.binary())


def _read(column: pa.Array, dtype, shape) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(len(column), *shape)


def _assigner(books: np.ndarray, moved: np.ndarray | None, b: int, kept: int):
    """Rows with a ``v`` (and, later than the first round, a state with ``kept`` bounds) to the new state with ``b``."""
    parts, k, d = books.shape

    def assign(batches):
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            v = _matrix(batch.column("v"), parts * d).reshape(n, parts, d)
            own, outer = np.zeros((n, parts), np.uint8), np.zeros((n, parts), np.float32)
            near, lower = np.zeros((n, parts, b), np.uint8), np.zeros((n, parts, b), np.float32)
            needed = np.zeros((n, parts), np.uint16)
            if moved is not None:
                old_own = _read(batch.column("code"), np.uint8, (parts,))
                old_near = _read(batch.column("near"), np.uint8, (parts, kept))
                old_lower = _read(batch.column("lower"), np.float32, (parts, kept))
                old_outer = _read(batch.column("outer"), np.float32, (parts,))
            for p in range(parts):
                if moved is None:
                    own[:, p], near[:, p], lower[:, p], outer[:, p] = nearest(v[:, p], books[p], b)
                    needed[:, p] = b + 1
                    continue
                # Fewer bounds than before: the first one left out is the outer bound.
                out = old_outer[:, p] if b == kept else old_lower[:, p, b]
                own[:, p], near[:, p], lower[:, p], outer[:, p], needed[:, p] = again(
                    v[:, p], books[p], moved[p], old_own[:, p], old_near[:, p, :b], old_lower[:, p, :b], out
                )
            state = [_binary(own), _binary(near), _binary(lower), _binary(outer), _binary(needed)]
            names = ["code", "near", "lower", "outer", "used"]
            rest = [c for c in batch.schema.names if c not in names]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), *state], [*rest, *names])

    return assign


def _sums(parts: int, d: int, k: int, b: int):
    """Per task: for each entry its number of parts and their sum, and how many parts needed how many bounds (``part`` -1)."""

    def add(batches):
        total, count, used = np.zeros((parts, k, d), np.int64), np.zeros((parts, k), np.int64), np.zeros(b + 2, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            v = _matrix(batch.column("v"), parts * d).reshape(batch.num_rows, parts, d)
            own = _read(batch.column("code"), np.uint8, (parts,))
            used += np.bincount(_read(batch.column("used"), np.uint16, (parts,)).ravel(), minlength=b + 2)
            for p in range(parts):
                count[p] += np.bincount(own[:, p], minlength=k)
                np.add.at(total[p], own[:, p], v[:, p])
        at = [(p, j, i, int(total[p, j, i]), int(count[p, j])) for p in range(parts) for j in range(k) for i in range(d) if count[p, j]]
        at += [(-1, j, 0, int(n), 0) for j, n in enumerate(used) if n]
        columns = list(zip(*at, strict=True)) or [[]] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64()), strict=True)],
            ["part", "entry", "place", "total", "n"],
        )

    return add


def _next_bounds(needed: np.ndarray, b: int, how: Codes) -> int:
    """The fewest bounds that serve ``how.served`` of all parts; as many as now if these don't."""
    want = int(np.searchsorted(np.cumsum(needed), how.served * needed.sum()))
    return int(np.clip(want, min(how.fewest, b), b))


def vector_codes(
    rows: DataFrame, stages: Stages, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", how: Codes = Codes()
) -> tuple[DataFrame, np.ndarray, Report]:
    """(codes, codebooks, report): one row ``vec_id, label, code (binary), error`` for each usable vector; codebooks by part, entry, component.

    Null vectors and those with null or non-finite components are left out. Vectors are filled up with zeros to the longest one's
    length and to a multiple of ``how.parts``; an empty one is all zeros. The codebooks start as the vectors of the smallest
    ids (null ids last, equal ids by their components), fewer if there are fewer. A repeated row counts, and is returned, as often as it
    stands there. Components of 2**26 and more (|x| of 262,144) raise an error. No usable vector: no rows, and codebooks without entries.

    Bounded: codebooks, and sums for each entry, are collected (parts x entries x components); the state of a vector is 5 bytes a bound.
    """
    good = rows.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), F.col(vector).alias("x"))
    good = good.where(usable(F.col("x")))
    longest = good.agg(F.max(F.size("x"))).first()[0] or 0
    length = -(-longest // how.parts) * how.parts
    d = length // how.parts
    table = stages.keep(good.select("vec_id", "label", whole_numbers(F.col("x"), length, how.scale).alias("v")))
    first = table.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(how.entries).collect()
    k = len(first)
    books = np.array([r["v"] for r in first], np.int64).reshape(k, how.parts, d).transpose(1, 0, 2).copy()
    report, moved, kept = Report(), None, 0
    b = min(how.closest, max(0, k - 1))
    state = "vec_id " + table.schema["vec_id"].dataType.simpleString() + ", label " + table.schema["label"].dataType.simpleString()
    state += ", v array<bigint>, " + _STATE_SQL
    if not k:
        return table.select("vec_id", "label", F.lit(b"").alias("code"), F.lit(0).cast("long").alias("error")), books, report
    for step in range(how.rounds + 1):
        table = stages.keep(table.mapInArrow(_assigner(books, moved, b, kept), state))
        kept = b
        found = table.select("v", "code", "used").mapInArrow(
            _sums(how.parts, d, k, b), "part int, entry int, place int, total long, n long"
        )
        # At most parts x entries x components rows, and one for each number of bounds.
        found = found.groupBy("part", "entry", "place").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect()
        needed = np.zeros(b + 2, np.int64)
        new = books.copy()
        for r in found:
            if r["part"] < 0:
                needed[r["entry"]] = r["total"]
            else:
                new[r["part"], r["entry"], r["place"]] = r["total"] // r["n"]
        report.bounds.append(b)
        report.needed.append(needed)
        if step == how.rounds:
            break
        gap = new - books
        moved = np.nextafter(np.sqrt(np.einsum("pkd,pkd->pk", gap, gap).astype(np.float64)), np.inf)
        books = new
        if step:
            b = _next_bounds(needed, b, how)

    def errors(batches):
        for batch in batches:
            v = _matrix(batch.column("v"), length).reshape(batch.num_rows, how.parts, d)
            own = _read(batch.column("code"), np.uint8, (how.parts,))
            gap = v - books[np.arange(how.parts)[None, :], own]
            error = pa.array(np.einsum("npd,npd->n", gap, gap), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), batch.column("code"), error], ["vec_id", "label", "code", "error"]
            )

    kinds = ", ".join(f"{c} {table.schema[c].dataType.simpleString()}" for c in ("vec_id", "label"))
    return table.select("vec_id", "label", "v", "code").mapInArrow(errors, f"{kinds}, code binary, error long"), books, report


def books_text(books: np.ndarray) -> str:
    """All components in decimal, by part, entry and place, joined by commas."""
    return ",".join(map(str, books.ravel().tolist()))
