"""Running sums and forward fills over an ordered table, without a window over all of it.

Rows carry one or more chunk columns, coarse to fine, each monotone in the row order. A window runs
inside the finest chunk only; what earlier chunks contribute comes from a table with one row per
chunk, which is itself scanned by the coarser chunk columns. So the largest window holds one chunk,
or the chunks of one coarser chunk, however long the whole table is.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Order:
    """``keys`` separate independent sequences, ``chunks`` go from coarse to fine.

    ``within`` orders the rows of a chunk; ``pos`` compares any two rows of a sequence.
    """

    keys: tuple[str, ...] = ("corpus_id",)
    chunks: tuple[str, ...] = ("span", "chunk")
    within: str = "seq"
    pos: str = "pos"

    def keyed(self, *more: str) -> Order:
        return replace(self, keys=(*self.keys, *more))

    def coarser(self) -> Order:
        """The order of the table with one row per finest chunk."""
        return replace(self, chunks=self.chunks[:-1], within=self.chunks[-1])

    @property
    def group(self) -> list[str]:
        """A chunk of a sequence. The chunk leads, since sorts tell rows apart by their first column."""
        return [*reversed(self.chunks), *self.keys]

    @property
    def place(self) -> list[str]:
        return [*self.group, self.within]


def same(left: Sequence[Column], right: Sequence[Column]) -> Column:
    """Pairwise equality. Keys are never NULL, so that a join can use the partitioning of a window."""
    return reduce(lambda a, b: a & b, [x == y for x, y in zip(left, right)])


def scan(
    df: DataFrame,
    order: Order,
    sums: Mapping[str, Column] | None = None,
    lasts: Mapping[str, Column] | None = None,
    before: Collection[str] = (),
    sparse: bool = False,
) -> DataFrame:
    """Add a running sum per entry of ``sums`` and the last non-NULL value per entry of ``lasts``.

    Those named in ``before`` leave the current row out. ``sparse`` says that few rows have a value in ``lasts``, so that only these
    are sorted to find the last one of a chunk.
    """
    sums, lasts = dict(sums or {}), dict(lasts or {})
    names = [*sums, *lasts]
    if order.chunks:
        # The join below drops rows without a chunk. Said of all uses of a table, they share one shuffle of it.
        df = df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in order.group]))
    valued = df.withColumns({f"__v_{n}": e for n, e in {**sums, **lasts}.items()})
    rows_of = Window.partitionBy(*order.group).orderBy(order.within)

    def frame(name: str):
        return rows_of.rowsBetween(Window.unboundedPreceding, -1 if name in before else Window.currentRow)

    here = {f"__h_{n}": F.sum(f"__v_{n}").over(frame(n)) for n in sums}
    here |= {f"__h_{n}": F.last(f"__v_{n}", ignorenulls=True).over(frame(n)) for n in lasts}
    rows = valued.withColumns(here)
    if not order.chunks:
        done = {n: F.coalesce(F.col(f"__h_{n}"), F.lit(0)) for n in sums} | {n: F.col(f"__h_{n}") for n in lasts}
        return rows.withColumns(done).drop(*[f"__{t}_{n}" for n in names for t in "vh"])

    of_sums = [F.sum(f"__v_{n}").alias(f"__c_{n}") for n in sums]
    of_lasts = [
        F.max_by(f"__v_{n}", F.when(F.col(f"__v_{n}").isNotNull(), F.col(order.within))).alias(f"__c_{n}") for n in lasts
    ]
    if sparse and lasts:
        found = valued.where(reduce(lambda a, b: a | b, [F.col(f"__v_{n}").isNotNull() for n in lasts]))
        found = found.groupBy(*[F.col(c).alias(f"__f_{i}") for i, c in enumerate(order.group)]).agg(*of_lasts)
        chunks = valued.groupBy(*order.group).agg(*of_sums) if sums else valued.select(*order.group).distinct()
        match = same([F.col(c) for c in order.group], [F.col(f"__f_{i}") for i in range(len(order.group))])
        per_chunk = chunks.join(found, match, "left").drop(*[f"__f_{i}" for i in range(len(order.group))])
    else:
        per_chunk = valued.groupBy(*order.group).agg(*of_sums, *of_lasts)
    carried = scan(
        per_chunk,
        order.coarser(),
        {f"__p_{n}": F.coalesce(F.col(f"__c_{n}"), F.lit(0)) for n in sums},
        {f"__p_{n}": F.col(f"__c_{n}") for n in lasts},
        before=[f"__p_{n}" for n in names],
    )
    ids = order.group
    carried = carried.select(
        *[F.col(c).alias(f"__k_{i}") for i, c in enumerate(ids)], *[F.col(f"__p_{n}") for n in names]
    )
    joined = rows.join(carried, same([F.col(c) for c in ids], [F.col(f"__k_{i}") for i in range(len(ids))]))
    out = {n: F.col(f"__p_{n}") + F.coalesce(F.col(f"__h_{n}"), F.lit(0)) for n in sums}
    out |= {n: F.coalesce(F.col(f"__h_{n}"), F.col(f"__p_{n}")) for n in lasts}
    return joined.withColumns(out).drop(
        *[f"__{t}_{n}" for n in names for t in "vhp"], *[f"__k_{i}" for i in range(len(ids))]
    )
