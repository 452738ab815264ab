"""Universal Dependencies features, ``A=x|B=y``, with ``||`` between alternative sets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def feat_sets(raw: Column) -> Column:
    """``array<array<struct<feat,value>>>``: one sorted set per block.

    Sets are sorted by feature name; equal names keep their order. NULL where any item lacks ``=``
    (so for ``""`` and ``_`` too). Items named ``_`` are left out, which may leave a set empty.
    """

    def items(block: Column) -> Column:
        return F.split(block, r"\|")

    def parsed(block: Column) -> Column:
        # The position is the second field, so that the natural order of structs is a stable sort.
        pairs = F.transform(
            items(block),
            lambda item, i: F.struct(
                F.substring_index(item, "=", 1).alias("feat"),
                i.alias("at"),
                item.substr(F.locate("=", item) + 1, F.length(item)).alias("value"),
            ),
        )
        kept = F.array_sort(F.filter(pairs, lambda p: p["feat"] != "_"))
        return F.transform(kept, lambda p: F.struct(p["feat"].alias("feat"), p["value"].alias("value")))

    blocks = F.split(raw, r"\|\|")
    wrong = F.exists(blocks, lambda b: F.exists(items(b), lambda item: ~item.contains("=")))
    return F.when(~wrong, F.transform(blocks, parsed))


def feats_key(feats: Column) -> Column:
    return F.array_join(F.transform(feats, lambda p: F.concat(p["feat"], F.lit("="), p["value"])), "|")
