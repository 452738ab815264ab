"""Dense numbers in the order of a key, without a global window."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# monotonically_increasing_id: the task in the upper bits, the row in the task in the lower ones.
_ROW_BITS = 33


def dense_ids(df: DataFrame, keys: Sequence[str], keep: Callable[[DataFrame], DataFrame], name: str = "id") -> DataFrame:
    """Adds ``name``: 0, 1, 2, ... in the order of ``keys`` (nulls first), which must be unique together.

    Rows are sorted over ranges of the key and written by ``keep`` with their place in their range; what the ranges before
    hold (one number per task that wrote) is added when they are read. As keys are unique, a task that runs again
    numbers its rows as before, and the numbers do not depend on where ranges begin.
    """
    ranges = df.repartitionByRange(*[F.asc_nulls_first(k) for k in keys]).sortWithinPartitions(*[F.asc_nulls_first(k) for k in keys])
    placed = keep(ranges.withColumn("__at", F.monotonically_increasing_id()))
    task = F.shiftright("__at", _ROW_BITS)
    # One row per task of the write, which is at most spark.sql.shuffle.partitions.
    sizes = sorted(map(tuple, placed.groupBy(task.alias("__task")).agg(F.count("*")).collect()))
    before = [0, *accumulate(n for _, n in sizes)]
    starts = df.sparkSession.createDataFrame([(t, s) for (t, _), s in zip(sizes, before)], "__task long, __start long")
    row = F.col("__at").bitwiseAND((1 << _ROW_BITS) - 1)
    found = placed.withColumn("__task", task).join(F.broadcast(starts), "__task")
    return found.withColumn(name, F.col("__start") + row).drop("__task", "__start", "__at")
