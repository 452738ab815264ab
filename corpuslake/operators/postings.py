"""Occurrences of an n-gram as lists of places, put together where they are made, before they are shuffled.

A task gathers some occurrences, and gives one row for those of an n-gram: its first place and the distances to the next ones, in as few
bytes as they need. So an n-gram's text goes to the shuffle once for all of them, and no row is made for an occurrence. A long list
is cut into rows of ``CUT`` places.

Rows of an n-gram then come sorted by their first place. Lists of different tasks may lie between each other, so a frequent n-gram is merged:
places up to the first one of the next row are final. As a list has at most ``CUT`` places, what is held is bounded by the number of
lists, and not by that of the occurrences.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Occurrences that a task gathers at once.
GATHERED = 1 << 20
# Places in a row, and rows of one n-gram that are merged at once.
CUT, ROWS = 1 << 11, 1 << 9
# Places of whole n-grams that are looked at together; an n-gram with more is merged.
TOGETHER = 1 << 19


def packed(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers from 0 in groups of seven bits, the lowest first, and how many bytes each takes."""
    size = np.ones(len(values), np.int64)
    for k in range(1, 9):
        over = values >> (7 * k) > 0
        if not over.any():
            break
        size += over
    ends = np.cumsum(size)
    start = ends - size
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    for k in range(int(size.max(initial=0))):
        live = size > k
        more = (size[live] > k + 1).astype(np.uint8) << 7
        out[start[live] + k] = (values[live] >> (7 * k) & 127).astype(np.uint8) | more
    return out, size


def unpacked(octets: np.ndarray) -> np.ndarray:
    """The numbers of ``packed``."""
    ends = np.flatnonzero(octets < 128) + 1
    start = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    size, out = ends - start, np.zeros(len(ends), np.int64)
    for k in range(int(size.max(initial=0))):
        live = size > k
        out[live] |= (octets[start[live] + k] & 127).astype(np.int64) << (7 * k)
    return out


def _codes(table: pa.Table, keys: Sequence[str]) -> np.ndarray:
    """A number per row; rows of equal keys (nulls are equal) have the same one."""
    code = np.zeros(table.num_rows, np.int64)
    for k in keys:
        found = table.column(k).combine_chunks().dictionary_encode(null_encoding="encode")
        both = code * max(len(found.dictionary), 1) + found.indices.to_numpy(zero_copy_only=False)
        code = pa.array(both).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return code


def _gather(keys: Sequence[str], gathered: int, cut: int):
    """Occurrences -> rows of lists."""

    def lists(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches).combine_chunks()
        code, idx = _codes(table, keys), table.column("idx").to_numpy()
        order = np.lexsort((idx, code))
        code, idx = code[order], idx[order]
        begins = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
        nth = np.arange(len(idx)) - np.repeat(begins, np.diff(np.append(begins, len(idx))))
        starts = np.flatnonzero(nth % cut == 0)
        later = np.ones(len(idx), bool)
        later[starts] = False
        octets, size = packed(np.diff(idx, prepend=0)[later])
        # The bytes before each list: those of the later places before its start.
        before = np.concatenate([[0], np.cumsum(size)])[np.append(starts - np.arange(len(starts)), len(size))]
        rest = pa.Array.from_buffers(
            pa.binary(), len(starts), [None, pa.py_buffer(before.astype(np.int32).tobytes()), pa.py_buffer(octets.tobytes())]
        )
        named = table.select(list(keys)).take(pa.array(order[starts]))
        yield from named.append_column("first", pa.array(idx[starts])).append_column("rest", rest).combine_chunks().to_batches(10_000)

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= gathered:
                yield from lists(held)
                held, n = [], 0
        if n:
            yield from lists(held)

    return stream


def _places(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """All places of some rows, row by row, and how many each row has."""
    first, (octets, _), count = table.column("first").to_numpy(), _octets(table), _sizes(table)
    values = unpacked(octets)
    starts = np.cumsum(count) - count
    steps = np.empty(int(count.sum()), np.int64)
    later = np.ones(len(steps), bool)
    later[starts] = False
    steps[starts], steps[later] = first, values
    sums = np.cumsum(steps)
    return sums - np.repeat(sums[starts] - first, count), count


class Merged:
    """The gaps of one n-gram, whose rows come in parts."""

    def __init__(self):
        self.count, self.first, self.last = 0, None, None
        self._open = np.empty(0, np.int64)
        self._gaps = self._times = np.empty(0, np.int64)

    def add(self, table: pa.Table) -> None:
        for k in range(0, table.num_rows, ROWS):
            self._add(table.slice(k, ROWS))

    def _add(self, table: pa.Table) -> None:
        places, _ = _places(table)
        upto = table.column("first")[-1].as_py()
        self._open = np.sort(np.concatenate([self._open, places]), kind="stable")
        at = int(np.searchsorted(self._open, upto, "right"))
        self._final(self._open[:at])
        self._open = self._open[at:].copy()

    def _final(self, places: np.ndarray) -> None:
        if not len(places):
            return
        if self.first is None:
            self.first = int(places[0])
            gaps = np.diff(places)
        else:
            gaps = np.diff(places, prepend=self.last)
        self.count, self.last = self.count + len(places), int(places[-1])
        found, times = np.unique(gaps, return_counts=True)
        self._gaps, at = np.unique(np.concatenate([self._gaps, found]), return_inverse=True)
        self._times = np.bincount(at, np.concatenate([self._times, times]), len(self._gaps)).astype(np.int64)

    def gaps(self) -> tuple[np.ndarray, np.ndarray]:
        """The gaps of all places, and how often each occurs."""
        self._final(self._open)
        self._open = self._open[:0]
        return self._gaps, self._times


def _octets(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all lists, and where the lists begin and end in them."""
    rest = table.column("rest").combine_chunks()
    offsets = np.frombuffer(rest.buffers()[1], np.int32, len(rest) + 1, rest.offset * 4).astype(np.int64)
    data = rest.buffers()[2]
    octets = np.empty(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    return octets, offsets - offsets[0]


def _sizes(table: pa.Table) -> np.ndarray:
    """How many places each row has."""
    octets, offsets = _octets(table)
    return np.diff(np.concatenate([[0], np.cumsum(octets < 128)])[offsets]) + 1


class _Open:
    """An n-gram whose rows may go on. With more than ``most`` places, it is merged."""

    def __init__(self, most: int):
        self.tables, self.merged = [], None
        self._most, self._size = most, 0

    def add(self, table: pa.Table) -> None:
        if self.merged is None:
            self.tables.append(table)
            self._size += int(_sizes(table).sum())
            if self._size > self._most:
                self.merged = Merged()
                for t in self.tables:
                    self.merged.add(t)
                self.tables = [self.tables[0].slice(0, 1)]
        else:
            self.merged.add(table)


def _by_ngram(keys: Sequence[str], most: int, whole: Callable, merged: Callable):
    """Sorted rows of lists -> what ``whole`` tells of many n-grams, and ``merged`` of one with more than ``most`` places."""

    def together(tables: list[pa.Table]) -> pa.Table:
        table = pa.concat_tables(tables).combine_chunks()
        code = _codes(table, keys)
        begins = np.concatenate([[True], code[1:] != code[:-1]])[: len(code)]
        places, count = _places(table)
        of = np.repeat(np.cumsum(begins) - 1, count)
        if ((places[1:] < places[:-1]) & (of[1:] == of[:-1])).any():
            places = places[np.lexsort((places, of))]
        return whole(table.select(list(keys)).take(pa.array(np.flatnonzero(begins))), places, of)

    def goes_on(last: _Open, table: pa.Table) -> bool:
        return all(last.tables[0].column(k)[0].as_py() == table.column(k)[0].as_py() for k in keys)

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        held, held_size, last = [], 0, None

        def ended(one: _Open) -> Iterator[pa.Table]:
            if one.merged is not None:
                yield merged(one.tables[0].select(list(keys)), one.merged)
            else:
                held.extend(one.tables)

        for batch in batches:
            table = pa.Table.from_batches([batch])
            if not table.num_rows:
                continue
            code = _codes(table, keys)
            cuts = [0, *(np.flatnonzero(code[1:] != code[:-1]) + 1).tolist(), table.num_rows]
            held_size += int(_sizes(table).sum())
            if last is not None and goes_on(last, table):
                last.add(table.slice(0, cuts[1]))
                cuts = cuts[1:]
            if len(cuts) == 1:
                continue
            if last is not None:
                yield from ended(last)
            last = _Open(most)
            last.add(table.slice(cuts[-2]))
            # N-grams between the first and the last one of a batch are whole; only large ones are looked at alone.
            begins, upto = np.array(cuts[:-1]), cuts[-2]
            if len(begins) > 1:
                places = np.add.reduceat(_sizes(table.slice(begins[0], upto - begins[0])), begins[:-1] - begins[0])
                at = int(begins[0])
                for k in np.flatnonzero(places > most):
                    a, b = int(begins[k]), int(begins[k + 1])
                    one = _Open(most)
                    one.add(table.slice(a, b - a))
                    yield from ended(one)
                    held.append(table.slice(at, a - at))
                    at = b
                held.append(table.slice(at, upto - at))
            if held_size > TOGETHER:
                if held:
                    yield together(held)
                held, held_size = [], 0
        if last is not None:
            yield from ended(last)
        if held:
            yield together(held)

    def flat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for made in stream(batches):
            yield from made.combine_chunks().to_batches(10_000)

    return flat


def summed_by_ngram(
    occurrences: DataFrame, keys: Sequence[str], most: int, schema: T.StructType, whole: Callable, merged: Callable,
    gathered: int | None = None,
) -> DataFrame:
    """Rows of ``schema`` that are made of the places (``idx``) of each n-gram, all of one in one task.

    ``whole(keys, places, of)`` gets many n-grams: a row of keys each, the places of all in order, and whose each is. ``merged(keys, one)``
    gets one with more than ``most`` places (see ``Merged``); no more are put in order at once.
    """
    named = {f.name: f for f in occurrences.schema.fields}
    lists = T.StructType([*[named[k] for k in keys], T.StructField("first", T.LongType()), T.StructField("rest", T.BinaryType())])
    rows = occurrences.select(*keys, F.col("idx").cast("long").alias("idx"))
    cut = max(1, min(most, CUT))
    made = rows.mapInArrow(_gather(list(keys), gathered or GATHERED, cut), lists).repartition(*keys)
    # The hash leads the sort: it tells n-grams apart in its first eight bytes. It is made after the shuffle.
    order = made.withColumn("__h", F.xxhash64(*keys)).sortWithinPartitions("__h", *keys, "first").select(*lists.names)
    return order.mapInArrow(_by_ngram(list(keys), min(most, TOGETHER), whole, merged), schema)
