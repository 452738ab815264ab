"""Stored tables: text units, n-gram frequencies, token attributes and their features."""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslake.config import NgramSpec
from corpuslake.operators.bitmaps import SearchIndex, bitmaps_of, sorted_bitmaps
from corpuslake.operators.gaps import count_of_gaps, moved
from corpuslake.operators.ngrams import ARF_OFF, distinct_values, frequency_table
from corpuslake.operators.units import expired
from corpuslake.sinks import snapshots
from corpuslake.sinks.snapshots import Part, Snapshot
from corpuslake.sources.tables import PerCorpus

UNITS, FREQUENCIES, TOKENS, FEATS, REJECTED = (
    "liveattrs_entry", "colcounts", "livetokens", "livetokens_udfeats", "livetokens_rejected"
)
# An index of the token attributes: numbered combinations, and bitmaps of their numbers.
ENTRIES, BITMAPS = "livetokens_entries", "livetokens_bitmaps"
# What an ARF is made of: gaps between occurrences, and the tokens of each input.
GAPS, SIZES = "colcounts_gaps", "colcounts_sizes"
COUNTED = (FREQUENCIES, GAPS, SIZES)


class Repeated(ValueError):
    """This input of the corpus is stored already."""


@dataclass(frozen=True)
class Target:
    """Where the tables of a corpus lie; aligned corpora share them under the name of their group."""

    root: str
    corpus: str
    group: str | None = None
    format: str = "parquet"

    @property
    def log(self) -> str:
        return self.path("snapshots")

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{self.group or self.corpus}_{table}"

    @property
    def units(self) -> str:
        return self.path(UNITS)

    @property
    def frequencies(self) -> str:
        return self.path(FREQUENCIES)

    @property
    def gaps(self) -> str:
        return self.path(GAPS)

    @property
    def sizes(self) -> str:
        return self.path(SIZES)

    @property
    def tokens(self) -> str:
        return self.path(TOKENS)

    @property
    def feats(self) -> str:
        return self.path(FEATS)

    @property
    def rejected(self) -> str:
        return self.path(REJECTED)

    @property
    def entries(self) -> str:
        return self.path(ENTRIES)

    @property
    def bitmaps(self) -> str:
        return self.path(BITMAPS)


def _hadoop_path(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _hadoop_path(spark, path)
    return fs.exists(target)


def snapshot(spark: SparkSession, target: Target) -> Snapshot:
    return snapshots.latest(spark, target.log)


def read(spark: SparkSession, target: Target, path: str, at: Snapshot | None = None) -> DataFrame:
    """The rows of the table at ``path``, as the latest snapshot (or that of ``at``) has it."""
    table = path.removeprefix(target.path(""))
    parts = (at or snapshot(spark, target)).of(table)
    if not parts:
        raise FileNotFoundError(f"no rows at {path}")
    return snapshots.rows(spark, path, parts, target.format)


def require_existing(spark: SparkSession, target: Target) -> None:
    if not snapshot(spark, target).of(UNITS):
        raise FileNotFoundError(f"nothing to append to: {target.units}")


def input_key(spark: SparkSession, paths: Sequence[str]) -> str:
    """Tells inputs apart: a hash of the files' paths, sizes and times."""
    hadoop, found = spark._jvm.org.apache.hadoop.fs, []
    for path in paths:
        file = hadoop.Path(path)
        status = file.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(file)
        found.append(f"{path}\n{status.getLen()}\n{status.getModificationTime()}")
    return hashlib.sha256("\n".join(found).encode()).hexdigest()


def _corpora(df: DataFrame) -> list[str]:
    # One row per corpus of the write.
    return [r[0] for r in df.select("corpus_id").distinct().collect()]


def units_part(units: DataFrame, target: Target, sources: Sequence[str] = ()) -> Part:
    return snapshots.written(units, target.units, UNITS, _corpora(units), sources, target.format)


def frequency_parts(
    table: DataFrame, target: Target, sources: Sequence[str] = (), corpora: list[str] | None = None
) -> list[Part]:
    """No part for no rows: partitioned by ``ngram_size``, it would have no file to tell its columns. ``corpora`` are those with rows, if known."""
    if not (corpora := _corpora(table) if corpora is None else corpora):
        return []
    return [snapshots.written(table, target.frequencies, FREQUENCIES, corpora, sources, target.format, ("ngram_size",))]


def merged_frequencies(
    spark: SparkSession, table: DataFrame, target: Target, before: Snapshot, sources: Sequence[str] = ()
) -> tuple[list[Part], list[Part]]:
    """(parts to add, parts to drop) for new counts of n-grams: (corpus_id, ngram_size, columns) stays unique.

    Counts of corpora that are stored already are added up. Counts with an ARF come from gaps (``arf_parts``) and can't be added here.
    """
    corpora = _corpora(table)
    held = [p for p in before.of(FREQUENCIES) if set(p.corpora) & set(corpora)]
    if not held:
        return frequency_parts(table, target, sources), []
    stored = snapshots.rows(spark, target.frequencies, held, target.format)
    both = table.withColumn("ngram_size", F.col("ngram_size").cast("string")).unionByName(stored)
    if both.where(F.col("arf") != -1).limit(1).count():
        raise ValueError("counts with and without an ARF can't be added")
    keys = [c for c in table.columns if c not in ("count", "arf")]
    summed = both.groupBy(*keys).agg(F.sum("count").alias("count"), F.max("arf").alias("arf")).select(*table.columns)
    known = {s for p in held for s in p.sources}
    return frequency_parts(summed, target, sorted(known | set(sources))), held


def arf_parts(
    gaps: DataFrame, sizes: DataFrame, spec: NgramSpec, target: Target, before: Snapshot, sources: Sequence[str] = ()
) -> tuple[list[Part], list[Part]]:
    """(parts to add, parts to drop) for new text, given by its ``gap_rows`` and the ``tokens`` and ``corpus_size`` of each corpus.

    New text follows what is stored of its corpus. Its gaps are stored beside those of the text before, which is not read again,
    and the counts and ARF of its corpora are made anew from all gaps.
    """
    spark, corpora = gaps.sparkSession, _corpora(sizes)
    mine = F.col("corpus_id").isin(corpora) & (F.col("ngram_size").cast("int") == spec.size)
    held = {t: [p for p in before.of(t) if set(p.corpora) & set(corpora)] for t in (FREQUENCIES, GAPS, SIZES)}
    if held[FREQUENCIES]:
        stored = snapshots.rows(spark, target.frequencies, held[FREQUENCIES], target.format)
        if stored.where(mine & (F.col("arf") == ARF_OFF)).limit(1).count():
            raise ValueError("counts without an ARF can't be given one; read all texts of the corpus in one job")
    size, old = F.lit(spec.size).cast("int").alias("ngram_size"), F.lit(0).cast("long").alias("before")
    sizes = sizes.select("corpus_id", "tokens", "corpus_size", size)
    known = sizes.withColumn("before", old)
    if held[SIZES]:
        stored = snapshots.rows(spark, target.sizes, held[SIZES], target.format).where(mine)
        known = known.unionByName(stored.withColumn("before", F.col("tokens")))
    # One row per corpus; a broadcast if they are few.
    place = PerCorpus.of(known, ["corpus_id"], before=F.sum("before"), corpus_size=F.sum("corpus_size"))
    keys = ["corpus_id", *spec.names]
    placed = moved(place.attach(gaps, spec.names).drop("corpus_size"), "before").withColumn("ngram_size", size)
    add = [
        snapshots.written(sizes, target.sizes, SIZES, corpora, sources, target.format),
        snapshots.written(placed, target.gaps, GAPS, corpora, sources, target.format),
    ]
    everything = snapshots.rows(spark, target.gaps, [*held[GAPS], add[1]], target.format).where(mine)
    counts = count_of_gaps(place.attach(everything, spec.names).drop("before"), keys)
    more, drop, _ = snapshots.rewritten(spark, target.frequencies, held[FREQUENCIES], mine, target.format, ("ngram_size",))
    from_all = sorted({s for p in held[GAPS] for s in p.sources} | set(sources))
    return [*add, *more, *frequency_parts(frequency_table(counts, spec), target, from_all, _corpora(everything))], drop


def write_units(units: DataFrame, target: Target, append: bool = False) -> None:
    spark = units.sparkSession
    before = snapshot(spark, target)
    part = units_part(units, target)
    snapshots.publish(spark, target.log, before.with_parts([part], [] if append else before.of(UNITS)))


def write_frequencies(table: DataFrame, target: Target, append: bool = False) -> None:
    """``append`` adds to the counts of corpora that are stored already."""
    spark = table.sparkSession
    before = snapshot(spark, target)
    if append:
        add, drop = merged_frequencies(spark, table, target, before)
    else:
        add, drop = frequency_parts(table, target), before.of_any(COUNTED)
    snapshots.publish(spark, target.log, before.with_parts(add, drop))


def write_arf(gaps: DataFrame, sizes: DataFrame, spec: NgramSpec, target: Target, append: bool = False) -> None:
    """Counts and ARF of n-grams (see ``arf_parts``); ``append`` continues corpora that are stored already."""
    spark = gaps.sparkSession
    before = snapshot(spark, target)
    gone = [] if append else before.of_any(COUNTED)
    add, drop = arf_parts(gaps, sizes, spec, target, before.with_parts(drop=gone))
    snapshots.publish(spark, target.log, before.with_parts(add, [*drop, *gone]))


def index_parts(entries: DataFrame, attrs: Sequence[str], target: Target) -> list[Part]:
    """Parts of an index over ``entries_of``. Bitmaps are made from the entries as stored."""
    first = snapshots.written(entries, target.entries, ENTRIES, [target.corpus], (), target.format)
    stored = snapshots.rows(entries.sparkSession, target.entries, [first], target.format)
    bitmaps = sorted_bitmaps(bitmaps_of(stored, attrs))
    return [first, snapshots.written(bitmaps, target.bitmaps, BITMAPS, [target.corpus], (), target.format)]


def read_index(spark: SparkSession, target: Target, at: Snapshot | None = None) -> SearchIndex:
    """The index of one snapshot, so that entries and bitmaps belong together."""
    at = at or snapshot(spark, target)
    return SearchIndex(read(spark, target, target.entries, at), read(spark, target, target.bitmaps, at))


def write_livetokens(
    tokens: DataFrame, feats: DataFrame, target: Target, rejected: DataFrame | None = None,
    entries: DataFrame | None = None, attrs: Sequence[str] = (),
) -> None:
    """Replaces these tables at once. Features are sorted in each file, so that a search skips most of it.

    With ``entries`` (``entries_of`` for ``attrs``) an index is stored, too; without, that of the tables before goes.
    """
    spark = tokens.sparkSession
    before = snapshot(spark, target)
    add = [
        snapshots.written(tokens, target.tokens, TOKENS, [target.corpus], (), target.format),
        snapshots.written(feats.sortWithinPartitions("feat", "value"), target.feats, FEATS, [target.corpus], (), target.format),
    ]
    if rejected is not None:
        add.append(snapshots.written(rejected, target.rejected, REJECTED, [target.corpus], (), target.format))
    if entries is not None:
        add += index_parts(entries, attrs, target)
    drop = [p for t in (TOKENS, FEATS, REJECTED, ENTRIES, BITMAPS) for p in before.of(t)]
    snapshots.publish(spark, target.log, before.with_parts(add, drop))


def older_parts(
    spark: SparkSession, target: Target, before: Snapshot, date_attr: str, oldest: dt.date | str
) -> tuple[list[Part], list[Part], int]:
    return snapshots.rewritten(spark, target.units, before.of(UNITS), expired(date_attr, oldest), target.format)


def remove_older(spark: SparkSession, target: Target, date_attr: str, oldest: dt.date | str) -> int:
    """Removes text units older than a date and tells how many. Only parts that lose some are written anew."""
    before = snapshot(spark, target)
    add, drop, gone = older_parts(spark, target, before, date_attr, oldest)
    if gone:
        snapshots.publish(spark, target.log, before.with_parts(add, drop))
    return gone


def corpus_parts(spark: SparkSession, target: Target, before: Snapshot, corpus: str) -> tuple[list[Part], list[Part]]:
    """(parts to add, parts to drop) to take a corpus out of units and n-grams."""
    add, drop = [], []
    for table in (UNITS, *COUNTED):
        held, by = before.of(table, corpus), ("ngram_size",) if table == FREQUENCIES else ()
        more, less, _ = snapshots.rewritten(spark, target.path(table), held, F.col("corpus_id") == corpus, target.format, by)
        add += more
        drop += less
    return add, drop


def vacuum(spark: SparkSession, target: Target, keep: int = 1) -> int:
    """Deletes parts that the last ``keep`` snapshots don't name; not while another job writes."""
    return snapshots.vacuum(spark, target.log, target.path, keep)


def export_values(df: DataFrame, column: str, path: str) -> None:
    """Sorted distinct values as text, one per line; files follow each other in the order of their names."""
    values = distinct_values(df.where(F.col(column).isNotNull()), column)
    values.select(F.col(column).cast("string")).write.mode("overwrite").text(path)
