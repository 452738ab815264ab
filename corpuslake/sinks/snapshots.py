"""Which stored files make up the tables: a log of snapshots, each naming the parts of all tables.

A write puts its rows into new folders (parts) beside the old ones, then publishes one small file that names the parts that
count from now on. Until then, and if the job dies, readers see the state before. A snapshot also says which corpora and
which input each part came from, so that the same input is not added twice.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslake.stages import shuffles_let_go


class ChangedMeanwhile(RuntimeError):
    """Another job published a snapshot since this one read it; nothing of this one counts, run it again."""


@dataclass(frozen=True)
class Part:
    """``source`` tells the input apart ("" if it is not known). ``corpora`` are those with rows in the part, in order."""

    table: str
    name: str
    corpora: tuple[str, ...]
    sources: tuple[str, ...] = ()


@dataclass(frozen=True)
class Snapshot:
    version: int = 0
    parts: tuple[Part, ...] = ()

    def of(self, table: str, corpus: str | None = None) -> tuple[Part, ...]:
        return tuple(p for p in self.parts if p.table == table and (corpus is None or corpus in p.corpora))

    def of_any(self, tables: Iterable[str]) -> tuple[Part, ...]:
        return tuple(p for t in tables for p in self.of(t))

    def with_parts(self, add: Iterable[Part] = (), drop: Iterable[Part] = ()) -> Snapshot:
        gone = {p.name for p in drop}
        return Snapshot(self.version + 1, (*(p for p in self.parts if p.name not in gone), *add))


def _at(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _versions(spark: SparkSession, log: str) -> list[int]:
    fs, folder = _at(spark, log)
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def latest(spark: SparkSession, log: str) -> Snapshot:
    versions = _versions(spark, log)
    return load(spark, log, versions[-1]) if versions else Snapshot()


def load(spark: SparkSession, log: str, version: int) -> Snapshot:
    fs, path = _at(spark, f"{log}/{version:010d}.json")
    stream = fs.open(path)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    parts = json.loads(text)["parts"]
    return Snapshot(version, tuple(Part(p["table"], p["name"], tuple(p["corpora"]), tuple(p["sources"])) for p in parts))


def publish(spark: SparkSession, log: str, new: Snapshot) -> None:
    """Makes ``new`` the latest snapshot, all or nothing; the file is complete before it gets its name."""
    fs, path = _at(spark, f"{log}/{new.version:010d}.json")
    _, hidden = _at(spark, f"{log}/.{uuid.uuid4().hex}")
    out = fs.create(hidden, False)
    out.write(bytearray(json.dumps({"parts": [asdict(p) for p in new.parts]}, ensure_ascii=False).encode()))
    out.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    context = hadoop.FileContext.getFileContext(fs.makeQualified(path).toUri(), spark._jsc.hadoopConfiguration())
    try:
        # Without the option to overwrite, this fails if another job has published this version.
        context.rename(fs.makeQualified(hidden), fs.makeQualified(path), spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 0))
    except Exception as e:
        fs.delete(hidden, False)
        if "FileAlreadyExists" in str(e):
            raise ChangedMeanwhile(f"version {new.version} of {log} exists") from e
        raise


def written(
    df: DataFrame, folder: str, table: str, corpora: Iterable[str], sources: Iterable[str] = (), form: str = "parquet",
    by: tuple[str, ...] = (),
) -> Part:
    """A new part with these rows; it counts once a snapshot names it."""
    part = Part(table, uuid.uuid4().hex, tuple(sorted(corpora)), tuple(sorted(sources)))
    # Hashes as text take half the bytes by this codec.
    packed = {"compression": "zstd"} if form == "parquet" else {}
    with shuffles_let_go(df.sparkSession):
        df.write.format(form).options(**packed).partitionBy(*by).save(f"{folder}/part={part.name}")
    return part


def rows(spark: SparkSession, folder: str, parts: Iterable[Part], form: str = "parquet", named: bool = False) -> DataFrame:
    """The rows of these parts (at least one), with the part's name in ``part`` if asked for."""
    # Partition values such as a corpus named 2020 stay strings.
    setting = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        found = spark.read.format(form).option("basePath", folder).load([f"{folder}/part={p.name}" for p in parts])
    finally:
        spark.conf.set(setting, before)
    return found if named else found.drop("part")


def rewritten(
    spark: SparkSession, folder: str, parts: Iterable[Part], gone: Column, form: str = "parquet", by: tuple[str, ...] = ()
) -> tuple[list[Part], list[Part], int]:
    """(parts to add, parts to drop, rows that go): parts with rows that ``gone`` selects are written anew without them."""
    parts = list(parts)
    if not parts:
        return [], [], 0
    found = rows(spark, folder, parts, form, named=True)
    # One row per part and corpus with a loss.
    lost = found.groupBy("part", "corpus_id").agg(F.count_if(gone).alias("gone"), F.count("*").alias("all")).collect()
    add, drop, total = [], [], 0
    for part in parts:
        mine = [r for r in lost if r["part"] == part.name]
        if n := sum(r["gone"] for r in mine):
            total += n
            drop.append(part)
            if left := [r["corpus_id"] for r in mine if r["gone"] < r["all"]]:
                kept = rows(spark, folder, [part], form).where(~F.coalesce(gone, F.lit(False)))
                add.append(written(kept, folder, part.table, left, part.sources, form, by))
    return add, drop, total


def vacuum(spark: SparkSession, log: str, folder_of: Callable[[str], str], keep: int = 1) -> int:
    """Deletes parts that none of the last ``keep`` snapshots names, and older snapshots; returns how many parts.

    Not while another job writes to these tables: its parts aren't named yet.
    """
    versions = _versions(spark, log)
    named = {(p.table, p.name) for v in versions[-keep:] for p in load(spark, log, v).parts}
    tables = {p.table for v in versions for p in load(spark, log, v).parts}
    deleted = 0
    for table in sorted(tables):
        fs, folder = _at(spark, folder_of(table))
        for status in fs.listStatus(folder) if fs.exists(folder) else []:
            name = status.getPath().getName()
            if name.startswith("part=") and (table, name[5:]) not in named:
                fs.delete(status.getPath(), True)
                deleted += 1
    for v in versions[:-keep]:
        fs, path = _at(spark, f"{log}/{v:010d}.json")
        fs.delete(path, False)
    return deleted
