"""Intermediate tables in the shared checkpoint folder, to cut long plans and avoid recomputing them."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder the session names; in local mode, where it may be unset, one in the warehouse."""
    folder = spark.conf.get(_SETTING, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"{_SETTING} must name a folder all executors can reach")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/stages"


@contextmanager
def shuffles_let_go(spark: SparkSession) -> Iterator[None]:
    """Tables written here leave no shuffle files behind: Spark removes them with the job, and not when the driver's JVM collects garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


class Stages:
    """Writes tables to read back; ``drop`` removes them once the job's own output is written.

    A query that returns a DataFrame over its stages can't drop them; they go when the driver's JVM ends.
    """

    def __init__(self, spark: SparkSession):
        self._spark = spark
        self._paths: list[str] = []

    def folder(self) -> str:
        """A new folder, not made yet, that goes with the stages."""
        path = f"{shared_folder(self._spark)}/stage-{uuid.uuid4().hex}"
        fs, target = self._on_disk(path)
        fs.deleteOnExit(target)
        self._paths.append(path)
        return path

    def keep(self, df: DataFrame, **options) -> DataFrame:
        """``options`` are those of the Parquet writer."""
        path = self.folder()
        with shuffles_let_go(self._spark):
            df.write.options(**options).parquet(path)
        return self._spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        for path in self._paths:
            fs, target = self._on_disk(path)
            fs.delete(target, True)
        self._paths.clear()

    def _on_disk(self, path: str):
        target = self._spark._jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self._spark._jsc.hadoopConfiguration()), target
