"""Operators on the metadata table of text units."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def bibliography(units: DataFrame, cols: Sequence[str], id_attr: str, distinct: bool = False) -> DataFrame:
    """Chosen columns, ``id_attr`` under the name ``id``; one row per text unit unless ``distinct``."""
    view = units.select(*[F.col(c).alias("id") if c == id_attr else F.col(c) for c in cols])
    return view.distinct() if distinct else view


def expired(date_attr: str, oldest: dt.date | str) -> Column:
    """True for dates before ``oldest``; a value that is no date does not expire."""
    day = F.try_to_date(F.col(date_attr), "yyyy-M-d")
    return F.coalesce(day < F.lit(str(oldest)).cast("date"), F.lit(False))


def moving_window(units: DataFrame, date_attr: str, oldest: dt.date | str) -> DataFrame:
    return units.where(~expired(date_attr, oldest))


def duplicate_items(units: DataFrame) -> DataFrame:
    """Item ids used more than once in a corpus."""
    named = units.where("item_id is not null")
    return named.groupBy("item_id", "corpus_id").agg(F.count("*").alias("n")).where("n > 1")


def aligned(units: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of different corpora with the same ``item_id``, each pair once.

    (``item_id``, ``corpus_id``) must be unique, so an item has at most one row per corpus; a breach fails the job
    (``duplicate_items`` lists them). Rows without an id meet none.
    """
    wanted = ["corpus_id", *columns]
    # One shuffle serves the test and both sides of the join.
    rows = units.where("item_id is not null").repartition("item_id")
    alone = F.count("*").over(Window.partitionBy("item_id", "corpus_id")) == 1
    twice = F.raise_error(F.concat(F.lit("item id "), "item_id", F.lit(" is not unique in "), "corpus_id")).cast("string")
    units = rows.withColumn("corpus_id", F.when(alone, F.col("corpus_id")).otherwise(twice))
    left = units.select("item_id", *[F.col(c).alias(f"{c}_a") for c in wanted])
    right = units.select("item_id", *[F.col(c).alias(f"{c}_b") for c in wanted])
    return left.join(right, "item_id").where("corpus_id_a < corpus_id_b")
