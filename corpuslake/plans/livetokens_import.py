"""The second job: a vertical to counted token attributes and their features."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslake.config import TokenAttr, feats_attr, plain_attrs
from corpuslake.operators import livetokens as lt
from corpuslake.operators.bitmaps import entries_of
from corpuslake.operators.structure import width_errors
from corpuslake.sinks import tables as sink
from corpuslake.sources.vertical import read_lines, resolve_paths, token_column, token_lines
from corpuslake.stages import Stages


@dataclass(frozen=True)
class ImportReport:
    """``width_errors``: token lines of unusual width; ``rejected``: combinations that don't look valid, which are
    stored with their count and the last line they are on; ``unparsed``: tokens without features that parse."""

    width_errors: DataFrame
    rejected: int
    unparsed: int


def attribute_rows(tokens: DataFrame, attrs: Sequence[TokenAttr]) -> DataFrame:
    feats = feats_attr(attrs)
    raw = token_column(feats.idx) if feats else F.lit(None).cast("string")
    return tokens.select(F.col("pos").alias("__line"), *[token_column(a.idx).alias(a.name) for a in plain_attrs(attrs)], raw.alias("__feats"))


def import_livetokens(
    spark: SparkSession,
    target: sink.Target,
    attrs: Sequence[TokenAttr],
    file: str | None = None,
    files: Sequence[str] | None = None,
    keep_featless: bool = False,
    strict_numeric: bool = False,
    index: bool = False,
) -> ImportReport:
    """Reads a vertical and replaces both tables, and that of rejected combinations.

    Structures do not matter here, nor does the order of lines. ``index`` stores the bitmaps for ``sinks.tables.read_index``, too.
    """
    names = [a.name for a in plain_attrs(attrs)]
    lines = read_lines(spark, resolve_paths(spark, file, files), target.corpus)
    tokens = token_lines(lines)
    stages = Stages(spark)
    try:
        raw = stages.keep(lt.raw_counts(attribute_rows(tokens, attrs), names, "__feats", "__line"))
        counted = stages.keep(lt.parsed_counts(raw, names, "__feats", "__line", keep_featless))
        valid = lt.valid_only(counted, names, strict_numeric)
        rejected = counted.where(~lt.looks_valid(names, strict_numeric))
        rejected = rejected.select(*names, "feats_key", "cnt", "last_line")
        entries = entries_of(valid, names, stages.keep) if index else None
        sink.write_livetokens(*lt.token_tables(valid, names), target, rejected, entries, names)
        unparsed = raw.where(lt.feat_sets(F.col("__feats")).isNull()).agg(F.coalesce(F.sum("cnt"), F.lit(0))).first()[0]
        return ImportReport(width_errors(tokens), sink.read(spark, target, target.rejected).count(), unparsed)
    finally:
        stages.drop()
