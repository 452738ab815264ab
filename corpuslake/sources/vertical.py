"""Vertical files: one token per line with tab-separated columns, between XML-like structure tags.

Several files make one line stream in list order; gzip is read through the Hadoop codec.
"""

from __future__ import annotations

import re
import warnings
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslake.sources.charsets import Charset, aligned, any_charset, charset_of

# Rows of one file split get consecutive numbers in the lower bits of monotonically_increasing_id.
_ROW_BITS = 33
# A chunk is at most this many lines of one split, so a gzip file (one split) makes many chunks.
CHUNK_BITS = 20
# A span is this many bytes (as stored) of all files put together; it holds a bounded number of chunks.
SPAN_BITS = 34


def resolve_paths(
    spark: SparkSession, file: str | None = None, files: Sequence[str] | None = None, skip_hidden: bool = False
) -> list[str]:
    """One of ``file`` and ``files``; a directory stands for its files by name. Entries that don't exist are skipped.

    Spark's readers pass over files whose names begin with ``_`` or ``.``, so such a file raises an error;
    ``skip_hidden`` leaves out those of directories (``_SUCCESS`` and the like) instead.
    """
    if (file is None) == (files is None):
        raise ValueError("exactly one of file and files is needed")
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    found: list[str] = []
    for entry in [file] if files is None else files:
        if not entry:
            warnings.warn("a path without text is left out", stacklevel=2)
            continue
        path = hadoop.Path(entry)
        fs = path.getFileSystem(conf)
        if not fs.exists(path):
            warnings.warn(f"nothing exists at {entry}, so it is left out", stacklevel=2)
            continue
        if fs.getFileStatus(path).isFile():
            found.append(fs.makeQualified(path).toString())
        else:
            listed = sorted(s.getPath().toString() for s in fs.listStatus(path) if s.isFile())
            found += [p for p in listed if not (skip_hidden and _hidden(p))]
    if hidden := [p for p in found if _hidden(p)]:
        raise ValueError(f"Spark would not read {hidden[0]}: rename it, or leave such files out with skip_hidden")
    if not found:
        raise FileNotFoundError("none of the given paths holds a file")
    return found


def _hidden(path: str) -> bool:
    return path.rpartition("/")[2][:1] in ("_", ".")


def read_lines(
    spark: SparkSession, paths: Sequence[str], corpus_id: str, encoding: str = "utf-8", chunk_bits: int = CHUNK_BITS
) -> DataFrame:
    """``corpus_id, span, chunk, pos, seq, line``: ``pos`` orders all lines, ``seq`` is dense in a chunk.

    The order is (file, start of the split, row in the split). It is taken in the scan stage itself,
    so a repeated task gives the same numbers, and no line passes through Python. Encodings: see ``charsets``.
    """
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()

    files, start, by_charset = [], 0, {}
    for i, entry in enumerate(paths):
        path = hadoop.Path(entry)
        fs = path.getFileSystem(conf)
        uri = re.sub("^file:/+", "file:/", fs.makeQualified(path).toUri().toString())
        # Both forms in which Spark may name a local file, so that no row's path has to be changed.
        files += [(form, i, start) for form in dict.fromkeys([uri, re.sub("^file:/", "file:///", uri)])]
        start += fs.getFileStatus(path).getLen()
        by_charset.setdefault(charset_of(spark, entry, encoding), {})[entry] = None
    listed = spark.createDataFrame(files, "path string, file_idx int, start long")
    parts = [_charset_lines(spark, list(own), listed, corpus_id, c, chunk_bits) for c, own in by_charset.items()]
    return reduce(DataFrame.unionByName, parts)


def _charset_lines(
    spark: SparkSession, paths: list[str], listed: DataFrame, corpus_id: str, charset: Charset, chunk_bits: int
) -> DataFrame:
    """Lines of files of one charset."""
    row = F.monotonically_increasing_id().bitwiseAND((1 << _ROW_BITS) - 1)
    scanned = spark.read.options(**charset.options()).text(paths).select(
        F.col("value").cast("binary").alias("raw"),
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        row.alias("seq"),
    )
    if charset.width > 1:
        # One row per file: whether a cut is inside a character, and where the file begins.
        begins = F.min(F.when(F.col("block") == 0, F.col("seq"))).alias("begins")
        known = scanned.groupBy("path").agg(F.max(F.length("raw") % charset.width).alias("odd"), begins).collect()
        facts = spark.createDataFrame(known, "path string, odd int, begins long")
        listed = listed.join(F.broadcast(facts), "path", "left")
    # The list comes from the driver's own listing, so it is as small as that.
    numbered = scanned.join(F.broadcast(listed), "path", "left")
    unlisted = F.raise_error(F.concat(F.lit("lines of a file not listed: "), "path")).cast("int")
    numbered = numbered.withColumn("file_idx", F.coalesce("file_idx", unlisted))
    extra = ["file_idx", "block", "odd", "begins"] if charset.width > 1 else []
    lines = numbered.select(
        F.lit(corpus_id).alias("corpus_id"),
        F.shiftright(F.col("start") + F.col("block"), SPAN_BITS).alias("span"),
        F.struct("file_idx", "block", F.shiftright("seq", chunk_bits).alias("part")).alias("chunk"),
        F.struct("file_idx", "block", "seq").alias("pos"),
        "seq",
        "raw",
        *extra,
    )
    if charset.width > 1 and any(r["odd"] for r in known):
        lines = lines.where("odd = 0").unionByName(aligned(lines.where("odd > 0"), charset))
    with any_charset(spark):
        text = charset.text(F.col("raw"))
        if charset.marked:
            first = (F.col("block") == 0) & (F.col("seq") == F.col("begins"))
            text = F.when(first, F.regexp_replace(text, "^\uFEFF", "")).otherwise(text)
        return lines.select("corpus_id", "span", "chunk", "pos", "seq", F.rtrim(text, F.lit("\r")).alias("line"))


def is_tag(line: Column) -> Column:
    """A name after ``<`` or ``</``, and no tab: a token that begins with ``<`` and whose last column ends in ``>`` is none."""
    return line.startswith("<") & line.endswith(">") & line.rlike(r"^</?[^\s<>/]+(?: [^\t]*|/)?>$")


def is_whole_tag(line: Column) -> Column:
    """All that follows a tag's name are attributes with quoted values; a closing tag has none."""
    return line.rlike(r"""^(?:</[^\s<>/]+ *>|<[^\s<>/]+(?: +[^\s="']+=(?:"[^"]*+"|'[^']*+'))*+ */?>)$""")


def line_kind(line: Column) -> Column:
    tag = is_tag(line)
    return (
        F.when(line == "", "blank")
        .when(~tag, "token")
        .when(line.startswith("</"), "close")
        .when(line.endswith("/>"), "empty")
        .otherwise("open")
    )


def tag_name(line: Column) -> Column:
    return F.regexp_extract(line, r"^</?([^\s/>]+)", 1)


def tag_attrs(line: Column) -> Column:
    """Attributes of a tag as a map; of repeated names the last one counts. Values are in double or single quotes."""
    found = F.regexp_extract_all(line, F.lit(r"""([^\s="']+)=("[^"]*"|'[^']*')"""), F.lit(0))

    def name(attr: Column) -> Column:
        return F.substring_index(attr, "=", 1)

    def entry(attr: Column) -> Column:
        size = F.length(name(attr))
        return F.struct(name(attr).alias("key"), F.substr(attr, size + 3, F.length(attr) - size - 3).alias("value"))

    def entries(attrs: Column) -> Column:
        names = F.transform(attrs, name)
        last = F.filter(attrs, lambda a, i: ~F.array_contains(F.slice(names, i + 2, F.size(names)), name(a)))
        return F.transform(F.when(F.size(F.array_distinct(names)) < F.size(names), last).otherwise(attrs), entry)

    none = F.array().cast("array<struct<key:string,value:string>>")
    # A value of a lambda is made once, however often it is used.
    made = F.transform(F.array(found), entries)[0]
    return F.map_from_entries(F.when(line.contains("="), made).otherwise(F.when(line.isNotNull(), none)))


def struct_events(lines: DataFrame) -> DataFrame:
    """Structure tags with ``kind`` (open, close, empty), ``name``, ``attrs`` and ``broken`` (see ``is_whole_tag``); other columns stay."""
    line = F.col("line")
    return (
        lines.where(is_tag(line))
        .withColumns({"kind": line_kind(line), "name": tag_name(line), "attrs": tag_attrs(line), "broken": ~is_whole_tag(line)})
        .drop("line")
    )


def token_lines(lines: DataFrame) -> DataFrame:
    """Token lines with ``cols``, the array of their columns; other columns stay."""
    line = F.col("line")
    return lines.where(line_kind(line) == "token").withColumn("cols", F.split(line, "\t")).drop("line")


def token_column(idx: int, cols: str = "cols") -> Column:
    """The column at ``idx``; a line too short has an empty one."""
    return F.coalesce(F.get(F.col(cols), F.lit(idx)), F.lit(""))
