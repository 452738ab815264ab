"""Charsets of vertical files: how their lines are found in bytes that Spark splits anywhere, and how they become text.

In most charsets a byte 0x0A is a line end and nothing else, so lines are cut by bytes and decoded one by one. In UTF-16 and UTF-32
a line end is two or four bytes, which Spark's reader finds at any byte: U+0A05 before U+4E00 holds one, too, half in each
character. Lines cut there are put together again (``aligned``): the bytes before a cut, counted over all splits, tell it from a line end.
"""

from __future__ import annotations

import codecs
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslake.operators.ordered import Order, scan

# Charsets by their names in Python and in Java in which 0x0A is never part of a longer character.
BYTEWISE = {
    "big5": "Big5", "big5hkscs": "Big5-HKSCS", "cp932": "windows-31j", "cp949": "x-windows-949", "euc_jp": "EUC-JP",
    "euc_kr": "EUC-KR", "gb18030": "GB18030", "gb2312": "GB2312", "gbk": "GBK", "shift_jis": "Shift_JIS",
}
# Those of several bytes a unit, with their names in Java and the bytes of a unit.
UNITS = {"utf-16-le": ("UTF-16LE", 2), "utf-16-be": ("UTF-16BE", 2), "utf-32-le": ("UTF-32LE", 4), "utf-32-be": ("UTF-32BE", 4)}
# Byte order marks, at the start of a file whose charset does not say the order.
MARKS = {
    "utf-16": {codecs.BOM_UTF16_LE: "utf-16-le", codecs.BOM_UTF16_BE: "utf-16-be"},
    "utf-32": {codecs.BOM_UTF32_LE: "utf-32-le", codecs.BOM_UTF32_BE: "utf-32-be"},
}


@dataclass(frozen=True)
class Charset:
    """``java`` is None for bytes that are UTF-8 already; ``upper`` are the characters of the bytes 0x80-0xFF of a single-byte charset."""

    java: str | None = None
    width: int = 1
    marked: bool = False
    upper: str | None = None

    @property
    def line_end(self) -> bytes:
        return "\n".encode(self.java) if self.width > 1 else b"\n"

    def options(self) -> dict[str, str]:
        """Options of Spark's text reader."""
        return {"lineSep": "\n"} | ({"encoding": self.java} if self.width > 1 else {})

    def text(self, raw: Column) -> Column:
        """Text of a line's bytes; what is no character becomes U+FFFD."""
        if self.upper is not None:
            latin = "".join(map(chr, range(0x80, 0x100)))
            return F.translate(F.decode(raw, "ISO-8859-1"), latin, self.upper)
        if self.java is None:
            return raw.cast("string")
        if self.width < 4:
            return F.decode(raw, self.java)
        # Java takes U+FEFF at the start of UTF-32 for a mark, so a character goes before each line and is taken off again.
        guarded = F.concat(F.lit(bytearray("x".encode(self.java))), raw)
        return F.substring(F.decode(guarded, self.java), 2, 2**31 - 1)


def _single_byte(name: str) -> str | None:
    try:
        upper = bytes(range(0x80, 0x100)).decode(name, errors="replace")
        single = len(upper) == 128 and bytes(range(0x80)).decode(name) == "".join(map(chr, range(0x80)))
    except UnicodeDecodeError:
        return None
    return upper if single else None


def charset_of(spark: SparkSession, path: str, encoding: str) -> Charset:
    """The charset of a file, by any name Python knows. Without a mark, UTF-16 and UTF-32 are big-endian (RFC 2781)."""
    name = codecs.lookup(encoding).name
    if name in ("utf-8", "ascii"):
        return Charset()
    if name in BYTEWISE:
        return Charset(BYTEWISE[name])
    if name in UNITS:
        return Charset(*UNITS[name])
    if name in MARKS:
        head = _first_bytes(spark, path, 4)
        found = next((order for mark, order in MARKS[name].items() if head.startswith(mark)), None)
        return Charset(*UNITS[found or f"{name}-be"], marked=found is not None)
    if (upper := _single_byte(name)) is not None:
        return Charset(upper=upper)
    raise ValueError(f"unsupported vertical encoding: {encoding}")


def _first_bytes(spark: SparkSession, path: str, n: int) -> bytes:
    hadoop, conf = spark._jvm.org.apache.hadoop, spark._jsc.hadoopConfiguration()
    file = hadoop.fs.Path(path)
    stream = file.getFileSystem(conf).open(file)
    try:
        codec = hadoop.io.compress.CompressionCodecFactory(conf).getCodec(file)
        source = codec.createInputStream(stream) if codec else stream
        found = [source.read() for _ in range(n)]
    finally:
        stream.close()
    return bytes(b for b in found if b >= 0)


@contextmanager
def any_charset(spark: SparkSession) -> Iterator[None]:
    """Lets ``decode`` take any charset of Java and replace malformed bytes; the expression keeps this when it has been made."""
    names = ("spark.sql.legacy.javaCharsets", "spark.sql.legacy.codingErrorAction")
    before = {n: spark.conf.get(n) for n in names}
    for n in names:
        spark.conf.set(n, "true")
    try:
        yield
    finally:
        for n, value in before.items():
            spark.conf.set(n, value)


def aligned(rows: DataFrame, charset: Charset) -> DataFrame:
    """Lines of ``raw`` bytes without cuts inside characters; ``file_idx`` and the columns of ``Order`` place them, others stay.

    The first piece of a line that was cut gets all of it, the others become empty, so rows keep their numbers. Only pieces are
    shuffled once more, by line. A file whose bytes are no whole number of units is read as if its end were cut off.
    """
    width, length = charset.width, F.length("raw")
    order = Order().keyed("file_idx")
    placed = scan(rows, order, {"__before": length % width}, before=["__before"])
    begins, ends = F.col("__before") % width == 0, (F.col("__before") + length) % width == 0
    whole = placed.where(begins & ends).drop("__before")
    pieces = scan(placed.where(~(begins & ends)), order, lasts={"__first": F.when(begins, F.col("pos"))})
    pieces = pieces.select(*order.keys, "__first", F.struct("pos", *[c for c in rows.columns if c != "pos" and c not in order.keys]).alias("row"))
    # The pieces of one line are gathered, as the line itself is one value.
    lines = pieces.groupBy(*order.keys, "__first").agg(F.array_sort(F.collect_list("row")).alias("rows"))
    end, raws = F.lit(bytearray(charset.line_end)), F.transform("rows", lambda r: r["raw"])
    joined = F.reduce(F.slice(raws, 2, F.size(raws)), F.get(raws, F.lit(0)), lambda a, b: F.concat(a, end, b))
    flat = lines.select(*order.keys, joined.alias("__joined"), F.posexplode("rows").alias("__i", "row"))
    value = {"raw": F.when(F.col("__i") == 0, F.col("__joined")).otherwise(F.lit(bytearray()))}
    back = flat.select(*[value.get(c, F.col(c) if c in order.keys else F.col(f"row.{c}")).alias(c) for c in rows.columns])
    return whole.select(*rows.columns).unionByName(back)
