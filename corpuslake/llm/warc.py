"""WARC archives: a deterministic sharded writer that stores equal payloads once, and a reader.

Shards are ranges of ids, chosen from the data alone; within one, records are in order of id, and a file is closed once
its compressed size reaches a limit. Tasks write under temporary names and return rows of a manifest. Spark keeps the rows of
one attempt of each task, and only the files these name get their final names, so that lost executors and repeated attempts
leave nothing behind. The same input gives the same files, byte for byte.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from urllib.parse import quote

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from corpuslake.llm.common import whole_text
from corpuslake.stages import Stages

_VERSION = "WARC/1.1"
_SAME = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_URN = "urn:page:"
_MANIFEST_SQL = "shard int, file int, temporary string, name string, records long, bytes long"
_RECORD_SQL = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload string"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload, usedforsecurity=False).digest()).decode()


# --- records ----------------------------------------------------------------------------------


def record(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as a gzip member of its own."""
    lines = [_VERSION, f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block)}", "", ""]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)  # its header has no time
    return packer.compress("\r\n".join(lines).encode() + block + b"\r\n\r\n") + packer.flush()


def page_record(page: str, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, date: str) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    target = quote(url, safe="!#$%&'()*+,/:;=?@[]~") if url else _URN + page
    headers = [
        ("WARC-Record-ID", f"<{_URN}{page}>"),
        ("WARC-Target-URI", target),
        ("WARC-Date", date),
        ("WARC-Payload-Digest", f"sha1:{digest(payload)}"),
        ("WARC-Block-Digest", f"sha1:{digest(block)}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if revisit:
        headers += [("WARC-Profile", _SAME), ("WARC-Refers-To", f"<{_URN}{refers_to}>")]
    return record("revisit" if revisit else "response", headers, block)


class _Files:
    """The files of one task: at most one open, each rolled by its compressed size."""

    def __init__(self, folder: str, most_bytes: int, date: str):
        self._fs, self._root = fs.FileSystem.from_uri(folder)
        self._attempt, self._most, self._date = uuid.uuid4().hex, most_bytes, date
        self._fs.create_dir(f"{self._root}/_temporary/{self._attempt}", recursive=True)
        self._out, self._row, self._next = None, None, (-1, 0)
        self.closed: list[tuple] = []

    def add(self, shard: int, packed: bytes) -> None:
        if self._out is None or self._row[0] != shard or self._row[5] + len(packed) > self._most:
            self.close()
            number = self._next[1] if self._next[0] == shard else 0
            self._next = (shard, number + 1)
            name = f"pages-{shard:06d}-{number:06d}.warc.gz"
            temporary = f"_temporary/{self._attempt}/{name}"
            self._out = self._fs.open_output_stream(f"{self._root}/{temporary}", compression=None)
            self._row = [shard, number, temporary, name, 0, 0]
            info = f"software: corpuslake\r\nformat: {_VERSION[5:]}\r\n".encode()
            self._write(
                record(
                    "warcinfo",
                    [("WARC-Record-ID", f"<urn:file:{name}>"), ("WARC-Date", self._date), ("WARC-Filename", name),
                     ("Content-Type", "application/warc-fields")],
                    info,
                )
            )
        self._write(packed)
        self._row[4] += 1

    def _write(self, packed: bytes) -> None:
        self._out.write(packed)
        self._row[5] += len(packed)

    def close(self) -> None:
        if self._out is not None:
            self._out.close()
            self.closed.append(tuple(self._row))
            self._out = None

    def manifest(self) -> pd.DataFrame:
        rows, self.closed = self.closed, []
        return pd.DataFrame(rows, columns=["shard", "file", "temporary", "name", "records", "bytes"])


def _written(folder: str, most_bytes: int, date: str):
    """Sorted rows to files. A row without payload precedes the pages it decides: they revisit ``keeper``."""

    def write(batches):
        files = _Files(folder, most_bytes, date)
        decided, last, copies = None, None, 0
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("shard", "page_id", "sha", "kind", "keeper", "url", "body")]
            for shard, page, sha, kind, keeper, url, body in zip(*columns, strict=True):
                if kind == 0:
                    decided = (page, sha, keeper)
                    continue
                own = decided is not None and decided[:2] == (page, sha)
                same = page is not None and last == (shard, page, sha)
                first_of_page = last is None or last[:2] != (shard, page)
                copies = 0 if first_of_page else copies + 1
                name = "none" if page is None else str(page)
                if copies or page is None:
                    name += f":{shard}:{copies}"
                # Without a decision a page is the keeper of its payload; its repeated rows revisit it.
                to = decided[2] if own else page if same and keeper else None
                files.add(shard, page_record(name, url, (body or "").encode(), to, to is not None, date))
                last = (shard, page, sha)
            yield pa.RecordBatch.from_pandas(files.manifest(), schema=_MANIFEST)
        files.close()
        yield pa.RecordBatch.from_pandas(files.manifest(), schema=_MANIFEST)

    return write


_MANIFEST = pa.schema(
    [("shard", pa.int32()), ("file", pa.int32()), ("temporary", pa.string()), ("name", pa.string()), ("records", pa.int64()),
     ("bytes", pa.int64())]
)


def _committed(folder: str):
    """Gives files their final names; a file that has it already was renamed by an earlier attempt."""

    def commit(frames):
        store, root = fs.FileSystem.from_uri(folder)
        for rows in frames:
            for temporary, name in zip(rows["temporary"], rows["name"], strict=True):
                if store.get_file_info(f"{root}/{temporary}").type != fs.FileType.NotFound:
                    store.move(f"{root}/{temporary}", f"{root}/{name}")
            yield rows

    return commit


def bounds_of(rows: DataFrame, size: Column, shard_bytes: int, most_shards: int) -> np.ndarray:
    """Ids at which shards begin: a function of the data alone. About eight ids a shard, chosen by hash, are collected."""
    total = rows.agg(F.count("page_id").alias("n"), F.sum(size).alias("bytes")).first()
    shards = int(min(most_shards, max(1, (total["bytes"] or 0) // shard_bytes), max(1, total["n"])))
    every = max(1, total["n"] // (8 * shards))
    ids = rows.where(F.pmod(F.xxhash64("page_id"), F.lit(every)) == 0).select("page_id").dropna().toPandas()["page_id"]
    ids = np.unique(ids.to_numpy(np.int64))
    return np.unique(ids[[len(ids) * k // shards for k in range(1, shards)]]) if len(ids) else ids


def write_warc(
    pages: DataFrame,
    folder: str,
    stages: Stages,
    page_id: str = "page_id",
    url: str = "url",
    payload: str = "html",
    least_bytes: int = 0,
    file_bytes: int = 1 << 28,
    shard_bytes: int = 1 << 25,
    most_shards: int = 1 << 15,
    date: str = "1970-01-01T00:00:00Z",
) -> DataFrame:
    """Writes one record per row below ``folder`` (a URI that every executor reaches, not there yet) and returns the manifest.

    Of rows with equal payloads of at least ``least_bytes`` that with the largest id is stored, the others are revisits of
    it. Null payloads are empty ones. Rows without an id are stored whole and are nobody's original. A row that
    repeats the id and payload of the stored one is a revisit of it. A null url becomes the record's name. Other columns aren't
    read, so they can't clash. An empty table writes no file. Equal means equal length and SHA-1.
    """
    spark = pages.sparkSession
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), whole_text(F.col(payload)).alias("body")
    )
    rows = rows.withColumn("sha", F.unhex(F.sha1(F.col("body").cast("binary")))).withColumn("size", F.octet_length("body"))
    ids = rows.where(F.col("page_id").isNotNull() & (F.col("size") >= least_bytes)).select("page_id", "sha", "size")
    keepers = ids.groupBy("sha", "size").agg(F.max("page_id").alias("keeper"), F.min("page_id").alias("least"))
    # Written, so that the join has a plain shuffle on both sides, and Spark can split what one payload brings.
    keepers = stages.keep(keepers.where(F.col("keeper") != F.col("least")))
    decided = ids.join(keepers, ["sha", "size"]).where(F.col("page_id") != F.col("keeper")).distinct()

    starts = bounds_of(rows, F.col("size"), shard_bytes, most_shards)

    @pandas_udf("int")
    def shard(page: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(starts, page.to_numpy(np.int64), side="right").astype(np.int32))

    none = F.lit(None)
    # The column keeper of a page says whether copies of it may be stored as revisits at all.
    body = rows.select(
        "page_id", "sha", F.lit(1).alias("kind"), F.when(F.col("size") >= least_bytes, F.lit(1).cast("long")).alias("keeper"),
        "url", "body",
    )
    both = body.union(
        decided.select("page_id", "sha", F.lit(0).alias("kind"), "keeper", none.cast("string"), none.cast("string"))
    ).withColumn("shard", shard(F.coalesce("page_id", F.lit(-(1 << 63)))))
    both = both.repartitionById(len(starts) + 1, F.col("shard")).sortWithinPartitions("shard", "page_id", "sha", "kind", "url")
    manifest = f"{folder}/_temporary/manifest"
    both.mapInArrow(_written(folder, file_bytes, date), _MANIFEST_SQL).write.parquet(manifest)
    rows = spark.read.schema(_MANIFEST_SQL).parquet(manifest).mapInPandas(_committed(folder), _MANIFEST_SQL)
    rows.write.parquet(f"{folder}/_manifest")
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_temporary")
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    return spark.read.schema(_MANIFEST_SQL).parquet(f"{folder}/_manifest")


# --- reading ----------------------------------------------------------------------------------


def members(stream, chunk: int = 1 << 20):
    """The gzip members of a stream, each unpacked."""
    unpack, parts = zlib.decompressobj(31), []
    while data := stream.read(chunk):
        while data:
            parts.append(unpack.decompress(data))
            data = unpack.unused_data
            if unpack.eof:
                yield b"".join(parts)
                unpack, parts = zlib.decompressobj(31), []
    if parts:
        raise ValueError("the archive ends inside a record")


def parse(packed: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (by lower-case name; ``version`` is the first line) and block of a record."""
    head, _, rest = packed.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    headers = {k.strip().lower(): v.strip() for k, v in (line.split(":", 1) for line in lines)} | {"version": version}
    n = int(headers["content-length"])
    if len(rest) < n:
        raise ValueError("a block is shorter than its header says")
    return headers, rest[:n]


def _page(name: str | None) -> int | None:
    found = re.match(rf"<{_URN}(-?\d+)", name or "")
    return int(found[1]) if found else None


def page_of(headers: dict[str, str], block: bytes, with_payload: bool) -> tuple:
    """A row of the pages table with what the record says of its payload; a stored payload must have the digest it names."""
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"(?im)^content-length:\s*(\d+)", http)[1])
    named = headers["warc-payload-digest"].removeprefix("sha1:")
    kind = headers["warc-type"]
    if kind == "response" and (len(payload), digest(payload)) != (size, named):
        raise ValueError(f"the payload of {headers['warc-record-id']} does not have its digest")
    text = payload.decode() if with_payload and kind == "response" else None
    url = headers["warc-target-uri"]
    to = _page(headers.get("warc-refers-to"))
    return _page(headers["warc-record-id"]), None if url.startswith(_URN) else url, size, named, kind, to, text


def read_warc(spark: SparkSession, folder: str, with_payload: bool = False) -> DataFrame:
    """``page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload`` of every page record of the manifest's files.

    Files are read as streams, a record at a time. ``payload`` is null for revisits and unless asked for.
    """
    files = spark.read.schema(_MANIFEST_SQL).parquet(f"{folder}/_manifest")

    def read(frames):
        store, root = fs.FileSystem.from_uri(folder)
        for names in frames:
            for name in names["name"]:
                rows, chars = [], 0
                with store.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for packed in members(stream):
                        headers, block = parse(packed)
                        if headers["warc-type"] == "warcinfo":
                            continue
                        rows.append(page_of(headers, block, with_payload))
                        chars += len(rows[-1][-1] or "")
                        if len(rows) >= 4096 or chars > 1 << 24:
                            yield pa.RecordBatch.from_arrays(_columns(rows), schema=_RECORD)
                            rows, chars = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays(_columns(rows), schema=_RECORD)

    def arrow(batches):
        yield from read(b.to_pandas() for b in batches)

    n = max(1, files.count())
    return files.select("name").repartition(n).mapInArrow(arrow, _RECORD_SQL)


_RECORD = pa.schema(
    [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
     ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.string())]
)


def _columns(rows: list[tuple]) -> list[pa.Array]:
    return [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _RECORD, strict=True)]
