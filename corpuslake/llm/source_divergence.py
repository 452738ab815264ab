"""How far the sources of a language differ in their terms: frequent terms by prefixes, then distances and marked terms.

Frequent terms (in at least so many documents of a language) are found by extending byte prefixes level by level. A
prefix is in at least as many documents as each of its extensions, so one that is in too few is not extended. A term ends with
an end mark; a prefix that ends with it is a complete term, and is kept.

Documents are written once as chunks: a chunk's distinct terms, sorted, and for each document the numbers of its terms. A level
counts a chunk's prefixes there and adds the chunks up. What survives is told to the next level as a bitmap of hashes of
bounded size; a prefix let through by chance is counted exactly again, and falls then.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuslake.llm.common import whole_text, words_of
from corpuslake.stages import Stages

_END = b"\0"  # not part of any term
_BUCKET = 1 << 15  # bits that Spark's bitmap functions put in one value
_BRIEF = 64  # bytes of keys that are hashed together
_CHUNK = pa.schema(
    [("lang", pa.string()), ("sources", pa.list_(pa.string())), ("ids", pa.list_(pa.string())),
     ("terms", pa.list_(pa.binary())), ("starts", pa.list_(pa.int64())), ("codes", pa.list_(pa.int32())),
     ("counts", pa.list_(pa.int32()))]
)
_CHUNK_SQL = (
    "lang string, sources array<string>, ids array<string>, terms array<binary>, starts array<long>, codes array<int>, "
    "counts array<int>"
)
#: A chunk is a row of some MB. Spark's reader decodes up to 4,096 rows of a row group at once, and the writer looks at the size of one
#: after 100 rows, so a task would hold all chunks of its file. Looked at after each row, a row group is a few chunks.
_FEW_A_GROUP = {"parquet.block.size": 1 << 24, "parquet.block.size.row.check.min": 1, "parquet.page.size.row.check.min": 1}
#: Bytes that terms are made of: ASCII letters, and all of characters beyond ASCII.
_LETTERS = np.array([b >= 0x80 or chr(b).isalpha() for b in range(256)])


@dataclass(frozen=True)
class Divergence:
    """``least``: documents of a language that a kept term is in. ``smoothing`` is added to each count, ``scale`` is the whole
    that shares are parts of. ``top``: marked terms of a source.

    ``first``: bytes of the first level's prefixes; each level has twice as many. ``chunk``: about so many bytes of text.
    ``bits``: of a bitmap, at most. ``block_terms``, ``block_sources``: of a cell in which sources are compared.
    """

    least: int = 30
    smoothing: int = 5
    scale: int = 1_000_000_000
    top: int = 50
    first: int = 3
    chunk: int = 1 << 24
    bits: int = 1 << 27
    block_terms: int = 1 << 13
    block_sources: int = 1 << 8


# --- bitmaps of hashes ------------------------------------------------------------------------


def bitmap(rows: DataFrame, h: Column, n: int, most: int) -> np.ndarray:
    """The hashes ``h`` (bigints) of ``n`` rows as a bitmap of 16 to 32 bits a row, ``most`` bits at most."""
    bits = int(np.clip(1 << (16 * max(n, 1) - 1).bit_length(), _BUCKET, most))
    at = rows.select(F.pmod(h, F.lit(bits)).alias("at"))
    # At most ``most`` / 32,768 values of 4 KB.
    found = at.groupBy(F.expr(f"at div {_BUCKET}").alias("bucket")).agg(
        F.bitmap_construct_agg((F.col("at") % _BUCKET).cast("long")).alias("part")
    )
    out = np.zeros(bits // 8, np.uint8)
    for r in found.collect():
        part = np.frombuffer(bytes(r["part"]), np.uint8)
        out[r["bucket"] * _BUCKET // 8 :][: len(part)] = part
    return out


def among(hashes: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Of each hash (int64) whether its bit is set."""
    at = hashes % np.int64(len(bits) * 8)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0


def _mixed(h: np.ndarray, words: np.ndarray) -> np.ndarray:
    h = (h ^ words) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def key_hashes(lang: str, keys: pa.Array) -> np.ndarray:
    """A hash (int64) of the language and each key (binary, no nulls): eight bytes at a time, all keys at once; long keys one by one."""
    if not len(keys):
        return np.empty(0, np.int64)
    seed = np.uint64(xxhash.xxh3_64_intdigest(lang.encode()))
    ends = np.frombuffer(keys.buffers()[1], np.int32)[keys.offset : keys.offset + len(keys) + 1].astype(np.int64)
    start, size = ends[:-1], np.diff(ends)
    octets = np.zeros(int(ends[-1] - ends[0]) + 8, np.uint8)
    if len(octets) > 8:
        octets[:-8] = np.frombuffer(keys.buffers()[2], np.uint8)[ends[0] : ends[-1]]
    start = start - ends[0]
    h = _mixed(np.full(len(keys), seed), size.astype(np.uint64))
    brief = size <= _BRIEF
    for at in range(0, min(_BRIEF, int(size.max(initial=0))), 8):
        rows = np.flatnonzero(brief & (size > at))
        words = np.ascontiguousarray(octets[(start[rows] + at)[:, None] + np.arange(8)]).view("<u8")[:, 0]
        # Bytes behind the key's end count as zeros.
        beyond = 8 * (8 - np.minimum(size[rows] - at, 8)).astype(np.uint64)
        h[rows] = _mixed(h[rows], words << beyond)
    for k in np.flatnonzero(~brief).tolist():
        h[k] = seed ^ np.uint64(xxhash.xxh3_64_intdigest(octets[start[k] : start[k] + size[k]].tobytes()))
    return h.view(np.int64)


# --- chunks of documents ----------------------------------------------------------------------


def _chunk(lang: str, sources: list, ids: list, texts: pa.Array) -> pa.RecordBatch:
    """``ids``: of documents whose id stands in several rows; null for all others."""
    words, doc = words_of(texts, _LETTERS)
    coded = words.dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    width = max(1, len(order))
    pairs, counts = np.unique(doc * width + rank[coded.indices.to_numpy()], return_counts=True)
    starts = np.searchsorted(pairs, np.arange(len(texts) + 1) * width)
    values = [[lang], [sources], [ids], None, [starts], [(pairs % width).astype(np.int32)], [counts.astype(np.int32)]]
    terms = coded.dictionary.take(pa.array(order)).cast(pa.binary())
    columns = [pa.array(v, f.type) for v, f in zip(values, _CHUNK, strict=True) if v is not None]
    columns.insert(3, pa.ListArray.from_arrays(pa.array([0, len(terms)], pa.int32()), terms))
    return pa.RecordBatch.from_arrays(columns, schema=_CHUNK)


def _chunker(repeated: np.ndarray, size: int):
    def chunks(batches):
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            maybe = among(batch.column("h").to_numpy(zero_copy_only=False), repeated)
            ids = [i if m else None for i, m in zip(batch.column("id").to_pylist(), maybe.tolist(), strict=True)]
            sources = batch.column("source").to_pylist()
            octets = pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False)
            for lang in dict.fromkeys(langs):
                rows = np.array([k for k, x in enumerate(langs) if x == lang])
                part = np.cumsum(octets[rows], dtype=np.int64) // size
                for p in np.unique(part):
                    some = rows[part == p]
                    yield _chunk(lang, [sources[k] for k in some], [ids[k] for k in some], batch.column("text").take(pa.array(some)))

    return chunks


def _column(batch: pa.RecordBatch, name: str, row: int) -> np.ndarray:
    return batch.column(name)[row].values.to_numpy(zero_copy_only=False)


def _ended_terms(batch: pa.RecordBatch, row: int) -> pa.Array:
    """A chunk's terms, each with the end mark."""
    return pc.binary_join_element_wise(batch.column("terms")[row].values, pa.scalar(_END), pa.scalar(b""))


def _runs(keys: pa.Array) -> np.ndarray:
    """Of sorted keys, the number of each one's run of equal keys."""
    if len(keys) < 2:
        return np.zeros(len(keys), np.int64)
    differ = pc.not_equal(keys[1:], keys[:-1]).to_numpy(zero_copy_only=False)
    return np.concatenate(([0], np.cumsum(differ)))


def _counter(size: int, before: int, alive: np.ndarray | None):
    """Of each chunk: (lang, key, its hash, null, documents with it), and rows with the id instead for documents whose id repeats."""

    def count_chunk(batch: pa.RecordBatch, row: int) -> pa.RecordBatch:
        lang, terms = batch.column("lang")[row].as_py(), _ended_terms(batch, row)
        on = pc.binary_length(terms).to_numpy(zero_copy_only=False) > before
        if alive is not None:
            places = np.flatnonzero(on)
            parents = pc.binary_slice(terms.take(pa.array(places)), 0, before)
            run = _runs(parents)
            first = np.flatnonzero(np.diff(run, prepend=-1))
            on[places] = among(key_hashes(lang, parents.take(pa.array(first))), alive)[run]
        places = np.flatnonzero(on)
        keys = pc.binary_slice(terms.take(pa.array(places)), 0, size)
        # Terms are sorted, so equal prefixes are neighbours.
        run = _runs(keys)
        group = np.full(len(terms), -1, np.int32)
        group[places] = run
        heads = keys.take(pa.array(np.flatnonzero(np.diff(run, prepend=-1))))
        codes, starts = _column(batch, "codes", row), _column(batch, "starts", row)
        doc = np.repeat(np.arange(len(starts) - 1, dtype=np.int32), np.diff(starts))
        g = group[codes]
        doc, g = doc[g >= 0], g[g >= 0]
        once = np.ones(len(g), bool)
        once[1:] = (g[1:] != g[:-1]) | (doc[1:] != doc[:-1])
        doc, g = doc[once], g[once]
        ids = batch.column("ids")[row].values
        shared = ids.is_valid().to_numpy(zero_copy_only=False)[doc]
        n = np.bincount(g[~shared], minlength=len(heads))
        told = np.flatnonzero(n)
        names = ids.take(pa.array(doc[shared])).to_pylist()
        pairs = sorted(set(zip(names, g[shared].tolist(), strict=True)))
        found = heads.take(pa.array(np.concatenate([told, np.array([k for _, k in pairs], np.int64)])))
        return pa.RecordBatch.from_arrays(
            [pa.repeat(pa.scalar(lang, pa.string()), len(found)), found, pa.array(key_hashes(lang, found)),
             pa.array([None] * len(told) + [i for i, _ in pairs], pa.string()),
             pa.array(np.concatenate([n[told], np.ones(len(pairs), np.int64)]))],
            ["lang", "key", "h", "id", "n"],
        )

    def count(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                yield count_chunk(batch, row)

    return count


def _occurrences(kept: np.ndarray):
    """Of each chunk: (lang, source, key, occurrences) for terms in the bitmap."""

    def count_chunk(batch: pa.RecordBatch, row: int) -> pa.RecordBatch:
        lang, terms = batch.column("lang")[row].as_py(), _ended_terms(batch, row)
        on = among(key_hashes(lang, terms), kept)
        codes, starts = _column(batch, "codes", row), _column(batch, "starts", row)
        names = batch.column("sources")[row].values.dictionary_encode()
        source = np.repeat(names.indices.to_numpy().astype(np.int64), np.diff(starts))
        some = on[codes]
        # Terms that are kept are numbered anew.
        width, new = max(1, int(on.sum())), np.cumsum(on) - 1
        key, n = source[some] * width + new[codes[some]], _column(batch, "counts", row)[some]
        if len(names.dictionary) * width <= 4 * len(key):
            # Sums of whole numbers, far below the bound of doubles.
            sums = np.bincount(key, weights=n).astype(np.int64)
            at = np.flatnonzero(sums)
            sums = sums[at]
        else:
            at, where = np.unique(key, return_inverse=True)
            sums = np.bincount(where, weights=n, minlength=len(at)).astype(np.int64)
        held = terms.take(pa.array(np.flatnonzero(on)))
        return pa.RecordBatch.from_arrays(
            [pa.repeat(pa.scalar(lang, pa.string()), len(at)), names.dictionary.take(pa.array(at // width)),
             held.take(pa.array(at % width)), pa.array(sums)],
            ["lang", "source", "key", "n"],
        )

    def count(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                yield count_chunk(batch, row)

    return count


# --- frequent terms ---------------------------------------------------------------------------


def chunks_of(docs: DataFrame, stages: Stages, how: Divergence) -> DataFrame:
    """``docs``: id (string), lang, source, text, no nulls but in id."""
    # Ids in several rows of a language are told by a bitmap; documents it lets through by chance are counted by id as well.
    rows = docs.withColumn("h", F.xxhash64("lang", "id"))
    several = rows.where("id is not null").groupBy("lang", "id").agg(F.count("*").alias("n"), F.first("h").alias("h"))
    several = stages.keep(several.where("n > 1").select("h"))
    n = several.count()
    repeated = bitmap(several, F.col("h"), n, how.bits) if n else np.zeros(_BUCKET // 8, np.uint8)
    rows = rows.select("lang", "source", "id", "text", F.when(F.col("id").isNull(), F.lit(0)).otherwise(F.col("h")).alias("h"))
    return stages.keep(rows.mapInArrow(_chunker(repeated, how.chunk), _CHUNK_SQL), **_FEW_A_GROUP)


def frequent_terms(chunks: DataFrame, stages: Stages, how: Divergence) -> DataFrame:
    """``lang, key, h, n``: terms (with the end mark) in at least ``how.least`` documents of the language, and their number."""
    kept, size, before, alive = None, how.first, 0, None
    while True:
        counted = chunks.select("lang", "ids", "terms", "starts", "codes").mapInArrow(
            _counter(size, before, alive), "lang string, key binary, h long, id string, n long"
        )
        counted = counted.groupBy("lang", "key", "h", "id").agg(F.sum("n").alias("n"))
        by_doc = F.when(F.col("id").isNull(), F.col("n")).otherwise(F.lit(1))
        counted = counted.groupBy("lang", "key", "h").agg(F.sum(by_doc).alias("n")).where(F.col("n") >= how.least)
        level = stages.keep(counted)
        complete = F.substring("key", -1, 1) == F.lit(_END)
        found = level.where(complete)
        kept = found if kept is None else kept.union(found)
        onward = level.where(~complete)
        left = onward.count()
        if not left:
            return kept
        alive = bitmap(onward, F.col("h"), left, how.bits)
        size, before = 2 * size, size


# --- shares, distances and marked terms -------------------------------------------------------


def _share(n: str, total: str, terms: str, how: Divergence) -> Column:
    """1 + floor(scale * (n + smoothing) / (total + smoothing * terms)), in whole numbers; 0 without terms."""
    above = f"cast({how.scale} as decimal(12, 0)) * cast({n} + {how.smoothing} as decimal(20, 0))"
    below = f"cast({total} + {how.smoothing} * {terms} as decimal(20, 0))"
    return F.expr(f"case when {terms} > 0 then 1 + ({above}) div ({below}) else cast(0 as bigint) end")


_CELL_SQL = "lang string, source string, other string, apart long, seen long, base long"


def _compare(key, table):
    """All pairs of a cell's sources (of both its blocks, if they are two): sums of differences over the terms seen here."""
    lang, _, i, j = (k.as_py() for k in key)
    sources = table.column("source").combine_chunks().dictionary_encode()
    names, at = sources.dictionary.to_pylist(), sources.indices.to_numpy()
    block, rest = np.zeros(len(names), np.int64), np.zeros(len(names), np.int64)
    block[at] = table.column("block").to_numpy()
    rest[at] = table.column("p0").to_numpy()
    term = table.column("h").to_numpy()
    present = ~np.isnan(table.column("p").to_numpy()) if table.column("p").null_count else np.ones(len(table), bool)
    rows, row = np.unique(term[present], return_inverse=True)
    share = np.repeat(rest[None, :], len(rows), axis=0)
    share[row, at[present]] = table.column("p").combine_chunks().fill_null(0).to_numpy()[present]
    left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
    out = {c: [] for c in ("source", "other", "apart", "base")}
    for a in left:
        apart = np.abs(share[:, [a]] - share[:, right]).sum(axis=0)
        base = np.abs(rest[a] - rest[right])
        for b, x, y in zip(right.tolist(), apart.tolist(), base.tolist(), strict=True):
            if a != b:
                out["source"].append(names[a])
                out["other"].append(names[b])
                out["apart"].append(x)
                out["base"].append(y)
                if i != j:
                    out["source"].append(names[b])
                    out["other"].append(names[a])
                    out["apart"].append(x)
                    out["base"].append(y)
    n = len(out["source"])
    return pa.table(
        {"lang": pa.array([lang] * n, pa.string()), "source": pa.array(out["source"], pa.string()),
         "other": pa.array(out["other"], pa.string()), "apart": pa.array(out["apart"], pa.int64()),
         "seen": pa.array([len(rows)] * n, pa.int64()), "base": pa.array(out["base"], pa.int64())}
    )


def _distances(shares: DataFrame, groups: DataFrame, how: Divergence) -> DataFrame:
    """``lang, source, item, value`` for all pairs of sources of a language.

    Terms are dealt to blocks, and so are sources; a cell has one block of terms and two of sources, with a row for each source
    beside those for its terms, so every pair of sources meets in every block of terms. Terms that a cell does not
    see are in neither source; their differences are all the same.
    """
    most = groups.groupBy("lang").agg(F.count("*").alias("s"), F.max("terms").alias("v")).agg(F.max("s"), F.max("v")).first()
    wide, deep = -(-(most[0] or 1) // how.block_sources), max(1, -(-(most[1] or 0) // how.block_terms))
    block = F.pmod(F.xxhash64("source"), F.lit(wide)).cast("int").alias("block")
    h = F.xxhash64("key")
    rows = shares.select("lang", "source", block, F.pmod(h, F.lit(deep)).cast("int").alias("t"), h.alias("h"), "p", "p0")
    present = groups.select(
        "lang", "source", block, F.explode(F.sequence(F.lit(0), F.lit(deep - 1))).alias("t"),
        F.lit(0).cast("long").alias("h"), F.lit(None).cast("long").alias("p"), "p0",
    )
    both = rows.unionByName(present).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(wide - 1))))
    both = both.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other")).drop("other")
    cells = both.groupBy("lang", "t", "i", "j").applyInArrow(_compare, _CELL_SQL)
    found = cells.groupBy("lang", "source", "other").agg(
        F.sum("apart").alias("apart"), F.sum("seen").alias("seen"), F.max("base").alias("base")
    )
    terms = groups.select("lang", "source", "terms")
    found = found.join(terms, ["lang", "source"])
    return found.select(
        "lang", "source", F.col("other").alias("item"), (F.col("apart") + (F.col("terms") - F.col("seen")) * F.col("base")).alias("value")
    )


def divergence(
    docs: DataFrame, stages: Stages, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source",
    how: Divergence = Divergence(),
) -> DataFrame:
    """``lang, source, part, item, value, rank``: of each (lang, source), its distance from each other source of the language
    (part ``pair``), and the ``how.top`` terms that it has more often than the language (part ``term``).

    Null text, language and source are empty strings. Rows of one id in a language are one document when documents are counted, and each row
    is read when occurrences are; rows without an id are documents of their own. A language without frequent terms has distances of
    0. No documents: no rows.
    """
    docs = docs.select(
        F.col(doc_id).cast("string").alias("id"), whole_text(F.col(lang)).alias("lang"), whole_text(F.col(source)).alias("source"),
        whole_text(F.col(text)).alias("text"),
    )
    chunks = chunks_of(docs, stages, how)
    kept = frequent_terms(chunks, stages, how)
    n = kept.count()
    bits = bitmap(kept, F.col("h"), n, how.bits)
    counts = chunks.select("lang", "sources", "terms", "starts", "codes", "counts").mapInArrow(
        _occurrences(bits), "lang string, source string, key binary, n long"
    )
    counts = counts.groupBy("lang", "source", "key").agg(F.sum("n").alias("n"))
    counts = stages.keep(counts.join(kept.select("lang", "key"), ["lang", "key"], "left_semi"))
    terms = kept.groupBy("lang").agg(F.count("*").alias("terms"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = docs.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(terms, "lang", "left")
    groups = groups.select(
        "lang", "source", F.coalesce("total", F.lit(0)).cast("long").alias("total"), F.coalesce("terms", F.lit(0)).cast("long").alias("terms")
    )
    groups = stages.keep(groups.withColumn("p0", _share("0", "total", "terms", how)))
    shares = stages.keep(
        counts.join(groups, ["lang", "source"]).select("lang", "source", "key", "n", _share("n", "total", "terms", how).alias("p"), "p0")
    )
    pairs = _distances(shares, groups, how).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(ranked))

    langs = groups.groupBy("lang").agg(F.sum("total").alias("total"), F.max("terms").alias("terms"))
    overall = shares.groupBy("lang", "key").agg(F.sum("n").alias("n")).join(langs, "lang")
    overall = overall.select("lang", "key", _share("n", "total", "terms", how).alias("q"))
    marked = shares.join(overall, ["lang", "key"]).where(F.col("p") > F.col("q"))
    item = F.expr("cast(substring(key, 1, octet_length(key) - 1) as string)")
    marked = marked.select("lang", "source", F.lit("term").alias("part"), item.alias("item"), (F.col("p") - F.col("q")).alias("value"))
    marked = marked.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= how.top)
    return pairs.unionByName(marked)
