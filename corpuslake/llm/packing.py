"""Packing tokenized documents into windows, planned by non-negative least squares over the histogram of lengths.

A document is cut into full windows and one rest. The rests' lengths (fewer than a window's, so at most window - 1 of
them) are counted; combinations of two or three lengths that fill a window exactly are enumerated, and the repeat count of each is
solved for by least squares with counts >= 0, rounded, and filled up greedily. What no combination takes is packed
greedily end to end and cut where a window ends; the last window is cut at powers of two.

The plan depends on the histogram only. A rest finds its place in it by its length and its rank among rests of that length, so
no task sees more than its own documents.
"""

from __future__ import annotations

import os
import zlib
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpuslake.llm.common import whole_text
from corpuslake.stages import Stages

_BATCH_CHARS = 1 << 22


# --- token ids --------------------------------------------------------------------------------


@cache
def tokenizer(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@cache
def encoder(path: str, most: int = 1_000_000) -> WordEncoder:
    """One for all tasks of a process, so that later tasks find the words of earlier ones."""
    return WordEncoder(path, most)


class WordEncoder:
    """Ids of texts by a byte-level tokenizer, each distinct word encoded once.

    The tokenizer never joins what stands before a lone blank or line end with what follows, so a text whose white space
    is only such is the sequence of its words, and ids of a word (with what precedes it) are kept: at most ``most`` words,
    then it starts anew. Other texts are encoded as they are.
    """

    def __init__(self, path: str, most: int = 1_000_000):
        self._tokenizer = tokenizer(path)
        self._most = most
        vocabulary = self._tokenizer.get_vocab(with_added_tokens=True)
        self._octets = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for piece, i in vocabulary.items():
            self._octets[i] = len(piece)
        self._newline = self._encode(["\n"])[0]
        self._clear()

    def _clear(self) -> None:
        self._codes: dict[str, int] = {}
        self._ids, self._used = np.empty(1 << 16, np.uint32), 0
        self._start, self._length = np.empty(0, np.int64), np.empty(0, np.int64)

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        found = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, np.uint32) for e in found]

    def _learn(self, words: list[str]) -> None:
        """Encodes many words as one text and cuts its ids at the words' ends, which the ids' lengths in bytes show."""
        for k in range(0, len(words), 4096):
            some = words[k : k + 4096]
            spaced = [w if w[0] == "\n" else " " + w for w in some]
            ids = self._encode(["".join(spaced)])[0]
            stops = np.searchsorted(
                np.cumsum(self._octets[ids]), np.cumsum([len(w.encode()) for w in spaced]), side="left"
            )
            lengths = np.diff(stops + 1, prepend=0)
            while self._used + len(ids) > len(self._ids):
                self._ids = np.concatenate([self._ids, np.empty_like(self._ids)])
            self._ids[self._used : self._used + len(ids)] = ids
            self._codes.update(zip(some, range(len(self._codes), len(self._codes) + len(some)), strict=True))
            self._start = np.concatenate([self._start, self._used + np.cumsum(lengths) - lengths])
            self._length = np.concatenate([self._length, lengths])
            self._used += len(ids)

    @staticmethod
    def plain(text: str) -> bool:
        """Whether each white space is one blank or line end between other characters."""
        if not text or text[0].isspace() or text[-1].isspace():
            return False
        if "  " in text or " \n" in text or "\n " in text or "\n\n" in text:
            return False
        return len(text.split()) == 1 + text.count(" ") + text.count("\n")

    def _words(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of plain texts. A line end before each text makes its first word like a line's; its id goes again."""
        lines = pa.array(["\n" + t.replace("\n", " \n") for t in texts], pa.large_string())
        split = pc.split_pattern(lines, " ")
        words = split.flatten().dictionary_encode()
        names = words.dictionary.to_pylist()
        if len(self._codes) + len(names) > self._most:
            self._clear()
        get = self._codes.get
        if new := [w for w in names if get(w) is None]:
            self._learn(new)
        codes = np.fromiter(map(self._codes.__getitem__, names), np.int64, len(names))[np.asarray(words.indices)]
        lengths = self._length[codes]
        ends = np.cumsum(lengths)
        ids = self._ids[np.repeat(self._start[codes] - ends + lengths, lengths) + np.arange(ends[-1])]
        stops = ends[np.asarray(split.offsets)[1:] - 1].tolist()
        return [ids[a + len(self._newline) : b] for a, b in zip([0, *stops], stops, strict=False)]

    def _segments(self, text: str):
        """A long plain text in parts that each begin after a blank or line end; the tokenizer sees no difference."""
        start = 0
        while len(text) - start > _BATCH_CHARS:
            cut = text.find("\n", start + _BATCH_CHARS // 2)
            if cut < 0 or cut - start > 2 * _BATCH_CHARS:
                break
            yield text[start:cut]
            start = cut + 1
        yield text[start:]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray] = [np.empty(0, np.uint32)] * len(texts)
        waiting, chars = [], 0

        def flush():
            nonlocal waiting, chars
            if waiting:
                for k, ids in zip(waiting, self._words([texts[k] for k in waiting]), strict=True):
                    out[k] = ids
            waiting, chars = [], 0

        for k, text in enumerate(texts):
            if not text:
                continue
            if not self.plain(text):
                out[k] = self._encode([text])[0]
            elif len(text) > _BATCH_CHARS:
                parts = []
                for n, part in enumerate(self._segments(text)):
                    parts += ([self._newline] if n else []) + self._words([part])
                out[k] = np.concatenate(parts)
            else:
                waiting.append(k)
                chars += len(text)
                if chars > _BATCH_CHARS:
                    flush()
        flush()
        return out


# --- the plan ---------------------------------------------------------------------------------


def combinations(window: int) -> np.ndarray:
    """Pairs and triples of lengths that add up to the window, as rows of three (0: none), longest first."""
    pairs = [(window - a, a, 0) for a in range(1, window // 2 + 1)]
    triples = [
        (a, window - a - c, c)
        for c in range(1, window // 3 + 1)
        for a in range(window - 2 * c, (window - c + 1) // 2 - 1, -1)
    ]
    return np.array(pairs + triples, np.int64).reshape(-1, 3)


def least_squares(combos: np.ndarray, counts: np.ndarray, rounds: int = 150) -> np.ndarray:
    """x >= 0 that makes the sum of the combinations' lengths, x times each, close to the counts: accelerated projected gradient."""

    def used(x):
        y = np.bincount(combos.ravel(), weights=np.repeat(x, combos.shape[1]), minlength=len(counts))
        y[0] = 0
        return y

    def spread(r):
        return r[combos].sum(axis=1)

    counts = counts.astype(np.float64)
    v = np.ones(len(combos))
    for _ in range(10):
        v = spread(used(v))
        top = np.linalg.norm(v)
        v /= top
    x = z = np.zeros(len(combos))
    t = 1.0
    for _ in range(rounds):
        new = np.maximum(0.0, z - spread(used(z) - counts) / (1.05 * top))
        t_new = (1 + (1 + 4 * t * t) ** 0.5) / 2
        z = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x


@dataclass(frozen=True)
class Plan:
    """``key`` = length << 50 | first rank, sorted, of every interval of ranks; ``sequence`` of its first, ``step`` 0 or 1 by which
    it grows, ``offset``; or, with step 0, the place in the stream of what is packed end to end."""

    window: int
    key: np.ndarray
    sequence: np.ndarray
    step: np.ndarray
    offset: np.ndarray
    stream_sequence: int
    stream_ends: np.ndarray  # of the last, shorter sequences
    stream_full: int  # tokens in full windows


def plan(counts: np.ndarray, window: int) -> Plan:
    """``counts[l]``: rests or full windows of length l, for l up to the window."""
    left = counts.astype(np.int64).copy()
    combos = combinations(window)
    rows, sequence = [], int(left[window])
    rows.append((window, 0, 0, 1, 0))
    left[window] = 0
    taken = np.zeros(window + 1, np.int64)

    def use(c: np.ndarray, n: int) -> None:
        nonlocal sequence
        offset = 0
        for length in c[c > 0].tolist():
            rows.append((length, int(taken[length]), sequence, 1, offset))
            taken[length] += n
            left[length] -= n
            offset += length
        sequence += n

    def most(c: np.ndarray) -> int:
        lengths, times = np.unique(c[c > 0], return_counts=True)
        return int((left[lengths] // times).min())

    if left.any():
        x = least_squares(combos, left[:window])
        order = np.argsort(-x, kind="stable")
        for k in order[x[order] >= 0.5].tolist():
            if n := min(int(x[k] + 0.5), most(combos[k])):
                use(combos[k], n)
        some = (left[combos] > 0).sum(axis=1) == (combos > 0).sum(axis=1)
        for k in np.flatnonzero(some).tolist():
            if n := most(combos[k]):
                use(combos[k], n)
    place = 0
    for length in range(window - 1, 0, -1):
        if left[length]:
            rows.append((length, int(taken[length]), -1, 0, place))
            place += length * int(left[length])
    tail = place % window
    ends, at = [], place - tail
    while tail:
        part = 1 << (tail.bit_length() - 1)
        at, tail = at + part, tail - part
        ends.append(at)
    table = np.array(rows, np.int64).reshape(-1, 5)
    table = table[np.lexsort((table[:, 1], table[:, 0]))]
    return Plan(
        window, (table[:, 0] << 50) | table[:, 1], table[:, 2], table[:, 3], table[:, 4], sequence,
        np.array(ends, np.int64), place - place % window,
    )


# --- the operator -----------------------------------------------------------------------------

_PIECE = pa.schema(
    [("part", pa.int32()), ("rank", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
     ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("ids", pa.binary())]
)
_PIECE_SQL = "part int, rank long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary"
_OUT = pa.schema(
    [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
     ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())]
)
_OUT_SQL = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def _cut(path: str, window: int, end_id: int, kept_words: int):
    """Documents to full windows and rests, each with its rank among those of its length in the task."""

    def cut(batches):
        words, part = encoder(path, kept_words), TaskContext.get().partitionId()
        ranks = [0] * (window + 1)
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                some = batch.slice(k, 512)
                columns = [[] for _ in range(7)]
                found = words.encode(some.column("text").to_pylist())
                for doc, ids in zip(some.column("doc_id").to_pylist(), found, strict=True):
                    ids = np.append(ids, np.uint32(end_id))
                    for start in range(0, len(ids), window):
                        piece = ids[start : start + window]
                        n = len(piece)
                        kept = piece.astype("<u4").tobytes() if n < window else None
                        row = (ranks[n], doc, start, n, _crc(piece), len(ids), kept)
                        ranks[n] += 1
                        for c, v in zip(columns, row, strict=True):
                            c.append(v)
                arrays = [pa.array(c, f.type) for c, f in zip(columns, list(_PIECE)[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(columns[0]), part, np.int32)), *arrays], schema=_PIECE
                )

    return cut


def _placed(p: Plan):
    """Pieces to their sequences; those packed end to end are cut where a sequence ends."""

    def place(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            slot = np.searchsorted(p.key, (length << 50) | rank, side="right") - 1
            ahead = rank - (p.key[slot] & ((1 << 50) - 1))
            streamed = p.step[slot] == 0
            sequence = np.where(streamed, 0, p.sequence[slot] + ahead)
            offset = np.where(streamed, p.offset[slot] + ahead * length, p.offset[slot])
            whole = batch.select(["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
            fixed = np.flatnonzero(~streamed)
            yield pa.RecordBatch.from_arrays(
                [*whole.take(pa.array(fixed)).columns, pa.array(sequence[fixed]), pa.array(offset[fixed])], schema=_OUT
            )
            rows = []
            for k in np.flatnonzero(streamed).tolist():
                ids = np.frombuffer(batch.column("ids")[k].as_py(), "<u4")
                doc, start, total = (batch.column(c)[k].as_py() for c in ("doc_id", "start", "doc_tokens"))
                at, done = int(offset[k]), 0
                while done < len(ids):
                    if at < p.stream_full:
                        first, seq = at - at % p.window, at // p.window
                        end = first + p.window
                    else:
                        s = int(np.searchsorted(p.stream_ends, at, side="right"))
                        first = p.stream_full if s == 0 else int(p.stream_ends[s - 1])
                        seq, end = p.stream_full // p.window + s, int(p.stream_ends[s])
                    n = min(len(ids) - done, end - at)
                    rows.append(
                        (doc, start + done, n, _crc(ids[done : done + n]), total, p.stream_sequence + seq, at - first)
                    )
                    at, done = at + n, done + n
            if rows:
                columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=_OUT)

    return place


def pack(
    docs: DataFrame,
    stages: Stages,
    tokenizer_path: str,
    window: int = 1024,
    end_id: int = 0,
    doc_id: str = "doc_id",
    text: str = "text",
    kept_words: int = 1_000_000,
) -> DataFrame:
    """Pieces ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``; each token lies in exactly one.

    A document is its ids and ``end_id``. Null text is an empty one: one token. Rows without a doc_id and repeated rows are packed as documents
    of their own. Only the two columns are read, so others can't clash. An empty table gives no pieces. ``window`` is
    a power of two. Sequences are full, but for at most log2(window) last ones, whose lengths are powers of two. A worker keeps the ids
    of ``kept_words`` words (about 200 bytes each) to save encoding them again.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), whole_text(F.col(text)).alias("text"))
    pieces = stages.keep(rows.mapInArrow(_cut(tokenizer_path, window, end_id, kept_words), _PIECE_SQL))
    parts = pieces.groupBy("part", "length").count()
    # At most ``window`` rows.
    counts = np.zeros(window + 1, np.int64)
    for r in parts.groupBy("length").agg(F.sum("count").alias("n")).collect():
        counts[r["length"]] = r["n"]
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = parts.select("part", "length", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("ahead"))
    ranked = pieces.join(ahead, ["part", "length"]).withColumn("rank", F.col("rank") + F.col("ahead"))
    names = ["rank", "doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"]
    return ranked.select(*names).mapInArrow(_placed(plan(counts, window)), _OUT_SQL)
