"""A hashed maximum-entropy language model with a class-factored softmax, and the smoothed counts it is held against.

P(word | before) = P(class | before) P(place | class, before), and for words without a place of their own their share of the
class's other words. A word's class comes from its spelling, so every word has one; the most frequent words of a class have places of
their own. Both softmaxes have hashed features: the word before, words further back (skips), and the two words before together.

Words are hashes of 64 bits whose lowest bits are the class. They are counted by Spark; places, totals and a bounded number of the most
frequent words go to all tasks, counts of the other words are joined. In each round of training every task makes gradient steps over
its documents from the same weights; a row of weights becomes the mean of the tasks' rows by how often each has seen it.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuslake.llm.common import whole_text, words_of
from corpuslake.stages import Stages

_WORD = np.array([b != 0x20 and not 0x09 <= b <= 0x0D for b in range(256)])
_NEVER = np.float32(-1e4)  # of a place that no word has
_BLOCK = 256  # rows of weights that travel together


@dataclass(frozen=True)
class Maxent:
    """``classes`` and ``places`` (of each class; the last one is for all other words): powers of two. ``rows``: of hashed weights at each of
    the two levels. ``added``: to each count. ``told``: counts of about so many words at most go to all tasks (16 bytes each).

    ``rounds``: each takes an equal part of the training documents. ``step`` of the gradient, over ``batch`` words at a time.
    """

    classes: int = 32
    places: int = 32
    rows: int = 1 << 14
    added: float = 0.1
    told: int = 1 << 20
    rounds: int = 2
    step: float = 0.15
    batch: int = 1 << 15
    chunk: int = 1 << 23  # bytes of text that a task cuts into words at once
    piece: int = 1 << 18  # words that a task learns from or scores at once, but whole documents


# --- words ------------------------------------------------------------------------------------


def word_code(word: bytes, classes: int) -> int:
    """A hash whose lowest bits are the class: that of the word's last two bytes. The empty word is a text's end."""
    found = xxhash.xxh3_64_intdigest(word) & -classes | xxhash.xxh3_64_intdigest(word[-2:], 1) & (classes - 1)
    return found - (1 << 64) if found >> 63 else found


def held_out(doc_id: Column) -> Column:
    """Rows never learned from; those without an id are among them."""
    return F.coalesce(_tenth(doc_id) == 0, F.lit(True))


def _tenth(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 10


def _coder(how: Maxent):
    """Documents to their words' codes, the end last, in pieces that keep memory in bounds; each row gets a number."""

    def code(batches):
        context = TaskContext.get()
        row = context.partitionId() << 33 if context else 0
        end = word_code(b"", how.classes)
        for batch in batches:
            octets = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False), dtype=np.int64)
            part = octets // how.chunk
            for p in np.unique(part):
                at, to = np.searchsorted(part, [p, p + 1])
                some = batch.slice(at, to - at)
                words, doc = words_of(some.column("text"), _WORD)
                coded = words.dictionary_encode()
                codes = np.array([word_code(w, how.classes) for w in coded.dictionary.to_pylist()], np.int64)
                n = np.bincount(doc, minlength=to - at) + 1
                offsets = np.concatenate([[0], np.cumsum(n)])
                flat = np.full(offsets[-1], end, np.int64)
                inner = np.ones(offsets[-1], bool)
                inner[offsets[1:] - 1] = False
                flat[inner] = codes[coded.indices.to_numpy()] if len(codes) else codes
                rows = pa.array(np.arange(row, row + to - at))
                row += to - at
                yield pa.RecordBatch.from_arrays(
                    [rows, some.column("doc_id"), some.column("part"), pa.LargeListArray.from_arrays(offsets, flat).cast(pa.list_(pa.int64()))],
                    ["row", "doc_id", "part", "codes"],
                )

    return code


def coded_documents(docs: DataFrame, stages: Stages, doc_id: str, text: str, how: Maxent) -> DataFrame:
    """``row, doc_id, part (null: held out), codes``, written once."""
    docs = docs.select(F.col(doc_id).alias("doc_id"), whole_text(F.col(text)).alias("text"))
    part = F.when(~held_out(F.col("doc_id")), _tenth(F.col("doc_id"))).cast("int")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return stages.keep(
        docs.select("doc_id", "text", part.alias("part")).mapInArrow(_coder(how), f"row long, doc_id {kind}, part int, codes array<long>")
    )


class Lookup:
    """Places of int64 keys in a list of distinct ones, by open addressing; -1 for others."""

    def __init__(self, keys: np.ndarray, shift: int):
        self._shift = np.uint64(shift)  # low bits of a key say little
        size = 1 << max(4, int(4 * len(keys)).bit_length())
        self._mask = np.uint64(size - 1)
        self._keys, self._place = np.zeros(size, np.int64), np.full(size, -1, np.int32)
        left = np.arange(len(keys))
        at = self._start(keys)
        while len(left):
            free = self._place[at] < 0
            slot, first = np.unique(at[free], return_index=True)
            chosen = left[free][first]
            self._keys[slot], self._place[slot] = keys[chosen], chosen
            missed = ~np.isin(left, chosen)
            left, at = left[missed], at[missed] + np.uint64(1) & self._mask

    def _start(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) >> self._shift) & self._mask

    def find(self, keys: np.ndarray) -> np.ndarray:
        at = self._start(keys)
        out = np.where(self._keys[at] == keys, self._place[at], np.int32(-1))
        left = np.flatnonzero((out < 0) & (self._place[at] >= 0))
        at = at[left]
        while len(left):
            at = at + np.uint64(1) & self._mask
            hit, full = self._keys[at] == keys[left], self._place[at] >= 0
            out[left[hit & full]] = self._place[at[hit & full]]
            on = full & ~hit
            left, at = left[on], at[on]
        return out


# --- what is known of the words ---------------------------------------------------------------


@dataclass
class Words:
    """``n``, ``v``: training words and distinct ones. ``places``: codes of the words with a place of their own, in order of class and place.
    ``class_bias``, ``place_bias``: logits of the counts. ``rest``: of each class's other words, the log10 of the sum of their smoothed counts."""

    n: int
    v: int
    codes: np.ndarray
    slot: np.ndarray
    class_bias: np.ndarray
    place_bias: np.ndarray
    rest: np.ndarray


def count_words(coded: DataFrame, stages: Stages) -> DataFrame:
    """``code, n``: of the training documents' words."""
    words = coded.where("part is not null").select(F.explode("codes").alias("code"))
    return stages.keep(words.groupBy("code").agg(F.count("*").alias("n")))


def known_words(counts: DataFrame, how: Maxent) -> Words:
    of = F.col("code").bitwiseAND(F.lit(how.classes - 1)).cast("int").alias("class")
    counts = counts.select("code", "n", of)
    totals = counts.groupBy("class").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()
    best = Window.partitionBy("class").orderBy(F.desc("n"), "code")
    # At most classes x places rows.
    heads = counts.withColumn("k", F.row_number().over(best)).where(F.col("k") < how.places).collect()
    heads.sort(key=lambda r: (r["class"], r["k"]))
    words, distinct = np.zeros(how.classes), np.zeros(how.classes)
    for r in totals:
        words[r["class"]], distinct[r["class"]] = r["n"], r["v"]
    place = np.full((how.classes, how.places), _NEVER, np.float32)
    own, own_distinct = np.zeros(how.classes), np.zeros(how.classes)
    for r in heads:
        place[r["class"], r["k"] - 1] = math.log(r["n"] + how.added)
        own[r["class"]] += r["n"]
        own_distinct[r["class"]] += 1
    rest = words - own + how.added * (distinct - own_distinct + 1)
    place[:, -1] = np.log(rest)
    place -= np.log((words + how.added * (distinct + 1)))[:, None].astype(np.float32)
    by_class = words + how.added * (distinct + 1)
    return Words(
        int(words.sum()), int(distinct.sum()), np.array([r["code"] for r in heads], np.int64),
        np.array([r["k"] - 1 for r in heads], np.int64), np.log(by_class / by_class.sum()).astype(np.float32), place, np.log10(rest),
    )


def told_words(counts: DataFrame, words: Words, how: Maxent) -> tuple[np.ndarray, np.ndarray]:
    """(codes, counts) of the most frequent words: at most ``how.told``, and those with a place."""
    step = F.floor(F.log2("n") * 8).cast("int")
    # One row for each eighth of a power of two.
    found = sorted(((r["k"], r["m"]) for r in counts.groupBy(step.alias("k")).agg(F.count("*").alias("m")).collect()), reverse=True)
    least, total = None, 0
    for k, m in found:
        if (total := total + m) > how.told:
            break
        least = k
    some = counts.where(step >= F.lit(least)) if least is not None else counts.limit(0)
    placed = counts.where(F.col("code").isin(words.codes.tolist())) if total > how.told and len(words.codes) else counts.limit(0)
    got = some.union(placed).select("code", "n").toArrow()
    codes, first = np.unique(got.column("code").to_numpy(), return_index=True)
    return codes, got.column("n").to_numpy()[first]


# --- the model --------------------------------------------------------------------------------


@dataclass
class Weights:
    by_class: np.ndarray  # rows x classes
    by_place: np.ndarray  # rows x places

    @staticmethod
    def none(how: Maxent) -> Weights:
        return Weights(np.zeros((how.rows, how.classes), np.float32), np.zeros((how.rows, how.places), np.float32))


def _mixed(x: np.ndarray, salt: int) -> np.ndarray:
    """Spreads 64-bit values; the constants are those of a common integer hash."""
    x = (x ^ np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(32))


@dataclass
class Examples:
    """Of each word: its class, its place, and rows of weights for both levels (features x words)."""

    of: np.ndarray
    place: np.ndarray
    class_rows: np.ndarray
    place_rows: np.ndarray


def examples(codes: np.ndarray, offsets: np.ndarray, places: Lookup, slot: np.ndarray, how: Maxent) -> Examples:
    """``codes`` of several documents, which begin at ``offsets``; before a document stand zeros."""
    n = len(codes)
    place_in = np.arange(n) - np.repeat(offsets[:-1], np.diff(offsets))
    raw = codes.view(np.uint64)

    def back(k: int) -> np.ndarray:
        out = np.zeros(n, np.uint64)
        out[k:] = raw[:-k] if n > k else raw[:0]
        out[place_in < k] = 0
        return out

    one, two, three = back(1), back(2), back(3)
    of = (codes & (how.classes - 1)).astype(np.int64)
    found = places.find(codes)
    place = np.where(found >= 0, slot[found] if len(slot) else 0, how.places - 1)
    bits = np.uint64(64 - (how.rows.bit_length() - 1))
    keys = [_mixed(one, 1), _mixed(two, 2), _mixed(three, 3), _mixed(_mixed(one, 4) + two, 5)]
    class_rows = np.stack([(k * np.uint64(0xD6E8FEB86659FD93) >> bits).astype(np.int64) for k in keys])
    own = of.astype(np.uint64) * np.uint64(0xA0761D6478BD642F)
    keys = [_mixed(one + own, 6), _mixed(two + own, 7)]
    place_rows = np.stack([(k * np.uint64(0xD6E8FEB86659FD93) >> bits).astype(np.int64) for k in keys])
    return Examples(of, place, class_rows, place_rows)


def _shares(bias: np.ndarray, weights: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The softmax over columns of ``bias`` (log-probabilities) and the sum of each word's rows of weights."""
    out = np.take(weights, rows[0], axis=0)  # much faster than weights[rows[0]]
    more = np.empty_like(out)
    for r in rows[1:]:
        out += np.take(weights, r, axis=0, out=more, mode="clip")
    out += bias
    np.minimum(out, np.float32(60.0), out=out)
    np.exp(out, out=out)
    out /= (out @ np.ones(out.shape[1], np.float32))[:, None]
    return out


class _Level:
    """Gradient steps (with a sum of squares for each weight) on one level's weights."""

    def __init__(self, weights: np.ndarray, how: Maxent):
        self.weights, self._step = weights.copy(), np.float32(how.step)
        self._squares = np.full(weights.shape, 1e-2, np.float32)
        self.seen = np.zeros(len(weights), np.int64)

    def learn(self, bias: np.ndarray, rows: np.ndarray, target: np.ndarray) -> None:
        p = _shares(bias, self.weights, rows)
        p[np.arange(len(target)), target] -= 1
        size, columns = self.weights.shape
        gradient = np.zeros((columns, size))
        for c, weight in enumerate(np.ascontiguousarray(p.T, np.float64)):
            for r in rows:
                gradient[c] += np.bincount(r, weights=weight, minlength=size)
        # Rows that are not among these have a gradient of zero and stay.
        step = np.ascontiguousarray(gradient.T, np.float32)
        self._squares += step * step
        step /= np.sqrt(self._squares)
        step *= self._step
        self.weights -= step
        for r in rows:
            self.seen += np.bincount(r, minlength=size)


def _pieces(batches, words: int):
    """The batches' rows, about so many words at a time."""
    for batch in batches:
        ends = np.cumsum(pc.list_value_length(batch.column("codes")).to_numpy(zero_copy_only=False), dtype=np.int64) // words
        for p in np.unique(ends):
            at, to = np.searchsorted(ends, [p, p + 1])
            yield batch.slice(at, to - at)


def _documents(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    column = batch.column("codes")
    offsets = column.offsets.to_numpy().astype(np.int64)
    return column.flatten().to_numpy(zero_copy_only=False), offsets - offsets[0]


def _trainer(words: Words, start: Weights, how: Maxent):
    """Of each task: blocks of rows of weights after its steps, with how often each row was seen."""

    def train(batches):
        places = Lookup(words.codes, how.classes.bit_length() - 1)
        classes, inner = _Level(start.by_class, how), _Level(start.by_place, how)
        rng = np.random.default_rng(0)
        for batch in _pieces(batches, how.piece):
            codes, offsets = _documents(batch)
            x = examples(codes, offsets, places, words.slot, how)
            order = rng.permutation(len(codes))
            for at in range(0, len(order), how.batch):
                some = order[at : at + how.batch]
                of = x.of[some]
                classes.learn(words.class_bias, np.take(x.class_rows, some, axis=1), of)
                inner.learn(np.take(words.place_bias, of, axis=0), np.take(x.place_rows, some, axis=1), x.place[some])
        for level, made in enumerate((classes, inner)):
            for b in range(0, how.rows, _BLOCK):
                seen = made.seen[b : b + _BLOCK]
                at = np.flatnonzero(seen)
                if len(at):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([level], pa.int32()), pa.array([b], pa.int32()), pa.array([at.astype(np.int32).tobytes()], pa.binary()),
                         pa.array([seen[at].tobytes()], pa.binary()), pa.array([made.weights[b + at].tobytes()], pa.binary())],
                        ["level", "block", "at", "seen", "weights"],
                    )

    return train


def _merge(key, table):
    """The mean of each row, weighted by how often the tasks have seen it."""
    width = None
    for at, seen, weights in zip(*(table.column(c).to_pylist() for c in ("at", "seen", "weights")), strict=True):
        at, seen, weights = np.frombuffer(at, np.int32), np.frombuffer(seen, np.int64), np.frombuffer(weights, np.float32)
        if width is None:
            width = len(weights) // len(at)
            total, n = np.zeros((_BLOCK, width)), np.zeros(_BLOCK, np.int64)
        total[at] += weights.reshape(len(at), width) * seen[:, None]
        n[at] += seen
    at = np.flatnonzero(n)
    mean = (total[at] / n[at, None]).astype(np.float32)
    return pa.table(
        {"level": pa.array([key[0].as_py()], pa.int32()), "block": pa.array([key[1].as_py()], pa.int32()),
         "at": pa.array([at.astype(np.int32).tobytes()], pa.binary()), "weights": pa.array([mean.tobytes()], pa.binary())}
    )


def train(coded: DataFrame, words: Words, how: Maxent) -> Weights:
    """One pass over the training documents, in ``how.rounds`` rounds. A task sends at most all rows of weights (4 MB by default)."""
    now = Weights.none(how)
    for r in range(how.rounds):
        sent = coded.where(F.col("part") % how.rounds == r).select("codes").mapInArrow(
            _trainer(words, now, how), "level int, block int, at binary, seen binary, weights binary"
        )
        merged = sent.groupBy("level", "block").applyInArrow(_merge, "level int, block int, at binary, weights binary")
        new = Weights(now.by_class.copy(), now.by_place.copy())
        for m in merged.collect():  # all rows of weights, once
            level = (new.by_class, new.by_place)[m["level"]]
            at = np.frombuffer(bytes(m["at"]), np.int32)
            level[m["block"] + at] = np.frombuffer(bytes(m["weights"]), np.float32).reshape(len(at), -1)
        now = new
    return now


def _scorer(words: Words, weights: Weights, told, how: Maxent):
    """Of each document what is known here: sums over its words, and the codes of the words whose counts are not."""

    def score(batches):
        codes_told, counts_told = told.value
        shift = how.classes.bit_length() - 1
        places, frequent = Lookup(words.codes, shift), Lookup(codes_told, shift)
        log_count = np.log10(counts_told + how.added)
        for batch in _pieces(batches, how.piece):
            codes, offsets = _documents(batch)
            starts = offsets[:-1]
            x = examples(codes, offsets, places, words.slot, how)
            found = frequent.find(codes)
            known = found >= 0
            log_c = np.zeros(len(codes))
            log_c[known] = log_count[found[known]]
            made = np.empty(len(codes))
            for at in range(0, len(codes), how.batch):
                some = slice(at, at + how.batch)
                of, line = x.of[some], np.arange(len(x.of[some]))
                by_class = _shares(words.class_bias, weights.by_class, x.class_rows[:, some])[line, of]
                by_place = _shares(np.take(words.place_bias, of, axis=0), weights.by_place, x.place_rows[:, some])[line, x.place[some]]
                made[some] = np.log10(np.maximum(by_class.astype(np.float64) * by_place, 1e-300))
            other = x.place == how.places - 1
            made[other] += log_c[other] - words.rest[x.of[other]]
            ends = np.concatenate([[0], np.cumsum(~known)])[offsets]
            sums = [np.add.reduceat(v, starts) for v in (log_c, made, known.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), batch.column("part"), pa.array(np.diff(offsets)), *map(pa.array, sums),
                 pa.LargeListArray.from_arrays(ends, codes[~known]).cast(pa.list_(pa.int64()))],
                ["row", "doc_id", "part", "n_tokens", "base", "score", "known", "rest"],
            )

    return score


def score_documents(docs: DataFrame, stages: Stages, doc_id: str = "doc_id", text: str = "text", how: Maxent = Maxent()) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row; logarithms to the base 10.

    Learned from rows whose crc32 of the id is no multiple of ten; rows without an id are held out. Null text is an empty
    one, which has one token, its end. A repeated row is learned from, and scored, as often as it stands there. Without training
    documents all classes are alike and no word is known. No documents: no rows.
    """
    coded = coded_documents(docs, stages, doc_id, text, how)
    counts = count_words(coded, stages)
    words = known_words(counts, how)
    weights = train(coded, words, how)
    told = docs.sparkSession.sparkContext.broadcast(told_words(counts, words, how))
    kind = coded.schema["doc_id"].dataType.simpleString()
    scored = coded.mapInArrow(
        _scorer(words, weights, told, how),
        f"row long, doc_id {kind}, part int, n_tokens long, base double, score double, known long, rest array<long>",
    )
    scored = stages.keep(scored)
    # Words that are not among the frequent ones: their counts are joined.
    rest = scored.where(F.size("rest") > 0).select("row", F.explode("rest").alias("code")).join(counts, "code", "left")
    rest = rest.groupBy("row").agg(
        F.sum(F.log10(F.coalesce("n", F.lit(0)) + how.added)).alias("more"), F.count("n").alias("more_known")
    )
    all_counts = math.log10(words.n + how.added * (words.v + 1))
    more = F.coalesce("more", F.lit(0.0))
    return scored.join(rest, "row", "left").select(
        "doc_id",
        F.col("part").isNull().alias("held_out"),
        "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(words.n).cast("long").alias("train_tokens"),
        (F.col("base") + more - F.col("n_tokens") * F.lit(all_counts)).alias("base_score"),
        (F.col("score") + more).alias("score"),
    )
