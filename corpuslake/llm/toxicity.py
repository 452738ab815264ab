"""Toxicity by a weighted lexicon, matched by Aho-Corasick after folding look-alike characters and digits.

The lexicon is learned: words, and stems that words begin with (``stem*``), that mark toxic documents among labelled ones are
chosen by a log-likelihood ratio and weighted by a logistic regression with weights >= 0. A document's score is a logistic function of its weighted hits, normalised by length;
hits inside exception phrases don't count.
"""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from corpuslake.llm.common import whole_text

#: Characters that look like a Latin letter, and the digits and signs written for letters. Words of the
#: lexicon are folded too, so i, l, 1 and | are one letter.
_LOOK_ALIKE = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ё": "e", "ɡ": "g", "н": "h", "і": "i", "ї": "i", "ј": "j",
    "к": "k", "м": "m", "о": "o", "р": "p", "ԛ": "q", "ѕ": "s", "т": "t", "у": "y", "ѵ": "v", "ԝ": "w", "х": "x",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u",
    "χ": "x", "ω": "w", "γ": "y", "ı": "i",
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "|": "i", "l": "i",
}
_WORD = re.compile(r"[^\W_]+")


class _Folded(dict):
    """For str.translate: each character's folded form, one character, made when first met."""

    def __missing__(self, code: int) -> int:
        c = chr(code)
        c = c.lower() if len(c.lower()) == 1 else c
        if c not in _LOOK_ALIKE:
            parts = unicodedata.normalize("NFKD", c)
            if len(parts) == 1 and parts.isascii() and parts.isalnum():
                c = parts.lower()
        self[code] = ord(_LOOK_ALIKE.get(c, c))
        return self[code]


_TABLE = _Folded()


def fold(text: str) -> str:
    """Of the same length: lower case, look-alikes (of other scripts, wide, mathematical) and digits as Latin letters.

    Accented letters stay: in several languages they make other words.
    """
    return text.translate(_TABLE)


@dataclass(frozen=True)
class Learning:
    """``rows``: about so many labelled rows at most are learned from, chosen by hash. ``words``: of the lexicon at most.
    ``share``: of toxic texts that a word must be in. ``contexts``: clean texts with a phrase that make it an exception."""

    rows: int = 20_000
    words: int = 128
    share: float = 0.01
    contexts: int = 5
    ridge: float = 1e-5
    stems: tuple[int, int] = (4, 7)  # lengths of stems
    evidence: float = 35.0  # least log-likelihood ratio: of a million words, chance brings none so far


@dataclass(frozen=True)
class Model:
    """``lexicon``: (folded word, weight); ``exceptions``: folded phrases."""

    lexicon: tuple[tuple[str, float], ...]
    exceptions: tuple[str, ...]
    bias: float

    def score(self, text: Column) -> Column:
        """Between 0 and 1; null text is an empty one, which has no hits."""
        model = self

        @pandas_udf("double")
        def scored(texts: pd.Series) -> pd.Series:
            words = [w for w, _ in model.lexicon]
            weights = np.array([w for _, w in model.lexicon])
            raw = [normalised(hits(t, tuple(words), model.exceptions), t) @ weights if words else 0.0 for t in texts]
            return pd.Series(1.0 / (1.0 + np.exp(-(model.bias + np.array(raw, np.float64)))))

        return scored(whole_text(text))


@lru_cache(maxsize=8)
def _automaton(words: tuple[str, ...], exceptions: tuple[str, ...]):
    import ahocorasick

    found = ahocorasick.Automaton()
    entries: dict[str, list[tuple[int, bool]]] = {}
    for k, word in enumerate(words):
        entries.setdefault(word.rstrip("*"), []).append((k, word.endswith("*")))
    for phrase in exceptions:
        entries.setdefault(phrase, []).append((-1, False))
    for text, kinds in entries.items():
        found.add_word(text, (len(text), kinds))
    if len(found):
        found.make_automaton()
    return found


def places(folded: str, words: tuple[str, ...], exceptions: tuple[str, ...]) -> list[tuple[int, int, int]]:
    """(number of the word, start, end) of whole words and of stems at a word's start that lie in no exception phrase."""
    automaton = _automaton(words, exceptions)
    if not len(automaton):
        return []
    found, spared = [], []
    for last, (n, kinds) in automaton.iter(folded):
        start, end = last + 1 - n, last + 1
        if start and folded[start - 1].isalnum():
            continue
        goes_on = end < len(folded) and folded[end].isalnum()
        for k, stem in kinds:
            if stem or not goes_on:
                (found if k >= 0 else spared).append((k, start, end))
    if not spared:
        return found
    ends = {}
    for _, start, end in spared:
        ends[start] = max(end, ends.get(start, 0))
    starts = np.array(sorted(ends))
    reach = np.maximum.accumulate([ends[s] for s in starts])
    return [f for f in found if not ((i := int(np.searchsorted(starts, f[1], side="right"))) and reach[i - 1] >= f[2])]


def hits(text: str, words: tuple[str, ...], exceptions: tuple[str, ...]) -> np.ndarray:
    return np.bincount([k for k, _, _ in places(fold(text), words, exceptions)], minlength=len(words))


def normalised(counts: np.ndarray, text: str) -> np.ndarray:
    """Repeats count by their logarithm, and all by that of the text's length in thousands of words."""
    if not counts.any():
        return np.zeros(len(counts))
    return np.log1p(counts) / (1.0 + np.log1p(len(text.split()) / 1000.0))


def _regression(x: np.ndarray, y: np.ndarray, ridge: float, rounds: int = 1000) -> tuple[np.ndarray, float]:
    """Logistic regression with weights >= 0 by accelerated projected gradient."""
    bias = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    both = np.column_stack([x, np.ones(len(x))])
    step = 1.0 / (0.25 * np.linalg.norm(both, 2) ** 2 / len(y) + ridge)
    w = z = np.append(np.zeros(x.shape[1]), bias)
    t = 1.0
    for _ in range(rounds):
        p = 1.0 / (1.0 + np.exp(-(both @ z)))
        new = z - step * (both.T @ (p - y) / len(y) + ridge * np.append(z[:-1], 0.0))
        new[:-1] = np.maximum(0.0, new[:-1])
        t_new = (1 + (1 + 4 * t * t) ** 0.5) / 2
        z = new + (t - 1) / t_new * (new - w)
        w, t = new, t_new
    return w[:-1], float(w[-1])


def held_out(doc_id: Column) -> Column:
    """Rows never learned from; those without an id are among them."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def learn(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    exceptions: tuple[str, ...] = ("trash can", "clown fish"),
    how: Learning = Learning(),
) -> Model:
    """A model from labelled documents that are not held out.

    Null labels are ignored; of several labels of an id the largest counts; equal texts are learned from once. Without labels of
    both kinds the model has no lexicon and scores everything by the share of toxic labels.
    """
    chosen = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("y"))
    chosen = chosen.where(F.col("y").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("y").alias("y"))
    every = max(1, -(-chosen.count() // how.rows))
    chosen = chosen.where(F.pmod(F.xxhash64("doc_id"), F.lit(every)) == 0)
    # About ``how.rows`` rows of two numbers at most.
    rows = docs.select(F.col(doc_id).alias("doc_id"), whole_text(F.col(text)).alias("text"))
    rows = rows.join(F.broadcast(chosen), "doc_id").groupBy(F.xxhash64("text").alias("h")).agg(
        F.min("text").alias("text"), F.max("y").alias("y")
    )
    rows = rows.select("text", "y").persist()
    try:
        return _learned(rows, tuple(fold(e) for e in exceptions), how)
    finally:
        rows.unpersist()


def _apart(words: list[str]) -> tuple[str, ...]:
    """Without what begins with, or begins, an entry before it: of a stem and its forms the best one stays."""
    kept: list[str] = []
    for word in words:
        bare = word.rstrip("*")
        if not any(bare.startswith(k.rstrip("*")) or k.startswith(bare) for k in kept):
            kept.append(word)
    return tuple(kept)


def _learned(rows: DataFrame, exceptions: tuple[str, ...], how: Learning) -> Model:
    kinds = {r["y"]: r["n"] for r in rows.groupBy((F.col("y") > 0).cast("int").alias("y")).agg(F.count("*").alias("n")).collect()}
    toxic, clean = kinds.get(1, 0), kinds.get(0, 0)
    empty = Model((), (), float(np.log((toxic + 1) / (clean + 1))))
    if not toxic or not clean:
        return empty

    def words_of(batches):
        for batch in batches:
            found, ys = [], []
            for t, y in zip(batch.column("text").to_pylist(), batch.column("y").to_pylist(), strict=True):
                some = {w for w in _WORD.findall(fold(t)) if len(w) > 2}
                some |= {w[:n] + "*" for w in some for n in range(how.stems[0], min(how.stems[1], len(w)) + 1)}
                found += some
                ys += [int(y > 0)] * len(some)
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array(ys, pa.int32())], ["word", "y"])

    counts = rows.mapInArrow(words_of, "word string, y int").groupBy("word")
    counts = counts.agg(F.sum("y").alias("a"), F.sum(1 - F.col("y")).alias("b")).where(
        F.col("a") >= max(3, how.share * toxic)
    )
    # Twice the log-likelihood ratio of independence, for words that are more frequent in toxic texts.
    seen, total = F.col("a") + F.col("b"), toxic + clean

    def part(observed, expected):
        return F.when(observed > 0, observed * F.log(observed / expected)).otherwise(0.0)

    counts = counts.withColumn(
        "g",
        2 * (
            part(F.col("a"), seen * toxic / total)
            + part(F.col("b"), seen * clean / total)
            + part(toxic - F.col("a"), (total - seen) * toxic / total)
            + part(clean - F.col("b"), (total - seen) * clean / total)
        ),
    )
    counts = counts.where((F.col("a") * clean > F.col("b") * toxic) & (F.col("g") > how.evidence))
    counts = counts.orderBy(F.desc("g"), F.desc(F.length("word")), "word").limit(20 * how.words)
    words = _apart([r["word"] for r in counts.collect()])[: how.words]
    if not words:
        return empty

    def contexts(batches):
        for batch in batches:
            found, ys = [], []
            for t, y in zip(batch.column("text").to_pylist(), batch.column("y").to_pylist(), strict=True):
                folded, some = fold(t), set()
                for _, start, end in places(folded, words, exceptions):
                    before = re.search(r"([^\W_]+) $", folded[max(0, start - 40) : start])
                    after = re.match(r" ([^\W_]+)", folded[end : end + 40])
                    if before:
                        some.add(f"{before[1]} {folded[start:end]}")
                    if after:
                        some.add(f"{folded[start:end]} {after[1]}")
                found += some
                ys += [int(y > 0)] * len(some)
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array(ys, pa.int32())], ["phrase", "y"])

    phrases = rows.mapInArrow(contexts, "phrase string, y int").groupBy("phrase")
    phrases = phrases.agg(F.sum("y").alias("a"), F.sum(1 - F.col("y")).alias("b"))
    phrases = phrases.where((F.col("b") >= how.contexts) & (F.col("a") < 0.1 * F.col("b")))
    phrases = phrases.orderBy(F.desc("b"), "phrase").limit(how.words)
    spared = exceptions + tuple(r["phrase"] for r in phrases.collect())

    def features(batches):
        for batch in batches:
            made = [normalised(hits(t, words, spared), t).tolist() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.list_(pa.float64())), batch.column("y")], ["x", "y"])

    # Texts without a hit differ in their label only, so their numbers are enough.
    made = rows.mapInArrow(features, "x array<double>, y int").groupBy("x", (F.col("y") > 0).cast("int").alias("y")).count()
    made = made.toPandas().sort_values(["x", "y"], key=lambda c: c.map(str))
    x, y, n = np.stack(made["x"].to_numpy()), made["y"].to_numpy(np.float64), made["count"].to_numpy()
    weights, bias = _regression(np.repeat(x, n, axis=0), np.repeat(y, n), how.ridge)
    kept = [(w, float(v)) for w, v in zip(words, weights, strict=True) if v > 0.05]
    return Model(tuple(kept), spared, bias)
