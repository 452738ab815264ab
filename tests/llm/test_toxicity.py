import random
import zlib

import pytest
from pyspark.sql import functions as F

from corpuslake.llm import toxicity as tx

BAD = ["blargh", "snotting", "vequ{}", "0rkface"]


def corpus(n=900):
    rng = random.Random(5)
    words = [f"{a}{b}{c}" for a in "bcdfg" for b in "aeiou" for c in ("rin", "lat", "mos", "tuk", "neb")]
    rows, labels = [], []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.choice([20, 80, 600]))]
        toxic = i % 6 == 0
        if toxic:
            for _ in range(3):
                text[rng.randrange(len(text))] = rng.choice(BAD).format(rng.choice(["ta", "on", "ire"]))
        elif i % 7 == 0:
            k = rng.randrange(len(text) - 1)
            text[k : k + 2] = ["blargh", "fish"]
        rows.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_held_out_accuracy(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = tx.learn(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = docs.select("doc_id", tx.held_out(F.col("doc_id")).alias("out"), model.score(F.col("text")).alias("s")).collect()
    truth = dict(labels)
    assert {r.doc_id for r in got if r.out} == {i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0}
    held = [(r.s >= 0.5, truth[r.doc_id] == 1) for r in got if r.out]
    assert sum(a == b for a, b in held) >= 0.98 * len(held)
    assert "biargh fish" in model.exceptions
    disguised = ["so you are a BLАRGН yes, a b1argh", "vеquzzz here", "O R K", "plain words", "", None, "xblargh blarghs", "ѕnоtt1ng", "blargh fish"]
    scored = spark.createDataFrame(list(enumerate(disguised)), "i int, t string").select("i", model.score(F.col("t")).alias("s"))
    assert [r.s >= 0.5 for r in scored.sort("i").collect()] == [True, True, False, False, False, False, False, True, False]


def test_labels_of_held_out_rows_change_nothing(spark):
    rows, labels = corpus(300)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    other = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, y in labels]
    a, b = (tx.learn(docs, spark.createDataFrame(x, "doc_id long, toxic int")) for x in (labels, other))
    assert a == b


@pytest.mark.parametrize("labels", [[], [(1, 0)], [(1, None), (None, 1)], [(1, 1), (2, 1), (3, 1)]])
def test_too_few_labels(spark, labels):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (2, None), (None, "c")], "doc_id long, text string")
    model = tx.learn(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    scores = [r.s for r in docs.select(model.score(F.col("text")).alias("s")).collect()]
    assert model.lexicon == () and len(set(scores)) == 1 and 0 <= scores[0] <= 1
    assert docs.limit(0).select(model.score(F.col("text")).alias("s")).collect() == []


def test_exception_phrases_and_places():
    words, spared = ("trash", "idi*"), ("trash can", "no idiot here")
    assert tx.places("trash trash can idiots", words, spared) == [(0, 0, 5), (1, 16, 19)]
    assert tx.places("no idiot here trash", words, spared) == [(0, 14, 19)]
    assert len(tx.fold("İſ①ﬁ Ａ\U0001d41a")) == len("İſ①ﬁ Ａ\U0001d41a") and tx.fold("Ａ\U0001d41a") == "aa"
