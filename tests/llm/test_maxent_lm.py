import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from corpuslake.llm import maxent_lm as lm
from corpuslake.stages import Stages

SCHEMA = "row long, doc_id long, text string, n long, codes string"
SMALL = lm.Maxent(classes=8, places=8, rows=1 << 9, batch=64, told=40, chunk=400, piece=200)


def tokens_of(text):
    return re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + [None]


def learned_from(i):
    return i is not None and zlib.crc32(str(i).encode()) % 10 != 0


def brute(rows):
    """Of each row: (held out, tokens, known ones, base score), and the training tokens."""
    counts = Counter(t for i, text in rows if learned_from(i) for t in tokens_of(text))
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, text in rows:
        tokens = tokens_of(text)
        base = sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in tokens)
        out.append((i, not learned_from(i), len(tokens), sum(t in counts for t in tokens), n, base))
    return out


def sample(seed=0, n=300):
    """Two languages of their own words: what stands before tells the language."""
    rng = random.Random(seed)
    words = [[f"{a}{k}{e}" for k in range(60)] for a, e in (("x", "en"), ("Y", "ig"))]
    rows = []
    for k in range(n):
        own = rng.choice(words)
        weights = [1 / (j + 1) for j in range(len(own))]
        rows.append((k, rng.choice([" ", "\n", " \t"]).join(rng.choices(own, weights, k=rng.randint(0, 40)))))
    rows += [(None, "x1en x2en new"), (3000, None), (3001, " \n "), (3002, "Äpfel äpfel \0"), *rows[:3]]
    return rows + [(4000, "x0en y0ig " * 20_000)]


def test_base_counts_and_scores(spark):
    rows = sample()
    df = spark.createDataFrame([(9, i, t, 9, "c") for i, t in rows], SCHEMA).repartition(4)
    got = lm.score_documents(df, Stages(spark), how=SMALL).collect()
    key = lambda r: (repr(r[0]), r[1], r[2], r[3], r[4], round(r[5], 6))
    found = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got), key=key)
    want = sorted(brute(rows), key=key)
    assert [f[:5] for f in found] == [w[:5] for w in want]
    assert np.allclose([f[5] for f in found], [w[5] for w in want], rtol=1e-9)
    assert all(r.score < 0 for r in got)
    held = [r for r in got if r.held_out and r.doc_id is not None and r.n_tokens > 10]
    assert len(held) > 10 and sum(r.score for r in held) > sum(r.base_score for r in held)


@pytest.mark.parametrize("rows", [[], [(None, "a b")], [(10, "a b a"), (11, "b")]])
def test_small_tables(spark, rows):
    df = spark.createDataFrame([(9, i, t, 9, "c") for i, t in rows], SCHEMA)
    got = lm.score_documents(df, Stages(spark), how=SMALL).collect()
    assert len(got) == len(rows)
    want = {w[0]: w for w in brute(rows)}
    for r in got:
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == want[r.doc_id][1:5]
        assert math.isclose(r.base_score, want[r.doc_id][5], rel_tol=1e-9, abs_tol=1e-12) and r.score < 0


def test_probabilities_sum_to_one(spark):
    """Over all known words and one unknown word of each class, whatever stands before."""
    rows = sample(1, 120)
    df = spark.createDataFrame([(9, i, t, 9, "c") for i, t in rows], SCHEMA)
    stages = Stages(spark)
    coded = lm.coded_documents(df, stages, "doc_id", "text", SMALL)
    counts = lm.count_words(coded, stages)
    words = lm.known_words(counts, SMALL)
    weights = lm.train(coded, words, SMALL)
    codes, n = lm.told_words(counts, words, lm.Maxent(told=1 << 20, classes=8, places=8))
    assert len(codes) == words.v and n.sum() == words.n
    unknown, k = [], 0
    while len(unknown) < 8:
        c = lm.word_code(b"no such word %d" % k, 8)
        if c & 7 not in [u & 7 for u in unknown]:
            unknown.append(c)
        k += 1
    log_n = dict(zip(codes.tolist(), np.log10(n + 0.1), strict=True))
    places = lm.Lookup(words.codes, 3)
    for before in ([], ["x1en"], ["x1en", "y2ig", "x5en"], ["never", "seen"]):
        head = [lm.word_code(w.encode(), 8) for w in before]
        total = 0.0
        for c in [*codes.tolist(), *unknown]:
            x = lm.examples(np.array([*head, c], np.int64), np.array([0, len(head) + 1]), places, words.slot, SMALL)
            a = lm._shares(words.class_bias, weights.by_class, x.class_rows)[-1]
            b = lm._shares(words.place_bias[x.of], weights.by_place, x.place_rows)[-1]
            p = float(a[x.of[-1]]) * float(b[x.place[-1]])
            if x.place[-1] == SMALL.places - 1:
                p *= 10 ** (log_n.get(c, -1.0) - words.rest[x.of[-1]])
            total += p
        assert abs(total - 1) < 1e-4


def test_lookup():
    rng = np.random.default_rng(3)
    keys = np.unique(np.concatenate([rng.integers(-(2**63), 2**63 - 1, 3000), np.arange(50) << 5, [0, -1]]))
    found = lm.Lookup(keys, 5)
    assert (found.find(keys) == np.arange(len(keys))).all()
    others = np.setdiff1d(rng.integers(-(2**63), 2**63 - 1, 3000), keys)
    assert (found.find(others) == -1).all()
    assert (lm.Lookup(keys[:0], 5).find(keys) == -1).all()


def test_steps_follow_the_gradient():
    how = lm.Maxent(classes=4, places=4, rows=16, step=0.1)
    rng = np.random.default_rng(1)
    level = lm._Level(np.zeros((16, 4), np.float32), how)
    rows = rng.integers(0, 16, (2, 500))
    target = rows[0] % 4
    bias = np.zeros(4, np.float32)

    def loss():
        return float(-np.log(lm._shares(bias, level.weights, rows)[np.arange(500), target]).mean())

    before = loss()
    for _ in range(100):
        level.learn(bias, rows, target)
    assert loss() < 0.5 * before and (level.seen == 100 * np.bincount(rows.ravel(), minlength=16)).all()


def test_mean_by_how_often_seen():
    def block(at, seen, weights):
        return {"at": np.array(at, np.int32).tobytes(), "seen": np.array(seen, np.int64).tobytes(),
                "weights": np.array(weights, np.float32).tobytes()}

    table = pa.Table.from_pylist([block([0, 2], [1, 5], [[1, 1], [2, 2]]), block([2], [15], [[6, 2]])])
    got = lm._merge((pa.scalar(0, pa.int32()), pa.scalar(0, pa.int32())), table)
    assert np.frombuffer(got.column("at")[0].as_py(), np.int32).tolist() == [0, 2]
    assert np.frombuffer(got.column("weights")[0].as_py(), np.float32).tolist() == [1, 1, 5, 2]
