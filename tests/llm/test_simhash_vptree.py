import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from corpuslake.llm import simhash_vptree as sv
from corpuslake.stages import Stages


def brute_print(text, k=4):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, linked):
    parent = {i: i for i in ids}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in range(len(ids)):
        for b in range(a):
            if linked(a, b):
                x, y = find(ids[a]), find(ids[b])
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def texts(n, seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)] + ["É x", "ab\x1cc"]
    out = []
    for _ in range(n):
        if out and rng.random() < 0.6:
            words = rng.choice(out).split(" ")
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            out.append(" ".join(words))
        else:
            out.append(" ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 4, 30, 120, 200]))))
    return out


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize(
    "bounds", [sv.VantageTree(), sv.VantageTree(leaf_rows=16, block_rows=40, most_copies=50)], ids=["one", "grid"]
)
def test_links_equal_brute_force(spark, bounds):
    rows = list(enumerate([*texts(300, 1), None, "", " \t\n", "A b C d", "a B\rc\x0bd", "x y"]))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in sv.simhash_classes(df, Stages(spark), bounds=bounds).collect()}
    prints = [brute_print(t) for _, t in rows]
    want = brute_components([i for i, _ in rows], lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 4)
    assert {i: r.fingerprint for i, r in got.items()} == {i: signed(p) for i, p in enumerate(prints)}
    assert {i: r.component_id for i, r in got.items()} == want
    assert len(set(want.values())) < len(rows) - 30


def test_nulls_repeats_and_clashing_columns(spark):
    rows = [(None, "a b c d e", 1), (5, "a b c d e", 2), (5, "a b c d e", 2), (None, "q r s t", 3), (2, None, 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp int")
    got = [(r.doc_id, r.component_id) for r in sv.simhash_classes(df, Stages(spark)).collect()]
    assert sorted(got, key=str) == sorted([(None, 5), (5, 5), (5, 5), (None, None), (2, 2)], key=str)
    assert sv.simhash_classes(df.limit(0), Stages(spark)).collect() == []


def test_search_misses_nothing():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    fps = np.concatenate([base ^ (np.uint64(1) << np.uint64(b)) for b in range(0, 60, 3)])
    pairs = set()
    everyone = np.arange(len(fps))
    sv.search(fps, everyone, everyone, 2, lambda i, j: pairs.update(zip(i.tolist(), j.tolist(), strict=True)))
    d = np.bitwise_count(fps[:, None] ^ fps[None, :])
    assert pairs == set(zip(*(x.tolist() for x in np.nonzero(d <= 2)), strict=True))


def test_rows_dealt_grow_with_the_input():
    rng, bounds, copies = np.random.default_rng(2), sv.VantageTree(), []
    for n in (50_000, 400_000):
        fps = rng.integers(-(1 << 63), (1 << 63) - 1, n)
        taken = fps[: bounds.sample].view(np.uint64)
        top = sv.tree(taken, n / len(taken), 4, bounds.leaf_rows, bounds.block_rows, bounds.most_copies)
        rows = pa.RecordBatch.from_arrays([pa.array(np.arange(n)), pa.array(fps)], ["rep", "fp"])
        copies.append(sum(len(b) for b in sv._dealt(top, 4)(iter([rows]))) / n)
    assert copies[1] < 1.3 * copies[0] and max(copies) < 6
