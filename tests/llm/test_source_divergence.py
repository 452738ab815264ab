import random
import re
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from corpuslake.llm import source_divergence as sd
from corpuslake.stages import Stages

SCHEMA = "key string, doc_id long, text string, lang string, source string, n int"
_TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def terms_of(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in _TERM.findall(text or "")]


def brute(rows, how):
    rows = [(i, t or "", l or "", s or "") for i, t, l, s in rows]
    seen, n, groups = defaultdict(set), Counter(), sorted({(l, s) for _, _, l, s in rows})
    for k, (i, t, l, s) in enumerate(rows):
        for term in terms_of(t):
            seen[l, term].add(("row", k) if i is None else ("id", i))
            n[l, s, term] += 1
    kept = defaultdict(list)
    for (l, term), docs in seen.items():
        if len(docs) >= how.least:
            kept[l].append(term)

    def share(count, total, v):
        return 1 + how.scale * (count + how.smoothing) // (total + how.smoothing * v)

    p, out = {}, []
    for l, s in groups:
        total = sum(n[l, s, t] for t in kept[l])
        p[l, s] = {t: share(n[l, s, t], total, len(kept[l])) for t in kept[l]}
    for l, s in groups:
        mates = [x for k, x in groups if k == l]
        pairs = [(sum(abs(p[l, s][t] - p[l, x][t]) for t in kept[l]), x) for x in mates if x != s]
        total = sum(n[l, x, t] for x in mates for t in kept[l])
        marked = []
        for t in kept[l]:
            q = share(sum(n[l, x, t] for x in mates), total, len(kept[l]))
            if n[l, s, t] and p[l, s][t] > q:
                marked.append((p[l, s][t] - q, t))
        for part, found in (("pair", pairs), ("term", marked)):
            found.sort(key=lambda f: (-f[0], f[1].encode()))
            out += [(l, s, part, x, v, k + 1) for k, (v, x) in enumerate(found) if part == "pair" or k < how.top]
    return sorted(out)


def sample(seed, n=400):
    rng = random.Random(seed)
    words = ["a", "ab", "abc", "abcdefghijkl", "abcdefghijklm", "Äpfel", "ÄPFEL", "x" * 90, "x" * 91, "日本", "日", "Ab", "zz"]
    words += ["".join(rng.choice("abcd") for _ in range(rng.randint(1, 5))) for _ in range(60)]
    rows = []
    for k in range(n):
        text = rng.choice([" ", "-", "1", "\n"]).join(rng.choice(words) for _ in range(rng.randint(0, 25)))
        lang = rng.choice(["en", "en", "de", None, ""])
        rows.append((rng.choice([k, k, k, 7, None]), rng.choice([text, text, text, "", None]), lang, rng.choice(["s1", "s1", "s2", "s3", None])))
    return rows + rows[:20] + [(9999, None, "fr", "lonely"), (10000, "word", "fr", "other")]


@pytest.mark.parametrize("how", [
    sd.Divergence(least=30, top=3),
    sd.Divergence(least=12, top=50, first=1, chunk=300, bits=1 << 15, block_terms=4, block_sources=2),
])
def test_equals_brute_force(spark, how):
    rows = sample(how.least)
    df = spark.createDataFrame([("k", *r, 1) for r in rows], SCHEMA).repartition(5)
    got = sd.divergence(df, Stages(spark), how=how)
    assert sorted(tuple(r) for r in got.select("lang", "source", "part", "item", "value", "rank").collect()) == brute(rows, how)


def test_empty_table_and_no_terms(spark):
    assert sd.divergence(spark.createDataFrame([], SCHEMA), Stages(spark)).collect() == []
    rows = [(1, "a b", "en", "s1"), (2, None, "en", "s2"), (2, "  ", "en", "s3")]
    got = sd.divergence(spark.createDataFrame([("k", *r, 1) for r in rows], SCHEMA), Stages(spark))
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, sd.Divergence())
    assert got.count() == 6


def test_one_very_long_text_and_a_hot_id(spark):
    rows = [(5, f"alpha beta{chr(97 + k % 26)}", "en", "s1") for k in range(300)] + [(k, "alpha", "en", "s2") for k in range(40)]
    rows += [(1000, "gamma " * 200_000 + "alpha", "en", "s2")] + [(2000 + k, "gamma", "en", "s3") for k in range(29)]
    how = sd.Divergence(chunk=1 << 12)
    got = sd.divergence(spark.createDataFrame([("k", *r, 1) for r in rows], SCHEMA), Stages(spark), how=how)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, how)


def test_words_of_whole_texts():
    texts = ["Ab c1d", "", "ÄB-ä\0x", "z", "z"]
    words, doc = sd.words_of(pa.array(["skip", *texts])[1:], sd._LETTERS)
    want = [(k, w.encode()) for k, t in enumerate(texts) for w in terms_of(t)]
    assert list(zip(doc.tolist(), words.to_pylist(), strict=True)) == want
    assert len(sd.words_of(pa.array([], pa.string()), sd._LETTERS)[0]) == 0


def test_bitmap_lets_all_of_its_hashes_through(spark):
    rows = spark.range(5000).select(F.xxhash64("id").alias("h"))
    bits = sd.bitmap(rows, F.col("h"), 5000, 1 << 27)
    hashes = np.array([r.h for r in rows.collect()], np.int64)
    assert sd.among(hashes, bits).all()
    assert sd.among(np.random.default_rng(0).integers(-(2**63), 2**63 - 1, 20_000), bits).mean() < 0.1


def test_row_groups_of_chunks_stay_small(spark):
    # Eight batches of one task, whose words are all different.
    rows = spark.range(40_000, numPartitions=1).select(
        F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(60)), lambda k: F.translate(F.hex(F.xxhash64("id", k)), "0123456789", "GHIJKLMNOP"))).alias("text"),
        F.lit("en").alias("lang"), F.lit("s").alias("source"), F.col("id").cast("string").alias("id"),
    )
    stages = Stages(spark)
    sd.chunks_of(rows, stages, sd.Divergence())
    folder = stages._paths[-1]
    files = [pq.ParquetFile(f) for f in Path(folder).glob("*.parquet")]
    groups = [f.metadata.row_group(k).num_rows for f in files for k in range(f.num_row_groups)]
    assert sum(groups) > 3 and max(groups) <= 2


def test_hashes_of_keys():
    keys = [b"", b"a", b"a\0", b"abcdefgh", b"abcdefgh\0", b"x" * 64, b"x" * 65, b"y" * 500, b"a"]
    got = sd.key_hashes("en", pa.array([b"skip", *keys], pa.binary())[1:])
    assert got[1] == got[-1] and len(set(got.tolist())) == len(keys) - 1
    # A key's hash does not depend on the others.
    assert [sd.key_hashes("en", pa.array([k], pa.binary()))[0] for k in keys] == got.tolist()
    assert (sd.key_hashes("de", pa.array(keys, pa.binary())) != got).all()
    assert len(sd.key_hashes("en", pa.array([], pa.binary()))) == 0
