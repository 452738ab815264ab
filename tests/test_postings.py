import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpuslake.operators import gaps, postings
from corpuslake.operators import ngrams as ng
from corpuslake.stages import Stages


def test_numbers_come_back():
    values = np.array([0, 1, 127, 128, 300, 1 << 20, (1 << 62) + 5, 0], np.int64)
    octets, size = postings.packed(values)
    assert postings.unpacked(octets).tolist() == values.tolist() and size.tolist() == [1, 1, 1, 2, 2, 3, 9, 1]
    assert not len(postings.unpacked(postings.packed(values[:0])[0]))


def arf(places, size):
    v = size / len(places)
    gaps = [(b - a) for a, b in zip(places, places[1:])] + [places[0] + size - places[-1]]
    found = sum(d >= v for d in gaps) + float(sum(d for d in gaps if d < v)) * len(places) / size
    return np.floor(found * 1000 + 0.5) / 1000


@pytest.mark.parametrize("hot_run, gathered, together", [(3, 7, 20), (25, 40, 1), (10**6, 10**6, 10**6)])
def test_lists_of_many_tasks(spark, monkeypatch, hot_run, gathered, together):
    """Lists that are cut, of tasks whose places lie between each other, with null keys and places that come twice."""
    monkeypatch.setattr(postings, "GATHERED", gathered)
    monkeypatch.setattr(postings, "TOGETHER", together)
    rng = random.Random(hot_run)
    held = defaultdict(list)
    for i in range(600):
        held[rng.choice(["a", None]), rng.choice(["the", "the", "of", None, f"w{i}"])] += [i] * rng.choice([1, 1, 1, 2])
    rows = [(*k, i, 700) for k, places in held.items() for i in places]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "corpus_id string, col0 string, idx long, corpus_size long").repartition(3)
    got = ng.count_with_arf(df, ["corpus_id", "col0"], len(rows), hot_run).collect()
    assert {(r[0], r[1]): (r["count"], r["arf"]) for r in got} == {k: (len(p), arf(p, 700)) for k, p in held.items()}
    assert len(got) == len(held)
    found = defaultdict(dict)
    for r in gaps.gap_rows(df, ["corpus_id", "col0"], len(rows), hot_run).collect():
        assert r["gap"] not in found[r[0], r[1]]
        found[r[0], r[1]][r["gap"]] = (r["n"], r["first"], r["last"])
    for k, places in held.items():
        want = {None: (len(places), places[0], places[-1])}
        for a, b in zip(places, places[1:]):
            want[b - a] = (want.get(b - a, (0,))[0] + 1, None, None)
        assert found.pop(k) == want
    assert not found


def test_occurrences_are_not_shuffled_as_rows(spark):
    """Only lists are shuffled, and once; those of an n-gram hold many places."""
    df = spark.range(6000).select(F.lit("c").alias("corpus_id"), (F.col("id") % 5).cast("string").alias("col0"),
                                  F.col("id").alias("idx"), F.lit(6000).alias("corpus_size"))
    counts = ng.count_with_arf(df, ["corpus_id", "col0"], 6000, 50)
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 2 and plan.count("Repartition") == 1
    lists = df.mapInArrow(postings._gather(["corpus_id", "col0"], 10**6, 50), "corpus_id string, col0 string, first long, rest binary")
    assert lists.count() == df.rdd.getNumPartitions() * 5 * -(-6000 // df.rdd.getNumPartitions() // 5 // 50)


def test_no_shuffle_outlives_a_stage(spark, tmp_path):
    """Shuffle files go with the table that is written, and the session's setting stays."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, store = spark.conf.get(name), spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        return sum(b.toString().startswith("shuffle_") for b in iter_of(store.getAllBlocks()))

    def iter_of(seq):
        return [seq.apply(i) for i in range(seq.size())]

    held = shuffled()
    Stages(spark).keep(spark.range(1000).repartition(3, "id"))
    assert shuffled() <= held and spark.conf.get(name) == before
