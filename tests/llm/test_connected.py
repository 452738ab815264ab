import random

import pytest

from corpuslake.llm.common import connected, running
from corpuslake.stages import Stages
from pyspark.sql import functions as F


@pytest.mark.parametrize("hot", [100_000, 3])
def test_components_equal_a_union_find(spark, hot):
    rng = random.Random(7)
    edges = [(k, k + 1) for k in range(40)] + [(k, 200) for k in range(150, 190)] + [(300, 300), (500, 400), (400, 500)]
    edges += [(rng.randrange(600, 700), rng.randrange(600, 700)) for _ in range(70)]
    rng.shuffle(edges)
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    got = connected(spark.createDataFrame(edges, "a long, b long"), Stages(spark), hot).collect()
    assert {r.node: r.root for r in got} == {x: find(x) for x in list(parent)} and len(got) == len(parent)


def test_no_edges(spark):
    assert connected(spark.createDataFrame([(1, 1)], "a long, b long"), Stages(spark)).collect() == []


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 1000])
def test_running(spark, n):
    rng = random.Random(n)
    values = [rng.randrange(100) for _ in range(n)]
    v = F.array(*map(F.lit, values)).cast("array<bigint>") if values else F.array().cast("array<bigint>")
    row = spark.range(1).select(running(v, lambda a, b: a + b).alias("s"), running(v, F.greatest).alias("m")).first()
    assert row.s == [sum(values[:k]) for k in range(n)]
    assert row.m == [max([0, *values[:k]]) for k in range(n)]
