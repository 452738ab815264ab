import numpy as np
import pytest

from corpuslake.llm import embedding_join as ej
from corpuslake.stages import Stages


def brute(rows):
    """(n_links, component) of each row."""
    good = [
        v if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v) else None for i, v in rows
    ]
    links = [0] * len(rows)
    parent = {i: i for i, _ in rows if i is not None}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, x in enumerate(good):
        for b, y in enumerate(good):
            if a == b or x is None or y is None or len(x) != len(y):
                continue
            x64, y64 = np.array(x, np.float64), np.array(y, np.float64)
            if x64 @ y64 / np.linalg.norm(x64) / np.linalg.norm(y64) >= 0.9:
                links[a] += 1
                p, q = find(rows[a][0]), find(rows[b][0])
                parent[max(p, q)] = min(p, q)
    return [(i, n, None if i is None else find(i)) for (i, _), n in zip(rows, links, strict=True)]


def sample():
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 8))
    out = [centres[rng.integers(12)] + rng.normal(scale=0.25, size=8) for _ in range(220)]
    out += [out[3]] * 5 + [out[7] * 1e3, -out[7], np.zeros(8)]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(out)]
    rows += [(300, None), (301, []), (302, [1.0, None]), (303, [1.0, float("nan")]), (304, [float("inf"), 1.0])]
    return rows + [(305, [1.0, 0.0]), (306, [2.0, 0.1]), (None, rows[3][1]), rows[9]]


@pytest.mark.parametrize(
    "bounds",
    [ej.Pivots(), ej.Pivots(sample=60, cell_rows=16, block_rows=12, most_copies=20)],
    ids=["one", "cells and blocks"],
)
def test_equals_brute_force(spark, bounds):
    rows = sample()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = ej.cosine_links(df, Stages(spark), bounds=bounds).collect()
    got = sorted(((r.vec_id, r.n_links, r.component_id) for r in found), key=str)
    assert got == sorted(brute(rows), key=str)
    assert all(r.kept == (r.vec_id == r.component_id) for r in found if r.vec_id is not None)


def test_empty_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, [1.0], 7)], "vec_id long, embedding array<float>, n_links int")
    assert [tuple(r) for r in ej.cosine_links(df, Stages(spark)).collect()] == [(1, 0, 1, True)]
    assert ej.cosine_links(df.limit(0), Stages(spark)).collect() == []
