import numpy as np
import pytest

from corpuslake.llm import vector_codes as vc
from corpuslake.stages import Stages

SCHEMA = "label int, vec_id long, embedding array<float>, v string, code int"


def brute(rows, how):
    """(codes, errors, codebooks) by plain rounds over all usable rows."""
    good = [r for r in rows if r[2] is not None and all(x is not None and np.isfinite(x) for x in r[2])]
    length = -(-max((len(r[2]) for r in good), default=0) // how.parts) * how.parts
    whole = [[int(np.floor(float(np.float32(x)) * how.scale)) for x in r[2]] for r in good]
    whole = [w + [0] * (length - len(w)) for w in whole]
    order = sorted(range(len(good)), key=lambda i: (good[i][1] is None, good[i][1] or 0, whole[i]))[: how.entries]
    d = length // how.parts
    books = [[whole[i][p * d : p * d + d] for i in order] for p in range(how.parts)]

    def assigned():
        out = []
        for w in whole:
            of = []
            for p in range(how.parts):
                dist = [sum((a - b) ** 2 for a, b in zip(w[p * d : p * d + d], e, strict=True)) for e in books[p]]
                of.append((min(dist), dist.index(min(dist))))
            out.append(of)
        return out

    for _ in range(how.rounds):
        own = assigned()
        for p in range(how.parts):
            for j in range(len(books[p])):
                mine = [w[p * d : p * d + d] for w, o in zip(whole, own, strict=True) if o[p][1] == j]
                if mine:
                    books[p][j] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    own = assigned()
    found = [(r[1], r[0], bytes(j for _, j in o), sum(e for e, _ in o)) for r, o in zip(good, own, strict=True)]
    return sorted(found, key=repr), books


def sample(n, length, seed):
    rng = np.random.default_rng(seed)
    rows = [(int(rng.integers(3)), i, [float(np.float32(x)) for x in rng.normal(scale=0.2, size=length)]) for i in range(n)]
    rows += [rows[2], rows[2], (None, 2, rows[5][2]), (None, None, rows[4][2]), (None, None, rows[4][2])]
    rows += [(1, 10_000 + i, [0.25] * length) for i in range(4)]  # ties
    rows += [(1, 1, None), (1, 0, [None] + [0.1] * (length - 1)), (1, -5, [float("nan")] * length), (0, -6, [float("inf")] * length)]
    return rows


@pytest.mark.parametrize("n, length, how", [
    (250, 16, vc.Codes(parts=4, entries=24, rounds=3, closest=6, fewest=2, served=0.9)),
    (60, 8, vc.Codes(parts=2, entries=64, rounds=2)),
    (20, 6, vc.Codes(parts=4, entries=1, rounds=2)),
])
def test_equals_plain_rounds(spark, n, length, how):
    rows = sample(n, length, n)
    df = spark.createDataFrame([(*r, "x", 7) for r in rows], SCHEMA).repartition(5)
    codes, books, report = vc.vector_codes(df, Stages(spark), how=how)
    want, want_books = brute(rows, how)
    got = sorted(((r.vec_id, r.label, bytes(r.code), r.error) for r in codes.collect()), key=repr)
    assert got == want
    assert books.tolist() == want_books
    assert all(n.sum() == len(want) * how.parts for n in report.needed)
    if how.entries == 24:
        assert report.needed[1][0] > 0 and report.needed[1][-1] < len(want) * how.parts  # bounds spare work


def test_lengths_that_differ_and_empty_vectors(spark):
    how = vc.Codes(parts=4, entries=3, rounds=1)
    rows = [(0, 1, [0.5] * 5), (0, 2, [0.1, 0.9]), (None, 3, []), (0, 4, [0.5] * 7), (0, 5, [-0.5] * 7)]
    codes, books, _ = vc.vector_codes(spark.createDataFrame([(*r, "x", 7) for r in rows], SCHEMA), Stages(spark), how=how)
    want, want_books = brute(rows, how)
    assert sorted(((r.vec_id, r.label, bytes(r.code), r.error) for r in codes.collect()), key=repr) == want
    assert books.tolist() == want_books


def test_no_usable_rows_and_only_empty_vectors(spark):
    for rows in ([], [(1, 1, None, "x", 7)], [(1, 1, [float("nan")], "x", 7)]):
        codes, books, _ = vc.vector_codes(spark.createDataFrame(rows, SCHEMA), Stages(spark))
        assert codes.count() == 0 and vc.books_text(books) == ""
    codes, books, _ = vc.vector_codes(spark.createDataFrame([(1, 1, [], "x", 7)], SCHEMA), Stages(spark))
    assert [(bytes(r.code), r.error) for r in codes.collect()] == [(bytes(16), 0)] and vc.books_text(books) == ""


def test_components_too_large_for_whole_numbers(spark):
    df = spark.createDataFrame([(1, 1, [3e38] * 16, "x", 7)], SCHEMA)
    with pytest.raises(Exception, match="whole numbers"):
        vc.vector_codes(df, Stages(spark))


def test_bounds_hold_after_moves():
    rng = np.random.default_rng(5)
    book = rng.integers(-40, 40, (30, 3))
    points = rng.integers(-40, 40, (400, 3))
    own, near, lower, outer = vc.nearest(points, book, 5)
    for _ in range(6):
        new = book + rng.integers(-3, 4, book.shape) * (rng.random(30) < 0.4)[:, None]
        moved = np.nextafter(np.sqrt(((new - book) ** 2).sum(1).astype(float)), np.inf)
        book = new
        own, near, lower, outer, needed = vc.again(points, book, moved, own, near, lower, outer)
        dist = vc.squared(points, book)
        assert (own == dist.argmin(1)).all()
        assert (lower <= np.sqrt(np.take_along_axis(dist, near, 1))).all()
        rest = dist.astype(float)
        np.put_along_axis(rest, np.concatenate([near, own[:, None]], 1), np.inf, 1)
        assert (outer <= np.sqrt(rest.min(1))).all()
        assert len({*needed.tolist()}) > 2
