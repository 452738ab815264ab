import random
from collections import Counter
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sequential import run

from corpuslake import NgramSpec, VertColumn
from corpuslake.operators import gaps
from corpuslake.operators import ngrams as ng
from corpuslake.operators.ordered import Order, scan
from corpuslake.sources.tables import corpus_sizes, text_tokens, with_token_offsets


def words(n, seed=1):
    rng = random.Random(seed)
    # A third of all tokens are one word.
    return [rng.choice(["the", "the", *[f"w{i}" for i in range(4)]]) for _ in range(n)]


def occurrences(spark, tokens, n):
    rows = [("c", t, i, n) for i, t in enumerate(tokens)]
    return spark.createDataFrame(rows, "corpus_id string, col0 string, idx long, corpus_size long").repartition(3)


@pytest.mark.parametrize("hot_run", [5, 40, 10**6])
def test_arf_of_frequent_words_in_blocks(spark, monkeypatch, hot_run):
    """Splitting the occurrences of frequent n-grams gives what one sort of them gives."""
    tokens = words(700)
    monkeypatch.setattr(ng, "HOT_KEYS", 50)
    got = ng.count_with_arf(occurrences(spark, tokens, 700), ["corpus_id", "col0"], 700, hot_run)
    _, grams, arf, _ = run(tokens, {}, "p", size=1)
    assert {r["col0"]: (r["count"], r["arf"]) for r in got.collect()} == {g: (n, arf[g]) for g, n in grams.items()}


@pytest.mark.parametrize("hot_run, cuts", [(10**6, [300]), (10**6, [0, 1, 650]), (5, [333, 334]), (40, [])])
def test_arf_of_gaps_of_parts(spark, monkeypatch, hot_run, cuts):
    """Gaps of parts, each counted from 0 and moved to its place, give the ARF of the whole."""
    tokens, keys = words(700, 5), ["corpus_id", "col0"]
    monkeypatch.setattr(ng, "HOT_KEYS", 50)
    parts = []
    for a, b in zip([0, *cuts], [*cuts, len(tokens)]):
        rows = gaps.gap_rows(occurrences(spark, tokens[a:b], 0), keys, b - a, hot_run)
        parts.append(gaps.moved(rows.withColumn("before", F.lit(a)), "before"))
    whole = reduce(DataFrame.unionByName, parts).withColumn("corpus_size", F.lit(700))
    got = gaps.count_of_gaps(whole, keys).collect()
    _, grams, arf, _ = run(tokens, {}, "p", size=1)
    assert {r["col0"]: (r["count"], r["arf"]) for r in got} == {g: (n, arf[g]) for g, n in grams.items()}
    # However many runs there are, a gap of an n-gram is one row in each part.
    named = [p.where("gap IS NOT NULL").groupBy(*keys, "gap").count().where("count > 1").count() for p in parts]
    assert not any(named)


def test_hot_ngrams_are_few(spark):
    hot = ng.hot_ngrams(occurrences(spark, words(700), 700), ["corpus_id", "col0"], 700 // 3)
    assert hot.count() < 3


def test_single_token_corpus(spark):
    got = ng.count_with_arf(occurrences(spark, ["a"], 1), ["corpus_id", "col0"]).first()
    assert (got["count"], got["arf"]) == (1, 1.0)


@pytest.mark.parametrize("size, block", [(1, 8), (2, 8), (3, 8), (3, 3), (4, 1 << 16)])
def test_rows_across_blocks_and_segments(spark, size, block):
    tokens, rng = words(200, 2), random.Random(3)
    segments, segment = [], 0
    for _ in tokens:
        segment += rng.random() < 0.15
        segments.append(segment)
    rows = [("c", i, s, t) for i, (t, s) in enumerate(zip(tokens, segments))]
    df = spark.createDataFrame(rows, "corpus_id string, tok_idx long, segment long, word string").repartition(3)
    got = ng.from_rows(df, size, {"col0": F.col("word")}, block=block).collect()
    want = [
        (i, " ".join(tokens[i - size + 1 : i + 1]))
        for i in range(size - 1, len(tokens))
        if segments[i] == segments[i - size + 1]
    ]
    assert sorted((r["idx"], r["col0"]) for r in got) == want


@pytest.mark.parametrize("size", [1, 2, 3])
def test_arrays(spark, size):
    texts = {1: "a b c\nd e", 2: "", 3: "f\ng h i"}
    df = spark.createDataFrame(list(texts.items()), "id long, text string")
    df = df.select(F.lit("c").alias("corpus_id"), (F.col("id") % 2).alias("_"), "id", F.lit(0).alias("range"),
                   text_tokens(F.col("text")).alias("tokens"))
    placed = with_token_offsets(df, Order(chunks=("range",), within="id"))
    got = ng.from_arrays(placed, size, {"col0": lambda w: F.upper(w)}, base="base").collect()
    want, at = [], 0
    for text in texts.values():
        for line in text.split("\n"):
            ws = line.split()
            want += [(at + i, " ".join(ws[i - size + 1 : i + 1]).upper()) for i in range(size - 1, len(ws))]
            at += len(ws)
    assert sorted((r["idx"], r["col0"]) for r in got) == want


@pytest.mark.parametrize("few", [True, False])
def test_corpus_sizes(spark, monkeypatch, few):
    from corpuslake.sources import tables

    if not few:
        monkeypatch.setattr(tables, "FEW_CORPORA", 1)
    df = spark.createDataFrame([("a", 2), ("b", 3), ("a", 4)], "corpus_id string, n int")
    sizes = corpus_sizes(df, ["corpus_id"], F.col("n"))
    assert (sizes.few, sizes.total("corpus_size")) == (few, 9)
    got = sizes.attach(df, ["n"]).collect()
    assert sorted((r["corpus_id"], r["n"], r["corpus_size"]) for r in got) == [("a", 2, 6), ("a", 4, 6), ("b", 3, 3)]


@pytest.mark.parametrize("levels", [0, 1, 2])
def test_scan_does_not_depend_on_chunks(spark, levels):
    rng = random.Random(levels)
    rows = [("k" + str(i % 2), i, i // 7, i // 40, rng.choice([None, None, i]), rng.randrange(5)) for i in range(300)]
    df = spark.createDataFrame(rows, "corpus_id string, seq long, fine long, coarse long, v long, n long")
    order = Order(chunks=("coarse", "fine")[2 - levels :])
    got = scan(df.repartition(5), order, {"upto": F.col("n"), "earlier_n": F.col("n")},
               {"held": F.col("v"), "earlier_v": F.col("v")}, before=["earlier_n", "earlier_v"]).collect()
    state = {}
    want = {}
    for k, seq, _, _, v, n in rows:
        total, last = state.get(k, (0, None))
        new = (total + n, last if v is None else v)
        want[seq] = (new[0], total, new[1], last)
        state[k] = new
    assert {r["seq"]: (r["upto"], r["earlier_n"], r["held"], r["earlier_v"]) for r in got} == want


def test_frequency_table(spark):
    counts = spark.createDataFrame([("c", "Ab", "x" * 200, 3)], "corpus_id string, col0 string, col2 string, count long")
    spec = NgramSpec(1, [VertColumn(0, role="lemma"), VertColumn(2)])
    row = ng.frequency_table(counts, spec).first()
    assert (row["col0"], row["col2"], row["count"], row["arf"], row["initial_cap"], row["ngram_size"]) == (
        "Ab", None, 3, -1.0, True, 1
    )
    assert ng.frequency_table(counts, NgramSpec(1, [VertColumn(0)])).first()["initial_cap"] is False


def test_column_visits(spark):
    counts = spark.createDataFrame([("a b", "x y", 2)], "col0 string, col1 string, n long")
    rows = ng.long_columns(counts, ["col0", "col1"], ["n"]).collect()
    assert Counter(map(tuple, rows)) == Counter([(2, 0, "a b"), (2, 1, "x y")])
    folded = ng.fold_columns(["col0", "col1"], F.lit(0), lambda acc, text, i: acc + F.length(text) * (i + 1))
    assert counts.select(folded).first()[0] == 9


def test_distinct_values(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",)], "v string")
    assert [r[0] for r in ng.distinct_values(df, "v").collect()] == ["a", "b"]


def test_frequent_ngrams_are_found_by_hashes(spark):
    keys = ["corpus_id", "col0"]
    rows = spark.createDataFrame([("a", "x")] * 5 + [("b", "x")] * 3 + [("a", "y")] * 2, "corpus_id string, col0 string")
    hot = ng.hot_ngrams(rows, keys, 2)
    assert sorted(map(tuple, hot.collect())) == [("a", "x", 5), ("b", "x", 3)]
    assert "Exchange hashpartitioning(__h" in hot._jdf.queryExecution().executedPlan().toString()
