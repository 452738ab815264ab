from pyspark.sql import functions as F

from corpuslake.operators import livetokens as lt
from corpuslake.operators import search


def combos(spark, rows, **options):
    df = spark.createDataFrame(rows, "word string, pos string, raw string, line long")
    return lt.count_combinations(df, ["word", "pos"], "raw", **options)


def test_combinations(spark):
    rows = [
        ("a", "N", "B=1|A=2", 1), ("a", "N", "A=2|B=1", 5), ("a", "N", "A=2||C=3", 6), ("b", "V", "_", 7),
        ("b", "V", "", 8),
    ]
    got = {(r["word"], r["feats_key"]): (r["cnt"], r["last_line"]) for r in combos(spark, rows, line="line").collect()}
    assert got == {("a", "A=2|B=1"): (2, 5), ("a", "A=2"): (1, 6), ("a", "C=3"): (1, 6)}
    kept = {(r["word"], r["feats_key"]): r["cnt"] for r in combos(spark, rows, keep_featless=True).collect()}
    assert kept[("b", "")] == 2


def test_validity(spark):
    values = ["Case=Nom", "a1", "-5/", " ", "word", "A=1|B=2", "x=y=z"]
    df = spark.createDataFrame([(v, "") for v in values], "a string, b string")
    got = [tuple(r) for r in df.select(lt.looks_valid(["a", "b"]), lt.looks_valid(["a", "b"], True)).collect()]
    # Any digit refuses a value; the strict form asks for a number as a whole.
    assert got == [(False, False), (False, True), (False, False), (False, False), (True, True), (False, False),
                   (True, True)]


def test_token_ids_are_stable_and_distinct(spark):
    rows = [("ab", "c", "A=1", 1), ("a", "bc", "A=1", 1)]
    first, second = (lt.token_tables(combos(spark, rows), ["word", "pos"]) for _ in range(2))
    ids = sorted(r["token_id"] for r in first[0].collect())
    assert len(set(ids)) == 2 and ids == sorted(r["token_id"] for r in second[0].collect())
    assert {r["token_id"] for r in first[1].collect()} == set(ids)


def tables(spark):
    tokens = spark.createDataFrame(
        [(1, 5, "w", "NOUN"), (2, 3, "x", "VERB"), (3, 1, "y", "NOUN")], "token_id long, cnt long, form string, pos string"
    )
    feats = spark.createDataFrame(
        [(1, "Number", "Sing"), (1, "Case", "Nom"), (3, "Case", "Acc"), (3, "Number", "Sing")],
        "token_id long, feat string, value string",
    )
    return tokens, feats


def test_search(spark):
    tokens, feats = tables(spark)
    found = search.search_tokens(tokens, feats, {"pos": "NOUN"}, [("Number", "Sing")])
    assert sorted((r["form"], r["cnt"], r["udfeats"]) for r in found.collect()) == [
        ("w", 5, "Case=Nom|Number=Sing"), ("y", 1, "Case=Acc|Number=Sing")
    ]
    assert search.total(found).first()["total"] == 2
    # No filter keeps all tokens that have features; several filters must all match.
    assert search.search_tokens(tokens, feats).count() == 2
    both = search.search_tokens(tokens, feats, {"pos": "NOUN", "form": "w"}, [("Number", "Sing"), ("Case", "Nom")])
    assert both.count() == 1
    assert search.search_tokens(tokens, feats, {}, [("Number", "Sing"), ("Case", "Gen")]).count() == 0
    # The same feature twice: a token with one value of it cannot pass.
    assert search.search_tokens(tokens, feats, {}, [("Case", "Nom"), ("Case", "Acc")]).count() == 0


def test_facets(spark):
    tokens, feats = tables(spark)
    got = search.available_values(
        tokens, feats, ["form", "pos"], {"pos": ["NOUN"], "form": []}, {"Number": ["Sing"], "Case": []}
    ).collect()
    assert sorted(map(tuple, got)) == [
        ("attr", "form", "w"), ("attr", "form", "y"), ("attr", "pos", "NOUN"), ("feat", "Case", "Acc"),
        ("feat", "Case", "Nom"), ("feat", "Number", "Sing"),
    ]
    any_case = search.attr_values(tokens, feats, ["form"], None, {"Case": ["Acc", "Gen"]})
    assert [tuple(r) for r in any_case.collect()] == [("form", "y")]


def test_feats_map_keeps_the_last_value(spark):
    _, feats = tables(spark)
    more = feats.union(spark.createDataFrame([(1, "Case", "Zzz")], feats.schema))
    rows = more.groupBy("token_id").agg(F.array_sort(F.collect_list(F.struct("feat", "value"))).alias("f"))
    got = {r[0]: r[1] for r in rows.select("token_id", search.feats_map(F.col("f"))).collect()}
    assert got == {1: {"Case": "Zzz", "Number": "Sing"}, 3: {"Case": "Acc", "Number": "Sing"}}
