import random

import pytest
from pyspark.sql import functions as F

from corpuslake.config import TokenAttr
from corpuslake.operators import livetokens as lt
from corpuslake.operators import search
from corpuslake.operators.bitmaps import SearchIndex, bitmaps_of, entries_of
from corpuslake.operators.dense import dense_ids
from corpuslake.plans import catalog
from corpuslake.plans.livetokens_import import import_livetokens
from corpuslake.sinks import tables as sink
from corpuslake.stages import Stages

SCHEMA = "word string, pos string, raw string"


def random_rows(n, seed=5):
    rng = random.Random(seed)
    feats = ["", "_", "A=1", "A=2|B=1", "B=1|C=x", "A=1|A=2", "C=y||A=2", "C=x|D=long value"]
    return [(f"w{min(rng.randrange(60), rng.randrange(60))}", rng.choice("NVX"), rng.choice(feats)) for _ in range(n)]


@pytest.fixture(scope="module")
def both(spark):
    """The two tables and the index of the same tokens, featless ones too."""
    stages = Stages(spark)
    tokens = spark.createDataFrame([*random_rows(4000), (None, "N", "A=1"), (None, None, "_")], SCHEMA)
    counted = stages.keep(lt.count_combinations(tokens, ["word", "pos"], "raw", keep_featless=True))
    entries = stages.keep(entries_of(counted, ["word", "pos"], stages.keep))
    index = SearchIndex(entries, stages.keep(bitmaps_of(entries, ["word", "pos"])))
    yield *map(stages.keep, lt.token_tables(counted, ["word", "pos"])), index
    stages.drop()


FILTERS = [
    (None, None),
    ({"pos": "N"}, None),
    ({"pos": ["N", "V"], "word": []}, {"A": ["1", "2"]}),
    (None, [("A", "1"), ("A", "2")]),  # only tokens with both values of a repeated feature
    ({"word": ["w1", "w2", "w3"]}, {"C": "x", "B": "1"}),
    ({"word": "none such"}, None),
    ({"pos": "X"}, {"C": "none such"}),
    (None, {"D": "long value"}),
]


@pytest.mark.parametrize("attrs,feat_filter", FILTERS)
def test_index_equals_tables(both, attrs, feat_filter):
    tokens, feats, index = both
    want = search.search_tokens(tokens, feats, attrs, feat_filter).select("word", "pos", "cnt", "udfeats")
    got = index.search(attrs, feat_filter).select("word", "pos", "cnt", F.col("feats_key").alias("udfeats"))
    rows = sorted(map(repr, map(tuple, want.collect())))
    assert sorted(map(repr, map(tuple, got.collect()))) == rows
    assert index.total(attrs, feat_filter).first()["total"] == len(rows)
    values = search.available_values(tokens, feats, ["word", "pos"], attrs, feat_filter)
    facets = index.facets(["word", "pos"], attrs, feat_filter)
    assert sorted(map(tuple, facets.select("kind", "name", "value").collect())) == sorted(map(tuple, values.collect()))


def test_facets_count_entries(both):
    _, _, index = both
    got = {(r["name"], r["value"]): r["n"] for r in index.facets(["pos"], None, {"B": "1"}).collect()}
    held = [r for r in index.entries.collect() if ("B", "1") in map(tuple, r["feats"])]
    assert got[("B", "1")] == len(held) and got[("pos", "V")] == sum(r["pos"] == "V" for r in held)
    assert got[("C", "x")] == sum(("C", "x") in map(tuple, r["feats"]) for r in held)


def test_totals_and_facets_read_no_entries(both):
    _, _, index = both
    plan = index.facets(["word"], {"pos": "N"})._jdf.queryExecution().optimizedPlan().toString()
    assert "cnt#" not in plan and "feats_key#" not in plan


def test_words_are_no_more_than_their_bits(both):
    _, _, index = both
    assert index.bitmaps.where("bits = 0").count() == 0
    n = index.entries.count()
    every = index.bitmaps.where("kind = 'every' and name = 'tokens'")
    assert every.count() == -(-n // 64) and every.agg(F.sum(F.bit_count("bits"))).first()[0] == n


@pytest.mark.parametrize("n,partitions", [(0, 3), (1, 1), (1000, 7)])
def test_dense_ids(spark, n, partitions):
    rng = random.Random(n)
    rows = list({(rng.choice([None, "", "a", "é", "z" * 40]), i) for i in range(n)})
    stages = Stages(spark)
    made = []
    for _ in range(2):
        rng.shuffle(rows)
        df = spark.createDataFrame(rows, "k string, i long").repartition(partitions)
        made.append(sorted((r["id"], r["k"], r["i"]) for r in dense_ids(df, ["k", "i"], stages.keep).collect()))
    stages.drop()
    order = sorted(rows, key=lambda r: (r[0] is not None, (r[0] or "").encode(), r[1]))
    assert made[0] == made[1] == [(i, *r) for i, r in enumerate(order)]


def test_import_with_index(spark, tmp_path):
    path = tmp_path / "v"
    path.write_text("<doc>\n" + "".join("\t".join(r) + "\n" for r in random_rows(300) if r[0] != "w1") + "</doc>\n")
    target = sink.Target(str(tmp_path / "out"), "c")
    attrs = [TokenAttr("word", 0), TokenAttr("pos", 1), TokenAttr("feats", 2, ud_feats=True)]
    import_livetokens(spark, target, attrs, file=str(path), strict_numeric=True, index=True)
    tokens, feats = sink.read(spark, target, target.tokens), sink.read(spark, target, target.feats)
    index = sink.read_index(spark, target)
    assert index.total().first()[0] == search.total(search.search_tokens(tokens, feats)).first()[0] > 0
    # An import without an index leaves none that is out of date.
    import_livetokens(spark, target, attrs, file=str(path), strict_numeric=True)
    with pytest.raises(FileNotFoundError):
        sink.read_index(spark, target)


def test_a_stored_import_that_is_gone_is_made_again(spark, tmp_path):
    folder = "/root/testdata/sf0.001"
    first = catalog.search_total(spark, folder).first()[0]
    key = next(k for k in catalog._IMPORTED if k[2] == "bitmaps")
    catalog._IMPORTED[key] = str(tmp_path / "gone")
    assert catalog.search_total(spark, folder).first()[0] == first > 0
    assert catalog._IMPORTED[key] != str(tmp_path / "gone")
