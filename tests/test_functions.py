import pytest
from pyspark.sql import functions as F

from corpuslake import NgramSpec, StructureSpec, TokenAttr, VertColumn
from corpuslake.config import feats_attr
from corpuslake.functions import (
    empty_to_null, feat_sets, feats_key, initial_cap, item_id, item_id_names, long_to_null, modifier_chain, ngram_hash,
    register_item_id, register_modifier,
)
from corpuslake.functions.modifiers import PENN_CLASS


def apply(spark, values, make, schema="v string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(make(F.col("v"))).collect()]


@pytest.mark.parametrize(
    "chain, want",
    [
        ("", ["Ěnglish", ""]),
        (None, ["Ěnglish", ""]),
        ("toLower", ["ěnglish", ""]),
        # A character, where the first byte would break a letter in two.
        ("firstChar", ["Ě", ""]),
        ("toLower:firstChar", ["ě", ""]),
        ("identity:cs_cnc2020", ["Ě", ""]),
        ("cs_cnc2000:toLower", ["ě", ""]),
        ("cs_cnc2000_spk", ["Ě", ""]),
    ],
)
def test_modifier_chains(spark, chain, want):
    assert apply(spark, ["Ěnglish", ""], modifier_chain(chain)) == want


def test_penn(spark):
    tags = [*PENN_CLASS, "", "nn", "?"]
    assert apply(spark, tags, modifier_chain("penn")) == [PENN_CLASS.get(t, "X") for t in tags]
    assert len(PENN_CLASS) == 36 and PENN_CLASS["WDT"] == "V" and PENN_CLASS["NNP"] == "X"


def test_unknown_and_registered_modifiers(spark):
    with pytest.raises(ValueError):
        modifier_chain("toLower:nothing")
    register_modifier("twice", lambda c: F.concat(c, c))
    assert apply(spark, ["ab"], modifier_chain("twice:firstChar")) == ["a"]


def test_item_ids(spark):
    df = spark.createDataFrame([("cs12", "a"), ("x", None), (None, "b")], "p string, q string")
    made = {
        n: [r[0] for r in df.select(item_id(n, [F.col("p"), F.col("q")])).collect()] for n in ("identity", "empty")
    }
    assert made == {"identity": ["cs12_a", None, None], "empty": ["", "", ""]}
    assert [r[0] for r in df.select(item_id("intercorp", [F.col("p")])).collect()] == ["12", None, None]
    # Two characters go, not two bytes.
    other = df.limit(1).select(item_id("intercorp", [F.lit("čs7é")]), item_id("intercorp", [F.lit("čs")])).first()
    assert tuple(other) == ("7é", "")
    with pytest.raises(ValueError):
        item_id("nothing", [])
    register_item_id("upper", lambda args: F.upper(args[0]))
    assert "upper" in item_id_names()


def test_text_functions(spark):
    assert apply(spark, ["", "a", None], empty_to_null) == [None, "a", None]
    assert apply(spark, ["a" * 127, "a" * 128, "é" * 64], long_to_null) == ["a" * 127, None, None]
    assert apply(spark, ["Éa b", "éa B", "", "1A"], initial_cap) == [True, False, False, False]


def test_hash_has_no_separator(spark):
    df = spark.createDataFrame([("ab", "c"), ("a", "bc")], "a string, b string")
    assert len({r[0] for r in df.select(ngram_hash([F.col("a"), F.col("b")])).collect()}) == 1


def test_feats(spark):
    cases = {
        "Case=Nom|Number=Sing||Case=Acc|Animacy=Anim": ["Case=Nom|Number=Sing", "Animacy=Anim|Case=Acc"],
        "_": None,
        "": None,
        "A=b=c|_=x": ["A=b=c"],
        "B=1|A=2|B=0": ["A=2|B=1|B=0"],
        "noequals": None,
        "A=1|": None,
        "A=1||": None,
        "_=x": [""],
    }
    got = apply(spark, cases, lambda v: F.transform(feat_sets(v), feats_key))
    assert got == list(cases.values())


def test_config_checks():
    with pytest.raises(ValueError):
        NgramSpec(0, [VertColumn(0)])
    with pytest.raises(ValueError):
        NgramSpec(1, [])
    with pytest.raises(ValueError):
        NgramSpec(1, [VertColumn(0), VertColumn(0, "toLower")])
    with pytest.raises(ValueError):
        StructureSpec({}, "")
    with pytest.raises(ValueError):
        feats_attr([TokenAttr("a", 0, True), TokenAttr("b", 1, True)])
    spec = StructureSpec({"doc": ["id", "year", "author"], "p": ["num", "style"]}, "p")
    assert spec.names == ["doc_id", "doc_year", "doc_author", "p_num", "p_style"]
