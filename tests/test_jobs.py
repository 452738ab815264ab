import pytest

from corpuslake import NgramSpec, SelfJoin, StructureSpec, TokenAttr, VertColumn
from corpuslake.operators import search, units
from corpuslake.operators.structure import TooManyErrors
from corpuslake.plans.extraction import extract
from corpuslake.plans.livetokens_import import import_livetokens
from corpuslake.sinks import tables as sink

SPEC = StructureSpec({"doc": ["id", "date"]}, "doc")
JOIN = SelfJoin("intercorp", ["doc_id"])
GRAMS = NgramSpec(1, [VertColumn(0, "toLower", "lemma")], arf=True)


def write(path, *docs):
    lines = []
    for doc_id, date, text in docs:
        lines += [f'<doc id="{doc_id}" date="{date}">', *text.split(), "</doc>"]
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def target(tmp_path, corpus):
    return sink.Target(f"file:{tmp_path}/out", corpus, group="aligned")


def test_create_and_append(spark, tmp_path):
    en, cs = target(tmp_path, "en"), target(tmp_path, "2020")
    a = write(tmp_path / "a", ("en1", "2020-01-05", "The the cat"), ("en2", "2021-1-5", "dog"))
    b = write(tmp_path / "b", ("cs1", "2021-02-01", "Pes"), ("cs3", "unknown", "kočka"))
    with pytest.raises(FileNotFoundError):
        extract(spark, cs, SPEC, file=b, append=True)
    assert extract(spark, en, SPEC, file=a, join=JOIN, ngrams=GRAMS) == 0
    extract(spark, cs, SPEC, file=b, append=True, join=JOIN, ngrams=GRAMS)
    stored = sink.read(spark, en, en.units)
    assert sorted((r["corpus_id"], r["doc_id"], r["poscount"], r["item_id"]) for r in stored.collect()) == [
        ("2020", "cs1", 1, "1"), ("2020", "cs3", 1, "3"), ("en", "en1", 3, "1"), ("en", "en2", 1, "2")
    ]
    counts = {(r["corpus_id"], r["col0"]): r["count"] for r in sink.read(spark, en, en.frequencies).collect()}
    assert counts == {("en", "the"): 2, ("en", "cat"): 1, ("en", "dog"): 1, ("2020", "pes"): 1, ("2020", "kočka"): 1}

    # Rows of different corpora meet on the item id.
    (pair,) = units.aligned(stored, ["doc_id"]).collect()
    assert (pair["item_id"], pair["doc_id_a"], pair["doc_id_b"]) == ("1", "cs1", "en1")
    assert units.duplicate_items(stored).count() == 0
    with pytest.raises(Exception, match="item id 1 is not unique in en"):
        units.aligned(stored.unionByName(stored.where("corpus_id = 'en'")), ["doc_id"]).collect()
    # Appending a corpus again would break that key, so nothing is written.
    with pytest.raises(ValueError):
        extract(spark, cs, SPEC, file=b, append=True, join=JOIN)
    assert sink.read(spark, en, en.units).count() == 4

    # A moving window: one old text goes, the one without a date stays.
    c = write(tmp_path / "c", ("de9", "2022-01-01", "Hund"))
    extract(spark, target(tmp_path, "de"), SPEC, file=c, append=True, join=JOIN, date_attr="doc_date",
            remove_before="2021-01-05")
    left = sink.read(spark, en, en.units).collect()
    assert sorted(r["doc_id"] for r in left) == ["cs1", "cs3", "de9", "en2"]
    # A corpus that loses all its texts.
    assert sink.remove_older(spark, en, "doc_date", "2021-01-06") == 1
    assert {r["corpus_id"] for r in sink.read(spark, en, en.units).collect()} == {"2020", "de"}
    assert sink.remove_older(spark, en, "doc_date", "2021-01-06") == 0

    # Creating again replaces the tables.
    extract(spark, en, SPEC, file=a, join=JOIN)
    assert sink.read(spark, en, en.units).count() == 2


@pytest.mark.parametrize("corpus", ["en:web", "a=b", "50%", "two words", "2020"])
def test_expired_corpora_with_any_name_go(spark, tmp_path, corpus):
    out = target(tmp_path, corpus)
    rows = spark.createDataFrame([("d1", "2001-01-01", corpus), ("d2", "2001-02-01", corpus)], "doc_id string, doc_date string, corpus_id string")
    sink.write_units(rows, out)
    more = spark.createDataFrame([("d3", "2031-01-01", "other")], "doc_id string, doc_date string, corpus_id string")
    sink.write_units(more, out, append=True)
    assert sink.remove_older(spark, out, "doc_date", "2020-01-01") == 2
    assert [r["corpus_id"] for r in sink.read(spark, out, out.units).collect()] == ["other"]


def test_a_unit_without_item_id_is_kept(spark, tmp_path):
    path = tmp_path / "v"
    path.write_text('<doc date="x">\nb\n</doc>\n<doc id="2">\nc\n</doc>\n')
    spec = StructureSpec({"doc": ["id", "date"], "p": ["n"]}, "p", parent="doc")
    out = target(tmp_path, "x")
    extract(spark, out, spec, file=str(path), join=SelfJoin("identity", ["doc_id"]), max_errors=5)
    got = sorted((str(r["doc_id"]), str(r["doc_date"]), str(r["item_id"])) for r in sink.read(spark, out, out.units).collect())
    assert got == [("2", "None", "2"), ("None", "None", "None")]


def test_moving_window_arguments(spark, tmp_path):
    with pytest.raises(ValueError):
        extract(spark, target(tmp_path, "x"), SPEC, file="x", date_attr="doc_date", remove_before="2020-01-01")
    with pytest.raises(ValueError):
        extract(spark, target(tmp_path, "x"), SPEC, file="x", append=True, remove_before="2020-01-01")


def test_error_budget_comes_before_writing(spark, tmp_path):
    path = tmp_path / "bad"
    path.write_text('<doc id="1">\na\n</p>\n</doc>\n')
    out = target(tmp_path, "x")
    with pytest.raises(TooManyErrors):
        extract(spark, out, SPEC, file=str(path))
    assert not sink.exists(spark, out.units)
    assert extract(spark, out, SPEC, file=str(path), max_errors=1) == 1
    assert sink.read(spark, out, out.units).count() == 1


def test_nested_structures_use_the_budget_too(spark, tmp_path):
    path = tmp_path / "nested"
    path.write_text('<doc id="1">\n<p>\na\n</doc>\n</p>\n</doc>\n')
    out, spec = target(tmp_path, "n"), StructureSpec({"doc": ["id"]}, "p", nested=True)
    with pytest.raises(TooManyErrors):
        extract(spark, out, spec, file=str(path))
    assert extract(spark, out, spec, file=str(path), max_errors=1) == 1
    assert [(r["doc_id"], r["poscount"]) for r in sink.read(spark, out, out.units).collect()] == [("1", 1)]


def test_bibliography(spark):
    df = spark.createDataFrame([("d1", "1981", "x"), ("d1", "1981", "x")], "doc_id string, doc_year string, doc_author string")
    view = units.bibliography(df, ["doc_id", "doc_author"], "doc_id")
    assert view.columns == ["id", "doc_author"] and view.count() == 2
    assert units.bibliography(df, ["doc_id"], "doc_id", distinct=True).count() == 1


def test_import_and_search(spark, tmp_path):
    path = tmp_path / "v"
    path.write_text("<s>\nw\tNOUN\tNumber=Sing|Case=Nom\nw\tNOUN\tCase=Nom|Number=Sing\nx\tVERB\t_\ny7\tNOUN\tA=1\n"
                    "z\tADJ\tCase=Acc||Case=Gen\textra\n</s>\n")
    out = sink.Target(f"file:{tmp_path}/live", "c")
    attrs = [TokenAttr("form", 0), TokenAttr("pos", 1), TokenAttr("feats", 2, ud_feats=True)]
    report = import_livetokens(spark, out, attrs, file=str(path))
    assert report.width_errors.count() == 1 and (report.rejected, report.unparsed) == (1, 1)
    (refused,) = sink.read(spark, out, out.rejected).collect()
    assert (refused["form"], refused["feats_key"], refused["cnt"], refused["last_line"]["seq"]) == ("y7", "A=1", 1, 4)
    tokens, feats = sink.read(spark, out, out.tokens), sink.read(spark, out, out.feats)
    # The last, partial batch is stored too.
    assert sorted((r["form"], r["cnt"]) for r in tokens.collect()) == [("w", 2), ("z", 1), ("z", 1)]
    found = search.search_tokens(tokens, feats, {"pos": "NOUN"}, [("Case", "Nom")]).collect()
    assert [(r["form"], r["cnt"], r["udfeats"]) for r in found] == [("w", 2, "Case=Nom|Number=Sing")]
    import_livetokens(spark, out, attrs, file=str(path), keep_featless=True)
    assert sink.read(spark, out, out.tokens).count() == 4


def test_value_export(spark, tmp_path):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",)], "col2 string")
    sink.export_values(df, "col2", f"file:{tmp_path}/values")
    assert [r["value"] for r in spark.read.text(f"file:{tmp_path}/values").collect()] == ["a", "b"]
