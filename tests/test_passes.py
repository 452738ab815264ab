"""How often jobs make, sort and look at their rows."""

from pyspark.sql import functions as F
from test_structure import vertical

from corpuslake.operators import livetokens as lt
from corpuslake.operators import ngrams as ng
from corpuslake.operators import structure as st
from corpuslake.operators import tokens as tk
from corpuslake.operators.ordered import scan
from corpuslake.plans import corpora as cp
from corpuslake.sources import tables
from corpuslake.sources.vertical import read_lines, token_lines

LINES = ['<doc id="a">', "x\ty", "x", "", '<p n="1">', "y\tz", "</p>", "</doc>", "w\tw"]


def test_first_width_from_one_row_a_chunk(spark, tmp_path, monkeypatch):
    seen, of = [], tables.PerCorpus.of.__func__

    def counted(cls, df, *args, **options):
        seen.append(df.count())
        return of(cls, df, *args, **options)

    monkeypatch.setattr(tables.PerCorpus, "of", classmethod(counted))
    rows = read_lines(spark, vertical(tmp_path, LINES * 20), "c1", chunk_bits=6)
    assert st.width_errors(token_lines(rows)).count() == 20
    assert seen == [3]


def test_kept_tags_give_the_same_counts(spark, tmp_path):
    rows, kept = read_lines(spark, vertical(tmp_path, LINES * 20), "c1", chunk_bits=4), []

    def keep(df):
        kept.append(df.count())
        return df.localCheckpoint()

    want = sorted(map(repr, st.events_with_token_counts(rows).select("pos", "name", "tok").collect()))
    assert sorted(map(repr, st.events_with_token_counts(rows, keep=keep).select("pos", "name", "tok").collect())) == want
    assert kept[0] == 100 and kept[1] == 12


def test_columns_are_made_once_for_equal_words(spark):
    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def rule(word):
        made.add(1)
        return word.lower()

    texts = spark.createDataFrame([("c", ["A", "b", "\nB", "a", "b"])] * 40, "corpus_id string, tokens array<string>")
    columns = {"col0": rule, "col1": F.upper}
    want = {("a b", "A B", 80)}
    assert {tuple(r)[1:] for r in ng.count_from_arrays(texts, 2, columns).collect()} == want | {("b a", "B A", 40)}
    assert made.value < 40


def test_counted_rows_are_summed(spark):
    rows = spark.createDataFrame([("a", "_", 3), ("a", "X=1", 2), ("a", "X=1", 5)], "lemma string, feats string, count long")
    assert [r["cnt"] for r in lt.raw_counts(rows, ["lemma"], "feats", times="count").orderBy("feats").collect()] == [7, 3]


def test_last_values_of_few_rows(spark, tmp_path):
    rows = read_lines(spark, vertical(tmp_path, LINES * 20), "c1", chunk_bits=3)
    last = {"last": F.when(F.col("line") == "<doc id=\"a\">", F.struct("pos"))}
    plain, sparse = (scan(rows, tk.ORDER, lasts=last, sparse=s).select("pos", "last") for s in (False, True))
    assert sorted(map(repr, sparse.collect())) == sorted(map(repr, plain.collect()))


def test_words_become_lines_as_rows(spark, tmp_path):
    """A token rule may be what no array function takes, and null parts of tags leave null lines."""
    docs = [(1, "Ab  c\n\nd", "en", "s"), (2, None, "en", "s"), (3, "", None, None)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    token = F.udf(lambda w: f"{w}!", "string")
    before = (F.concat(F.lit("<x "), F.col("lang"), F.lit(">")),)
    lines = cp.document_lines(spark, str(tmp_path), cp.simple_paragraph, before, token=token).orderBy("pos").collect()
    text = {k: [r["line"] for r in lines if r["chunk"] == k] for k in (1, 2, 3)}
    assert text[1][1:] == ["<x en>", '<p num="1">', "Ab!", "c!", "</p>", '<p num="2">', "</p>", '<p num="3">', "d!", "</p>", "</doc>"]
    assert text[2] == [] and text[3][1:] == [None, '<p num="1">', "</p>", "</doc>"]
    assert [r["seq"] for r in lines if r["chunk"] == 1] == list(range(12))
