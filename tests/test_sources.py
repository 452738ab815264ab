"""Vertical files: order, paths, encodings, tags."""

import codecs
import gzip
import random

import pytest
from pyspark.sql import functions as F

from corpuslake.sources.tables import text_tokens
from corpuslake.operators.structure import tag_errors
from corpuslake.sources.vertical import is_whole_tag, line_kind, read_lines, resolve_paths, struct_events, tag_attrs, tag_name, token_column


def ordered(df):
    return [r["line"] for r in df.orderBy("pos").collect()]


def test_files_make_one_stream_in_list_order(spark, tmp_path):
    (tmp_path / "z part.vert").write_text("<doc>\none\ttwo\n")
    (tmp_path / "m.vert").write_text("three\r\n</doc>")
    paths = resolve_paths(spark, files=[str(tmp_path / "z part.vert"), str(tmp_path / "m.vert")])
    assert ordered(read_lines(spark, paths, "c")) == ["<doc>", "one\ttwo", "three", "</doc>"]


def test_order_and_numbers_over_many_splits(spark, tmp_path):
    (tmp_path / "x.vert").write_text("".join(f"w{i}\n" for i in range(20000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        rows = read_lines(spark, resolve_paths(spark, file=str(tmp_path / "x.vert")), "c", chunk_bits=6)
        assert rows.select("chunk").distinct().count() > 10
        assert ordered(rows) == [f"w{i}" for i in range(20000)]
        wide = rows.groupBy("chunk").agg((F.max("seq") - F.min("seq") + 1).alias("span"), F.count("*").alias("n"))
        assert wide.where("span <> n or n > 64").count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_directories_gzip_and_bad_entries(spark, tmp_path):
    folder = tmp_path / "d"
    folder.mkdir()
    (folder / "2.vert").write_text("second\n")
    with gzip.open(folder / "1.vert.gz", "wt") as out:
        out.write("first\n")
    with pytest.warns(UserWarning):
        paths = resolve_paths(spark, files=["", str(tmp_path / "missing"), str(folder)])
    assert ordered(read_lines(spark, paths, "c")) == ["first", "second"]
    with pytest.warns(UserWarning), pytest.raises(FileNotFoundError):
        resolve_paths(spark, file=str(tmp_path / "missing"))
    with pytest.raises(ValueError):
        resolve_paths(spark)


@pytest.mark.parametrize("name", ["_a.vert", ".h.vert"])
def test_files_that_readers_pass_over_are_not_lost(spark, tmp_path, name):
    (tmp_path / name).write_text("x\ny\n")
    (tmp_path / "b.vert").write_text("z\n")
    with pytest.raises(ValueError, match=name):
        resolve_paths(spark, file=str(tmp_path))
    with pytest.raises(ValueError, match=name):
        resolve_paths(spark, file=str(tmp_path / name), skip_hidden=True)
    assert ordered(read_lines(spark, resolve_paths(spark, file=str(tmp_path), skip_hidden=True), "c")) == ["z"]


@pytest.mark.parametrize("encoding", ["utf-8", "iso8859-2", "windows-1250"])
def test_encodings(spark, tmp_path, encoding):
    text = "kůň\tžluťoučký\ttest\n"
    (tmp_path / "v").write_bytes(text.encode(encoding))
    lines = read_lines(spark, resolve_paths(spark, file=str(tmp_path / "v")), "c", encoding)
    assert ordered(lines) == [text.strip("\n")]


def test_unsupported_encoding(spark, tmp_path):
    (tmp_path / "v").write_text("a\n")
    with pytest.raises(ValueError):
        read_lines(spark, [str(tmp_path / "v")], "c", "iso2022_kr")


TEXTS = {
    "cjk": "<doc>\n词\t名\n\n一二三\tx\r\n€é\tn\n</doc>",
    "plain": "".join(f"w{i}\tž\n" for i in range(60)),
}


@pytest.mark.parametrize("encoding", ["gb18030", "gbk", "big5", "shift_jis", "euc_jp", "euc_kr", "cp932", "cp949"])
def test_charsets_of_several_bytes(spark, tmp_path, encoding):
    text = "一二\t十\r\n" * 40 + "\n三\t一"
    (tmp_path / "v").write_bytes(text.encode(encoding))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "61")
    try:
        got = ordered(read_lines(spark, [str(tmp_path / "v")], "c", encoding))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == text.replace("\r", "").split("\n")


@pytest.mark.parametrize(
    "block,encoding",
    [(33, "utf-16-le"), (33, "utf-32-be"), (64, "utf-16-be"), (64, "utf-32"), (1 << 20, "utf-16"), (1 << 20, "utf-32-le")],
)
def test_units_of_several_bytes(spark, tmp_path, encoding, block):
    # Characters whose bytes look like line ends in either order, beside each other and beside line ends.
    rng = random.Random(block)
    letters = ["\u0a05", "\u4e00", "\u0a00", "\u000a", "\u0100", "\u010a", "a", "\t", "\U0001000a", "\U00010a00", "\U000a0000"]
    texts = ["".join(rng.choices(letters, k=150)) + "x", "\n\u0a05\u4e00\n\u0a05\u4e00", *TEXTS.values(), "\ufeffnot a mark\n\ufeffx"]
    names = []
    for i, text in enumerate(texts):
        names.append(f"{tmp_path}/{i}")
        with open(names[-1], "wb") as out:
            out.write(text.encode(encoding))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(block))
    try:
        # Empty lines are passed over by all jobs; those that pieces leave behind hold a place only.
        found = read_lines(spark, names, "c", encoding, chunk_bits=3)
        got = [line for line in ordered(found) if line]
        wide = found.groupBy("chunk").agg((F.max("seq") - F.min("seq") + 1).alias("span"), F.count("*").alias("n"))
        assert wide.where("span <> n").count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == [line.rstrip("\r") for t in texts for line in t.split("\n") if line.rstrip("\r")]


def test_marks_tell_the_order_of_each_file(spark, tmp_path):
    text = "<doc>\nžluť\n</doc>\n"
    (tmp_path / "1").write_bytes(codecs.BOM_UTF16_LE + text.encode("utf-16-le"))
    (tmp_path / "2").write_bytes(codecs.BOM_UTF16_BE + text.encode("utf-16-be"))
    (tmp_path / "3").write_bytes(text.encode("utf-16-be"))
    with gzip.open(tmp_path / "4.gz", "wb") as out:
        out.write(codecs.BOM_UTF16_LE + text.encode("utf-16-le"))
    paths = resolve_paths(spark, file=str(tmp_path))
    assert ordered(read_lines(spark, paths, "c", "utf-16")) == text.split() * 4


def test_malformed_bytes_become_a_mark(spark, tmp_path):
    (tmp_path / "v").write_bytes(b"a\xff\xff\nb\n")
    assert ordered(read_lines(spark, [str(tmp_path / "v")], "c", "euc_jp"))[1] == "b"
    (tmp_path / "w").write_bytes("ab\ncd".encode("utf-16-le") + b"x")
    assert ordered(read_lines(spark, [str(tmp_path / "w")], "c", "utf-16-le"))[0] == "ab"


def test_tags(spark):
    cases = {
        '<doc id="1" title="a > b">': ("open", "doc", {"id": "1", "title": "a > b"}),
        "<p>": ("open", "p", {}),
        '<g k="1" k="2"/>': ("empty", "g", {"k": "2"}),
        "<g/>": ("empty", "g", {}),
        "</doc>": ("close", "doc", {}),
        "<doc id='1' title='a \"b=\"c\"'>": ("open", "doc", {"id": "1", "title": 'a "b="c"'}),
        """<doc a="it's b='c'" d=''>""": ("open", "doc", {"a": "it's b='c'", "d": ""}),
        "<": ("token", None, None),
        "<\tSYM\t<x>": ("token", None, None),
        "<3\tSYM\t>": ("token", None, None),
        "<>": ("token", None, None),
        "</>": ("token", None, None),
        "<\tX": ("token", None, None),
        "": ("blank", None, None),
    }
    df = spark.createDataFrame([(c,) for c in cases], "line string")
    got = df.select("line", line_kind(F.col("line")).alias("k"), tag_name(F.col("line")).alias("n"),
                    tag_attrs(F.col("line")).alias("a")).collect()
    for r in got:
        kind, name, attrs = cases[r["line"]]
        assert r["k"] == kind
        if name:
            assert (r["n"], r["a"]) == (name, attrs)


def test_tags_that_are_not_whole(spark):
    whole = ["<p>", "<p/>", "<p />", "</p>", "</p >", '<p a="1">', "<p a='1'  b=\"2\"/>", '<p a=">" b="a=b">', '<p a="/">']
    broken = ["<p a=1>", '<p a="1>', '<p a="1"b="2">', '<p a = "1">', '</p a="1">', "<p x>"]
    df = spark.createDataFrame([(c,) for c in whole + broken], "line string")
    got = {r.line: r.whole for r in df.select("line", is_whole_tag(F.col("line")).alias("whole")).collect()}
    assert got == {c: c in whole for c in whole + broken}
    # Such a tag counts as an error, its other attributes as they are.
    events = struct_events(spark.createDataFrame([("c", 1, '<p a=1 b="2">'), ("c", 2, "</p>")], "corpus_id string, pos int, line string"))
    assert [(r.corpus_id, r.pos) for r in tag_errors(events).collect()] == [("c", 1)]
    assert [r.attrs for r in events.orderBy("pos").collect()] == [{"b": "2"}, {}]


def test_short_lines_have_empty_columns(spark):
    df = spark.createDataFrame([("a\tb",)], "line string").select(F.split("line", "\t").alias("cols"))
    assert df.select(token_column(1), token_column(5)).first()[:] == ("b", "")


def test_text_tokens_keep_paragraph_starts(spark):
    df = spark.createDataFrame([("a  b\n \nc d \n",), ("\n\nx",), ("",), (" ",)], "t string")
    got = [r[0] for r in df.select(text_tokens(F.col("t"))).collect()]
    assert got == [["a", "b", "\nc", "d"], ["\nx"], [], []]
