import subprocess
import sys
from pathlib import Path

import pytest
from test_jobs import JOIN, SPEC, target, write

from corpuslake import NgramSpec, VertColumn
from corpuslake.plans import corpora as cp
from corpuslake.plans.catalog import QUERIES
from corpuslake.plans.extraction import extract
from corpuslake.sinks import snapshots
from corpuslake.sinks import tables as sink

COUNTS = NgramSpec(1, [VertColumn(0, "toLower")])
REPO = Path(__file__).parent.parent


def stored(spark, out):
    units = sorted((r.corpus_id, r.doc_id, r.poscount) for r in sink.read(spark, out, out.units).collect())
    counts = {(r.corpus_id, r.col0): r["count"] for r in sink.read(spark, out, out.frequencies).collect()}
    return units, counts


def test_the_same_input_again(spark, tmp_path):
    en, cs = target(tmp_path, "en"), target(tmp_path, "cs")
    a = write(tmp_path / "a", ("en1", "2020-01-05", "the cat"), ("en2", "2021-01-05", "the dog"))
    b = write(tmp_path / "b", ("cs1", "2021-02-01", "pes"))
    extract(spark, en, SPEC, file=a, ngrams=COUNTS)
    extract(spark, cs, SPEC, file=b, append=True, ngrams=COUNTS)
    once = stored(spark, en)
    with pytest.raises(sink.Repeated):
        extract(spark, cs, SPEC, file=b, append=True, ngrams=COUNTS)
    assert stored(spark, en) == once
    extract(spark, cs, SPEC, file=b, append=True, ngrams=COUNTS, repeat="replace")
    assert stored(spark, en) == once
    # Another input of the same corpus: units are added, counts added up, and each n-gram stays one row.
    more = write(tmp_path / "c", ("en3", "2022-01-05", "the the bird"))
    extract(spark, en, SPEC, file=more, append=True, ngrams=COUNTS)
    units, counts = stored(spark, en)
    assert [u for u in units if u[0] == "en"] == [("en", "en1", 2), ("en", "en2", 2), ("en", "en3", 3)]
    assert counts == {("en", "the"): 4, ("en", "cat"): 1, ("en", "dog"): 1, ("en", "bird"): 1, ("cs", "pes"): 1}
    assert sink.read(spark, en, en.frequencies).count() == len(counts)
    with pytest.raises(ValueError, match="ARF"):
        extract(spark, cs, SPEC, file=a, append=True, ngrams=NgramSpec(1, [VertColumn(0, "toLower")], arf=True))
    assert stored(spark, en) == (units, counts)


def frequencies(spark, out):
    return sorted((r.corpus_id, r.col0, r["count"], r.arf, r.hash_id) for r in sink.read(spark, out, out.frequencies).collect())


def test_arf_of_a_corpus_that_grows(spark, tmp_path):
    """Parts that are appended give the counts and ARF of one job over all files, also for a corpus that is replaced."""
    en, cs = target(tmp_path, "en"), target(tmp_path, "cs")
    one = sink.Target(f"file:{tmp_path}/one", "en", group="aligned")
    grams = NgramSpec(2, [VertColumn(0, "toLower")], arf=True)
    a = write(tmp_path / "a", ("1", "2020-01-05", "the cat the cat the dog"), ("2", "2021-01-05", "the cat"))
    b = write(tmp_path / "b", ("3", "2021-02-01", "a the cat a the dog the cat"))
    c = write(tmp_path / "c", ("4", "2021-02-01", "the dog the dog the dog"), ("5", "2021-02-01", "one"))
    extract(spark, one, SPEC, files=[a, b, c], ngrams=grams)
    extract(spark, en, SPEC, file=a, ngrams=grams)
    extract(spark, cs, SPEC, file=c, append=True, ngrams=grams)
    other = [r for r in frequencies(spark, cs) if r[0] == "cs"]
    for file in (b, c):
        extract(spark, en, SPEC, file=file, append=True, ngrams=grams)
    whole = frequencies(spark, one)
    assert frequencies(spark, en) == sorted(whole + other) and any(r[3] not in (1.0, r[2]) for r in whole)
    # Counts without an ARF don't mix with these, and nothing is stored then.
    with pytest.raises(ValueError, match="ARF"):
        extract(spark, en, SPEC, file=write(tmp_path / "d", ("6", "2020-01-05", "x y")), append=True, ngrams=NgramSpec(2, [VertColumn(0, "toLower")]))
    assert frequencies(spark, en) == sorted(whole + other)
    # A corpus replaced by one of its inputs begins anew.
    extract(spark, en, SPEC, file=c, append=True, ngrams=grams, repeat="replace")
    assert frequencies(spark, en) == sorted([("en", *r[1:]) for r in other] + other)
    # A create without n-grams leaves no gaps to go on from.
    extract(spark, en, SPEC, file=a)
    assert not sink.snapshot(spark, en).of_any(sink.COUNTED)


def test_create_clears_both_tables(spark, tmp_path):
    en = target(tmp_path, "en")
    a = write(tmp_path / "a", ("en1", "2020-01-05", "the cat"))
    extract(spark, en, SPEC, file=a, ngrams=COUNTS)
    extract(spark, en, SPEC, file=a)
    with pytest.raises(FileNotFoundError):
        sink.read(spark, en, en.frequencies)
    assert sink.read(spark, en, en.units).count() == 1


def test_a_job_that_dies_between_two_writes_changes_nothing(spark, tmp_path, monkeypatch):
    en, cs = target(tmp_path, "en"), target(tmp_path, "cs")
    a = write(tmp_path / "a", ("en1", "2020-01-05", "the cat"))
    b = write(tmp_path / "b", ("cs1", "2021-02-01", "pes"))
    extract(spark, en, SPEC, file=a, ngrams=COUNTS)
    before, once = sink.snapshot(spark, en), stored(spark, en)

    def dies(*args, **kwargs):
        raise RuntimeError("lost")

    for step in ("frequency_parts", "merged_frequencies"):
        with monkeypatch.context() as m, pytest.raises(RuntimeError):
            m.setattr(sink, step, dies)
            extract(spark, cs, SPEC, file=b, append=True, ngrams=COUNTS, date_attr="doc_date", remove_before="2021-01-01")
    with monkeypatch.context() as m, pytest.raises(RuntimeError):
        m.setattr(snapshots, "publish", dies)
        extract(spark, en, SPEC, file=b)
    assert sink.snapshot(spark, en) == before and stored(spark, en) == once
    # What such jobs leave is removed by hand.
    assert sink.vacuum(spark, en) >= 3 and stored(spark, en) == once


def test_two_jobs_at_once(spark, tmp_path):
    en = target(tmp_path, "en")
    extract(spark, en, SPEC, file=write(tmp_path / "a", ("en1", "2020-01-05", "the cat")), join=JOIN)
    old = sink.snapshot(spark, en)
    extract(spark, en, SPEC, file=write(tmp_path / "b", ("en2", "2020-01-05", "dog")), append=True, join=JOIN)
    with pytest.raises(snapshots.ChangedMeanwhile):
        snapshots.publish(spark, en.log, old.with_parts())
    assert sink.read(spark, en, en.units).count() == 2
    assert sink.read(spark, en, en.units, old).count() == 1


def test_corpora_without_a_name(spark, tmp_path):
    rows = [(200 + k, "a b\nc", None if k % 3 == 0 else "xx" if k % 3 == 1 else "en", None if k == 4 else "s", 3) for k in range(9)]
    folder = f"{tmp_path}/data"
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    corpora = {"", "en", "xx"}
    assert {r[0] for r in cp.documents(spark, folder).select("corpus_id").distinct().collect()} == corpora
    for name in ("sink_units", "sink_units_all", "sink_frequencies", "sink_frequencies_all", "vertical_files_scan", "liveattrs_atoms"):
        found = QUERIES[name](spark, folder)
        assert {r[0] for r in found.select("corpus_id").distinct().collect()} == corpora, name
    counts = {(r.corpus_id, r.col0): r["count"] for r in QUERIES["sink_frequencies_all"](spark, folder).collect()}
    assert counts == {(c, w): 3 for c in corpora for w in "abc"}


def test_entry_without_the_training_data_operators(tmp_path):
    """A copy without the folders of these operators imports, and has all other queries."""
    for file in [REPO / "__spark_entry__.py", *(f for f in (REPO / "corpuslake").rglob("*.py") if "llm" not in f.parts)]:
        copy = tmp_path / file.relative_to(REPO)
        copy.parent.mkdir(parents=True, exist_ok=True)
        copy.write_bytes(file.read_bytes())
    if (REPO / "corpus_pipeline.py").exists():
        (tmp_path / "corpus_pipeline.py").write_bytes((REPO / "corpus_pipeline.py").read_bytes())
    code = "import __spark_entry__ as e; print(len(e.queries()), any(q.startswith('op') or q == 'pipeline' for q in e.queries()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)}, capture_output=True, text=True, timeout=120)
    assert done.stdout.split() == [str(len(QUERIES)), "False"], done.stderr
