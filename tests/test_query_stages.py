"""What queries store on their way, on documents made here."""

import pytest

from corpuslake.plans import catalog


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("docs")
    docs = [(k, f"Ab c ab.\nc c d{k}\n\nab c.", ["en", "de", None][k % 3], f"src{k % 4}") for k in range(12)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").write.parquet(f"{at}/documents.parquet")
    return str(at)


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString().splitlines()


def test_lines_are_counted_before_they_are_parsed(spark, folder):
    counts = catalog.QUERIES["vertical_lines_parse"](spark, folder)
    plan = plan_of(counts)
    below = plan[max(k for k, line in enumerate(plan) if "Aggregate" in line) + 1 :]
    assert below and not any("RLIKE" in line for line in below if "Filter" in line)
    found = {tuple(r)[:2]: r["n"] for r in counts.collect()}
    assert found["en", "c"] == 12 and found["", "d2"] == 1 and sum(found.values()) == 12 * 8


@pytest.mark.parametrize("name, grams", [("segment_ngrams", {("en", "Ab c"): 4, ("en", "ab. c"): 0}), ("subcorpus_filter", {("de", "ab c ab."): 2})])
def test_tokens_in_order_are_stored(spark, folder, name, grams):
    """The order of the tokens is not made again in the plan that counts their n-grams."""
    counts = catalog.QUERIES[name](spark, folder)
    assert not any("__end" in line or "Join" in line for line in plan_of(counts))
    found = {(r["corpus_id"], r["col0"]): r["count"] for r in counts.collect()}
    assert {k: found.get(k, 0) for k in grams} == grams


def test_wide_charsets_are_packed(spark, folder, monkeypatch):
    paths, read = [], catalog.read_lines
    monkeypatch.setattr(catalog, "read_lines", lambda spark, found, *args: paths.extend(found) or read(spark, found, *args))
    rows = catalog.QUERIES["vertical_charsets_scan"](spark, folder)
    want = catalog.QUERIES["vertical_lines_parse"](spark, folder)
    assert sorted(map(repr, rows.collect())) == sorted(map(repr, want.collect()))
    assert paths and all(p.endswith(".gz") for p in paths)
