"""Text units, errors and segments against the sequential model."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from sequential import run, sha1

from corpuslake import NgramSpec, SelfJoin, StructureSpec, VertColumn
from corpuslake.operators import structure as st
from corpuslake.plans.extraction import build
from corpuslake.sources.vertical import read_lines, struct_events
from corpuslake.stages import Stages


def vertical(tmp_path, *files):
    paths = []
    for i, lines in enumerate(files):
        path = tmp_path / f"part{i}.vert"
        path.write_text("".join(f"{line}\n" for line in lines), encoding="utf-8")
        paths.append(f"file:{path}")
    return paths


def extraction(spark, tmp_path, lines, spec, chunk_bits=20, **options):
    half = len(lines) // 2
    rows = read_lines(spark, vertical(tmp_path, lines[:half], lines[half:]), "c1", chunk_bits=chunk_bits)
    return build(rows, spec, Stages(spark), **options)


def unit_rows(made, spec):
    return sorted(map(repr, (tuple(r[c] for c in [*spec.names, "poscount"]) for r in made.units.collect())))


def overlapping(rng, n):
    lines, names = [], ["doc", "p", "s", "note"]
    for i in range(n):
        roll, name = rng.random(), rng.choice(names)
        if roll < 0.5:
            lines.append(f"w{rng.randrange(6)}\tl{rng.randrange(3)}")
        elif roll < 0.7:
            lines.append(f'<{name} id="{i}"' + (f' kind="k{rng.randrange(3)}"' if rng.random() < 0.6 else "") + ">")
        elif roll < 0.75:
            lines.append(f'<{name} id="{i}"/>')
        elif roll < 0.78:
            lines.append("")
        else:
            lines.append(f"</{name}>")
    return lines


def nested(rng, n):
    lines, stack = [], []
    for i in range(n):
        roll = rng.random()
        if roll < 0.5:
            lines.append(f"w{rng.randrange(6)}\tl{rng.randrange(3)}")
        elif roll < 0.72 and len(stack) < 6:
            stack.append(rng.choice(["doc", "p", "s"]))
            lines.append(f'<{stack[-1]} id="{i}"' + (f' kind="k{rng.randrange(3)}"' if rng.random() < 0.5 else "") + ">")
        elif roll < 0.76:
            lines.append(f'<{rng.choice(["doc", "p", "s"])} id="{i}"/>')
        elif stack:
            lines.append(f"</{stack.pop()}>")
    return lines + [f"</{name}>" for name in reversed(stack)]


STRUCTURES = {"doc": ["id", "kind"], "p": ["id", "kind"], "s": ["kind"]}


@pytest.mark.parametrize("seed, parent, chunk_bits", [(1, "doc", 4), (2, None, 7), (3, "s", 20)])
def test_overlapping_like_the_model(spark, tmp_path, seed, parent, chunk_bits):
    lines = overlapping(random.Random(seed), 600)
    spec = StructureSpec(STRUCTURES, "p", parent)
    ngrams = NgramSpec(2, [VertColumn(0)], arf=True)
    made = extraction(spark, tmp_path, lines, spec, chunk_bits, ngrams=ngrams)
    units, grams, arf, errors = run(lines, STRUCTURES, "p", parent)
    assert unit_rows(made, spec) == sorted(map(repr, units))
    assert made.errors.count() == errors
    got = {r["col0"]: (r["count"], r["arf"], r["hash_id"]) for r in made.frequencies.collect()}
    assert got == {g: (n, arf[g], sha1(g)) for g, n in grams.items()}


@pytest.mark.parametrize("seed, parent, chunk_bits", [(4, "doc", 4), (5, "s", 20)])
def test_nested_like_the_model(spark, tmp_path, seed, parent, chunk_bits):
    lines = nested(random.Random(seed), 500)
    spec = StructureSpec(STRUCTURES, "p", parent, nested=True)
    made = extraction(spark, tmp_path, lines, spec, chunk_bits, ngrams=NgramSpec(3, [VertColumn(1)]))
    units, grams, _, errors = run(lines, STRUCTURES, "p", parent, nested=True, size=3, column=1)
    assert errors == 0 and made.errors.count() == 0
    assert unit_rows(made, spec) == sorted(map(repr, units))
    assert {r["col1"]: r["count"] for r in made.frequencies.collect()} == dict(grams)


@pytest.mark.parametrize("seed, parent, chunk_bits", [(11, "doc", 3), (12, "s", 5), (13, None, 20)])
def test_malformed_nesting_like_the_model(spark, tmp_path, seed, parent, chunk_bits):
    rng = random.Random(seed)
    lines = overlapping(rng, 300) if seed == 12 else nested(rng, 400)
    for _ in range(25):
        k = rng.randrange(len(lines))
        lines[k : k + 1] = rng.choice([["</p>"], ["</doc>", lines[k]], [], ["</s>", "</s>"], [lines[k], '<p id="x">']])
    spec = StructureSpec(STRUCTURES, "p", parent, nested=True)
    made = extraction(spark, tmp_path, lines, spec, chunk_bits, ngrams=NgramSpec(2, [VertColumn(0)]))
    units, grams, _, errors = run(lines, STRUCTURES, "p", parent, nested=True)
    assert made.errors.count() == errors > 0
    assert unit_rows(made, spec) == sorted(map(repr, units))
    assert {r["col0"]: r["count"] for r in made.frequencies.collect()} == dict(grams)


def test_token_filter_like_the_model(spark, tmp_path):
    lines = overlapping(random.Random(6), 500)
    spec = StructureSpec(STRUCTURES, "p", "doc")
    accepted = (F.col("doc_kind") == "k1") | (F.get("cols", F.lit(0)) == "w2")
    made = extraction(
        spark, tmp_path, lines, spec, 5,
        token_filter=F.coalesce(accepted, F.lit(False)), filter_attrs=["doc_kind"],
        ngrams=NgramSpec(2, [VertColumn(0)], arf=True),
    )
    units, grams, arf, _ = run(
        lines, STRUCTURES, "p", "doc", accept=lambda cols, attrs: attrs.get("doc_kind") == "k1" or cols[0] == "w2"
    )
    assert unit_rows(made, spec) == sorted(map(repr, units))
    assert {r["col0"]: (r["count"], r["arf"]) for r in made.frequencies.collect()} == {
        g: (n, arf[g]) for g, n in grams.items()
    }


def messages(spark, tmp_path, lines, spec):
    rows = read_lines(spark, vertical(tmp_path, lines), "c1")
    found = st.structure_errors(struct_events(rows).withColumn("tok", F.lit(0)), spec)
    return [r["message"] for r in found.orderBy("pos").collect()]


def test_overlap_is_no_error_but_double_opening_is(spark, tmp_path):
    spec = StructureSpec({}, "p")
    assert messages(spark, tmp_path, ["<doc>", "<p>", "</doc>", "</p>"], spec) == []
    got = messages(spark, tmp_path, ['<p name="a">', '<p id="b">', "</p>", "</p>"], spec)
    assert got == [
        'open of <p id="b"> while still open: <p name="a">',
        "close of p, which is not open",
    ]


def test_wrong_nesting_is_an_error(spark, tmp_path):
    spec = StructureSpec({"doc": ["id"]}, "p", nested=True)
    got = messages(spark, tmp_path, ['<doc id="d">', "<p>", "</doc>", "</doc>"], spec)
    assert got[0] == "close of doc does not fit the innermost open element: <p>"
    # A close with nothing open is an error as well.
    assert messages(spark, tmp_path, ["</p>"], spec) == ["close of p does not fit the innermost open element: none"]


def test_outermost_value_counts_when_nested(spark, tmp_path):
    lines = ['<div k="outer">', '<div k="inner" x="1">', "<p>", "a", "</p>", "</div>", "</div>"]
    spec = StructureSpec({"div": ["k", "x"]}, "p", nested=True)
    (row,) = extraction(spark, tmp_path, lines, spec).units.collect()
    assert (row["div_k"], row["div_x"], row["poscount"], row["wordcount"]) == ("outer", "1", 1, 0)


def test_units_options(spark, tmp_path):
    # Atoms inside each other: the outer close finds its attributes taken, but keeps the corpus.
    lines = ['<p id="1">', "a", '<p id="2">', "b", "</p>", "c", "</p>"]
    spec = StructureSpec({"p": ["id"]}, "p", nested=True)
    rows = extraction(spark, tmp_path, lines, spec).units.collect()
    assert sorted(((r["p_id"], r["poscount"], r["corpus_id"]) for r in rows), key=str) == [
        ("1", 1, "c1"), (None, 2, "c1")
    ]
    assert extraction(spark, tmp_path, lines, spec, keep_bare=False).units.count() == 1


def test_parent_tokens_by_scope(spark, tmp_path):
    lines = ["<doc>", "<p>", "a", "b", "</p>", "</doc>", "<doc>", "c", "</doc>"]
    spec = StructureSpec({}, "p", "doc")
    counts = lambda **o: sorted(r["poscount"] for r in extraction(spark, tmp_path, lines, spec, **o).units.collect())
    assert counts() == [2, 3]
    assert counts(poscount_scope="row") == [1, 2]


def test_item_ids(spark, tmp_path):
    lines = ['<doc id="en1">', '<p id="7">', "a", "</p>", "<p>", "b", "</p>", "</doc>"]
    spec = StructureSpec({"doc": ["id"], "p": ["id"]}, "p")
    made = extraction(spark, tmp_path, lines, spec, join=SelfJoin("identity", ["doc_id", "p_id"]))
    assert sorted(str(r["item_id"]) for r in made.units.collect()) == ["None", "en1_7"]
    assert made.errors.count() == 1
    made = extraction(spark, tmp_path, lines, spec, join=SelfJoin("intercorp", ["doc_id"]))
    assert {r["item_id"] for r in made.units.collect()} == {"1"}


def test_width_errors(spark, tmp_path):
    from corpuslake.sources.vertical import token_lines

    rows = read_lines(spark, vertical(tmp_path, ["a\tb", "<p>", "c", "d\te"]), "c1")
    assert [r["message"] for r in st.width_errors(token_lines(rows)).collect()] == ["expected columns: 2, found: 1"]


def test_error_budget(spark):
    errors = spark.createDataFrame([("c", "x"), ("c", "y")], "corpus_id string, message string")
    assert st.check_errors(errors, 2) == 2
    with pytest.raises(st.TooManyErrors):
        st.check_errors(errors, 1)


def test_budget_ends_a_job_early(spark, tmp_path):
    """Errors of a chunk are counted when it is matched; coarser rounds, units and n-grams aren't reached."""
    # The first error lies in one chunk, the second in an element that is open over many.
    lines = ["<doc>", "<p>", "</s>", "</p>", *["w"] * 40, "<p>", *["w"] * 40, "</doc>", "</p>", "</doc>"]
    spec = StructureSpec({"doc": ["id"]}, "p", nested=True)
    def attempt(most):
        rows = read_lines(spark, vertical(tmp_path, lines), "c1", chunk_bits=4)
        events = struct_events(rows).withColumn("tok", F.lit(0))
        budget = st.Budget(Stages(spark).keep, most)
        try:
            st.resolve(events, spec, keep=budget)
        except st.TooManyErrors as e:
            assert e.found == budget.found > most
        return budget.found, budget.rounds

    found, rounds = attempt(2)
    assert found == 2 and rounds > 1
    assert attempt(0) == (1, 1)
    assert attempt(1) == (2, 2)
    with pytest.raises(st.TooManyErrors):
        extraction(spark, tmp_path, lines, StructureSpec({"doc": ["id"]}, "p"), max_errors=0)


@pytest.mark.parametrize("seed", [21, 22])
def test_elements_closed_files_later_like_the_model(spark, tmp_path, seed):
    """Elements left open, stray closes and closes of another name, over files that are chunks of the last round."""
    rng = random.Random(seed)
    lines = [rng.choice(["<doc>", "<doc>", "<p>", "</doc>", "</p>", "</doc>", "w"]) for _ in range(240)]
    spec = StructureSpec({"doc": ["id"], "p": ["id"]}, "p", "doc", nested=True)
    rows = read_lines(spark, vertical(tmp_path, *[lines[k : k + 24] for k in range(0, 240, 24)]), "c1", chunk_bits=3)
    made = build(rows, spec, Stages(spark))
    units, _, _, errors = run(lines, {"doc": ["id"], "p": ["id"]}, "p", "doc", nested=True)
    assert made.errors.count() == errors > 0
    assert unit_rows(made, spec) == sorted(map(repr, units))


def test_what_the_last_round_of_matching_reads(spark):
    """An element left open in every chunk: only those that later closes can meet are matched again."""
    opens = [("c", k, "open", k) for k in range(50)]
    schema = "corpus_id string, span int, kind string, __pos int"

    def left(rows):
        df = spark.createDataFrame(rows, schema)
        return sorted((r.span, r.kind) for r in st._far_apart(df, ["corpus_id"], "span").collect())

    assert left(opens) == []
    assert left([("c", -1, "close", -1), *opens]) == []
    assert left([*opens, ("c", 50, "close", 50)]) == [(49, "open"), (50, "close")]
    # Two closes after chunk 9, of which the opens of chunks 10 and on are out of reach.
    mixed = [*opens[:10], ("c", 10, "close", 100), ("c", 10, "close", 101), ("c", 10, "open", 102), *opens[20:]]
    assert left(mixed) == [(8, "open"), (9, "open"), (10, "close"), (10, "close")]


@pytest.mark.parametrize("size", [1, 2, 3, 7, 64])
def test_chunks_over_several_batches(size):
    rng = random.Random(5)
    rows = [{"c": k // 5 if k < 40 else 8, "kind": rng.choice(["open", "close"]), "name": rng.choice("ab"), "attrs": None, "__pos": k} for k in range(60)]
    table = pa.Table.from_pylist(rows, pa.schema([("c", pa.int64()), ("kind", pa.string()), ("name", pa.string()), ("attrs", pa.string()), ("__pos", pa.int64())]))

    def through(batches):
        return pa.Table.from_batches(list(st._matched(["c"])(iter(batches)))).to_pylist()

    assert through(table.to_batches(max_chunksize=size)) == through([table.combine_chunks().to_batches()[0]])
