import collections
import random

import public_tokenizers
from test_simhash_vptree import brute_components, brute_print
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline as cp
from corpuslake.llm import secrets, toxicity
from corpuslake.stages import Stages

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def documents():
    rng = random.Random(12)
    words = [a + b + c for a in ("ba", "do", "ki", "lu", "me") for b in ("r", "st", "nd", "ft") for c in ("o", "an", "el", "us", "ix")]

    def prose(n):
        return " ".join(rng.choice(words) for _ in range(n))

    rows = [(i, "\n".join(prose(rng.randrange(20, 60)) + "." for _ in range(4))) for i in range(240)]
    labels = []
    for i in range(0, 240, 4):
        rows[i] = (i, rows[i][1].replace(" ", f" {rng.choice(['snark', 'grumph'])} ", 3))
    labels = [(i, int(i % 4 == 0)) for i in range(240)]
    licence = "This line stands in a great many documents of the corpus."
    for i in range(1, 240, 6):
        rows[i] = (i, rows[i][1] + "\n" + licence)
    near, exact = {}, {}
    for k, i in enumerate(i for i in range(1, 200, 10) if i % 4):
        if k % 2:
            near[1000 + i] = i
            rows.append((1000 + i, rows[i][1].replace(" ", " other ", 2)))
        else:
            exact[1000 + i] = i
            rows.append((1000 + i, rows[i][1]))
    rows += [(2000, "a short text\npassword = 'hunter22hunter'"), (2001, None), (2002, ""), (2003, "x")]
    return [(i, t, "en", "s", len(t or "")) for i, t in rows], labels, licence, near, exact


def test_stages_do_what_they_say(spark, tmp_path):
    rows, labels, licence, near, exact = documents()
    folder = str(tmp_path / "data")
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    docs, seen, stages = spark.read.parquet(f"{folder}/documents.parquet"), [], Stages(spark)
    for name, stage in cp.STAGES:
        before = docs
        docs = stages.keep(stage(spark, docs, folder))
        seen.append({r.doc_id: r.text for r in docs.collect()} if name != "packing" else docs)
        if name != "packing":
            assert docs.columns == before.columns and dict(docs.dtypes) == dict(before.dtypes)
            assert [r for r in docs.collect() if name != "toxicity" and r.n_chars != len(r.text or "")] == []
    mild, lines, single, hidden, pieces = seen
    given = {i: t for i, t, *_ in rows}

    toxic = {i for i, t in given.items() if any(w in (t or "").split() for w in ("snark", "grumph"))}
    assert set(given) - set(mild) == toxic

    assert sum(licence in (t or "") for t in lines.values()) == 1
    assert set(lines) == set(mild)

    still = {c: o for c, o in exact.items() if o in lines and lines[c] == lines[o]}
    assert len(still) > 5 and not set(still) & set(single) and set(still.values()) <= set(single)
    prints = {i: brute_print(t) for i, t in lines.items()}
    groups = brute_components(sorted(lines), lambda a, b: (prints[sorted(lines)[a]] ^ prints[sorted(lines)[b]]).bit_count() <= 4)
    assert set(single) == set(groups.values())
    assert set(lines) - set(single) <= {*near, *exact, 2002}

    assert hidden[2000] == "a short text\n[SECRET]'"
    assert {i: t for i, t in hidden.items() if i != 2000} == {i: t for i, t in single.items() if i != 2000}

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    total = collections.Counter()
    for r in pieces.collect():
        total[r.doc_id] += r.length
    assert total == {i: len(tok.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in hidden.items()}

    def place(r):
        return (r.doc_id, r.start, r.length, r.ids_crc32)

    whole = [place(r) for r in cp.run(spark, folder).collect()]
    assert sum(n for _, _, n, _ in whole) == sum(total.values())


def test_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
    assert len(cp.STAGES) == 5 and secrets.KINDS[3] == "entropy" and toxicity.Model


def test_empty_documents(spark, tmp_path):
    folder = str(tmp_path / "none")
    spark.createDataFrame([], COLUMNS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    assert cp.run(spark, folder).collect() == []
