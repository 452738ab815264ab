import collections
import random

from corpuslake.llm.line_dedup import dedup_lines
from corpuslake.stages import Stages

BLANKS = " \t\n\x0b\x0c\r"


def brute(rows, min_chars=20, min_docs=3):
    def key(line):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(BLANKS))

    holders = collections.defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        lost = [
            len(ids := holders.get(key(x), set()) - {None}) >= min_docs and i != max(ids) for x in lines
        ]
        kept = "\n".join(x for x, gone in zip(lines, lost, strict=True) if not gone)
        out.append((str(i), kept, len(lines), sum(lost)))
    return sorted(out)


def test_equals_brute_force(spark):
    rng = random.Random(2)
    shared = [f"{c} shared line number {k} of the corpus" for k, c in enumerate("ABCDéßÄ ")] + ["short", "", " \t"]
    rows = []
    for i in range(60):
        lines = [rng.choice(shared) for _ in range(rng.randrange(6))] + [f"own line {i} {rng.random()}"]
        lines = [rng.choice([x, x.upper(), f" {x}\t\r", x.lower()]) for x in lines]
        rng.shuffle(lines)
        rows.append((i, "\n".join(lines)))
    rows += [(70, None), (71, ""), (72, "\n\n"), (None, shared[0] + "\nx"), (5, rows[5][1]), (5, shared[1]), (80, "y" * 200_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(str(r.row.doc_id), r.kept_text, r.n_lines, r.n_dropped) for r in dedup_lines(df, Stages(spark)).collect()]
    assert sorted(got) == brute(rows)
    assert sum(r[3] for r in got) > 20


def test_many_lines_and_clashing_columns(spark):
    text = "\n".join(f"a line that every document has, {i}" for i in range(3000))
    df = spark.createDataFrame([(i, text, 7, "k") for i in range(4)], "doc_id long, text string, n_lines int, lost string")
    got = {r.row.doc_id: r for r in dedup_lines(df, Stages(spark)).collect()}
    assert [got[i].n_dropped for i in range(4)] == [3000, 3000, 3000, 0]
    assert got[3].kept_text == text and got[0].kept_text == "" and got[0].row.n_lines == 7
    assert dedup_lines(df.limit(0), Stages(spark)).collect() == []
