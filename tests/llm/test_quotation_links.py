import random

from corpuslake.llm import quotation_links as ql
from corpuslake.stages import Stages

TURNS = "conv_id long, turn long, role string, text string"


def mail(own, *quoted):
    """Own text and then (level, text) passages."""
    return "\n".join([own, "", *["> " * d + line for d, t in quoted for line in t.split("\n")]])


def test_threads_of_answers(spark):
    a, b, c, d = "The first question, of some length", "A first answer to that\nover two lines", "Another answer entirely", "A late remark on it all"
    rows = [
        (1, 0, "x", a), (1, 1, "y", mail(b, (1, a))), (1, 2, "z", mail(c, (1, a.upper()))),
        (1, 3, "x", "On Monday y wrote:\n" + mail("", (1, "A  first answer to that over two lines"), (2, a)) + "\n" + d),
        (1, 4, "w", mail("unrelated text of a new thread", (1, "a passage that nobody has written"))),
        (1, 5, "v", mail("deep", (2, d))), (2, 0, "x", mail("other conversation here", (1, a))),
        (2, 7, "y", ">> > >"), (3, 0, "x", None), (3, 1, "x", ""), (None, 0, "x", mail("nothing to link", (1, a))), (1, None, "x", mail("q", (1, a))),
    ]
    got = ql.link_quotations(spark.createDataFrame(rows, TURNS), Stages(spark)).collect()
    found = {(r.scope, r.message): (r.reply_to, r.thread, r.level) for r in got}
    assert len(got) == len(rows)
    assert {k: v for k, v in found.items() if v[0] is not None} == {
        (1, 1): (0, 0, 1), (1, 2): (0, 0, 1), (1, 3): (1, 0, 2), (1, 5): (3, 0, 3),
    }
    text = {(r.scope, r.message): r.text for r in got}
    assert text[1, 1] == b and text[1, 3] == d and text[2, 7] == "" and text[3, 0] == ""
    order = [(r.scope, r.message) for r in got if r.scope == 1 and r.message is not None]
    assert order == [(1, 0), (1, 1), (1, 2), (1, 3), (1, 5), (1, 4)]


def test_long_chains_and_repeats(spark):
    rows = [(1, k, "r", mail(f"message number {k} of a long chain", *([(1, f"message number {k - 1} of a long chain")] if k else []))) for k in range(40)]
    rows += [rows[5], (1, 99, "r", mail("q", (1, "message number 3 of a long chain")))]
    df = spark.createDataFrame([(*r, 1) for r in rows], TURNS + ", level int")
    got = {(r.message): (r.reply_to, r.thread, r.level) for r in ql.link_quotations(df, Stages(spark)).collect()}
    assert got[0] == (None, 0, 0) and got[99] == (3, 0, 4)
    assert all(got[k] == (k - 1, 0, k) for k in range(1, 40))
    assert ql.link_quotations(df.limit(0), Stages(spark)).collect() == []


def test_turns_as_mail_come_back(spark):
    rows = [(c, t, "user", f"turn {t} of conversation {c}\nwith a second line {t * c}") for c in range(3) for t in range(5)]
    out = ql.link_quotations(ql.as_mail(spark.createDataFrame(rows, TURNS)), Stages(spark)).collect()
    said = {(c, t): x for c, t, _, x in rows}
    for r in out:
        assert r.text == said[r.scope, r.message]
        assert r.reply_to == (r.message - 1 if r.message else None) and r.level == r.message


def test_short_messages(spark):
    rows = [(1, 0, "x", "A first message of some length."), (1, 1, "y", "Yes."),
            (1, 2, "x", mail("And then?", (1, "Yes."), (2, "A first message of some length."))),
            (2, 0, "x", "It is noon."), (2, 1, "y", mail("So it is.", (1, "it is  NOON."))), (2, 2, "x", "Yes."), (2, 3, "y", "Yes."),
            (2, 4, "x", mail("Well, well.", (1, "Yes."))), (2, 5, "x", mail("No.", (1, "Well"))),
            (3, 0, "x", "x" * 300), (3, 1, "y", "z" * 5000 + " wrote:\n> " + "x" * 300 + "\nindeed")]
    got = {(r.scope, r.message): r for r in ql.link_quotations(spark.createDataFrame(rows, TURNS), Stages(spark)).collect()}
    assert {k: r.reply_to for k, r in got.items() if r.reply_to is not None} == {(1, 2): 1, (2, 1): 0, (2, 4): 3, (3, 1): 0}
    assert got[3, 1].text == "indeed"


def brute(rows):
    """reply_to of each message, from its paragraphs and lines as they are."""

    def plain(t):
        return " ".join(t.lower().split())

    def units(lines, quoted):
        runs, run = [], []
        for x in [*lines, ""]:
            if x.strip():
                run.append(x)
            elif run:
                runs.append(run)
                run = []
        out = {plain(" ".join(r)) for r in runs if quoted or len(plain(" ".join(r))) >= 12}
        return out | {plain(x) for r in runs for x in r if len(r) > 1 and len(plain(x)) >= 12}

    own, quotes = {}, {}
    for c, m, _, text in rows:
        split = [ql.level(x) for x in text.split("\n")]
        mine = [x for d, x in split if d == 0]
        own[c, m] = units(mine, False) | ({plain(" ".join(mine))} - {""})
        for d in {d for d, _ in split if d}:
            quotes.setdefault((c, m), {})[d] = units([x if e == d else "" for e, x in split], True)
    out = {}
    for (c, m), by_level in quotes.items():
        for d in sorted(by_level):
            found = [max((o for k, o in own if k == c and o < m and u in own[k, o]), default=None) for u in by_level[d]]
            found = [f for f in found if f is not None]
            if found:
                out[c, m] = max((found.count(f), f) for f in found)[1]
                break
    return out


def test_random_mail_equals_brute_force(spark):
    rng = random.Random(8)
    phrases = ["Yes.", "No", "It is noon.", "A sentence that is long enough", "Another one, of some length", "a third, longer sentence here", "x"]
    rows = []
    for c in range(6):
        said = {}
        for m in range(40):
            k = 1000 * m + c  # several blocks
            said[k] = [rng.choice(phrases) + rng.choice(["", "", f" {rng.randrange(4)}"]) for _ in range(rng.randint(1, 3))]
            text = rng.choice(["\n", "\n\n"]).join(said[k])
            for d in (1, 2):
                if m and rng.random() < 0.6:
                    quoted = rng.choice(list(said.values()))
                    text += "\n\n" + "\n".join("> " * d + x for x in quoted[: rng.randint(1, 3)])
            rows.append((c, k, "x", text))
    got = ql.link_quotations(spark.createDataFrame(rows, TURNS), Stages(spark)).collect()
    want = brute(rows)
    assert {(r.scope, r.message): r.reply_to for r in got if r.reply_to is not None} == want and len(want) > 100


def test_levels():
    assert ql.level("> > a") == (2, "a") and ql.level(">>b") == (2, "b") and ql.level("a > b") == (0, "a > b")
    assert ql.level("  > c") == (1, "c")
