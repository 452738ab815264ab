import random
import re

from pyspark.sql import functions as F

from corpuslake.llm import quality as qu

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text, rules=qu.LineRules()):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    twice = {i for i, w in enumerate(windows) if windows.count(w) > 1}
    repeat = len({i + k for i in twice for k in range(3)})
    lines = [x for x in text.split("\n") if WORD.search(x)]
    lost = 0
    for line in lines:
        bare, n = line.strip(" \t\n\x0b\x0c\r"), len(WORD.findall(line))
        bad = (
            len(re.findall(rules.separators, bare)) >= rules.max_separators
            or re.search(rules.boilerplate, bare.lower() if bare.isascii() else bare)
            or len(re.findall(r"[#*$%&|<>]", bare)) > rules.max_symbols * n
            or (n >= rules.min_words and not re.search(rules.end, bare))
        )
        lost += n if bad else 0
    failed = len(words) < 50 or 100 * repeat > 50 * len(words)
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), repeat, failed, lost,
        not failed and lost <= rules.max_lost * len(words),
    )


def test_equals_brute_force(spark):
    rng = random.Random(8)
    words = ["the", "of", "and", "été", "a#", "b|", "x.", "日本", "c\x1cd", "all rights reserved", "Home | About | Us | Help"]
    texts = [None, "", " \t\n", "one", "a b", "a b c", "a a a a a", "x " * 60, "a.\n" * 60, "w" * 100_000]
    for n in (10, 49, 50, 51, 120, 400, 900):
        for k in (3, 40, 4000):
            pool = words + [f"w{i}" for i in range(k)]
            texts.append("".join(rng.choice(pool) + rng.choice([" ", " ", " ", ".\n", "\n", "\t ", "\r\n", " \x0b"]) for _ in range(n)))
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "lost_words", "kept"]
    got = {r.id: tuple(r.r[n] for n in names) for r in df.select("id", qu.quality_report(F.col("text")).alias("r")).collect()}
    for i, t in enumerate(texts):
        assert got[i] == brute(t), (i, (t or "")[:100])


def test_clean_prose_stays_and_navigation_goes(spark):
    rng = random.Random(1)
    prose = "\n".join(" ".join(f"w{rng.randrange(999)}" for _ in range(14)) + "." for _ in range(9))
    menu = "\n".join(["Home | News | Sport | Weather | Shop"] * 40)
    df = spark.createDataFrame([(1, prose), (2, menu + "\n" + prose), (3, prose + "\nClick here to log in")], "id int, text string")
    rows = {r.id: r.r for r in df.select("id", qu.quality_report(F.col("text")).alias("r")).collect()}
    assert rows[1].kept and rows[1].kept_text == prose
    assert not rows[2].kept
    assert rows[3].kept and rows[3].kept_text == prose
