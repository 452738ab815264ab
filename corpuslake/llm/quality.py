"""Line-first cleaning: lines that fail a rule go, then documents that lose too much text are rejected."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpuslake.llm.common import BLANKS, let, lines_of, up_to, whole_text

#: White space between two words, and the characters that count as symbols.
_GAP, _SYMBOL = r"[\x20\x09-\x0D]+", r"[#*$%&|<>]"


@dataclass(frozen=True)
class LineRules:
    """The rules of a line, and how much text a document may lose to them.

    ``end``: a line of ``min_words`` or more must end in one of these. ``separators``: a line with ``max_separators`` or
    more of them is navigation. ``boilerplate``: a line that holds one of these phrases goes (A-Z in either case). ``max_symbols``: per word.
    """

    end: str = r"""[.!?…。:;,"'”’»)\]]$"""
    min_words: int = 4
    separators: str = r"[|›»•]"
    max_separators: int = 3
    boilerplate: str = (
        r"all rights reserved|cookie|javascript|terms of (use|service)|privacy policy|click here|sign up|log in"
        r"|licensed under|released under|permission is hereby granted|subscribe"
    )
    max_symbols: float = 0.1
    max_lost: float = 0.5


def _verdict(bare: Column, n_words: Column, n_symbols: Column, rules: LineRules) -> Column:
    return (
        F.when(bare == "", None)
        .when(F.regexp_count(bare, F.lit(rules.separators)) >= rules.max_separators, F.lit("navigation"))
        .when(bare.rlike(f"(?i){rules.boilerplate}"), F.lit("boilerplate"))
        .when(n_symbols > rules.max_symbols * n_words, F.lit("symbols"))
        .when((n_words >= rules.min_words) & ~bare.rlike(rules.end), F.lit("punctuation"))
    )


def cut_line(line: Column, rules: LineRules) -> Column:
    """A struct: line, words, n_symbols, and verdict: the rule the line fails (navigation, boilerplate, symbols, punctuation),
    or null. Blank lines have no words and fail none."""

    def of_words(bare, words, n_symbols):
        verdict = _verdict(bare, F.size(words), n_symbols, rules)
        return F.struct(line.alias("line"), words.alias("words"), n_symbols.alias("n_symbols"), verdict.alias("verdict"))

    def of_bare(bare):
        words = F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, _GAP))
        symbols = F.regexp_count(bare, F.lit(_SYMBOL))
        return let(words, lambda w: let(symbols, lambda n: of_words(bare, w, n)))

    return let(F.btrim(line, F.lit(BLANKS)), of_bare)


def line_verdict(line: Column, rules: LineRules) -> Column:
    return cut_line(line, rules)["verdict"]


def _repeat_words(words: Column) -> Column:
    """Words that stand in a three-word window found twice or more.

    Windows are hashed, with their place in the low bits, and sorted as plain numbers; equal ones are then neighbours.
    A hash keeps 64 bits less those of a place (about 54 for 500 words), so equal hashes of different windows are
    negligible: below 1e-6 for a text of 20,000 words.
    """
    n = F.size(words) - 2
    bits = F.length(F.bin(F.size(words)))

    def sorted_windows(b: Column) -> Column:
        def window(i):
            h = F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))
            return F.call_function("shiftleft", h, b).bitwiseOR(i.cast("bigint"))

        return F.sort_array(F.transform(up_to(n), window))

    def twice(s: Column, b: Column) -> Column:
        def same(x, y):
            return F.coalesce(F.call_function("shiftright", x.bitwiseXOR(y), b) == 0, F.lit(False))

        def place(x, i):
            hit = same(x, F.get(s, i - 1)) | same(x, F.get(s, i + 1))
            return F.when(hit, x.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("bigint"), b) - 1))

        return F.filter(F.transform(s, place), lambda p: p.isNotNull())

    def covered(p: Column) -> Column:
        return F.size(F.array_distinct(F.flatten(F.transform(p, lambda x: F.array(x, x + 1, x + 2)))))

    found = let(bits, lambda b: let(sorted_windows(b), lambda s: let(twice(s, b), covered)))
    return F.when(n >= 2, found).otherwise(F.lit(0)).cast("bigint")


def quality_report(text: Column, rules: LineRules = LineRules(), kept_text: bool = True) -> Column:
    """A struct: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, lost_words, kept and kept_text.

    Words are runs of anything but ASCII white space. The base fails below 50 words, or if over half the words stand in
    repeated three-word windows. ``kept`` is false if the base fails or if failing lines hold more than ``rules.max_lost``
    of all words. ``kept_text`` joins the lines that stay, if it is asked for. Null text is an empty one: all counts 0, base failed.

    Words and white space never cross a line's end, so each line is cut into its words once, and all counts come from them.
    """

    def of_words(lines, words):
        with_word = F.transform(F.filter(lines, lambda x: F.size(x["words"]) > 0), lambda x: x["line"])
        lost = F.filter(lines, lambda x: x["verdict"].isNotNull())
        stay = F.transform(F.filter(lines, lambda x: x["verdict"].isNull()), lambda x: x["line"])
        counts = F.struct(
            F.size(words).cast("bigint").alias("n_words"),
            F.length(F.array_join(words, "")).cast("bigint").alias("word_chars"),
            _total(lines, lambda x: x["n_symbols"]).alias("n_symbols"),
            let(with_word, lambda w: F.size(w) - F.size(F.array_distinct(w))).cast("bigint").alias("n_dup_lines"),
            _repeat_words(words).alias("n_repeat_words"),
            _total(lost, lambda x: F.size(x["words"])).alias("lost_words"),
        )

        def judged(c):
            failed = (c["n_words"] < 50) | (100 * c["n_repeat_words"] > 50 * c["n_words"])
            good = ~failed & (c["lost_words"] <= rules.max_lost * c["n_words"])
            names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lost_words"]
            text_too = [F.array_join(stay, "\n").alias("kept_text")] if kept_text else []
            return F.struct(*[c[x].alias(x) for x in names], failed.alias("base_failed"), good.alias("kept"), *text_too)

        return let(counts, judged)

    return let(
        F.transform(lines_of(whole_text(text)), lambda line: cut_line(line, rules)),
        lambda lines: let(F.flatten(F.transform(lines, lambda x: x["words"])), lambda words: of_words(lines, words)),
    )


def _total(rows: Column, value) -> Column:
    return F.aggregate(rows, F.lit(0).cast("bigint"), lambda acc, x: acc + value(x).cast("bigint"))
