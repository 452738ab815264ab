"""Secrets in texts: fixed patterns, and candidate strings in which some window has a high Shannon entropy."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpuslake.llm.common import let, running, up_to, whole_text


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


#: Fixed values.
_NAMES = ["password", "passwd", "secret", "token", "api_?key"]
ASSIGN = f"""({"|".join(map(_either_case, _NAMES))})["']?\\x20*[:=]\\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "entropy")

ALPHABET = "0123456789abcdefABCDEFghijklmnopqrstuvwxyzGHIJKLMNOPQRSTUVWXYZ+/_-"
_HEX_CODES = 22
_SCALE = 1_000_000


@dataclass(frozen=True)
class EntropyRules:
    """A candidate is a run of at least ``window`` characters of ALPHABET. Its windows of that length have the class hex if all
    characters are hexadecimal digits, else base64; bits per character from ``hex_bits`` or ``base64_bits`` on make it a secret.
    A candidate that matches a pattern of ``allow`` whole is none."""

    window: int = 20
    hex_bits: float = 2.9
    base64_bits: float = 3.7
    allow: tuple[str, ...] = (
        r"[0-9+/_-]*",  # figures
        r"[A-Za-z+/_-]*",  # words
        r"[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}",  # record ids
        r".*EXAMPLE.*",  # keys of manuals
        r"[+/_-]*([A-Za-z]+[0-9]{0,4}[+/_-]+)+[A-Za-z]*[0-9]{0,4}",  # paths and names of words
    )

    def candidates(self) -> str:
        return f"[A-Za-z0-9+/_-]{{{self.window},}}"

    def least(self, bits: float) -> int:
        """Entropy is log2(w) - sum(c log2 c) / w, so the scaled sum of c log2 c may be this at most."""
        return math.floor((math.log2(self.window) - bits) * self.window * _SCALE)


def weights(window: int) -> list[int]:
    """c log2 c for c from 0 on, in millionths: whole numbers, so that sums don't depend on their order."""
    return [round(c * math.log2(c) * _SCALE) if c else 0 for c in range(window + 2)]


def high_entropy(candidate: Column, rules: EntropyRules) -> Column:
    """Whether some window of the candidate has enough entropy for its class.

    The window moves by one character: the counts of the one that enters and the one that leaves change, and with them
    the sum of c log2 c; nothing is counted anew.
    """
    w = rules.window
    table = F.array(*[F.lit(x).cast("bigint") for x in weights(w)])

    def moved(acc, code, step):
        count = F.element_at(acc["counts"], code)
        return F.struct(
            F.transform(acc["counts"], lambda v, k: v + F.when(k == code - 1, step).otherwise(0)).alias("counts"),
            (acc["sum"] + F.get(table, count + step) - F.get(table, count)).alias("sum"),
            (acc["other"] + F.when(code > _HEX_CODES, step).otherwise(0)).alias("other"),
            acc["hit"].alias("hit"),
        )

    def step(codes):
        def go(acc, i):
            entered = moved(acc, F.get(codes, i), F.lit(1))
            left = let(entered, lambda a: F.when(i >= w, moved(a, F.get(codes, i - w), F.lit(-1))).otherwise(a))
            most = lambda a: F.when(a["other"] == 0, rules.least(rules.hex_bits)).otherwise(
                rules.least(rules.base64_bits)
            )
            return let(
                left,
                lambda a: F.struct(
                    a["counts"].alias("counts"),
                    a["sum"].alias("sum"),
                    a["other"].alias("other"),
                    (a["hit"] | ((i >= w - 1) & (a["sum"] <= most(a)))).alias("hit"),
                ),
            )

        return go

    def scanned(codes):
        start = F.struct(
            F.array_repeat(F.lit(0), len(ALPHABET)).alias("counts"),
            F.lit(0).cast("bigint").alias("sum"),
            F.lit(0).alias("other"),
            F.lit(False).alias("hit"),
        )
        return F.aggregate(up_to(F.size(codes)), start, step(codes))["hit"]

    codes = F.transform(F.split(candidate, ""), lambda c: F.instr(F.lit(ALPHABET), c))
    allowed = candidate.rlike("^(" + "|".join(f"({x})" for x in rules.allow) + ")$")
    return ~allowed & let(F.filter(codes, lambda c: c > 0), scanned)


def _spans(body: Column, pattern: str, kind: int, good) -> Column:
    """Places of the pattern's matches for which ``good(text of the match, number of the match)`` holds.

    What lies between the matches gives their places, in code points.
    """
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")

    def placed(found):
        gaps = F.split(body, pattern, -1)
        lengths = let(
            gaps,
            lambda g: F.transform(found, lambda m, i: (F.length(F.get(g, i)) + F.length(m)).cast("bigint")),
        )

        def at(ends_before, g):
            def one(m, i):
                start = F.get(ends_before, i) + F.length(F.get(g, i))
                return F.when(
                    good(m, i),
                    F.struct(
                        start.cast("bigint").alias("start"),
                        F.lit(kind).alias("kind"),
                        (start + F.length(m)).cast("bigint").alias("end"),
                    ),
                )

            return F.filter(F.transform(found, one), lambda s: s.isNotNull())

        before = running(lengths, lambda a, b: a + b)
        return let(gaps, lambda g: let(before, lambda e: at(e, g)))

    return let(
        F.regexp_extract_all(body, F.lit(pattern), F.lit(0)),
        lambda found: F.when(F.size(found) == 0, none).otherwise(placed(found)),
    )


def secret_spans(text: Column, rules: EntropyRules = EntropyRules()) -> Column:
    """Spans of secrets, by start and then kind: structs of start, kind (index in KINDS) and end, in code points.

    Null or empty text has none. Kinds are found independently of each other, so spans of different kinds may overlap.
    """

    def spans(body):
        values = F.regexp_extract_all(body, F.lit(ASSIGN), F.lit(2))
        long_value = let(
            values, lambda v: _spans(body, ASSIGN, 0, lambda m, i: F.length(F.get(v, i)) >= 6)
        )
        return F.array_sort(
            F.concat(
                long_value,
                _spans(body, ACCESS, 1, lambda m, i: F.lit(True)),
                _spans(body, HEX, 2, lambda m, i: F.lit(True)),
                _spans(body, rules.candidates(), 3, lambda m, i: high_entropy(m, rules)),
            )
        )

    return let(whole_text(text), spans)


def spans_text(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with each run of overlapping spans replaced by ``mark``; null text stays null."""

    def rebuilt(s):
        def piece(ends_before):
            def one(x, i):
                e = F.get(ends_before, i)
                apart = (i == 0) | (x["start"] >= e)
                before = F.substring(text, (e + 1).cast("int"), (x["start"] - e).cast("int"))
                return F.when(apart, F.concat(before, F.lit(mark))).otherwise(F.lit(""))

            return F.array_join(F.transform(s, one), "")

        ends = F.transform(s, lambda x: x["end"])
        tail = F.substring(text, (F.array_max(ends) + 1).cast("int"), F.length(text))
        return F.concat(let(running(ends, F.greatest), piece), tail)

    return let(spans, lambda s: F.when(text.isNull() | (F.size(s) == 0), text).otherwise(rebuilt(s)))
