"""Conversations from messages that quote each other: quotes link a message to the one it answers, and then go.

Lines are told apart by their quote level. Runs of one level are passages; each paragraph of a passage, and each of its lines,
is normalised and hashed. The last message before in the same conversation whose own text holds the hash is the quoted one. A
message answers the one that most of its passages of the lowest linked level come from; answers form threads.
"""

from __future__ import annotations

import re
import unicodedata

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpuslake.llm.common import whole_text
from corpuslake.stages import Stages

_QUOTE = re.compile(r"(?:[ \t]{0,3}>)+[ \t]?")
#: Lines that announce a quote, if one follows.
_ANNOUNCES = re.compile(r"^.*\b(wrote|writes|said|schrieb|a écrit|escribió)\s*:\s*$", re.I)


def level(line: str) -> tuple[int, str]:
    """Quote level of a line, and the line without its marks."""
    found = _QUOTE.match(line)
    return (found[0].count(">"), line[found.end() :]) if found else (0, line)


def key(text: str, least: int = 1) -> bytes | None:
    """Hash of the text without differences of case, width and white space; None if fewer than ``least`` characters are left."""
    text = " ".join(unicodedata.normalize("NFKC", text).casefold().split())
    return xxhash.xxh3_128_digest(text.encode()) if len(text) >= least else None


def parse(text: str, least: int) -> tuple[str, list[tuple[int, bytes]]]:
    """The message's own text, and (level, key) of each passage's paragraphs and lines; own ones have level 0.

    Units under ``least`` characters count only as a whole: of own ones the whole message, of quoted ones a whole paragraph. So a short
    paragraph is linked with a message that says nothing else.
    """
    lines = [level(line) for line in text.split("\n")]
    announced = set()
    for k, (depth, line) in enumerate(lines):
        if depth == 0 and _ANNOUNCES.match(line):
            after = next((d for d, rest in lines[k + 1 :] if d or rest.strip()), 0)
            if after:
                announced.add(k)
    own = [line for k, (depth, line) in enumerate(lines) if not depth and k not in announced]
    passages, run, depth = [], [], 0
    for k, (d, line) in enumerate([*lines, (-1, "")]):
        if (d != depth or not line.strip()) and run:
            passages.append((depth, run))
            run = []
        depth = d
        if line.strip() and k not in announced and d >= 0:
            run.append(line)
    keys = dict.fromkeys([(0, h)] if (h := key(" ".join(own))) else [])
    for d, run in passages:
        whole = key(" ".join(run), 1 if d else least)
        lines_of_run = [key(line, least) for line in run] if len(run) > 1 else []
        keys.update(dict.fromkeys((d, h) for h in (whole, *lines_of_run) if h))
    return "\n".join(own).strip("\n"), list(keys)


_BLOCK_BITS = 10  # messages of a conversation that are looked at together
_PARSED = pa.schema([("level", pa.int32()), ("key", pa.binary())])


def _nearest_holders(units: DataFrame) -> DataFrame:
    """``scope, message, level, origin`` of each quoted unit: the last message before whose own text holds it.

    Messages of one unit are looked at in blocks; what earlier blocks hold comes from one row per block.
    """
    events = units.distinct().select(
        "scope", "key", "message", "level", F.when(F.col("level") == 0, F.col("message")).alias("holder"),
        F.shiftright("message", _BLOCK_BITS).alias("block"),
    )
    within = Window.partitionBy("scope", "key", "block").orderBy("message").rangeBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("scope", "key").orderBy("block").rangeBetween(Window.unboundedPreceding, -1)
    blocks = events.groupBy("scope", "key", "block").agg(F.max("holder").alias("last"))
    blocks = blocks.withColumn("carried", F.max("last").over(earlier)).drop("last")
    told = events.withColumn("here", F.max("holder").over(within)).where("level > 0").join(blocks, ["scope", "key", "block"])
    return told.select("scope", "message", "level", F.coalesce("here", "carried").alias("origin")).where("origin is not null")


def _threads(answers: DataFrame, stages: Stages) -> DataFrame:
    """``scope, message, root, level`` of each message that answers another, by doubling: a round halves the way to the root.

    Only messages that are not at their root yet take part in a round, so that short threads are done after a few.
    """
    at = answers.select("scope", F.col("message").alias("root"), F.lit(True).alias("goes_on"))
    now = answers.select("scope", "message", F.col("reply_to").alias("root"), F.lit(1).cast("long").alias("level"))
    now = stages.keep(now.join(at, ["scope", "root"], "left").withColumn("goes_on", F.coalesce("goes_on", F.lit(False))))
    while not now.where("goes_on").isEmpty():
        up = now.select(
            "scope", F.col("message").alias("root"), F.col("root").alias("far"), F.col("level").alias("more"),
            F.col("goes_on").alias("then"),
        )
        moved = now.where("goes_on").join(up, ["scope", "root"]).select(
            "scope", F.col("far").alias("root"), "message", (F.col("level") + F.col("more")).alias("level"), F.col("then").alias("goes_on")
        )
        now = stages.keep(now.where("not goes_on").unionByName(moved))
    return now.drop("goes_on")


def link_quotations(
    messages: DataFrame,
    stages: Stages,
    scope: str = "conv_id",
    message: str = "turn",
    author: str = "role",
    text: str = "text",
    least: int = 12,
) -> DataFrame:
    """``scope, message, author, text, n_quoted, n_linked, reply_to, thread, level``, in order of scope, thread and message.

    ``message`` numbers a conversation's messages in time. ``text`` is without quotes and the lines that announce them; a paragraph
    under ``least`` characters is linked only with a message that says nothing else. ``reply_to`` is the earlier message answered, null if none is found; ``thread`` is the
    message at the start of the answers and ``level`` the number of answers in between, so that sorted rows have each message after
    the one it answers.

    Null text is an empty one. Rows without scope or message link nothing. Rows that repeat a message are parts of one, each with
    its own text. Other columns aren't read, so they can't clash. An empty table gives an empty one.
    """

    def parsed(batches):
        for batch in batches:
            made = [parse(t, least) for t in batch.column("body").to_pylist()]
            units = [[{"level": d, "key": h} for d, h in keys] for _, keys in made]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("scope", "message", "author")), pa.array([own for own, _ in made], pa.string()),
                 pa.array(units, pa.list_(pa.struct(list(_PARSED))))],
                names=["scope", "message", "author", "text", "units"],
            )

    rows = messages.select(
        F.col(scope).alias("scope"), F.col(message).cast("long").alias("message"), F.col(author).alias("author"),
        whole_text(F.col(text)).alias("body"),
    )
    kinds = dict(rows.dtypes)
    schema = f"scope {kinds['scope']}, message long, author {kinds['author']}, text string, units array<struct<level int, key binary>>"
    rows = stages.keep(rows.mapInArrow(parsed, schema))

    units = rows.where(F.col("scope").isNotNull() & F.col("message").isNotNull())
    units = units.select("scope", "message", F.explode("units").alias("u")).select("scope", "message", "u.*")
    quoted = _nearest_holders(units)
    votes = quoted.groupBy("scope", "message", "level", "origin").agg(F.count("*").alias("n"))
    votes = votes.groupBy("scope", "message").agg(
        F.sum("n").alias("n_linked"),
        F.max(F.struct((-F.col("level")).alias("near"), "n", "origin")).alias("best"),
    )
    answers = stages.keep(votes.select("scope", "message", "n_linked", F.col("best.origin").alias("reply_to")))
    found = answers.join(_threads(answers, stages), ["scope", "message"])
    return (
        rows.join(found, ["scope", "message"], "left")
        .select(
            "scope",
            "message",
            "author",
            "text",
            F.size(F.filter("units", lambda u: u["level"] > 0)).cast("long").alias("n_quoted"),
            F.coalesce("n_linked", F.lit(0)).alias("n_linked"),
            "reply_to",
            F.coalesce("root", "message").alias("thread"),
            F.coalesce("level", F.lit(0)).alias("level"),
        )
        .orderBy("scope", "thread", "message")
    )


def as_mail(turns: DataFrame) -> DataFrame:
    """Turns (conv_id, turn, role, text) as mail: each quotes the turn before it, and in it the one before that."""
    one = turns.groupBy("conv_id", "turn").agg(F.min(F.struct("role", "text")).alias("said"))

    def before(k):
        return one.select("conv_id", (F.col("turn") + k).alias("turn"), F.col("said").alias(f"said{k}"))

    def quote(k):
        said = F.col(f"said{k}")
        body = F.regexp_replace(F.concat(said["role"], F.lit(" wrote:\n"), F.regexp_replace(said["text"], "(?m)^", "> ")), "(?m)^", "> " * (k - 1))
        return F.coalesce(F.concat(F.lit("\n\n"), body), F.lit(""))

    joined = turns.join(before(1), ["conv_id", "turn"], "left").join(before(2), ["conv_id", "turn"], "left")
    return joined.select("conv_id", "turn", "role", F.concat(whole_text(F.col("text")), quote(1), quote(2)).alias("text"))
