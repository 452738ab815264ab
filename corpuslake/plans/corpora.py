"""Corpora made from the given tables: ``documents`` and ``conversations`` as annotated text.

A document's corpus is its language. A line of its text is a paragraph, a piece between spaces a
token; lemma, tag and features follow from the word by rule.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslake.operators.ordered import Order
from corpuslake.sources.tables import spread, text_tokens

# Documents in one coarse chunk of the ordered scans.
RANGE_BITS = 16
# Turns of one conversation in one chunk.
TURN_BITS = 8

# What a line that is no word begins with until lines are made; no word holds one.
MARK = "\n"

LINE_ORDER = Order(chunks=("range", "chunk"))
TEXT_ORDER = Order(chunks=("range",), within="doc_id")
TURN_ORDER = Order(chunks=("range", "chunk"), within="pos")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("corpus_id", F.coalesce("lang", F.lit("")))


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/conversations.parquet")


def lemma(word: Column) -> Column:
    return F.lower(word)


def tag(word: Column) -> Column:
    return (
        F.when(word.rlike(r"^\p{Lu}"), "NNP")
        .when(word.endswith(",") | word.endswith("."), "NN")
        .when(word.rlike("[0-9]"), "CD")
        .when(word.endswith("tion"), "NNS")
        .when(word.endswith("ing"), "VBG")
        .otherwise("JJ")
    )


def feats(word: Column) -> Column:
    size = F.when(F.length(word) <= 3, "S").when(F.length(word) <= 7, "M").otherwise("L")
    cap = F.when(word.rlike(r"^\p{Lu}"), "Yes").otherwise("No")
    main = F.concat(F.lit("Len="), size, F.lit("|Cap="), cap)
    return F.when(F.length(word) == 1, "_").when(word.endswith("tion"), F.concat(main, F.lit("||Suf=tion|Cap="), cap)).otherwise(main)


COLUMNS: dict[int, Callable[[Column], Column]] = {0: lambda w: w, 1: lemma, 2: tag, 3: feats}


def document_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(documents(spark, sf_dir).select("corpus_id", "doc_id", "text"), "doc_id")
    return docs.select("corpus_id", F.shiftright("doc_id", RANGE_BITS).alias("range"), "doc_id", "text")


def tokenised(texts: DataFrame) -> DataFrame:
    """``tokens`` instead of ``text``. Where texts are shuffled, they go as they are, and tokens are made after it."""
    return texts.select(*[c for c in texts.columns if c != "text"], text_tokens(F.col("text")).alias("tokens"))


def document_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenised(document_texts(spark, sf_dir))


def conversation_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spread(conversations(spark, sf_dir).select("conv_id", "turn", "text"), "conv_id", "turn")
    return turns.select(F.lit("conversations").alias("corpus_id"), text_tokens(F.col("text")).alias("tokens"))


def words_of(line: Column) -> Column:
    return F.array_remove(F.split(line, "[ \n]+"), "")


def paragraph_words(line: Column) -> Column:
    """``words_of`` of a text without line ends; needs no pattern."""
    return F.array_remove(F.split(line, " "), "")


def day(doc_id: Column) -> Column:
    return F.date_format(F.date_add(F.lit("2020-01-01").cast("date"), F.pmod(doc_id, F.lit(365)).cast("int")), "yyyy-MM-dd")


def doc_tag() -> Column:
    return F.concat(
        F.lit('<doc id="'), F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
        F.lit('" lang="'), F.coalesce("lang", F.lit("")),
        F.lit('" source="'), F.coalesce("source", F.lit("")),
        F.lit('" date="'), day(F.col("doc_id")),
        F.lit('">'),
    )


def p_tag(num: Column) -> Column:
    return F.concat(F.lit('<p num="'), (num + 1).cast("string"), F.lit('">'))


def plain_token(word: Column) -> Column:
    """A token line of word and lemma."""
    return F.concat_ws("\t", word, lemma(word))


def full_token(word: Column) -> Column:
    return F.concat_ws("\t", word, lemma(word), tag(word), feats(word))


def tags(*lines: Column) -> Column:
    """Lines among the words of a paragraph that are made already."""
    return F.array(*[F.concat(F.lit(MARK), line) for line in lines])


def tags_if(test: Column, *lines: Column) -> Column:
    return F.when(test, tags(*lines)).otherwise(F.array().cast("array<string>"))


def document_lines(
    spark: SparkSession,
    sf_dir: str,
    paragraph: Callable[[Column, Column], Column],
    before: tuple[Column, ...] = (),
    after: tuple[str | Column, ...] = (),
    where: Column | None = None,
    token: Callable[[Column], Column] = plain_token,
) -> DataFrame:
    """Documents as vertical lines; ``paragraph(text, num)`` gives the words and ``tags`` of one, as an array.

    ``token`` makes the line of a word, once words are rows: inside an array, it would not be compiled.
    """
    body = F.flatten(F.transform(F.split("text", "\n"), paragraph))
    entries = F.concat(tags(doc_tag(), *before), body, tags(*[F.lit(a) for a in after], F.lit("</doc>")))
    docs = documents(spark, sf_dir).where(F.lit(True) if where is None else where)
    docs = spread(docs.select("corpus_id", "doc_id", "text", "lang", "source"), "doc_id")
    rows = docs.select("corpus_id", "doc_id", F.posexplode(entries).alias("seq", "entry"))
    entry = F.col("entry")
    made = F.when(entry.startswith(MARK), F.substr(entry, F.lit(2))).when(entry.isNotNull(), token(entry))
    return rows.select(
        "corpus_id",
        F.shiftright("doc_id", RANGE_BITS).alias("range"),
        F.col("doc_id").alias("chunk"),
        F.struct("doc_id", "seq").alias("pos"),
        "seq",
        made.alias("line"),
    )


def simple_paragraph(text: Column, num: Column) -> Column:
    return F.concat(tags(p_tag(num)), paragraph_words(text), tags(F.lit("</p>")))


def conversation_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as vertical lines: system messages as a ``conv`` without turns, then the dialogue.

    The tags around a conversation come from its first and last turn numbers, so the turns of one
    are never brought together.
    """
    turns = spread(conversations(spark, sf_dir), "conv_id", "turn")

    def conv(kind: str) -> Column:
        return F.concat(F.lit('<conv id="'), F.col("conv_id").cast("string"), F.lit(f'" kind="{kind}">'))

    turn = F.concat(
        F.lit('<turn num="'), F.col("turn").cast("string"), F.lit('" role="'), F.col("role"), F.lit('">')
    )
    words = F.transform(words_of(F.col("text")), plain_token)
    body = F.when(
        F.col("role") == "system", F.concat(F.array(conv("system")), words, F.array(F.lit("</conv>")))
    ).otherwise(F.concat(F.array(turn), words, F.array(F.lit("</turn>"))))
    dialogue = turns.where("role <> 'system'").groupBy("conv_id").agg(F.min("turn").alias("a"), F.max("turn").alias("b"))
    edges = dialogue.select(
        "conv_id",
        F.inline(
            F.array(
                F.struct(F.col("a").alias("turn"), F.lit(0).alias("part"), conv("dialogue").alias("line")),
                F.struct(F.col("b").alias("turn"), F.lit(2).alias("part"), F.lit("</conv>").alias("line")),
            )
        ),
    ).withColumn("seq", F.lit(0))
    rows = turns.select("conv_id", "turn", F.lit(1).alias("part"), F.posexplode(body).alias("seq", "line"))
    return rows.unionByName(edges).select(
        F.lit("conversations").alias("corpus_id"),
        F.shiftright("conv_id", RANGE_BITS).alias("range"),
        F.struct("conv_id", F.shiftright("turn", TURN_BITS).alias("t")).alias("chunk"),
        F.struct("conv_id", "turn", "part", "seq").alias("pos"),
        "line",
    )
