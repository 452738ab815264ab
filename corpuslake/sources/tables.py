"""Corpora kept as tables with one text per row, tokenised without moving rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslake.operators.ordered import Order, same, scan

# A token that begins a paragraph keeps the newline before it; no token can contain one otherwise.
BREAK = "\n"


def text_tokens(text: Column) -> Column:
    """Tokens of a text (pieces between spaces and newlines); the first of each line starts with BREAK."""
    spaced = F.regexp_replace(text, r"\n[ \n]*", " \n")
    return F.array_remove(F.array_remove(F.split(spaced, " "), ""), BREAK)


def bare(token: Column) -> Column:
    return F.when(token.startswith(BREAK), F.substr(token, F.lit(2))).otherwise(token)



def spread(df: DataFrame, *by: str) -> DataFrame:
    """Rows over all cores if the input has fewer splits than that; large inputs stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *by) if df.rdd.getNumPartitions() < cores else df


# More corpora than this in one job are joined by a shuffle instead of a broadcast.
FEW_CORPORA = 10_000
_SPREAD = 64


@dataclass(frozen=True)
class PerCorpus:
    """One row of ``values`` per corpus, made by one job; kept on the driver if there are few corpora."""

    table: DataFrame
    keys: tuple[str, ...]
    values: tuple[str, ...]
    few: bool

    @classmethod
    def of(cls, df: DataFrame, keys: Sequence[str], at_most: int | None = None, **values: Column) -> PerCorpus:
        at_most = FEW_CORPORA if at_most is None else at_most
        made = df.groupBy(*keys).agg(*[e.alias(n) for n, e in values.items()])
        rows = made.limit(at_most + 1).collect()
        few = len(rows) <= at_most
        table = df.sparkSession.createDataFrame(rows, made.schema) if few else made
        return cls(table, tuple(keys), tuple(values), few)

    def attach(self, df: DataFrame, spread_by: Sequence[str]) -> DataFrame:
        """Add the values. With many corpora, the rows of one are spread by ``spread_by`` first."""
        names = [f"__c{i}" for i in range(len(self.keys))]
        table = self.table.select(*[F.col(k).alias(n) for k, n in zip(self.keys, names)], *self.values)
        match = same([F.col(k) for k in self.keys], [F.col(n) for n in names])
        if self.few:
            return df.join(F.broadcast(table), match).drop(*names)
        table = table.withColumn("__s", F.explode(F.sequence(F.lit(0), F.lit(_SPREAD - 1))))
        salted = df.withColumn("__t", F.pmod(F.xxhash64(*spread_by), F.lit(_SPREAD)).cast("int"))
        return salted.join(table, match & (F.col("__s") == F.col("__t"))).drop("__s", "__t", *names)

    def total(self, value: str) -> int:
        return self.table.agg(F.sum(value)).first()[0] or 0


def corpus_sizes(df: DataFrame, keys: Sequence[str], tokens: Column, at_most: int | None = None) -> PerCorpus:
    """``corpus_size``: the sum of ``tokens`` per corpus."""
    return PerCorpus.of(df, keys, at_most, corpus_size=F.coalesce(F.sum(tokens), F.lit(0)).cast("long"))


def text_lengths(texts: DataFrame, order: Order, tokens: str = "tokens") -> DataFrame:
    """(corpus, chunk, id, ``n``) rows: what sizes and offsets are made of, so stored they spare passes over the texts."""
    return texts.select(*order.place, F.size(tokens).cast("long").alias("n"))


def with_token_offsets(texts: DataFrame, order: Order, lengths: DataFrame | None = None) -> DataFrame:
    """Add ``base``, the tokens of the corpus before this text.

    Only ``text_lengths`` are scanned; ``order.within`` must identify a text in its chunk.
    """
    ids = order.place
    lengths = (text_lengths(texts, order) if lengths is None else lengths).withColumnRenamed("n", "__n")
    based = scan(lengths, order, {"base": F.col("__n")}, before=["base"])
    based = based.select(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(ids)], "base")
    # The offsets of a partition are few beside its texts, so these are not sorted for the join.
    joined = texts.join(based.hint("shuffle_hash"), same([F.col(c) for c in ids], [F.col(f"__k{i}") for i in range(len(ids))]))
    return joined.drop(*[f"__k{i}" for i in range(len(ids))])
