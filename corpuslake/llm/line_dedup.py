"""Lines that many documents share are dropped from all of them but one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslake.llm.common import BLANKS, ascii_lower, let, lines_of, up_to, whole_text
from corpuslake.stages import Stages


def line_key(line: Column) -> Column:
    """The line without ASCII white space at its ends and with A-Z in lower case."""
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def shared_lines(rows: DataFrame, min_chars: int, min_docs: int) -> tuple[DataFrame, DataFrame]:
    """Of rows (id, sig, body): the places of long enough lines by hashed key, and the keys in ``min_docs`` documents.

    Distinct documents are counted after combining by (key, document), so that a key that a third of all documents
    holds is spread by document first.
    """
    places = rows.select("id", "sig", F.posexplode(lines_of(F.col("body"))).alias("pos", "line"))
    places = places.withColumn("key", line_key(F.col("line"))).where(F.length("key") >= min_chars)
    places = places.select("id", "sig", "pos", F.unhex(F.md5("key")).alias("key"))
    shared = places.groupBy("key").agg(F.count_distinct("id").alias("docs"), F.max("id").alias("keeper"))
    return places, shared.where(F.col("docs") >= min_docs).select("key", "keeper")


def dedup_lines(
    docs: DataFrame,
    stages: Stages,
    doc_id: str = "doc_id",
    text: str = "text",
    min_chars: int = 20,
    min_docs: int = 3,
) -> DataFrame:
    """``row`` (all columns of the input), ``kept_text``, ``n_lines`` (before dropping) and ``n_dropped`` per input row.

    A line whose key has ``min_chars`` code points or more and occurs in ``min_docs`` documents or more is dropped
    everywhere but in the largest ``doc_id`` holding it, where all its copies stay. Keys are compared by a 128-bit hash.

    Null or empty text is one empty line, which stays. Rows with the same ``doc_id`` are one document, each row keeping its
    own lines. Rows without a ``doc_id`` count as no document, and lose lines that documents share. Other columns are
    carried in ``row``, so their names can't clash. An empty table gives an empty table.
    """
    rows = docs.select(
        F.struct("*").alias("row"), F.col(doc_id).alias("id"), whole_text(F.col(text)).alias("body")
    ).withColumn("sig", F.xxhash64("body"))
    places, shared = shared_lines(rows, min_chars, min_docs)
    # Written, so that the join has a plain shuffle on both sides, and Spark can split what one frequent line brings.
    lost = places.join(stages.keep(shared), "key").where(~F.col("id").eqNullSafe(F.col("keeper")))
    lost = lost.groupBy("id", "sig").agg(F.collect_set("pos").alias("lost"))
    lost = lost.select(F.col("id").alias("lost_id"), F.col("sig").alias("lost_sig"), "lost")
    joined = rows.join(
        lost, F.col("id").eqNullSafe(F.col("lost_id")) & (F.col("sig") == F.col("lost_sig")), "left"
    )
    lost_here = F.coalesce("lost", F.array().cast("array<int>"))

    def result(lines: Column) -> Column:
        stay = F.array_except(up_to(F.size(lines)), lost_here)
        kept = F.when(F.col("lost").isNull(), F.col("body")).otherwise(
            F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n")
        )
        return F.struct(
            kept.alias("kept_text"),
            F.size(lines).cast("long").alias("n_lines"),
            F.size(lost_here).cast("long").alias("n_dropped"),
        )

    return joined.select("row", let(lines_of(F.col("body")), result).alias("found")).select("row", "found.*")
