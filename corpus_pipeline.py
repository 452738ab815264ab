"""The corpus pipeline: toxic documents go, shared lines go, near copies go, secrets are hidden, and the rest is packed."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslake.llm import line_dedup, packing, secrets, simhash_vptree, toxicity
from corpuslake.stages import Stages

_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _with_text(docs: DataFrame, text) -> DataFrame:
    """The columns of documents with a new text and its length.

    In two steps: beside an alias ``text``, a lambda's ``text`` would mean the alias.
    """
    changed = docs.select(*[text.alias("text") if c == "text" else F.col(c) for c in _COLUMNS])
    n_chars = F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_chars")
    return changed.select(*[n_chars if c == "n_chars" else F.col(c) for c in _COLUMNS])


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.5 by a model learned from the labels."""
    model = toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.select(*_COLUMNS).where(model.score(F.col("text")) < 0.5)


def without_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document that keeps no line stays with an empty text."""
    found = line_dedup.dedup_lines(docs.select(*_COLUMNS), Stages(spark))
    flat = found.select("row.doc_id", F.col("kept_text").alias("text"), "row.lang", "row.source", F.lit(0).alias("n_chars"))
    return _with_text(flat, F.col("text"))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group whose SimHash fingerprints (four-word shingles) link at 4 or fewer differing bits.

    Rows without an id stay, and so do all rows of an id that stays.
    """
    found = simhash_vptree.simhash_classes(docs, Stages(spark), shingle=4, distance=4)
    gone = found.where(F.col("component_id") != F.col("doc_id")).select("doc_id").distinct()
    return docs.select(*_COLUMNS).join(gone, "doc_id", "left_anti").select(*_COLUMNS)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span of a secret is replaced by a mark."""
    text = F.col("text")
    return _with_text(docs, secrets.redacted(text, secrets.secret_spans(text)))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Fewer words are kept than by the operator alone: workers still hold what earlier stages left."""
    return packing.pack(docs, Stages(spark), public_tokenizers.path("byte_bpe_50k.json"), kept_words=250_000)


STAGES = [
    ("toxicity", without_toxic),
    ("line dedup", without_shared_lines),
    ("SimHash near-dedup", without_near_copies),
    ("secret scans", without_secrets),
    ("packing", packed),
]

#: A learned model and fingerprints are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each but the last written and read again.

    Null and empty texts count as empty in every stage; a null text is still null when it is packed. Rows of an id that repeats stay or
    go together in the first and third stage. Columns beyond those of documents are not read. No documents: no rows.
    """
    docs, stages = spark.read.parquet(f"{sf_dir}/documents.parquet"), Stages(spark)
    for _, stage in STAGES[:-1]:
        docs = stages.keep(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
