"""Registered queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslake.llm import (
    embedding_join,
    line_dedup,
    maxent_lm,
    packing,
    quality,
    quotation_links,
    secrets,
    sentencepiece_codec,
    simhash_vptree,
    source_divergence,
    toxicity,
    vector_codes,
    warc,
)
from corpuslake.llm.common import let, table
from corpuslake.stages import Stages

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op3_secrets(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", secrets.secret_spans(F.col("text")).alias("spans"))
    base = F.filter("spans", lambda s: s["kind"] < 3)

    def count_of(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    counts = [count_of(k).alias(f"n_{name}") for k, name in enumerate(secrets.KINDS)]
    return docs.select(
        "doc_id",
        *counts,
        F.sha2(secrets.spans_text(base), 256).alias("base_sha256"),
        secrets.spans_text(F.col("spans")).alias("spans"),
    )


@query
def op4_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs, Stages(spark)).select(
        "row.doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256")
    )


@query
def op6_quality_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "lost_words", "kept"]
    return docs.select(
        "doc_id", let(quality.quality_report(F.col("text"), kept_text=False), lambda r: F.struct(*[r[n].alias(n) for n in names])).alias("r")
    ).select("doc_id", "r.*")


@query
def op2_embedding_join(spark, sf_dir):
    return embedding_join.cosine_links(table(spark, sf_dir, "embeddings"), Stages(spark))


@query
def op8_simhash(spark, sf_dir):
    found = simhash_vptree.simhash_classes(table(spark, sf_dir, "documents"), Stages(spark))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


@query
def op1_packing(spark, sf_dir):
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack(table(spark, sf_dir, "documents"), Stages(spark), path)


@query
def op9_warc(spark, sf_dir):
    stages = Stages(spark)
    folder = stages.folder()
    warc.write_warc(table(spark, sf_dir, "pages"), folder, stages)
    return warc.read_warc(spark, folder).drop("url", "payload")


@query
def op5_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), model.score(F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query
def op7_sentencepiece(spark, sf_dir):
    """The library uses as many threads as a task has cores; ``parity`` compares each text with the original library."""
    threads = int(spark.conf.get("spark.task.cpus", "1"))
    codec = sentencepiece_codec.Codec.load(public_tokenizers.path("piece_bpe_32k.model"), threads)
    found = sentencepiece_codec.encode_documents(table(spark, sf_dir, "documents"), codec)
    return found.select("doc_id", "n_tokens", "ids_crc32", F.sha2("decoded", 256).alias("decoded_sha256"), "same", "parity")


@query
def op10_quotation_links(spark, sf_dir):
    """The turns as mail that quotes the two turns before it; the links and the texts are found again."""
    mail = quotation_links.as_mail(table(spark, sf_dir, "conversations"))
    found = quotation_links.link_quotations(mail, Stages(spark))
    return found.select(
        F.col("scope").alias("conv_id"), F.col("message").alias("turn"), "n_quoted", "n_linked", "reply_to", "thread",
        "level", F.sha2("text", 256).alias("text_sha256"),
    )


@query
def op13_vector_codes(spark, sf_dir):
    codes, books, _ = vector_codes.vector_codes(table(spark, sf_dir, "embeddings"), Stages(spark))
    of_label = codes.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    found = codes.join(of_label, F.col("label").eqNullSafe(F.col("of")))
    books_sha256 = F.sha2(F.lit(vector_codes.books_text(books)), 256)
    return found.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", books_sha256.alias("codebooks_sha256"))


@query
def op11_maxent_lm(spark, sf_dir):
    return maxent_lm.score_documents(table(spark, sf_dir, "documents"), Stages(spark))


@query
def op12_source_divergence(spark, sf_dir):
    return source_divergence.divergence(table(spark, sf_dir, "documents"), Stages(spark))
