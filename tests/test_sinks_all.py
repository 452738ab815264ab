import __spark_entry__

DATA = "/root/testdata/sf0.001"


def test_sinks_cover_every_corpus(spark):
    corpora = {r[0] for r in spark.read.parquet(f"{DATA}/documents.parquet").select("lang").distinct().collect()}
    for name in ("sink_units_all", "sink_frequencies_all"):
        found = __spark_entry__.queries()[name](spark, DATA)
        assert {r[0] for r in found.select("corpus_id").distinct().collect()} == corpora
