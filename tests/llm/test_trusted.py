"""Trusted labels of the n-gram rules."""

from gaugeline.llm import ngram_rules
from pyspark.sql import functions as F


def test_every_trusted_label_counts(spark):
    docs = spark.range(24_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("w"), F.col("id")).alias("text"))
    labels = docs.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    weights = ngram_rules.gram_weights(docs, labels, buckets=64)
    assert max(map(abs, weights[:32])) < 0.01  # all documents are trusted: both shares of single words agree
