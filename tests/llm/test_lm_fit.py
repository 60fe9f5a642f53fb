"""Training of the attention language model."""

import os

import numpy as np
import pytest
from gaugeline.llm import attention_lm as lm
from gaugeline.llm.bytebpe import default_path
from gaugeline.llm.common import text_or_empty
from pyspark.sql import functions as F

BOOK = "/root/testdata/sf0.01/documents.parquet"


def test_every_training_text_reaches_the_weights(spark):
    rows = [(n, n % 5 == 0, n, np.arange(n, n + 40, dtype="<u2").tobytes()) for n in range(50)]
    prepared = spark.createDataFrame(rows, "key long, held_out boolean, row long, ids binary")
    vocab = lm.with_pairs(lm.vocabulary(np.ones(2000), 1999), np.ones((lm.HEADS + lm.SHARED,) * 2))
    first = lm.initial()
    moved = [np.abs(lm.fit(prepared.where(F.col("row") == n), vocab, 40) - first).max() for n in (1, 17, 33)]
    assert min(moved) > 0
    assert np.array_equal(lm.fit(prepared.where("held_out"), vocab, 400), first)


@pytest.mark.skipif(not os.path.isfile(BOOK), reason="test tables are not here")
def test_score_beats_the_class_pairs(spark):
    docs = spark.read.parquet(BOOK)
    rows = docs.select(F.col("doc_id").cast("long").alias("key"), lm.held_out("doc_id").alias("held_out"), text_or_empty("text").alias("text"))
    prepared = lm._prepared(rows, {}, default_path(), 0)
    vocab, n_ids = lm._counted(prepared, default_path())
    plain = lm.initial()
    lm.unpacked(plain)["classes"][:] = 0

    def mean(flat):
        return lm.scored(prepared.where("held_out"), vocab, flat).agg(F.sum("score") / F.sum("n_tokens")).first()[0]
    pairs, fitted = mean(plain), mean(lm.fit(prepared, vocab, n_ids))
    print(f"held-out log10 a word: class pairs {pairs:.4f}, fitted {fitted:.4f}, {n_ids} ids")
    assert fitted > pairs + 0.01
