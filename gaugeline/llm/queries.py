"""Registered queries of the text operators, with SQL twins where SQL can state them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from ..session import stage
from . import (
    attention_lm, chat, decontam, fim, mil_quality, mixing, ngram_rules, pqlinks, setsketch, sharding, tokenfiles, turnrepair, warczip,
)
from .twins import TWINS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op2_setsketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setsketch.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op3_token_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts are control strings."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], turns.schema)
    return chat.read_back(stage(chat.format_turns(turns.unionByName(extra)), "formatted"))


def op4_zip_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warczip.read_records(warczip.write_archives(table(spark, sf_dir, "pages")))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight shards of equal weight, and the shard each row would have with nine."""
    return sharding.shard_records(table(spark, sf_dir, "documents"), [1.0] * 8).withColumn("law", F.lit("key"))


def op6_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = tokenfiles.write_shards(table(spark, sf_dir, "documents"))
    return tokenfiles.read_documents(manifest).withColumnRenamed("key", "doc_id")


def op7_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


def op8_attention_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = mil_quality.train(docs, labels, ~mil_quality.held_out("doc_id"))
    scored = mil_quality.score(docs, model)
    return scored.select("doc_id", mil_quality.held_out("doc_id").alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_ngram_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_rules.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_attention_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attention_lm.lm_scores(table(spark, sf_dir, "documents"))


def op11_pq_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pqlinks.near_vectors(table(spark, sf_dir, "embeddings"))


def op12_repair_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged as the contract says, repaired; those left without rows have zeros."""
    turns = table(spark, sf_dir, "conversations")
    return turnrepair.with_absent(turnrepair.repair(turnrepair.damaged(turns)), turns)


def op13_skip_list_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fim.restored(fim.transformed(table(spark, sf_dir, "documents")))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2("restored", 256).alias("restored_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    made = {f.__name__: f for f in (op1_pareto_mix, op2_setsketch, op3_token_chat, op4_zip_warc, op5_rendezvous_shards,
                                      op6_token_shards, op7_winnowing, op8_attention_mil, op9_ngram_rules, op10_attention_lm, op11_pq_links, op12_repair_turns, op13_skip_list_fim)}
    return {**made, "pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return dict(TWINS)
