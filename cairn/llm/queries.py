"""Registered queries of the text-corpus operators: thin wrappers with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (chat, context_mixing, decontamination, exact_dedup, fill_middle, line_dedup, mixing, packing, prefix_trie,
               sharding, simhash, token_counts, toxicity)
from .tables import read


def op1_extendible_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shard(read(spark, sf_dir, "documents"))
    return out.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
                      "shard", "shard_depth", "shard_bytes")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.deduplicate_lines(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    slim = mixing.sizes(read(spark, sf_dir, "documents"))
    plan = mixing.plan_mix(slim, mixing.ranked_weights(slim, (5, 2, 1)))
    return mixing.taken_words(slim, plan)


def op5_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_mixing.score(read(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(read(spark, sf_dir, "documents"))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    hard = "\\### Assistant: </turn> ok"
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(hard).alias("text"))
    rows = read(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    out = chat.format_conversations(rows.unionByName(extra))
    t = chat.Template()
    loss = F.concat_ws("", F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: chat.unescape(s["text"], t)))
    back = out.select("conv_id", "formatted", chat.parsed_turns(F.col("formatted"), t).alias("turns"), loss.alias("loss"))
    told = F.concat_ws("", F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))))
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                       F.sha2(told.cast("binary"), 256).alias("turns_sha256"),
                       F.length("loss").cast("long").alias("loss_chars"),
                       F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(read(spark, sf_dir, "conversations")).drop("turn_id", "words")


def op12_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.digests(read(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_extendible_sharding, op2_line_dedup, op3_token_counts, op4_source_mixing,
    op5_context_mixing, op6_decontamination, op7_simhash, op8_exact_dedup, op9_chat_format, op10_toxicity,
    op11_prefix_trie, op12_best_fit_packing, op13_fill_in_middle)}
