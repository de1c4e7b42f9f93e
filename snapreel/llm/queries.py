"""Registered queries of the pipeline operators: one ``opN_<name>`` each, over whole tables."""

from __future__ import annotations

import secrets

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapreel.llm import (ann, bpe, decontam, labelled, linedup, neardup, packing, pii, quality, search, shards, tokenfile, toxicity,
                          trie)
from snapreel.llm.common import table
from snapreel.session import scratch_path


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    tokenfile.write_ids(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), path)
    return tokenfile.read_ids(spark, path)


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.groups(table(spark, sf_dir, "documents"), words=4, similarity=80)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op3_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = spark.conf.get("spark.snapreel.pii.key", "")          # without a key of the session's, one that nobody learns
    key = given.encode() if given else secrets.token_bytes(32)
    out = pii.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), key)
    return out.select("doc_id", F.col("_pii_found").alias("n_entities"), "text")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = linedup.deduplicate_lines(table(spark, sf_dir, "documents"), similarity=80)
    return out.select("doc_id", F.col("_ld_lines").cast("bigint").alias("n_lines"),
                      F.col("_ld_removed").cast("bigint").alias("n_removed"), "text")


def _judged(scored: DataFrame, threshold: float) -> DataFrame:
    return scored.select("doc_id", labelled.held_out().alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return _judged(toxicity.scored(docs.select("doc_id", "text"), model), 0.7)


def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.neighbours(table(spark, sf_dir, "embeddings"), k=10, every=100)


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return _judged(quality.scored(docs.select("doc_id", "text"), model), 0.5)


def op9_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shards.interleave(table(spark, sf_dir, "documents"), n_shards=40)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), max_len=2048)


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = bpe.tokenised(docs, public_tokenizers.path("word_bpe_49k.json"), decoded_col="decoded")
    ids = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    return out.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(ids.cast("binary"), 256).alias("ids_sha256"),
                      F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op12_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.nodes(trie.rebuilt(trie.ordered(table(spark, sf_dir, "conversations"))))


QUERIES = {f.__name__: f for f in (
    op1_token_files, op2_near_duplicates, op3_surrogates, op4_line_dedup, op5_toxicity, op6_nearest, op7_decontamination, op8_quality,
    op9_shards, op10_packing, op11_bpe, op12_search, op13_conversation_trie)}
