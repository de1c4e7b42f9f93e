"""The corpus pipeline: documents to packed training sequences, stage by stage.

Each stage takes what the stage before it wrote and its decisions take effect:
toxic documents go; lines that repeat an earlier line go, and with them documents
that have no other; of every group of near-duplicates one document stays;
documents that share a window with a benchmark item go; the rest is tokenised
and packed. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapreel.llm import decontam, linedup, neardup, packing, toxicity
from snapreel.llm.common import table
from snapreel.session import scratch_path

TOXIC = 0.7


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of being toxic is below ``TOXIC``."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.scored(docs, model, out="_toxicity").where(F.col("_toxicity") < TOXIC).select(*docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines with an earlier line of Jaccard similarity 0.8 or more are cut."""
    return linedup.cut_lines(docs, similarity=80)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose five-word shingles are 0.8 similar or more."""
    return neardup.deduplicate(docs, words=5, similarity=80)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a ten-word window of a benchmark item."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' token ids, placed in sequences of 2048."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), max_len=2048)


STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

ORACLE_SQL = None        # a trained classifier and a tokenizer: tested against a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each stage's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


QUERIES = {"pipeline": run}
