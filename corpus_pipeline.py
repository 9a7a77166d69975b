"""The training-data pipeline: filter, deduplicate, decontaminate, pack.

Each stage works on everything its predecessor kept. The first three drop
documents and keep the columns of ``documents``; the last returns the packed
pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rowcast.llm import decontam, packing, simhash, toxicity
from rowcast.llm.common import stored


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the model trained on ``labels`` calls toxic."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.clean(docs, model)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near duplicates."""
    return simhash.keep_one(docs, shingle=4, max_bits=4, keep_null_ids=False)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold ten consecutive words of a benchmark item."""
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), window=10)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences of at most 1024 tokens."""
    return packing.pack(docs, max_len=1024, end_id=2)


STAGES = [
    ("toxicity", toxicity_stage),
    ("simhash_near_dedup", simhash_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("best_fit_packing", packing_stage),
]

# A trained model and a tokenizer decide the rows: SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
