"""From raw documents to training shards: the stages, and one call that runs them all."""

from __future__ import annotations

from contextlib import nullcontext

from pyspark.sql import DataFrame, SparkSession

from churnloom.llm import decontaminate, minhash, mixing, order, quality, registry
from churnloom.llm.store import table
from churnloom.session import remove, run_folder, scratch_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality classifier rejects."""
    return quality.keep_good(docs, registry.labelled_for_training(spark, sf_dir))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates."""
    return minhash.drop_near_duplicates(docs, similarity=minhash.STAGE_SIMILARITY)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a passage of the benchmark."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mix the sources to their target weights: parts of documents, repeated as the mix repeats them."""
    return mixing.mix(docs)


def shard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write token sequences in training order; one row for each sequence as read back."""
    return order.materialise(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("near-dedup", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("training order", shard_stage),
]

#: A trained classifier, exact near-duplicate components and binary shards cannot be put in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; every stage is written and read again.

    What a stage stores for itself goes once its result is written, and the result of the stage before it too. The last
    stage keeps its tables: the shards are among them.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for k, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"stage{k}")
        with run_folder(spark, f"stage{k}-tables") if k < len(STAGES) - 1 else nullcontext():
            out = stage(spark, docs, sf_dir)
            out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
        if before is not None:
            remove(spark, before)
        before = path
    return docs
