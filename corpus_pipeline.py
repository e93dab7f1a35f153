"""The corpus pipeline: documents pass the stages in order, each stored before the next reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablemend.llm import decontamination, packing, secret_scan, simhash, toxicity
from tablemend.llm.common import stored
from tablemend.llm.queries import tokenizer_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for toxic go."""
    return toxicity.without_toxic(docs, toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents whose fingerprints are linked one stays, that with the smallest id."""
    return simhash.without_copies(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a test item go."""
    return decontamination.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; their secrets are masked."""
    return secret_scan.masked(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences."""
    return packing.packed(docs, tokenizer_path())


STAGES = [("toxicity", drop_toxic), ("near_dedup", drop_copies), ("decontamination", drop_leaks), ("secrets", mask_secrets), ("packing", pack)]

#: No stage can be told to DuckDB; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of one folder of tables."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
