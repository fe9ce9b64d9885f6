"""Corpus pipeline: documents that pass each stage, written as Parquet and reread between stages."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from yieldspark import session
from yieldspark.llm import decontam, pieces, quality, secrets, simhash
from yieldspark.llm.common import table
from yieldspark.llm.queries import tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality.keep(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group linked by fingerprints."""
    return simhash.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the table ``benchmark``."""
    return decontam.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced by their kind."""
    return secrets.redact(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their token ids, the pieces' ends in the source, the decoded text and the number of ids."""
    return pieces.with_ids(docs, tokenizer_path())


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scans", secret_scans),
    ("sentencepiece", sentencepiece),
]

#: SimHash components and token ids have no SQL form; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are a table that the next one reads."""
    docs, run_id = table(spark, sf_dir, "documents"), uuid.uuid4().hex
    for name, stage in STAGES:
        path = session.scratch_table_path(spark, f"pipeline-{run_id}/{name}")
        out = stage(spark, docs, sf_dir)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
