"""Registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (chat, decontam, interactions, langid, licenses, neighbours, periods, pieces, quality, secrets, simhash,
               substrings, warc)
from .common import table

#: File name of the tokenizer model among the installed public tokenizers.
TOKENIZER = "piece_bpe_32k.model"

QueryFn = Callable[[SparkSession, str], DataFrame]


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return str(public_tokenizers.path(name))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.digest(table(spark, sf_dir, "documents"))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digest(table(spark, sf_dir, "documents"), tokenizer_path())


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.digest(table(spark, sf_dir, "conversations"))


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.digest(table(spark, sf_dir, "documents"))


def op6_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(table(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.digest(table(spark, sf_dir, "pages"))


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digest(table(spark, sf_dir, "documents"))


def op9_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digest(table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.measure(table(spark, sf_dir, "documents"))


def op11_filter_interaction_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interactions.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.digest(table(spark, sf_dir, "embeddings"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods.digest(table(spark, sf_dir, "documents"))


def queries() -> dict[str, QueryFn]:
    out = {f.__name__: f for f in (
        op1_language_id, op2_sentencepiece, op3_chat_formatting, op4_benchmark_decontamination, op5_suffix_array_dedup,
        op6_secret_scans, op7_warc, op8_simhash_near_dedup, op9_license_scans, op10_quality_rules,
        op11_filter_interaction_audit, op12_nearest_neighbours, op13_periodic_runs)}
    import corpus_pipeline
    out["pipeline"] = corpus_pipeline.run
    return out


def oracles() -> dict[str, str]:
    from . import oracles as o
    return dict(o.SQL)
