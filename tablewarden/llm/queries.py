"""The registered queries of the text operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from tablewarden.llm import (
    bpe,
    chat,
    classifier,
    decontaminate,
    exact_dedup,
    line_dedup,
    periodic_runs,
    phrases,
    pii,
    quality_rules,
    simhash,
    token_counts,
    token_files,
)
from tablewarden.llm.common import documents

Query = Callable[[SparkSession, str], DataFrame]


def _on_documents(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(documents(spark, sf_dir))


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def _classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.classify(documents(spark, sf_dir), _labels(spark, sf_dir))


def _decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_items(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def _chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.chat_digests(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def queries() -> dict[str, Query]:
    return {
        "op1_bpe_round_trip": _on_documents(bpe.round_trip_digests),
        "op2_simhash": _on_documents(simhash.near_duplicates),
        "op3_suffix_dedup": _on_documents(exact_dedup.exact_dedup_digests),
        "op4_decontamination": _decontaminate,
        "op5_quality_classifier": _classify,
        "op6_token_counts": _on_documents(token_counts.count_tokens),
        "op7_token_files": _on_documents(token_files.token_file_digests),
        "op8_quality_rules": _on_documents(quality_rules.apply_rules),
        "op9_personal_data": _on_documents(pii.find_personal_data),
        "op10_line_dedup": _on_documents(line_dedup.line_dedup_digests),
        "op11_chat_samples": _chat,
        "op12_collocations": _on_documents(phrases.collocations),
        "op13_periodic_runs": _on_documents(periodic_runs.run_digests),
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op8_quality_rules": quality_rules.oracle(),
        "op10_line_dedup": line_dedup.oracle(),
    }
