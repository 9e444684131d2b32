"""Named queries over the operators of this subpackage, with SQL counterparts where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from greenwave.llm import alignment, decontaminate, divergence, hilbert, host_rules, licences, lines, near_dedup, packing, quality, substrings, token_counts, token_files
from greenwave.llm.common import table
from greenwave.session import new_table_path, ship_package


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.classes(table(spark, sf_dir, "documents"))


def op2_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_table_path(spark, "token-ids")
    token_files.write_tokens(table(spark, sf_dir, "documents"), folder, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return token_files.token_index(spark, folder)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), nameless=True)


def op5_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert.shard_documents(table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.removal(table(spark, sf_dir, "documents"))


def op8_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules.judge(table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op13_frequent_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.removal(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = (op1_near_duplicates, op2_licences, op3_token_files, op4_decontamination, op5_hilbert_shards, op6_quality_rules, op7_repeated_passages, op8_host_rules,
           op9_packing, op10_token_counts, op11_source_divergence, op12_token_alignment, op13_frequent_lines, pipeline)


def _shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)

    run.__name__ = query.__name__
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {q.__name__: _shipped(q) for q in QUERIES}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_near_duplicates": near_dedup.SQL,
        "op2_licences": licences.sql(),
        "op4_decontamination": decontaminate.SQL,
        "op7_repeated_passages": substrings.SQL,
        "op8_host_rules": host_rules.SQL,
        "op11_source_divergence": divergence.SQL,
        "op13_frequent_lines": lines.SQL,
    }
