"""Named queries of the text operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from prefkit.llm import compression_quality, fair_mix, fill_middle, isolation_rules, line_dedup, lsh_forest, merkle, packing, prefix_parsing, secret_links, token_files, turn_repair, url_filter
from prefkit.llm.common import table


def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return isolation_rules.judge(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op2_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed_digests(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op3_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.round_trip(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op4_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.dedup_digests(table(spark, folder, "documents"))


def op5_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge_pages(table(spark, folder, "pages"))


def op6_document_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.edited_fingerprints(table(spark, folder, "documents"))


def op7_repeated_strings(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_parsing.removed_digests(table(spark, folder, "documents"))


def op8_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return fair_mix.taken_words(table(spark, folder, "documents"))


def op9_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return compression_quality.score_quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op10_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return lsh_forest.join_digests(table(spark, folder, "documents"))


def op11_turn_repair(spark: SparkSession, folder: str) -> DataFrame:
    return turn_repair.repaired_digests(table(spark, folder, "conversations"))


def op12_secret_links(spark: SparkSession, folder: str) -> DataFrame:
    return secret_links.secret_digests(table(spark, folder, "documents"))


def op13_fill_middle(spark: SparkSession, folder: str) -> DataFrame:
    return fill_middle.fill_middle_digests(table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_rules,
        op2_packing,
        op3_token_files,
        op4_line_dedup,
        op5_url_filter,
        op6_document_fingerprints,
        op7_repeated_strings,
        op8_source_mix,
        op9_quality_classifier,
        op10_jaccard_join,
        op11_turn_repair,
        op12_secret_links,
        op13_fill_middle,
    )
}
