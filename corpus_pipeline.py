"""The text pipeline: each stage is written and read again as the next one's documents.

Null, empty and repeated texts pass through every stage as its operator defines
it; columns the operators do not know stay with their documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from prefkit.llm import compression_quality, fair_mix, line_dedup, lsh_forest, packing
from prefkit.llm.common import WORD, stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _whole(docs: DataFrame, *without: str) -> Column:
    """All columns of a row in one, so that no name of a stage's own can meet them."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in without]).alias("row")


def _rows_again(rows: DataFrame, columns: list[str], text: Column | None = None) -> DataFrame:
    """The columns of ``row`` as they were, with another text, and n_chars to match, where given."""
    out = []
    for c in columns:
        value = F.col("row").getField(c) if c != "text" or text is None else text
        if c == "n_chars" and text is not None:
            value = F.length(text).cast("bigint")
        out.append(value.alias(c))
    return rows.select(*out)


def _number(doc_id: Column) -> Column:
    """A doc_id that is never null; nulls come first."""
    return F.coalesce(doc_id.cast("bigint"), F.lit(line_dedup.LOWEST))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the compression classifier accepts."""
    scores = compression_quality.score_quality(docs, table(spark, sf_dir, "labels"))
    # Documents of one doc_id stay or go together: all of them must be accepted.
    accepted = scores.groupBy(_number(F.col("doc_id")).alias("id")).agg(F.min("predicted").alias("kept")).where("kept = 1")
    rows = docs.select(_whole(docs), _number(F.col("doc_id")).alias("id")).join(accepted, "id", "left_semi")
    return _rows_again(rows, docs.columns)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated lines; one that has lost all its words goes. A null text becomes an empty one."""
    kept = line_dedup.dedup_lines(docs, _whole(docs, "text"))
    kept = kept.where(F.expr(f"n_removed = 0 or regexp_count(kept, r'{WORD}') > 0"))
    return _rows_again(kept, docs.columns, F.col("kept"))


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest doc_id."""
    keepers = lsh_forest.jaccard_join(docs).where("keeper")
    keepers = keepers.select(_number(F.col("doc_id")).alias("id"), "th").distinct()
    rows = docs.select(_whole(docs), _number(F.col("doc_id")).alias("id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"))
    # Of equal rows one stays.
    once = F.row_number().over(W.partitionBy("id", "th").orderBy(F.lit(1)))
    rows = rows.join(keepers, ["id", "th"], "left_semi").withColumn("nth", once).where("nth = 1")
    return _rows_again(rows, docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The copies of the mix; the last copy of a source ends where its target is reached."""
    copies = fair_mix.mixed_copies(docs).where("words > 0").select("_key", "_place", "words", "size")
    once = F.row_number().over(W.partitionBy("_key", "_place").orderBy(F.lit(1)))
    # Each of several equal rows has copies of its own in the mix.
    keyed = docs.select(_whole(docs), *fair_mix.queue_keys()).withColumn("nth", once).where("nth = 1")
    rows = keyed.join(copies, ["_key", "_place"])
    text = F.col("row").getField("text")
    parts = F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))
    cut = F.array_join(F.slice(parts, 1, F.col("words").cast("int")), "")
    return _rows_again(rows, docs.columns, F.when(F.col("words") < F.col("size"), cut).otherwise(text))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    return packing.packed_digests(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup_stage),
    ("jaccard_join", jaccard_join),
    ("source_mix", source_mix),
    ("packing", packed),
]
# SQL has neither zstandard nor the tokenizer.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
