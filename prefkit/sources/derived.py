"""Preference-shaped tables derived from conversations, labelled documents and benchmark texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from prefkit.operators.positions import DIGITS, hash_rank, seed_hash

# Turns per conversation that one key can hold.
TURNS = 1 << 32
# Uses of one rejected document per copy of it in the pairing join.
USES_PER_COPY = 256


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def exchange_id(conv_id: Column, turn: Column) -> Column:
    """One bigint per (conversation, turn); a turn that does not fit is an error."""
    fits = turn.between(0, TURNS - 1)
    return F.when(fits, conv_id * TURNS + turn).otherwise(F.raise_error(F.lit("turn number out of range")).cast("bigint"))


def exchanges(spark: SparkSession, folder: str) -> DataFrame:
    """row_id, conv_id, turn, question, answer: a user turn and the assistant's next turn."""
    turns = table(spark, folder, "conversations")
    asked = turns.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("question"))
    replied = turns.where("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer")
    )
    return asked.join(replied, ["conv_id", "turn"]).select(
        exchange_id(F.col("conv_id"), F.col("turn")).alias("row_id"), "conv_id", "turn", "question", "answer"
    )


def other_answers(pairs: DataFrame) -> DataFrame:
    """Exchanges with ``other``: the answer to the next exchange of the conversation, or the own one.

    Exchanges are two turns apart, so an equi-join on both keys finds it.
    """
    later = pairs.select("conv_id", (F.col("turn") - 2).alias("turn"), F.col("answer").alias("_next"))
    return pairs.join(later, ["conv_id", "turn"], "left").select(
        *pairs.columns, F.coalesce("_next", "answer").alias("other")
    )


def hard_preferences(spark: SparkSession, folder: str) -> DataFrame:
    """True reply against another reply of the same conversation; single exchanges are tied."""
    return other_answers(exchanges(spark, folder)).select(
        "row_id", "question", F.col("answer").alias("chosen"), F.col("other").alias("rejected")
    )


def labelled_preferences(spark: SparkSession, folder: str, seed: int | str = "pair") -> DataFrame:
    """row_id, question, chosen, rejected, rejected_id from documents labelled good and bad.

    Within a language, the good document of rank r (hash order) meets the bad
    one of rank r modulo their number. A language may hold most documents and
    few bad ones, so ranks are taken bucket by bucket and a bad document that
    serves many good ones takes part in the join as several copies.
    """
    documents = table(spark, folder, "documents").where(F.col("text").rlike(r"\S"))
    labels = table(spark, folder, "labels").where(F.col("quality").isin(0, 1)).select("doc_id", "quality")
    labelled = (
        documents.select("doc_id", "lang")
        .join(labels, "doc_id")
        .withColumn("_h", seed_hash(seed, F.col("doc_id")))
        .withColumn("_bucket", F.substring("_h", 1, DIGITS))
    )
    counts = labelled.groupBy("lang", "_bucket").agg(
        F.count_if(F.col("quality") == 1).alias("_good"), F.count_if(F.col("quality") == 0).alias("_bad")
    )
    lang = W.partitionBy("lang")
    upto = lang.orderBy("_bucket")
    counts = counts.select(
        "lang",
        "_bucket",
        (F.sum("_good").over(upto) - F.col("_good")).alias("_good_before"),
        (F.sum("_bad").over(upto) - F.col("_bad")).alias("_bad_before"),
        F.sum("_good").over(lang).alias("n_good"),
        F.sum("_bad").over(lang).alias("n_bad"),
    )
    good = F.col("quality") == 1
    inside = F.row_number().over(W.partitionBy("lang", "_bucket", "quality").orderBy("_h", "doc_id")) - 1
    ranked = labelled.join(counts, ["lang", "_bucket"]).select(
        "doc_id", "lang", "quality", "n_good", "n_bad",
        (F.when(good, F.col("_good_before")).otherwise(F.col("_bad_before")) + inside).alias("r"),
    )
    chosen = ranked.where(good & (F.col("n_bad") > 0)).select(
        F.col("doc_id").alias("row_id"), "lang", "r",
        (F.col("r") % F.col("n_bad")).alias("bad_r"),
        F.floor(F.floor(F.col("r") / F.col("n_bad")) / USES_PER_COPY).cast("bigint").alias("copy"),
    )
    # The question is found for the bare keys, before any text is with them.
    asked = hash_rank(table(spark, folder, "benchmark"), "item_id", seed).select(
        (F.col("rank") - 1).alias("q"), F.col("text").alias("question")
    )
    n_asked = table(spark, folder, "benchmark").agg(F.count(F.lit(1)).alias("n")).scalar()
    chosen = chosen.withColumn("q", F.col("r") % n_asked).join(asked, "q").drop("q", "r")
    # Only texts with a label move, and both joins by document read the same shuffle of them; hashing the
    # keys of a partition, which are few bytes, keeps the texts from being sorted.
    texts = documents.select("doc_id", "text").join(labels.select("doc_id"), "doc_id", "left_semi")
    copies = F.floor(F.floor((F.col("n_good") - 1) / F.col("n_bad")) / USES_PER_COPY).cast("bigint")
    bad = ranked.where(~good & (F.col("n_good") > 0)).select("doc_id", "lang", F.col("r").alias("bad_r"), copies.alias("copies"))
    rejected = texts.join(bad.hint("shuffle_hash"), "doc_id").select(
        F.col("doc_id").alias("rejected_id"), "lang", "bad_r",
        F.explode(F.sequence(F.lit(0).cast("bigint"), "copies")).alias("copy"),
        F.col("text").alias("rejected"),
    )
    known = texts.join(chosen.withColumnRenamed("row_id", "doc_id").hint("shuffle_hash"), "doc_id")
    return known.join(rejected.hint("shuffle_hash"), ["lang", "bad_r", "copy"]).select(
        F.col("doc_id").alias("row_id"), "question", F.col("text").alias("chosen"), "rejected", "rejected_id"
    )


def common_questions(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "benchmark").select(F.col("item_id").alias("row_id"), F.col("text").alias("question"))


def stored_answers(spark: SparkSession, folder: str, own: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two response sets keyed (source, row_id).

    For the exchanges ``own`` their own and the other answer; for a benchmark
    question the documents with its number and the next one, empty where there
    is none.
    """
    items = table(spark, folder, "benchmark").select("item_id")
    documents = table(spark, folder, "documents").select("doc_id", "text")

    def of(answer: str, ahead: int) -> DataFrame:
        sampled = own.select(F.lit("sample").alias("source"), "row_id", F.col(answer).alias("response"))
        # Only the documents that answer move; few questions are broadcast.
        answering = documents.join(items, F.col("item_id") + ahead == F.col("doc_id"), "left_semi")
        common = items.join(answering, F.col("item_id") + ahead == F.col("doc_id"), "left").select(
            F.lit("common").alias("source"), F.col("item_id").alias("row_id"), F.coalesce("text", F.lit("")).alias("response")
        )
        return sampled.unionByName(common)

    return of("answer", 0), of("other", 1)
