"""Mixing sources to target weights by weighted fair queueing, with SQL functions only.

The words of a source are queued in a hash order of its documents, up to
``MAX_COPIES`` times over. A copy's virtual finish time is the number of words
queued before and in it over the source's target, so at time 1 every source
has had its target. Copies are put into one global order of finish times and
the words beyond the total budget are cut off.

A source may hold most of the rows: running sums are taken in two steps, over
hash buckets of a source and inside one bucket. The same is done with ranges
of finish times. Only the list of sources is sorted in one task.

Cases: a null text has no words; a null source is a source of its own, the
last one; documents without words and sources with target 0 are taken 0 times;
repeated rows are queued one after another; an empty table gives an empty one;
other columns are ignored. Equal rows always give equal results.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from prefkit.llm.common import WORD, stored

WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
SEED = "mix"
BUCKET_BITS = 16
HASH_BITS = 60
RANGES = 1 << 16

_BEFORE = (W.unboundedPreceding, -1)


def queue_keys(seed: str = SEED) -> tuple[Column, Column]:
    """(_key, _place): the source, never null, and the hash that replaces a shuffle."""
    digest = F.md5(F.concat_ws("|", F.lit(seed), F.col("doc_id").cast("string"), F.col("text").cast("string")))
    place = F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("bigint")
    return F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("_key"), place.alias("_place")


def queue_rows(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """doc_id, source, _key, _place and size in words."""
    size = F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0))
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"), *queue_keys(seed), size.cast("bigint").alias("size")
    ).withColumn("_bucket", F.shiftright("_place", HASH_BITS - BUCKET_BITS))


def source_targets(rows: DataFrame, weights: Sequence[float] = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """_key, source_size, target, total: one row per source.

    Weights repeat in code point order of the sources. A target above
    ``max_copies`` times its source stops there; what is left over is shared
    again by weight. Sorted by cap over weight, the sources that stop are the
    first ones, so one pass finds the share per weight of the others.
    """
    totals = rows.groupBy("source", "_key").agg(F.sum("size").alias("source_size"))
    turn = F.pmod(F.row_number().over(W.orderBy(F.asc_nulls_last("source"))) - 1, F.lit(len(weights)))
    weighted = totals.withColumn("_weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int")))
    capped = weighted.withColumn("_cap", (F.col("source_size") * max_copies).cast("double")).withColumn(
        "_level", F.col("_cap") / F.col("_weight")
    )
    order = W.orderBy("_level", F.asc_nulls_last("source"))
    left = F.col("total") - F.coalesce(F.sum("_cap").over(order.rowsBetween(*_BEFORE)), F.lit(0.0))
    shared = capped.withColumn("total", F.sum("source_size").over(W.partitionBy())).select(
        "*",
        F.row_number().over(order).alias("_rank"),
        (left / F.sum("_weight").over(order.rowsBetween(W.currentRow, W.unboundedFollowing))).alias("_share"),
    )
    # The share of the first source that does not stop is that of all later ones.
    first = F.min(F.when(F.col("_share") < F.col("_level"), F.struct("_rank", "_share"))).over(W.partitionBy())
    return shared.withColumn("_common", first["_share"]).select(
        "_key",
        "source_size",
        F.coalesce(F.least("_cap", F.col("_common") * F.col("_weight")), "_cap").alias("target"),
        "total",
    )


def mix(rows: DataFrame, targets: DataFrame, max_copies: int = MAX_COPIES) -> DataFrame:
    """One row per copy of ``queue_rows``: copy, words taken of it, its finish time and ``begins``, the mix's words before it.

    A document without a copy keeps one row of 0 words.
    """
    sums = rows.groupBy("_key", "_bucket").agg(F.sum("size").alias("_sum"))
    ahead = F.coalesce(F.sum("_sum").over(W.partitionBy("_key").orderBy("_bucket").rowsBetween(*_BEFORE)), F.lit(0))
    buckets = sums.select("_key", "_bucket", ahead.alias("_ahead")).join(targets, "_key")
    queue = W.partitionBy("_key", "_bucket").orderBy("_place", "doc_id")
    inside = F.coalesce(F.sum("size").over(queue.rowsBetween(*_BEFORE)), F.lit(0))
    queued = (
        rows.select("*", F.row_number().over(queue).alias("_nth"), inside.alias("_inside"))
        .join(buckets, ["_key", "_bucket"])
        .withColumn("_start", F.col("_ahead") + F.col("_inside"))
    )
    goal = F.floor("target").cast("bigint")

    def copy_of(turn: int):
        start = F.col("_start") + F.col("source_size") * turn
        words = F.least(F.col("size"), goal - start)
        return F.when(words > 0, F.struct(F.lit(turn).alias("copy"), words.alias("_words"), ((start + words) / F.col("target")).alias("finish")))

    copies = F.filter(F.array(*[copy_of(turn) for turn in range(max_copies)]), lambda c: c.isNotNull())
    ranged = queued.select("*", F.inline_outer(copies)).withColumn(
        "_range",
        F.when(F.col("finish").isNull(), F.pmod(F.col("_place"), F.lit(RANGES))).otherwise(
            F.least(F.floor(F.col("finish") * RANGES), F.lit(RANGES))
        ),
    )
    spans = ranged.groupBy("_range").agg(F.coalesce(F.sum("_words"), F.lit(0)).alias("_sum"))
    # RANGES + 1 rows at most, whatever the size of the table.
    spans = spans.select("_range", F.coalesce(F.sum("_sum").over(W.orderBy("_range").rowsBetween(*_BEFORE)), F.lit(0)).alias("_earlier"))
    order = W.partitionBy("_range").orderBy("finish", "_place", "doc_id", "copy", "_start").rowsBetween(*_BEFORE)
    placed = ranged.join(F.broadcast(spans), "_range").withColumn(
        "begins", F.col("_earlier") + F.coalesce(F.sum("_words").over(order), F.lit(0))
    )
    words = F.greatest(F.lit(0), F.least(F.coalesce("_words", F.lit(0)), F.col("total") - F.col("begins")))
    row = ["doc_id", "source", "_key", "_bucket", "_nth", "_place"]
    return placed.withColumn("words", words).select(*row, "size", "source_size", "target", "copy", "finish", "begins", "words")


def mixed_copies(docs: DataFrame) -> DataFrame:
    """The copies of a documents table; sizes are counted once and stored."""
    rows = stored(queue_rows(docs), "sizes")
    return mix(rows, source_targets(rows))


def taken_words(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken of every document, copies added up."""
    one = [F.first(name).alias(name) for name in ("doc_id", "size", "source_size", "target")]
    taken = mixed_copies(docs).groupBy("_key", "_bucket", "_nth").agg(*one, F.sum("words").alias("taken"))
    return taken.drop("_key", "_bucket", "_nth")
