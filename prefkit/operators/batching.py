"""Batch numbers and padding within a batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from prefkit.functions.tokens import pad_left, pad_mask, pad_right
from prefkit.operators.positions import hash_rank, number_rows


def batch_number(pos: Column, size: int) -> Column:
    return F.floor(pos / size).cast("bigint")


def micro_batches(
    df: DataFrame,
    rows: int = 4,
    accumulate: int = 8,
    seed: int | None = None,
    key: str = "row_id",
    keys: DataFrame | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """Adds ``pos``, ``micro_batch`` and the optimiser step ``batch_id`` they add up to.

    Positions follow the key, or the seeded hash order where a seed is given. ``by``
    names columns whose values are numbered apart, such as ``split``. ``keys`` may name a
    cheaper frame with the same unique keys: only these are ranked, and the rows, often laid out by key
    already, meet their ranks without moving to them.
    """
    if by and seed is None:
        raise ValueError("numbering by groups needs a seed")
    if seed is None:
        placed = number_rows(df, F.col(key).asc(), name="pos")
    else:
        ranked = df if keys is None else keys.select(*by, key)
        placed = hash_rank(ranked, key, seed, by, name="pos").withColumn("pos", F.col("pos") - 1).drop("pos_of")
        if keys is not None:
            placed = df.join(placed, [*by, key])
    return placed.withColumn("micro_batch", batch_number(F.col("pos"), rows)).withColumn(
        "batch_id", batch_number(F.col("pos"), rows * accumulate)
    )


def batch_widths(df: DataFrame, ids: str, batch: str = "batch_id") -> DataFrame:
    return df.groupBy(batch).agg(F.max(F.size(ids)).cast("bigint").alias("width"))


def pad_batches(df: DataFrame, ids: str, pad_id: int, batch: str = "batch_id", left: bool = False) -> DataFrame:
    """Pads ``ids`` to the longest in its batch and adds ``mask``.

    A batch has a fixed number of rows, so the window never holds more.
    """
    wide = df.withColumn("_width", F.max(F.size(ids)).over(W.partitionBy(batch)))
    pad = pad_left if left else pad_right
    return (
        wide.withColumn("mask", pad_mask(F.col(ids), F.col("_width"), left))
        .withColumn(ids, pad(F.col(ids), F.col("_width"), pad_id))
        .drop("_width")
    )
