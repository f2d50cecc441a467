"""Train/test splits of exact size that any job can recompute."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from prefkit.operators.positions import hash_edge, key_edge, up_to_edge


def test_rows(fraction: float) -> Callable[[Column], Column]:
    """Rows of the test side among n: rounded up."""
    return lambda n: F.ceil(F.lit(float(fraction)) * n.cast("double"))


def ordered_split(df: DataFrame, fraction: float, key: str = "row_id") -> DataFrame:
    """Adds ``split``; the test side is the tail of the key order. A row without a key has no place in it and is an error."""
    size = test_rows(fraction)
    last_train = key_edge(df, key, lambda n: n - size(n))
    known = F.coalesce(F.col(key), F.raise_error(F.lit("a row has no key")).cast("bigint"))
    # Without a last train row everything is on the test side.
    test = F.coalesce(known > last_train.scalar(), F.lit(True))
    return df.withColumn("split", F.when(test, "test").otherwise("train"))


def seeded_split(df: DataFrame, fraction: float, seed: int, key: str = "row_id", keys: DataFrame | None = None) -> DataFrame:
    """Adds ``split``; the test side is the head of the seeded hash order.

    With one seed, a smaller test side lies within a larger one. ``keys`` may
    name a cheaper frame with the same keys to find the edge in.
    """
    edge = hash_edge(df if keys is None else keys, key, seed, test_rows(fraction))
    return df.withColumn("split", F.when(up_to_edge(edge, key, seed), "test").otherwise("train"))


def side(df: DataFrame, name: str) -> DataFrame:
    return df.where(F.col("split") == name)


def eval_rows(df: DataFrame, fraction: float, seed: int, first: int | None = None, key: str = "row_id") -> DataFrame:
    """The test side of ``seeded_split``, or its first rows in hash order.

    Asking for more rows than there are gives all of them.
    """
    size = test_rows(fraction)
    rank = size if first is None else lambda n: F.least(size(n), F.lit(first).cast("bigint"))
    return df.where(up_to_edge(hash_edge(df, key, seed, rank), key, seed))
