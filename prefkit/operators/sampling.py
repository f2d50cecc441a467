"""Sampling: questions for a comparison, rows and lengths for rollout steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from prefkit.operators.positions import hash_edge, up_to_edge


def sample_rows(df: DataFrame, n: int | None, seed: int, key: str = "row_id") -> DataFrame:
    """``n`` rows without replacement; the whole table when ``n`` is empty or not below its size.

    The rows are chosen by a threshold on the key's hash, so later costly
    columns see exactly the chosen rows.
    """
    if not n:
        return df
    edge = hash_edge(df, key, seed, lambda total: F.least(total, F.lit(n).cast("bigint")))
    return df.where(up_to_edge(edge, key, seed))


def draw(*parts: Column | str) -> Column:
    """A non-negative whole number below 2**60 from the given parts."""
    text = F.concat_ws("|", *[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def step_draws(spark: SparkSession, n: int, steps: int, batch: int, seed: int) -> DataFrame:
    """(step, slot, pos): ``batch`` distinct positions below ``n`` in each step, steps independent.

    Slot j picks one of the n - j positions still free; the earlier picks,
    taken in ascending order, shift it past the ones already used. This is exact
    for every n down to the batch size.
    """
    if batch > n:
        raise ValueError(f"cannot draw {batch} distinct rows from {n}")

    def pick(taken: Column, slot: Column) -> Column:
        free = F.pmod(draw("row", F.lit(seed), F.col("step"), slot), F.lit(n) - slot)
        place = F.aggregate(F.array_sort(taken), free, lambda p, t: F.when(t <= p, p + 1).otherwise(p))
        return F.array_append(taken, place)

    picks = F.aggregate(F.sequence(F.lit(0), F.lit(batch - 1)), F.array().cast("array<bigint>"), pick)
    return (
        spark.range(steps)
        .select(F.col("id").cast("int").alias("step"))
        .select("step", F.posexplode(picks).alias("slot", "pos"))
    )


def length_draw(seed: int, step: Column, slot: Column, low: int = 32, high: int = 256) -> Column:
    """A response length from ``low`` up to but not including ``high``."""
    return (F.lit(low) + F.pmod(draw("len", F.lit(seed), step, slot), F.lit(high - low))).cast("int")
