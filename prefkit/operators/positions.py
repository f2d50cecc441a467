"""Ranks and positions that never pull a table through one task.

Three ways, by what the caller needs:

* ``hash_edge`` finds the k-th row of a seeded hash order,
  ``key_edge`` the k-th value of a whole-number key. Both read one column and
  leave a one-row frame to compare against, so the table itself is only filtered.
* ``hash_rank`` ranks every row in a seeded hash order, ``rows_at`` only the
  rows at given positions.
* ``number_rows`` ranks every row in an arbitrary order; it writes the range
  sorted rows to the checkpoint folder once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from prefkit.session import shared_folder

# Hex digits that name a bucket: 65,536 buckets of even size, because md5 spreads evenly.
DIGITS = 4
# Parts of an order in which places look for their bucket.
CHUNKS = 4096


def seed_hash(seed: int | str, key: Column) -> Column:
    """The hash whose order replaces a seeded shuffle: same seed, same key, same place."""
    text = key.cast("string")
    # Without a key a row has no place in the order; all of them would silently get the same one.
    return F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(text, F.raise_error(F.lit("a row has no key")).cast("string"))))


def _bucket(h: Column) -> Column:
    return F.substring(h, 1, DIGITS)


def _bucket_table(hashed: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows per bucket with the number of rows before it and in total.

    At most 65,536 rows per group, whatever the size of the table.
    """
    counts = hashed.groupBy(*by, "_bucket").agg(F.count(F.lit(1)).alias("_cnt"))
    group = W.partitionBy(*by)
    return counts.select(
        *by,
        "_bucket",
        "_cnt",
        (F.sum("_cnt").over(group.orderBy("_bucket")) - F.col("_cnt")).alias("_before"),
        F.sum("_cnt").over(group).alias("_total"),
    )


def _hashed(df: DataFrame, key: str, seed: int | str) -> DataFrame:
    return df.withColumn("_h", seed_hash(seed, F.col(key))).withColumn("_bucket", _bucket(F.col("_h")))


def hash_edge(df: DataFrame, key: str, seed: int | str, rank: Callable[[Column], Column]) -> DataFrame:
    """One row ``edge`` = (hash, key) of the ``rank(n)``-th row in hash order; no row for rank 0."""
    keys = _hashed(df.select(key), key, seed)
    place = (
        _bucket_table(keys)
        .withColumn("_k", rank(F.col("_total")))
        .where("_before < _k and _k <= _before + _cnt")
        .select("_bucket", (F.col("_k") - F.col("_before")).alias("_nth"))
    )
    order = W.partitionBy("_bucket").orderBy("_h", key)
    return (
        keys.join(F.broadcast(place), "_bucket")
        .withColumn("_rn", F.row_number().over(order))
        .where("_rn = _nth")
        .select(F.struct("_h", F.col(key).alias("_key")).alias("edge"))
    )


def up_to_edge(edge: DataFrame, key: str, seed: int | str) -> Column:
    """True for the rows at or before ``edge`` in hash order; false where the edge is missing."""
    here = F.struct(seed_hash(seed, F.col(key)).alias("_h"), F.col(key).alias("_key"))
    return F.coalesce(here <= edge.scalar(), F.lit(False))


def key_edge(df: DataFrame, key: str, rank: Callable[[Column], Column]) -> DataFrame:
    """One row ``edge`` = the ``rank(n)``-th smallest of a unique bigint key; no row for rank 0.

    Four passes over the key column narrow it down 16 bits at a time, so it is
    exact for any spread of the keys and no pass keeps more than 65,536 counts.
    """
    found = None
    for shift in (48, 32, 16, 0):
        digits = df.select(F.shiftright(key, shift).alias("_d"))
        if found is not None:
            known = found.select(F.col("_d").alias("_high"), "_nth")
            digits = digits.join(F.broadcast(known), F.shiftright("_d", 16) == F.col("_high"))
        counts = digits.groupBy("_d").agg(
            F.count(F.lit(1)).alias("_cnt"), *([F.first("_nth").alias("_nth")] if found is not None else [])
        )
        placed = counts.select(
            "_d",
            "_cnt",
            (F.sum("_cnt").over(W.orderBy("_d")) - F.col("_cnt")).alias("_before"),
            (rank(F.sum("_cnt").over(W.partitionBy())) if found is None else F.col("_nth")).alias("_k"),
        )
        found = placed.where("_before < _k and _k <= _before + _cnt").select(
            "_d", (F.col("_k") - F.col("_before")).alias("_nth")
        )
    return found.select(F.col("_d").alias("edge"))


def hash_rank(
    df: DataFrame,
    key: str,
    seed: int | str,
    by: Sequence[str] = (),
    name: str = "rank",
    keys: DataFrame | None = None,
) -> DataFrame:
    """Rank from 1 in hash order, within ``by`` where given; also ``<name>_of``, the group's size.

    A group is spread over its buckets, so one holding most of the table is no
    slower than many small ones. ``keys`` may name a cheaper frame with the
    same keys to count them in.
    """
    hashed = _hashed(df, key, seed)
    table = _bucket_table(_hashed((df if keys is None else keys).select(*by, key), key, seed), by)
    order = W.partitionBy(*by, "_bucket").orderBy("_h", key)
    return (
        hashed.join(table, [*by, "_bucket"])
        .withColumn(name, F.col("_before") + F.row_number().over(order))
        .withColumn(f"{name}_of", F.col("_total"))
        .drop("_h", "_bucket", "_cnt", "_before", "_total")
    )


def rows_at(df: DataFrame, key: str, seed: int | str, positions: DataFrame) -> DataFrame:
    """``df`` rows at the given 0-based places of the hash order, once per row of ``positions``.

    Only buckets that hold a wanted place are ranked, and only by their keys.
    Places find their bucket by an equal chunk of the order, so any number of
    them is looked up in parallel; the bucket table is the only side that is
    broadcast, and it never has more than a fixed number of rows.
    """
    keys = _hashed(df.select(key), key, seed)
    table = _bucket_table(keys)
    width = F.greatest(F.ceil(F.col("_total") / CHUNKS), F.lit(1)).cast("bigint")
    ends = table.select("_bucket", "_before", (F.col("_before") + F.col("_cnt")).alias("_end"), width.alias("_width"))
    spans = ends.withColumn("_chunk", F.explode(F.sequence(F.expr("_before div _width"), F.expr("(_end - 1) div _width"))))
    one_width = table.agg(F.max(width)).scalar()
    wanted = positions.select("pos").distinct().withColumn("_chunk", F.floor(F.col("pos") / one_width).cast("bigint"))
    placed = wanted.join(F.broadcast(spans), "_chunk").where("pos >= _before and pos < _end")
    buckets = placed.select("_bucket", "_before").distinct()
    order = W.partitionBy("_bucket").orderBy("_h", key)
    ranked = keys.join(F.broadcast(buckets), "_bucket").select(
        key, (F.col("_before") + F.row_number().over(order) - 1).alias("pos")
    )
    return df.join(ranked.join(positions, "pos"), key)


def number_rows(df: DataFrame, *order: Column, name: str = "pos") -> DataFrame:
    """Position from 0 in the given order, which must be total.

    Ids and counts have to come from one layout of the rows, so the range
    sorted rows are checkpointed once.
    """
    shared_folder(df.sparkSession)
    laid = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_mid", F.monotonically_increasing_id())
        .checkpoint()
    )
    part = F.shiftright("_mid", 33).alias("_part")
    starts = laid.groupBy(part).agg(F.count(F.lit(1)).alias("_cnt"))
    starts = starts.select("_part", (F.sum("_cnt").over(W.orderBy("_part")) - F.col("_cnt")).alias("_start"))
    return (
        laid.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("_part", "_start", "_mid")
    )
