"""Attaching a value to words, one by one or once per text."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window as W, functions as F, types as T

# A table up to this many bytes is broadcast whole.
BROADCAST_BYTES = 64 << 20
# A key is hot when it holds more than one part in so many of all
# occurrences, hence there are never more hot keys than parts.
HOT_PARTS = 2000


def table_bytes(table: DataFrame, key: str) -> int:
    """An upper estimate of the hashed table's size: 64 bytes a row and the key's own."""
    row = table.agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length(F.col(key).cast("string"))), F.lit(0)).alias("b")
    ).first()
    return row["n"] * 64 + row["b"]


def is_small(table: DataFrame, key: str) -> bool:
    return table_bytes(table, key) <= BROADCAST_BYTES


def frequent(table: DataFrame, key: str) -> DataFrame:
    """The rows of a large table with the highest ``cnt``, as many as may be broadcast; equal counts stay together.

    There are few different counts, since a word counted n times takes n of all occurrences.
    """
    sizes = table.groupBy("cnt").agg(F.sum(F.octet_length(F.col(key).cast("string")) + 64).alias("b"))
    upto = sizes.select("cnt", F.sum("b").over(W.orderBy(F.desc("cnt"))).alias("_upto"))
    edge = upto.where(F.col("_upto") <= BROADCAST_BYTES).agg(F.min("cnt"))
    return table.where(F.col("cnt") >= edge.scalar())


def find_known(rows: DataFrame, items: str, table: DataFrame, key: str, value: str) -> DataFrame:
    """Replaces the lists ``items`` by ``known``, the values of items in a small ``table`` and null elsewhere, and ``rest``.

    ``rest`` holds the other items with their places. Words follow such uneven frequencies that
    a table of the ``frequent`` ones leaves few, and only those need to meet a large table.
    """
    kept = [c for c in rows.columns if c != items]
    item, out = rows.schema[items].dataType.elementType, table.schema[value].dataType
    rest = T.ArrayType(T.StructType([T.StructField("pos", T.IntegerType()), T.StructField(key, item)]))
    schema = T.StructType([*(rows.schema[c] for c in kept), T.StructField("known", T.ArrayType(out)), T.StructField("rest", rest)])
    small = table.select(F.col(key).alias("k"), F.col(value).alias("v")).toArrow().combine_chunks()
    shared = rows.sparkSession.sparkContext.broadcast(small)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, values = (shared.value[c].combine_chunks() for c in ("k", "v"))
        for batch in batches:
            lists = batch.column(items)
            flat, starts = lists.flatten(), ends(lists)
            found = values.take(pc.index_in(flat, value_set=keys.cast(flat.type)))
            left = np.flatnonzero(found.is_null().to_numpy(zero_copy_only=False))
            row = np.searchsorted(starts, left, side="right") - 1
            places = pa.array((left - starts[row]).astype(np.int32))
            others = pa.StructArray.from_arrays([places, flat.take(pa.array(left))], names=["pos", key])
            rest_ends = np.searchsorted(left, starts).astype(np.int32)
            columns = [batch.column(c) for c in kept]
            columns += [pa.ListArray.from_arrays(starts.astype(np.int32), found), pa.ListArray.from_arrays(rest_ends, others)]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "known", "rest"])

    return rows.select(*kept, items).mapInArrow(find, schema)


def ends(lists: pa.ListArray) -> np.ndarray:
    """Where each list begins among the flattened items, and where the last one ends; a null list is empty."""
    return np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))])


def merged(lists: pa.ListArray, places: pa.ListArray, values: pa.ListArray, look: Callable[[pa.Array], pa.Array]) -> pa.ListArray:
    """One list per row from its ``known`` lists and from the ``values`` that were found for the ``places`` left open.

    ``look`` turns the items of known lists into values, null where there is none. A row with several known
    lists, whose key came several times, gets the items of all in the order of place and value.
    """
    inner, rows = lists.flatten(), np.arange(len(lists))
    several = np.diff(ends(lists))
    inner_ends = ends(inner)
    flat = look(inner.flatten())
    valid = flat.is_valid().to_numpy(zero_copy_only=False)
    row = np.repeat(np.repeat(rows, several), np.diff(inner_ends))[valid]
    pos = (np.arange(len(flat)) - np.repeat(inner_ends[:-1], np.diff(inner_ends)))[valid]
    found = values.flatten()
    row = np.concatenate([row, np.repeat(rows, np.diff(ends(values)))])
    pos = np.concatenate([pos, places.flatten().to_numpy(zero_copy_only=False).astype(np.int64)])
    all_values = pa.concat_arrays([flat.filter(pa.array(valid)), found.cast(flat.type)])
    if (several > 1).any():
        order = pc.sort_indices(pa.table({"r": row, "p": pos, "v": all_values}), sort_keys=[(c, "ascending") for c in "rpv"], null_placement="at_start")
        all_values = all_values.take(order)
    elif len(found):
        all_values = all_values.take(pa.array(np.lexsort((pos, row))))
    counts = np.bincount(row, minlength=len(lists))
    return pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32), all_values)


def lookup(tokens: DataFrame, table: DataFrame, key: str, small: bool | None = None) -> DataFrame:
    """Left join of ``tokens`` with a stored ``table`` (``key``, ``cnt``, values).

    A small table is broadcast. Otherwise ``tokens``, which should then be stored and hold each word of a text once, are counted, and
    the hot ones, in the table or not, are broadcast with what the table says of
    them; the rest, none of which is frequent among the tokens, is joined by
    shuffling. ``small`` passes on a size check that was made already.
    """
    slim = table.drop("cnt")
    if is_small(table, key) if small is None else small:
        return tokens.join(F.broadcast(slim), key, "left")
    asked = tokens.where(F.col(key).isNotNull())
    counts = asked.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    # Fewer than HOT_PARTS keys can each hold more than that part of all tokens.
    hot = counts.where(F.col("_n") * HOT_PARTS > asked.agg(F.count(F.lit(1))).scalar()).select(key)
    common = asked.join(F.broadcast(hot.join(slim, key, "left")), key)
    rare = asked.join(F.broadcast(hot), key, "left_anti").join(slim, key, "left")
    # Rows without a key stay out of the shuffle, where they would meet in one task.
    missing = [F.lit(None).cast(slim.schema[c].dataType).alias(c) for c in slim.columns if c != key]
    without = tokens.where(F.col(key).isNull()).select("*", *missing)
    return common.unionByName(rare).unionByName(without)
