"""Small pieces the text operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from prefkit.session import fresh_path

# What separates words: space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"
LABEL_FOLDS, HELD_OUT_FOLD = 4, 2


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def texts_of(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id and text alone (a null text is empty), so that no other column can clash."""
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        *more,
    )


def stored(df: DataFrame, label: str) -> DataFrame:
    """The frame written below the shared folder and read again; cuts its lineage."""
    spark = df.sparkSession
    path = fresh_path(spark, f"llm-{label}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, *order: Column, label: str) -> DataFrame:
    """The frame with ``pos``, its place from 0 in the given order, range sorted and written once below the shared folder.

    Rows that are equal in the order get places next to each other. The broadcast holds one row per written partition.
    """
    laid = stored(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_mid", F.monotonically_increasing_id()), label)
    part = F.shiftright("_mid", 33).alias("_part")
    starts = laid.groupBy(part).agg(F.count(F.lit(1)).alias("_n"))
    starts = starts.select("_part", (F.sum("_n").over(W.orderBy("_part")) - F.col("_n")).alias("_start"))
    pos = F.col("_start") + F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))
    return laid.withColumn("_part", part).join(F.broadcast(starts), "_part").withColumn("pos", pos).drop("_part", "_start", "_mid")


def held_out(doc_id: Column) -> Column:
    """True for rows whose labels no operator may learn from."""
    fold = F.crc32(doc_id.cast("string").cast("binary")) % LABEL_FOLDS
    return F.coalesce(fold == HELD_OUT_FOLD, F.lit(False))


def learnable(labels: DataFrame) -> DataFrame:
    """One (doc_id, quality) row per labelled document outside the held-out fold; conflicting labels count as bad."""
    rows = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    rows = rows.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
    return rows.groupBy("doc_id").agg(F.min("quality").alias("quality"))


def raw_files(blobs: DataFrame, path: str) -> None:
    """One file per row of the binary column ``blob``, through Spark's text writer; a line end follows the bytes."""
    blobs.select(F.col("blob").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).text(path)


def byte_items(found: pa.Array, cut: int = 0) -> list[bytes]:
    """The items of a whole binary array without nulls, without their last ``cut`` bytes; faster than its ``to_pylist``."""
    _, offsets, data = found.buffers()
    edges, data = np.frombuffer(offsets, np.int32, len(found) + 1).tolist(), data.to_pybytes() if data else b""
    return [data[low : high - cut] for low, high in pairwise(edges)]


def map_slices(df: DataFrame, run: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str, rows: int = 256) -> DataFrame:
    """``mapInPandas`` that converts ``rows`` rows at a time, for wide texts whose batches would be large twice over.

    Whole numbers with nulls among them stay whole.
    """
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frames = (batch.slice(at, rows).to_pandas(integer_object_nulls=True) for batch in batches for at in range(0, batch.num_rows, rows))
        for out in run(frames):
            yield pa.RecordBatch.from_pandas(out, schema=arrow, preserve_index=False)

    return df.mapInArrow(slices, schema)
