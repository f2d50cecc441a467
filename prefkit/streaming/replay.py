"""Stored tables replayed as streams in the order of their times."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F, types as T

# Later than all rows, for those that only move a watermark on; still a time that pandas can hold.
LAST = datetime(2200, 1, 1)
# Rows of a replayed file, about.
FILE_ROWS = 500_000


def write_slices(df: DataFrame, time: str, path: str, slices: int) -> str:
    """Writes ``df`` as ``slices`` batches of files, each of a later span of ``time`` than the one before.

    A micro-batch takes some files and costs something however small they are, so a span has two, or one for ``FILE_ROWS`` rows.
    A file stream takes files by age, so it meets the spans in order, one or several of them at a time. The files of one
    span come in any order; its length is returned, as the lateness a watermark has to allow.
    """
    if slices < 1:
        raise ValueError("slices must be positive")
    span = df.agg(F.min(F.unix_micros(time)).alias("low"), F.max(F.unix_micros(time)).alias("high"), F.count(F.lit(1)).alias("n")).first()
    files = max(2, -(-span["n"] // (slices * FILE_ROWS)))
    low, high = span["low"] or 0, span["high"] or 0
    width = max(1, -(-(high - low + 1) // slices))
    for n in range(slices):
        inside = F.floor((F.unix_micros(time) - low) / width) == n
        df.where(inside).coalesce(files).write.mode("append").parquet(path)
    return f"{-(-width // 1000)} milliseconds"


def write_end(df: DataFrame, time: str, path: str, **values: object) -> None:
    """One row with ``values``, ``time`` at the end of time and nothing else: a source that says it is done.

    A watermark only moves on with rows. Real sources send such rows when they are idle.
    """
    row = {**dict.fromkeys(df.columns), time: LAST, **values}
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema])
    df.sparkSession.createDataFrame([tuple(row[c] for c in df.columns)], schema).coalesce(1).write.mode("append").parquet(path)


