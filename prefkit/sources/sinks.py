"""Writing reports, step metrics and training sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from prefkit.plans.model_comparison import RESULT_COLUMNS, in_input_order
from prefkit.session import shared_folder
from prefkit.sources.tables import CSV_OPTIONS


def write_comparison_csv(rows: DataFrame, path: str) -> None:
    """The comparison in input order as CSV with a header.

    Large results become several ordered part files, each with the header; AQE
    merges a small one into a single part.
    """
    options = {**CSV_OPTIONS, "emptyValue": ""}
    options.pop("multiLine")
    # Sorting samples its input first; a checkpoint keeps that from scoring twice.
    shared_folder(rows.sparkSession)
    in_input_order(rows.checkpoint()).select(*RESULT_COLUMNS).write.options(**options).csv(path)


def read_comparison_csv(spark: SparkSession, path: str) -> DataFrame:
    schema = ", ".join(f"{c} {'double' if c.endswith(('score', 'diff')) else 'string'}" for c in RESULT_COLUMNS)
    return spark.read.schema(schema).options(**CSV_OPTIONS).csv(path)


def append_step_metrics(steps: DataFrame, path: str) -> None:
    """Adds a run's step table to the metrics log, one folder per run; a run written again replaces its folder."""
    steps.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(path)


def export_training_set(df: DataFrame, table: str, path: str, batch: str = "batch_id", buckets: int = 64) -> None:
    """Writes a training set as a table at ``path``, by split and bucketed by batch.

    A batch lies in one file, its rows in key order; a trainer that asks for one batch opens one bucket,
    and grouping by batch moves nothing.
    """
    laid = df.repartition(buckets, F.col(batch)).sortWithinPartitions("split", batch, "row_id")
    writer = laid.write.mode("errorifexists").partitionBy("split").bucketBy(buckets, batch).sortBy(batch, "row_id")
    writer.option("path", path).saveAsTable(table)


def open_training_set(spark: SparkSession, table: str, path: str, schema: T.StructType, batch: str = "batch_id", buckets: int = 64) -> None:
    """Names an exported set in another session's catalog."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in [*(f for f in schema if f.name != "split"), schema["split"]])
    spark.sql(
        f"CREATE TABLE {table} ({columns}) USING parquet PARTITIONED BY (split)"
        f" CLUSTERED BY ({batch}) SORTED BY ({batch}, row_id) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    spark.sql(f"MSCK REPAIR TABLE {table}")


def read_batch(spark: SparkSession, table: str, split: str, number: int, batch: str = "batch_id") -> DataFrame:
    """One batch of an exported set."""
    return spark.table(table).where((F.col("split") == split) & (F.col(batch) == F.lit(number).cast(spark.table(table).schema[batch].dataType)))
