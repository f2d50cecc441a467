"""Reading preference, response and question tables; the local copy of a remote one."""

from __future__ import annotations

import hashlib
import json
import posixpath
import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from prefkit import schemas
from prefkit.sources import files as files_

CSV_OPTIONS = {
    "header": True,
    "multiLine": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def read_table(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", line_ends: bool = True) -> DataFrame:
    """A table in parquet, orc, json or csv under a declared schema.

    A csv file whose fields hold line ends has to be read by one task. Without (``line_ends`` false) files are
    split like those of any other format.
    """
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.options(**CSV_OPTIONS | {"multiLine": line_ends})
    return reader.format(fmt).load(path)


def require_keys(df: DataFrame, key: str = "row_id") -> DataFrame:
    """The frame itself; an error where a key is missing, which a declared schema does not catch."""
    if not df.where(F.col(key).isNull()).isEmpty():
        raise ValueError(f"rows without {key}; load_unkeyed_preferences writes keys for such a table")
    return df


def load_unkeyed_preferences(spark: SparkSession, path: str, stored: str, fmt: str = "parquet") -> DataFrame:
    """A table of question, chosen and rejected alone, with keys written once to the new folder ``stored``."""
    fields = [f for f in schemas.PREFERENCES.fields if f.name != "row_id"]
    keyed = assign_row_ids(read_table(spark, path, T.StructType(fields), fmt), stored)
    return keyed.select(*schemas.PREFERENCES.fieldNames())


def load_preferences(spark: SparkSession, path: str, split: str | None = None, fmt: str = "parquet", line_ends: bool = True) -> DataFrame:
    """row_id, question, chosen, rejected; ``split`` names a ``split=…`` folder, others are not read."""
    schema = schemas.PREFERENCES
    if split is None:
        return require_keys(read_table(spark, path, schema, fmt, line_ends))
    wide = T.StructType([*schema.fields, T.StructField("split", T.StringType())])
    return require_keys(read_table(spark, path, wide, fmt, line_ends).where(F.col("split") == split).drop("split"))


def load_responses(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Stored answers: row_id, response."""
    return read_table(spark, path, schemas.RESPONSES, fmt)


def manifest_of(df: DataFrame) -> str:
    """What a frame is made of: its columns, its plan, and the folders it reads with their files' sizes and times."""
    folders = sorted({posixpath.dirname(unquote(path)) for path in df.inputFiles()})
    plan = df._jdf.queryExecution().analyzed().canonicalized().toString()
    # Ids of expressions and of rows in memory are numbered anew in every session.
    plan = re.sub(r"#\d+L?|plan_id=\d+|\[\d+\] at .*", "", plan)
    return json.dumps({"columns": json.loads(df.schema.json()), "plan": hashlib.sha256(plan.encode()).hexdigest(), "folders": folders, "sources": files_.listing(df.sparkSession, folders)}, indent=1)


def cached_copy(df: DataFrame, path: str, *partition_by: str) -> DataFrame:
    """Writes ``df`` to parquet once and reads it back.

    A finished copy is reused while its manifest says that it was made of the same files, by the same plan; otherwise it is
    written anew. Rows that live in the driver are part of their plan; an RDD's are not, so its copies are always made anew.
    """
    spark = df.sparkSession
    manifest, place = manifest_of(df), f"{path}/_manifest.json"
    if not files_.is_complete(spark, path) or files_.read_text(spark, place) != manifest:
        df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
        files_.write_text(spark, place, manifest)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def assign_row_ids(df: DataFrame, path: str) -> DataFrame:
    """Gives rows without a key a unique ``row_id``, fixed by writing them out once.

    The ids follow the order of the files but have gaps.
    """
    return cached_copy(df.withColumn("row_id", F.monotonically_increasing_id()), path)
