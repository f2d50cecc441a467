"""Files and folders through the file system Spark itself uses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from prefkit.session import fresh_path


def _opened(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    place, system = _opened(spark, path)
    return system.exists(place)


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a finished write left its marker; a job that died half-way leaves none."""
    return exists(spark, f"{path}/_SUCCESS")


def child_folders(spark: SparkSession, path: str, complete: bool = False) -> list[str]:
    """Folders directly below a path; only those with a finished write where asked."""
    place, system = _opened(spark, path)
    if not system.exists(place):
        return []
    found = [str(s.getPath().toString()) for s in system.listStatus(place) if s.isDirectory()]
    return [f for f in found if not complete or is_complete(spark, f)]


def delete(spark: SparkSession, path: str) -> None:
    place, system = _opened(spark, path)
    system.delete(place, True)


def listing(spark: SparkSession, folders: list[str]) -> dict[str, int]:
    """Number, bytes, newest change and a hash of the files in some folders, listed by Spark; no file is opened."""
    if not folders:
        return {"files": 0}
    files = spark.read.format("binaryFile").load(folders).select("path", "length", F.unix_micros("modificationTime").alias("changed")).distinct()
    each = F.xxhash64("path", "length", "changed").cast("decimal(38,0)")
    found = files.agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"), F.max("changed").alias("changed"), F.sum(each).cast("string").alias("hash"))
    return found.first().asDict()


def written(df: DataFrame, label: str) -> DataFrame:
    """The frame written below the shared folder and read again, so that what follows does not compute it anew."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    place, system = _opened(spark, path)
    out = system.create(place, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text, null where there is none."""
    place, system = _opened(spark, path)
    if not system.exists(place):
        return None
    stream = system.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
