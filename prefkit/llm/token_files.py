"""Token ids in binary shard files, each document compressed alone with one shared dictionary.

A dictionary is trained once on a bounded sample of serialised id arrays and
written beside the shards under its hash. A shard holds consecutive documents
in ascending doc_id order:

    magic 8 bytes | dictionary's sha256, 32 bytes | part, shard: int32 | documents: int64 | id width: int32 | crc32 of all that follows: uint32
    doc_id int64 each | null flag uint8 each | number of ids uint32 each | offset uint64 each and one more | frames

so that one short document is read by its offset without its neighbours. A small index beside the shards
holds each one's path, range of doc_ids and number of ids: a document is found by opening the shards whose
range holds it. Ids take two bytes where the vocabulary allows it. Spark's text writer puts the
bytes of a shard, one per file, through the same commit as any table, so a
repeated task leaves no half-written shard, and any file system Spark knows will do; the checksum
tells a shard whose bytes were changed on the way. A shard is one row while it is written, held a few times over in
a worker and the JVM, so its size is a parameter that executors' memory bounds.

Cases: a null text counts as empty; an empty text has the end id alone;
null doc_ids come first; repeated rows and rows of one doc_id are kept, next to
each other; an empty table gives no shard and no row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
import hashlib
import struct
import zlib

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F
import zstandard

from prefkit.llm.common import map_slices, raw_files, texts_of
from prefkit.llm.word_cache import WordCache
from prefkit.session import fresh_path

MAGIC = b"TOKSHRD2"
HEAD = "<8s32siiqiI"
HEAD_BYTES = struct.calcsize(HEAD)
END_ID = 2
SAMPLE_ROWS, SAMPLE_BYTES, DICTIONARY_BYTES = 2000, 8 << 20, 64 << 10
SHARD_BYTES = 64 << 20
# Pieces of text a task remembers.
PIECES = 600_000
# Documents encoded or decoded at once.
ROWS = 1024
LEVEL = 3


def _serialise(ids: bytes, width: int) -> bytes:
    return ids if width == 4 else np.frombuffer(ids, "<u4").astype("<u2").tobytes()


def _width(vocabulary: int) -> int:
    return 2 if vocabulary <= 1 << 16 else 4


def train(samples: list[bytes]) -> bytes:
    """A dictionary; of too little data, the data itself."""
    total = sum(map(len, samples))
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, max(256, total // 8)), samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:] or b"\0" * 8


def sampled(docs: DataFrame, sample_rows: int) -> DataFrame:
    """At most ``sample_rows`` different documents, those with the smallest hashes, in one partition.

    The table is read by all tasks; only the sample moves.
    """
    rows = texts_of(docs).select("doc_id", "text", F.xxhash64("doc_id", "text").alias("_h"))
    chosen = rows.select("_h").distinct().orderBy("_h").limit(sample_rows)
    # The broadcast hashes are bounded by ``sample_rows``, and so is what is left of equal rows.
    sample = rows.join(F.broadcast(chosen), "_h", "left_semi").groupBy("_h").agg(F.first("text").alias("text"))
    return sample.repartition(1).sortWithinPartitions("_h").select("text")


def fit_dictionary(docs: DataFrame, tokenizer: str, end_id: int = END_ID, sample_rows: int = SAMPLE_ROWS) -> bytes:
    """Trained on ``sampled`` documents, up to ``SAMPLE_BYTES`` of ids."""
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache, samples, held = WordCache(tokenizer), [], 0
        for batch in batches:
            for text in batch["text"]:
                if held < SAMPLE_BYTES:
                    samples.append(_serialise(cache.ids(text) + end, _width(cache.vocabulary)))
                    held += len(samples[-1])
        yield pd.DataFrame({"dictionary": [train(samples)]})

    made = map_slices(sampled(docs, sample_rows), run, "dictionary binary").first()
    return train([]) if made is None else bytes(made["dictionary"])


class ShardWriter:
    """Collects the documents of one shard and puts its bytes together."""

    def __init__(self, dictionary: bytes, width: int, shard_bytes: int):
        self._most = shard_bytes
        self._press = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary), write_dict_id=False)
        self._hash, self._width = hashlib.sha256(dictionary).digest(), width
        self._clear()

    def _clear(self) -> None:
        self._ids, self._null, self._counts, self._frames, self.size = [], [], [], [], 0

    def __len__(self) -> int:
        return len(self._ids)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self._ids.append(0 if doc_id is None else doc_id)
        self._null.append(doc_id is None)
        self._counts.append(len(ids) // 4)
        self._frames.append(self._press.compress(_serialise(ids, self._width)))
        self.size += len(self._frames[-1])

    def full(self) -> bool:
        # The index of a document takes 21 bytes.
        return self.size + 21 * len(self) >= self._most

    def close(self, part: int, shard: int) -> bytes:
        offsets = np.concatenate([[0], np.cumsum([len(f) for f in self._frames])]).astype("<u8")
        columns = [np.array(self._ids, "<i8"), np.array(self._null, "u1"), np.array(self._counts, "<u4"), offsets]
        tables, check = [c.tobytes() for c in columns], 0
        for piece in (*tables, *self._frames):
            check = zlib.crc32(piece, check)
        head = struct.pack(HEAD, MAGIC, self._hash, part, shard, len(self), self._width, check)
        data = b"".join([head, *tables, *self._frames])
        self._clear()
        return data


class Shard:
    """A shard's bytes, read by its index."""

    def __init__(self, data: bytes):
        magic, self.dictionary_hash, self.part, self.shard, n, self.width, check = struct.unpack_from(HEAD, data)
        # The text writer ends every file with a line end.
        if magic != MAGIC or zlib.crc32(memoryview(data)[HEAD_BYTES:-1]) != check:
            raise ValueError("not a token shard, or a damaged one")
        at = HEAD_BYTES
        self.doc_ids = np.frombuffer(data, "<i8", n, at)
        self.null = np.frombuffer(data, "u1", n, at + 8 * n).astype(bool)
        self.counts = np.frombuffer(data, "<u4", n, at + 9 * n).astype(np.int64)
        self._offsets = np.frombuffer(data, "<u8", n + 1, at + 13 * n).astype(np.int64)
        self._frames = memoryview(data)[at + 21 * n + 8 :]

    def reader(self, dictionary: bytes) -> zstandard.ZstdDecompressor:
        if hashlib.sha256(dictionary).digest() != self.dictionary_hash:
            raise ValueError("the shard was written with another dictionary")
        return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))

    def ids(self, i: int, reader: zstandard.ZstdDecompressor) -> bytes:
        """Ids of the i-th document, as little-endian unsigned 32-bit integers."""
        raw = reader.decompress(self._frames[self._offsets[i] : self._offsets[i + 1]])
        return raw if self.width == 4 else np.frombuffer(raw, "<u2").astype("<u4").tobytes()


def write_token_files(docs: DataFrame, tokenizer: str, path: str, end_id: int = END_ID, shard_bytes: int = SHARD_BYTES) -> None:
    """Writes ``path/dictionary``, ``path/shards`` and ``path/index``."""
    dictionary = fit_dictionary(docs, tokenizer, end_id)
    end = int(end_id).to_bytes(4, "little")
    spark = docs.sparkSession
    raw_files(spark.createDataFrame([(bytearray(dictionary),)], "blob binary").coalesce(1), f"{path}/dictionary")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache, part, number = WordCache(tokenizer, PIECES), TaskContext.get().partitionId(), 0
        shard = ShardWriter(dictionary, _width(cache.vocabulary), shard_bytes)
        for batch in batches:
            for doc_id, ids in zip(batch["doc_id"].astype("Int64"), cache.ids_of(batch["text"].tolist()), strict=True):
                shard.add(None if doc_id is pd.NA else int(doc_id), ids + end)
                if shard.full():
                    yield pd.DataFrame({"blob": [shard.close(part, number)]})
                    number += 1
        if len(shard):
            yield pd.DataFrame({"blob": [shard.close(part, number)]})

    # Equal ids are told apart by text and row, so that no id is too frequent for a range.
    order = ["doc_id", "_th", "_row"]
    rows = texts_of(docs).select("*", F.xxhash64("text").alias("_th"), F.monotonically_increasing_id().alias("_row"))
    laid = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    raw_files(map_slices(laid.select("doc_id", "text"), run, "blob binary", rows=ROWS), f"{path}/shards")
    _write_index(spark, path)


def read_dictionary(spark: SparkSession, path: str) -> bytes:
    rows = spark.read.format("binaryFile").load(f"{path}/dictionary").select("content").take(1)
    return bytes(rows[0]["content"])[:-1]


def _shards(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def _write_index(spark: SparkSession, path: str) -> None:
    def heads(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for place, data in zip(batch["path"], batch["content"], strict=True):
                if len(data) > HEAD_BYTES:
                    found = Shard(data)
                    known = found.doc_ids[~found.null]
                    low, high = (int(known.min()), int(known.max())) if len(known) else (None, None)
                    rows = [(place, found.part, found.shard, low, high, int(found.counts.sum()))]
                    yield pd.DataFrame(rows, columns=["path", "part", "shard", "low", "high", "n"]).astype({"low": "Int64", "high": "Int64"})

    map_slices(_shards(spark, f"{path}/shards"), heads, INDEX, rows=1).write.parquet(f"{path}/index")


INDEX = "path string, part long, shard long, low long, high long, n long"


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """``INDEX``: one row per shard, its file, the least and greatest doc_id and the number of ids."""
    return spark.read.schema(INDEX).parquet(f"{path}/index")


def shard_starts(spark: SparkSession, path: str) -> DataFrame:
    """(part, shard, first): the number of ids before each shard, from the index alone."""
    sizes = read_index(spark, path).select("part", "shard", "n")
    before = (W.unboundedPreceding, -1)
    # One row per written partition in the first sum, the shards of one partition in the second.
    parts = sizes.groupBy("part").agg(F.sum("n").alias("_n"))
    parts = parts.select("part", F.coalesce(F.sum("_n").over(W.orderBy("part").rowsBetween(*before)), F.lit(0)).alias("_first"))
    inside = F.coalesce(F.sum("n").over(W.partitionBy("part").orderBy("shard").rowsBetween(*before)), F.lit(0))
    return sizes.withColumn("_in", inside).join(parts, "part").select("part", "shard", (F.col("_first") + F.col("_in")).alias("first"))


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids of every document in the files."""
    dictionary = read_dictionary(spark, path)

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for data in batch["content"]:
                if len(data) <= HEAD_BYTES:
                    continue
                shard = Shard(data)
                reader, n = shard.reader(dictionary), len(shard.counts)
                starts = np.cumsum(shard.counts) - shard.counts
                for low in range(0, n, ROWS):
                    rows = range(low, min(n, low + ROWS))
                    yield pd.DataFrame(
                        {
                            "part": shard.part,
                            "shard": shard.shard,
                            "doc_id": pd.array(shard.doc_ids[low : low + ROWS], "Int64"),
                            "at": starts[low : low + ROWS],
                            "n_tokens": shard.counts[low : low + ROWS],
                            "ids": [shard.ids(i, reader) for i in rows],
                            "null": shard.null[low : low + ROWS],
                        }
                    )

    rows = map_slices(
        _shards(spark, f"{path}/shards").select("content"), decode, "part long, shard long, doc_id long, at long, n_tokens long, ids binary, null boolean", rows=1
    )
    return rows.withColumn("doc_id", F.when(~F.col("null"), F.col("doc_id"))).drop("null")


def read_documents(spark: SparkSession, path: str, wanted: list[int]) -> DataFrame:
    """doc_id, ids of a few documents. Only shards whose range holds one are opened; other documents stay compressed."""
    dictionary = read_dictionary(spark, path)

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for data in batch["content"]:
                shard = Shard(data)
                hits = np.flatnonzero(np.isin(shard.doc_ids, wanted) & ~shard.null)
                if len(hits):
                    reader = shard.reader(dictionary)
                    yield pd.DataFrame({"doc_id": shard.doc_ids[hits], "ids": [shard.ids(i, reader) for i in hits]})

    asked = spark.createDataFrame([(int(i),) for i in wanted], "doc_id long")
    # As many paths as documents asked for, unless one of them fills several shards.
    places = [r["path"] for r in read_index(spark, path).join(asked, F.col("doc_id").between(F.col("low"), F.col("high")), "left_semi").select("path").collect()]
    if not places:
        return spark.createDataFrame([], "doc_id long, ids binary")
    return map_slices(_shards(spark, places).select("content"), find, "doc_id long, ids binary", rows=1)


def round_trip(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Writes a documents table and reads it back: doc_id, start, n_tokens, ids_crc32."""
    spark = docs.sparkSession
    path = fresh_path(spark, "token-files")
    write_token_files(docs, tokenizer, path)
    rows = read_token_files(spark, path).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    found = rows.join(shard_starts(spark, path), ["part", "shard"])
    return found.select("doc_id", (F.col("first") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
