"""URL rules and block lists in sorted digest arrays.

An entry is a host with a path prefix, written one after the other; it fits
the host, all its subdomains and every path that starts with the prefix. The
index is a set of segment files, each a range of sorted 64-bit xxhash digests
followed by the entries themselves:

    magic 8 bytes | entries int64 | path lengths int64 | those lengths int64 each
    digest int64 each | offset uint64 each and one more | kind uint8 each | entries, UTF-8

Tasks map the segments into memory, so nothing is shuffled or broadcast however
long the list is; pages of the files that no search touches are never read. All
candidates of a batch are probed by one binary search and a hit counts only
if the stored entry is the candidate itself.

Where the shared folder is a mounted one its files are mapped in place;
from any other store Spark hands each executor a copy.

Cases: a null url and one without ``://`` have an empty host and path and fit
nothing, so the verdict is allow; repeated rows are judged alike; equal entries
are kept once, a rule before a listed host; null entries are dropped; an empty
list or table is fine; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
import struct

import numpy as np
import pandas as pd
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
import xxhash

from prefkit.llm.common import raw_files
from prefkit.session import fresh_path

MAGIC = b"URLSEGM1"
HEAD = "<8sqq"
HEAD_BYTES = struct.calcsize(HEAD)
# The seed of Spark's xxhash64.
SEED = 42
SEGMENTS = 16
RULE_BLOCK, RULE_ALLOW, LISTED = 0, 1, 2

# The rules, and the words in a host that put it on the block list.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
BLOCKED_WORDS = ("adult", "ads", "bets", "casino", "pills", "spam")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, ASCII letters in lower case."""
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_entries(spark: SparkSession, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    kinds = {"block": RULE_BLOCK, "allow": RULE_ALLOW}
    return spark.createDataFrame([(host + path, len(path), kinds[verdict]) for host, path, verdict in rules], "entry string, path_chars int, kind int")


def suspicious_hosts(pages: DataFrame, words: Sequence[str] = BLOCKED_WORDS) -> DataFrame:
    """Block-list entries: the distinct hosts of a table that have one of the words between dots and hyphens."""
    hosts = pages.select(host_of(F.col("url")).alias("entry")).distinct()
    listed = F.arrays_overlap(F.split("entry", r"[.-]"), F.array(*[F.lit(w) for w in words]))
    return hosts.where(listed).select("entry", F.lit(0).alias("path_chars"), F.lit(LISTED).alias("kind"))


def write_index(entries: DataFrame, path: str, segments: int = SEGMENTS) -> None:
    """Segment files of (entry, path_chars, kind) rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat([b for b in batches if len(b)] or [pd.DataFrame({"digest": [], "entry": [], "path_chars": [], "kind": []})])
        if not len(rows):
            return
        texts = [e.encode() for e in rows["entry"]]
        lengths = np.unique(rows["path_chars"].to_numpy("<i8"))
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype("<u8")
        columns = [lengths, rows["digest"].to_numpy("<i8"), offsets, rows["kind"].to_numpy("u1")]
        head = struct.pack(HEAD, MAGIC, len(rows), len(lengths))
        yield pd.DataFrame({"blob": [b"".join([head, *[c.tobytes() for c in columns], *texts])]})

    once = entries.where("entry is not null").groupBy("entry").agg(F.min("kind").alias("kind"), F.max("path_chars").alias("path_chars"))
    sorted_rows = (
        once.select(F.xxhash64("entry").alias("digest"), "entry", "path_chars", "kind")
        .repartitionByRange(segments, "digest")
        .sortWithinPartitions("digest", "entry")
    )
    raw_files(sorted_rows.mapInPandas(run, "blob binary"), path)


class Segment:
    """One memory-mapped segment."""

    def __init__(self, path: str):
        data = np.memmap(path, np.uint8, "r")
        magic, n, m = struct.unpack_from(HEAD, data)
        if magic != MAGIC:
            raise ValueError("not a segment of an URL index")

        def column(kind: str, count: int, at: int) -> tuple[np.ndarray, int]:
            end = at + count * np.dtype(kind).itemsize
            return data[at:end].view(kind), end

        self.lengths, at = column("<i8", m, HEAD_BYTES)
        self.digests, at = column("<i8", n, at)
        self._offsets, at = column("<u8", n + 1, at)
        self._kinds, at = column("u1", n, at)
        self._texts = data[at:]

    def find(self, digests: np.ndarray, keys: list[bytes]) -> np.ndarray:
        """The kind of each key, -1 where the index does not hold it."""
        kinds = np.full(len(keys), -1, np.int64)
        at = np.searchsorted(self.digests, digests)
        todo = np.flatnonzero(at < len(self.digests))
        while len(todo := todo[self.digests[at[todo]] == digests[todo]]):
            for i in todo:
                low, high = int(self._offsets[at[i]]), int(self._offsets[at[i] + 1])
                if self._texts[low:high].tobytes() == keys[i]:
                    kinds[i] = self._kinds[at[i]]
            # Another entry may have the same digest.
            at[todo] += 1
            todo = todo[(kinds[todo] < 0) & (at[todo] < len(self.digests))]
        return kinds


_mapped: dict[tuple[str, ...], list[Segment]] = {}


def open_segments(files: tuple[str, ...], copied: bool) -> list[Segment]:
    """Mapped once per Python worker."""
    if files not in _mapped:
        _mapped.clear()
        _mapped[files] = [Segment(SparkFiles.get(f) if copied else f) for f in files]
    return _mapped[files]


def index_files(spark: SparkSession, path: str) -> tuple[tuple[str, ...], bool]:
    """The segment files every task can open, and whether Spark has to hand them out. At most one file per segment."""
    rows = spark.read.format("binaryFile").load(path).where(F.col("length") > HEAD_BYTES).select("path").collect()
    files = sorted(row["path"] for row in rows)
    if all(f.startswith("file:") for f in files):
        return tuple("/" + f.removeprefix("file:").lstrip("/") for f in files), False
    for f in files:
        spark.sparkContext.addFile(f)
    return tuple(f.rsplit("/", 1)[-1] for f in files), True


def suffixes(host: str) -> list[str]:
    """The host and every domain above it."""
    out = [host]
    while "." in host:
        host = host.split(".", 1)[1]
        out.append(host)
    return out


def probe(hosts: Sequence[str], paths: Sequence[str], segments: list[Segment]) -> pd.DataFrame:
    """rule (the longest that fits, or null), its kind, and whether a listed entry fits."""
    lengths = sorted({int(n) for s in segments for n in s.lengths})
    keys: dict[str, int] = {}
    asked = []
    for host, path in zip(hosts, paths, strict=True):
        fit = [path[:n] for n in lengths if len(path) >= n]
        asked.append([keys.setdefault(domain + prefix, len(keys)) for domain in suffixes(host) for prefix in fit] if host else [])
    names = list(keys)
    data = [k.encode("utf-8", "surrogatepass") for k in names]
    digests = np.array([xxhash.xxh64_intdigest(k, SEED) for k in data], np.uint64).view(np.int64)
    kinds = np.full(len(names), -1, np.int64)
    for segment in segments:
        kinds = np.maximum(kinds, segment.find(digests, data))
    out = []
    for candidates in asked:
        rules = [i for i in candidates if kinds[i] in (RULE_BLOCK, RULE_ALLOW)]
        best = max(rules, key=lambda i: len(names[i]), default=None)
        out.append((None if best is None else names[best], -1 if best is None else int(kinds[best]), any(kinds[i] == LISTED for i in candidates)))
    return pd.DataFrame(out, columns=["rule", "kind", "listed"])


def judge(pages: DataFrame, path: str) -> DataFrame:
    """page_id, host, path, rule, verdict and whether the block list has the host, by the index at ``path``."""
    files, copied = index_files(pages.sparkSession, path)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        segments = open_segments(files, copied)
        for batch in batches:
            found = probe(batch["host"], batch["path"], segments)
            verdict = np.where(found["rule"].notna(), found["kind"] == RULE_BLOCK, found["listed"])
            yield pd.DataFrame(
                {
                    "page_id": batch["page_id"].astype("Int64").array,
                    "host": batch["host"].array,
                    "path": batch["path"].array,
                    "rule": found["rule"].array,
                    "verdict": np.where(verdict, "block", "allow"),
                    "listed": found["listed"].array,
                }
            )

    url = F.col("url").cast("string")
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    return rows.mapInPandas(run, "page_id long, host string, path string, rule string, verdict string, listed boolean")


def judge_pages(pages: DataFrame) -> DataFrame:
    """The fixed rules, and for urls without one a block list of the table's own suspicious hosts."""
    spark = pages.sparkSession
    path = fresh_path(spark, "url-index")
    write_index(rule_entries(spark).unionByName(suspicious_hosts(pages)), path)
    return judge(pages, path)
