"""Quality by compression: which of two dictionaries fits a text better.

One zstandard dictionary is built from good and one from bad labelled text.
A text is cut into blocks, so that the dictionary counts all along it, and
each block is compressed with either. The difference of the two sizes over
their sum is mapped to a probability by a logistic curve fitted to labelled
rows the dictionaries have not seen. The curve also takes how far the text
shrinks at all, since a text that only repeats itself fits both dictionaries.

Cases: null and empty texts have difference 0 and do not shrink; repeated rows get equal
scores; without labels of both kinds every score is the share of good labels
(0.5 without any); other columns are ignored. Long texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
import zstandard

from prefkit.llm.common import held_out, learnable, map_slices, stored, texts_of

BLOCK = 2048
DICTIONARY_BYTES = 96 << 10
# Bounds of the labelled sample a dictionary is built from.
SAMPLE_ROWS, SAMPLE_BYTES = 3000, 8 << 20
LEVEL = 3
KEEP_FROM = 0.7
# Steps of the two inputs in the histogram the curve is fitted to.
DIFFERENCE_BINS, RATIO_BINS = 400, 20
SIZES = "doc_id long, raw long, good long, bad long"


def blocks(data: bytes, size: int = BLOCK) -> list[bytes]:
    return [data[i : i + size] for i in range(0, len(data), size)]


def build_dictionary(texts: Iterator[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A trained dictionary; where there is too little text to train one, the text itself."""
    parts: list[bytes] = []
    held = 0
    for text in texts:
        for block in blocks(text):
            if held < SAMPLE_BYTES:
                parts.append(block)
                held += len(block)
    if not parts:
        return b""
    try:
        return zstandard.train_dictionary(min(size, max(256, held // 4)), parts).as_bytes()
    except zstandard.ZstdError:
        return b"".join(parts)[-size:]


def _build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    rows = pd.concat([b for b in batches if len(b)] or [pd.DataFrame({"doc_id": [], "quality": [], "text": []})])
    rows = rows.sort_values(["doc_id", "text"])
    for quality in (0, 1):
        texts = (t.encode("utf-8", "surrogatepass") for t in rows.loc[rows["quality"] == quality, "text"])
        yield pd.DataFrame({"quality": [quality], "dictionary": [build_dictionary(texts)]})


def fit_dictionaries(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> dict[int, bytes]:
    """The dictionaries of bad (0) and good (1) text, built in one task from at most ``sample_rows`` rows each."""
    picked = labels.where(for_dictionary())
    order = (F.xxhash64(F.lit("dictionary"), "doc_id"), "doc_id")
    chosen = picked.where("quality = 0").orderBy(*order).limit(sample_rows)
    chosen = chosen.unionByName(picked.where("quality = 1").orderBy(*order).limit(sample_rows))
    # The broadcast keys are bounded by ``sample_rows``; each text comes with at most ``SAMPLE_BYTES`` code points.
    sample = texts_of(docs).join(F.broadcast(chosen), "doc_id")
    sample = sample.groupBy("doc_id").agg(F.first("quality").alias("quality"), F.min("text").alias("text"))
    sample = sample.select("doc_id", "quality", "text").coalesce(1)
    made = sample.mapInPandas(_build, "quality int, dictionary binary").collect()
    return {row["quality"]: bytes(row["dictionary"]) for row in made}


def for_dictionary() -> Column:
    """Labelled rows are split: half build the dictionaries, half calibrate."""
    return F.pmod(F.xxhash64(F.lit("half"), "doc_id"), F.lit(2)) == 0


class Meter:
    """Compressed size of a text with one dictionary, block by block."""

    def __init__(self, dictionary: bytes):
        shape = zstandard.ZstdCompressionParameters.from_level(
            LEVEL, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=0, write_checksum=0, write_dict_id=0, window_log=18
        )
        known = None
        if dictionary:
            known = zstandard.ZstdCompressionDict(dictionary)
            known.precompute_compress(compression_params=shape)
        self._press = zstandard.ZstdCompressor(compression_params=shape, dict_data=known)

    def size(self, data: bytes) -> int:
        return sum(len(self._press.compress(b)) for b in blocks(data))


def compressed_sizes(docs: DataFrame, dictionaries: dict[int, bytes]) -> DataFrame:
    """doc_id, raw bytes and the compressed sizes with the good and the bad dictionary."""

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        good, bad = Meter(dictionaries.get(1, b"")), Meter(dictionaries.get(0, b""))
        for batch in batches:
            data = [t.encode("utf-8", "surrogatepass") for t in batch["text"]]
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"].astype("Int64").array,
                    "raw": [len(d) for d in data],
                    "good": [good.size(d) for d in data],
                    "bad": [bad.size(d) for d in data],
                }
            )

    return map_slices(texts_of(docs), measure, SIZES)


def difference() -> Column:
    """From -1 to 1; positive where the good dictionary fits better."""
    return F.coalesce((F.col("bad") - F.col("good")) / F.nullif(F.col("bad") + F.col("good"), F.lit(0)), F.lit(0.0))


def ratio() -> Column:
    """Logarithm of compressed over raw size, 0 for an empty text; the 8 keeps short texts near 0."""
    return F.log((F.col("good") + 8) / (F.col("raw") + 8))


@dataclass(frozen=True)
class Curve:
    """P(good) = 1 / (1 + exp(-(difference * slope + ratio * bend + offset)))."""

    slope: float
    bend: float
    offset: float

    def column(self, difference: Column, ratio: Column) -> Column:
        return 1 / (1 + F.exp(-(self.slope * difference + self.bend * ratio + self.offset)))


def fit_curve(inputs: np.ndarray, good: np.ndarray, bad: np.ndarray) -> Curve:
    """Logistic curve by Newton's steps over counts of good and bad rows; a small penalty keeps it finite."""
    n = good.sum() + bad.sum()
    if not good.sum() or not bad.sum():
        share = (good.sum() + 1) / (n + 2) if n else 0.5
        return Curve(0.0, 0.0, float(np.log(share / (1 - share))))
    spread = np.maximum(np.sqrt(np.average(inputs**2, axis=0, weights=good + bad)), 1e-6)
    design = np.column_stack([inputs / spread, np.ones(len(inputs))])
    weights, penalty = np.zeros(3), np.array([1e-2, 1e-2, 1e-6])
    for _ in range(80):
        p = 1 / (1 + np.exp(-np.clip(design @ weights, -30, 30)))
        slope = design.T @ (good - (good + bad) * p) - penalty * weights
        bend = (design * ((good + bad) * p * (1 - p))[:, None]).T @ design + np.diag(penalty)
        step = np.clip(np.linalg.solve(bend, slope), -3, 3)
        weights = weights + step
        if np.abs(step).max() < 1e-9:
            break
    return Curve(float(weights[0] / spread[0]), float(weights[1] / spread[1]), float(weights[2]))


def calibrate(sizes: DataFrame, labels: DataFrame) -> Curve:
    """The curve from every labelled row of the other half, counted in bins of both inputs."""
    counts = (
        sizes.join(labels.where(~for_dictionary()), "doc_id")
        .groupBy(
            F.round(difference() * DIFFERENCE_BINS).cast("int").alias("d"), F.round(ratio() * RATIO_BINS).cast("int").alias("r")
        )
        .agg(F.sum("quality").alias("good"), F.sum(1 - F.col("quality")).alias("bad"))
        .orderBy("d", "r")
        .toPandas()
    )
    inputs = counts[["d", "r"]].to_numpy(float) / [DIFFERENCE_BINS, RATIO_BINS]
    return fit_curve(inputs, counts["good"].to_numpy(float), counts["bad"].to_numpy(float))


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted and the three sizes."""
    known = learnable(labels)
    sizes = stored(compressed_sizes(docs, fit_dictionaries(docs, known)), "sizes")
    curve = calibrate(sizes, known)
    scored = sizes.withColumn("score", curve.column(difference(), ratio()))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= KEEP_FROM).cast("int").alias("predicted"),
        F.col("raw").alias("raw_bytes"),
        F.col("good").alias("good_bytes"),
        F.col("bad").alias("bad_bytes"),
    )
