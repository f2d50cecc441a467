"""Fill-in-middle transformation: a text is cut into prefix, middle and suffix and its parts are put in another order.

Cuts are drawn in code points but texts are UTF-8. A whole Arrow buffer of
texts is viewed as 64-bit words: shifts and masks mark the bytes that end a code
point (the next byte is no continuation byte), ``bitwise_count`` counts them
per word, a running sum finds the word that holds the k-th end, and one
multiplication sums the marks inside that word up to its place. No text is
decoded, and the number of steps does not grow with a text's length.

The draws come from the sha256 of ``1:`` and the doc_id, so any job repeats them.

Cases: a null text counts as empty; an empty text and one that holds a mark
stay plain; a null doc_id draws as ``1:`` alone; rows of one doc_id share their
draws, each for its own length, and repeated rows give repeated results; an empty table gives an
empty one; other columns are ignored. Texts are never shortened.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from prefkit.llm.common import texts_of

# The marks before each part, and the shares of plain texts and of suffix-first orders in a hundred.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_FROM, SUFFIX_FIRST_BELOW = 90, 20
# Bytes of text put together at once; a longer text is taken alone.
BYTES_AT_ONCE = 8 << 20

_TOP = np.uint64(0x8080808080808080)
_LOW = np.uint64(0x0101010101010101)
COLUMNS = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def unit_ends(data: np.ndarray) -> np.ndarray:
    """Words of UTF-8 bytes to words whose top bits mark, byte by byte, the ends of code points.

    ``data`` is padded with at least one zero byte, which starts a unit of its own and so ends the last one.
    """
    words = data.view("<u8")
    # A byte continues a unit when its top bit is set and the next one is not.
    begins = ~(words & ~(words << np.uint64(1))) & _TOP
    ends = begins >> np.uint64(8)
    ends[:-1] |= begins[1:] << np.uint64(56)
    return ends


def select_in_word(marks: np.ndarray, nth: np.ndarray) -> np.ndarray:
    """The byte (0 to 7) of the nth mark, from 1, of each word."""
    upto = (marks >> np.uint64(7)) * _LOW
    reached = ((upto | _TOP) - nth.astype(np.uint64) * _LOW) & _TOP
    return 8 - np.bitwise_count(reached).astype(np.int64)


class UnitIndex:
    """Code points of a byte buffer, by rank."""

    def __init__(self, data: bytes | memoryview):
        size = len(data)
        padded = np.zeros((size // 8 + 1) * 8, np.uint8)
        padded[:size] = np.frombuffer(data, np.uint8)
        self._marks = unit_ends(padded)
        self._upto = np.cumsum(np.bitwise_count(self._marks), dtype=np.int64)

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Units that end before byte ``at``."""
        word, byte = np.divmod(at, 8)
        before = np.where(word > 0, self._upto[word - 1], 0)
        below = (np.uint64(1) << (8 * byte).astype(np.uint64)) - np.uint64(1)
        return before + np.bitwise_count(self._marks[word] & below).astype(np.int64)

    def byte_after(self, rank: np.ndarray) -> np.ndarray:
        """The byte after the unit of this rank, counted from 1; 0 for rank 0."""
        word = np.searchsorted(self._upto, rank, side="left")
        word = np.minimum(word, len(self._upto) - 1)
        before = np.where(word > 0, self._upto[word - 1], 0)
        inside = select_in_word(self._marks[word], np.maximum(rank - before, 1))
        return np.where(rank > 0, 8 * word + inside + 1, 0)


def cut_places(data: memoryview, offsets: np.ndarray, one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, ...]:
    """(units, first cut, second cut, byte of the first, byte of the second) of texts that lie one after another.

    The cuts are ``one`` and ``two`` modulo the units plus one, the smaller first.
    """
    index = UnitIndex(data)
    ranks = index.rank(offsets)
    units, base = np.diff(ranks), ranks[:-1]
    first, second = one % (units + 1), two % (units + 1)
    first, second = np.minimum(first, second), np.maximum(first, second)
    # A cut at the start stays at the text's own start, even where the text before it is empty.
    where = [np.where(cut > 0, index.byte_after(base + cut), offsets[:-1]) for cut in (first, second)]
    return units, first, second, *where


def _rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch that hold about ``BYTES_AT_ONCE``."""
    texts = batch.column("text")
    sizes = np.cumsum(np.asarray(pc.binary_length(texts)))
    low = 0
    while low < batch.num_rows:
        held = sizes[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(sizes, held + BYTES_AT_ONCE, side="right")))
        yield batch.slice(low, high - low)
        low = high


def _transformed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    prefix, suffix, middle = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()
    for whole in batches:
        for batch in _rows(whole):
            texts = batch.column("text").cast(pa.large_string())
            offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
            buffer = texts.buffers()[2]
            data = memoryview(buffer)[offsets[0] : offsets[-1]] if buffer else memoryview(b"")
            offsets = offsets - offsets[0]
            h1, h2, h3, h4 = (batch.column(f"h{i}").to_numpy() for i in (1, 2, 3, 4))
            units, first, second, a, b = cut_places(data, offsets, h1, h2)
            plain = (units == 0) | batch.column("marked").to_numpy(zero_copy_only=False) | (h3 % 100 >= PLAIN_FROM)
            form = np.where(plain, "plain", np.where(h4 % 100 < SUFFIX_FIRST_BELOW, "spm", "psm"))
            out = []
            for kind, start, i, j, end in zip(form.tolist(), offsets[:-1].tolist(), a.tolist(), b.tolist(), offsets[1:].tolist()):
                if kind == "psm":
                    out.append(b"".join((prefix, data[start:i], suffix, data[j:end], middle, data[i:j])))
                elif kind == "spm":
                    out.append(b"".join((suffix, data[j:end], prefix, data[start:i], middle, data[i:j])))
                else:
                    out.append(bytes(data[start:end]))
            # The parts of a valid text cut between its units are valid again.
            output = pa.Array.from_buffers(pa.string(), len(out), pa.array(out, pa.binary()).buffers())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(units),
                    pa.array(form.tolist(), pa.string()),
                    pa.array(first, mask=plain),
                    pa.array(second - first, mask=plain),
                    output,
                ],
                names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )


def fill_middle(docs: DataFrame) -> DataFrame:
    """``COLUMNS``: the transformed text of every document with its form and the sizes of its parts in code points."""
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    marked = F.col("text").contains(PREFIX) | F.col("text").contains(SUFFIX) | F.col("text").contains(MIDDLE)
    rows = texts_of(docs).select("doc_id", "text", marked.alias("marked"), digest.alias("_d"))
    draws = [F.conv(F.substring("_d", 8 * i + 1, 8), 16, 10).cast("bigint").alias(f"h{i + 1}") for i in range(4)]
    return rows.select("doc_id", "text", "marked", *draws).mapInArrow(_transformed, COLUMNS)


def restored(output: Column, form: Column) -> Column:
    """The text a transformed one was made from, put together from its parts."""
    parts = F.split(output, "|".join((PREFIX, SUFFIX, MIDDLE)), -1)
    # Parts by place: psm holds prefix, suffix, middle, spm holds suffix, prefix, middle.
    psm = F.concat(F.get(parts, F.lit(1)), F.get(parts, F.lit(3)), F.get(parts, F.lit(2)))
    spm = F.concat(F.get(parts, F.lit(2)), F.get(parts, F.lit(3)), F.get(parts, F.lit(1)))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def fill_middle_digests(docs: DataFrame) -> DataFrame:
    """The transformed documents with hashes of their output and of the text rebuilt from it."""
    rows = fill_middle(docs)
    return rows.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )
