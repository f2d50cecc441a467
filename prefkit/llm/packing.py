"""Packing of tokenised documents into sequences of equal length and balanced cost.

A sequence's cost is estimated as ``LINEAR`` per token plus ``QUADRATIC`` per
squared length of each piece in it, since attention stays inside a document.
A document's full-length pieces make sequences of their own. The remaining
pieces of a window of documents are assigned from the longest down, each to
the sequence of lowest cost that has room for it; a piece that fits nowhere is
cut. There are as many sequences as the tokens fill, so none is padded; what
is left at the end of a partition goes to sequences whose lengths are powers of two.

Windows are formed inside the partitions a table is read in: nothing is
shuffled, memory is bounded by a window, and a lost task gives the same
sequences again.

Cases: a null text counts as empty; an empty text has the end id alone; long
texts are cut, never shortened; repeated rows and repeated or null doc_ids are
packed like any other row; an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from prefkit.llm.common import map_slices, texts_of
from prefkit.llm.word_cache import WordCache

LENGTH, END_ID = 2048, 1
LINEAR, QUADRATIC = 1.0, 1 / 1024
WINDOW_TOKENS = 1 << 20
SEQUENCE_BITS = 33

PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"

# A piece: (row, start, length); a placed piece adds (sequence, offset).
Piece = tuple[int, int, int]


def powers_of_two(n: int) -> list[int]:
    return [1 << bit for bit in range(n.bit_length() - 1, -1, -1) if n >> bit & 1]


def assign(pieces: list[Piece], capacities: list[int], linear: float = LINEAR, quadratic: float = QUADRATIC) -> list[tuple[Piece, int, int]]:
    """Places pieces whose lengths sum to the capacities' sum; returns (piece, sequence, offset)."""
    room = np.array(capacities, np.int64)
    cost = np.zeros(len(room))
    size = room.copy()
    placed = []
    todo = sorted(pieces, key=lambda p: (p[2], p[0], p[1]))
    while todo:
        row, start, length = todo.pop()
        fits = np.flatnonzero(room >= length)
        if len(fits):
            at = int(fits[cost[fits].argmin()])
        else:
            at = int(room.argmax())
            # The rest of a cut piece is placed next; no waiting piece is longer than the room was.
            todo.append((row, start + int(room[at]), length - int(room[at])))
            length = int(room[at])
        placed.append(((row, start, length), at, int(size[at] - room[at])))
        room[at] -= length
        cost[at] += linear * length + quadratic * length * length
    return placed


def split_off(pieces: list[Piece], tokens: int) -> tuple[list[Piece], list[Piece]]:
    """(kept, carried): the shortest pieces, the last of them cut, carry exactly ``tokens``."""
    order = sorted(pieces, key=lambda p: (-p[2], p[0], p[1]))
    carried = []
    while tokens:
        row, start, length = order.pop()
        if length > tokens:
            order.append((row, start, length - tokens))
            start, length = start + length - tokens, tokens
        carried.append((row, start, length))
        tokens -= length
    return order, carried


class Packer:
    """Packs the documents of one partition, window by window."""

    def __init__(self, length: int, first_sequence: int, linear: float, quadratic: float):
        self._length, self._next, self._cost = length, first_sequence, (linear, quadratic)
        self._rows: dict[int, tuple[object, bytes]] = {}
        self._pieces: list[Piece] = []
        self._count = self._tokens = 0
        self._out: list[tuple] = []

    def _emit(self, piece: Piece, sequence: int, offset: int) -> None:
        row, start, length = piece
        doc_id, ids = self._rows[row]
        self._out.append((doc_id, start, length, ids[4 * start : 4 * (start + length)], len(ids) // 4, sequence, offset))

    def add(self, doc_id: object, ids: bytes) -> None:
        row, total = self._count, len(ids) // 4
        self._count += 1
        self._rows[row] = (doc_id, ids)
        whole = total - total % self._length
        for start in range(0, whole, self._length):
            self._emit((row, start, self._length), self._next, 0)
            self._next += 1
        if total > whole:
            self._pieces.append((row, whole, total - whole))
            self._tokens += total - whole
        else:
            del self._rows[row]

    def full(self) -> bool:
        return self._tokens >= WINDOW_TOKENS

    def close_window(self, last: bool) -> None:
        total = sum(length for _, _, length in self._pieces)
        capacities, carried, pieces = [self._length] * (total // self._length), [], self._pieces
        if last:
            capacities += powers_of_two(total % self._length)
        else:
            pieces, carried = split_off(pieces, total % self._length)
        for piece, sequence, offset in assign(pieces, capacities, *self._cost):
            self._emit(piece, self._next + sequence, offset)
        self._next += len(capacities)
        self._pieces, self._tokens = carried, sum(length for _, _, length in carried)
        self._rows = {row: self._rows[row] for row, _, _ in carried}

    def take(self) -> pd.DataFrame:
        rows = pd.DataFrame(self._out, columns=[part.split()[0] for part in PIECES.split(", ")])
        self._out = []
        return rows.astype({"doc_id": "Int64"})


def pack(
    docs: DataFrame,
    tokenizer: str,
    length: int = LENGTH,
    end_id: int = END_ID,
    linear: float = LINEAR,
    quadratic: float = QUADRATIC,
) -> DataFrame:
    """One row per piece, ``PIECES``; ``ids`` are little-endian unsigned 32-bit integers."""
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache = WordCache(tokenizer)
        packer = Packer(length, TaskContext.get().partitionId() << SEQUENCE_BITS, linear, quadratic)
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].astype("Int64"), batch["text"], strict=True):
                packer.add(doc_id, cache.ids(text) + end)
                if packer.full():
                    packer.close_window(last=False)
                    yield packer.take()
        packer.close_window(last=True)
        yield packer.take()

    return map_slices(texts_of(docs), run, PIECES)


def packed_digests(docs: DataFrame, tokenizer: str) -> DataFrame:
    """The pieces with a checksum in place of their ids."""
    rows = pack(docs, tokenizer)
    return rows.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
