"""Removal of repeated lines, exact and fuzzy, from a documents table.

A line is normalised: lower case, and every run of characters that are neither
letters nor digits becomes one space. Lines of fewer than ``MIN_WORDS`` words
are left alone. Equal lines are reduced to their first occurrence by (doc_id,
line). The distinct lines get a SimHash of their distinct words, ``BITS`` bits in ``BITS / 8`` blocks of
eight. By the pigeonhole principle hashes that differ in few bits agree in many blocks, and lines meet where they agree in
two: in one of ``PAIRS`` of blocks, every block with its neighbour and with the seventh next. (Any two hashes that differ in
at most seven bits agree in nine blocks, and of nine of sixteen in a ring two are neighbours: these always meet. Of all links between the
real lines of the test data, at 0.8 and above, nine in ten are found; see the README.) Hashes at most
``NEAR_BITS`` apart make candidates, candidates that hang together a candidate
group, and inside a group every pair of near hashes is verified: the edit similarity
(1 - distance / longer length, in characters of the normalised lines) must
reach the threshold. Of the lines that verified links connect, the first
occurrence stays and all others are removed.

Nothing lists all pairs: a block's lines are compared as arrays and leave one
link towards their group each, and a group is verified in cells of two slices of
its lines, where a pair already connected is not compared again. In a large table chance links make one group of lines that have nothing else in
common; slices hold lines of about one length, and only slices whose lengths allow the similarity meet.

Cases: null and empty texts have no lines to remove; empty lines stay; rows of
one doc_id are ordered by a hash of their text, and repeated rows are one
document, so they get equal results; a null doc_id comes first; an empty table
gives an empty one; other columns are ignored. Long lines are compared whole.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from fractions import Fraction
import hashlib
from itertools import chain, combinations, pairwise, product
import re
import sys

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType
import xxhash

from prefkit.llm.common import byte_items, stored
from prefkit.llm.components import connected_groups

MIN_WORDS = 5
SIMILARITY = Fraction(4, 5)
BITS, NEAR_BITS = 128, 28
BLOCKS = BITS // 8
PAIRS = [(k, (k + step) % BLOCKS) for step in (1, 7) for k in range(BLOCKS)]
# Characters and distinct words of lines hashed at once; lines per bucket of block values, and at most; lines per slice and per cell of groups.
CUT_CHARS, HELD_WORDS, BUCKET_LINES, MOST_LINES, SLICE, CELL_LINES = 1 << 21, 20_000, 50_000, 500_000, 512, 4000
# Slices of the lines of one length in a group, at most; lengths further apart than one step of STEP are too far for the similarity (1.25).
MOST_SLICES, STEP = 16, 1.26
# Rows and columns of hashes in a tile of many columns, columns that are many, and the most rows in a tile of few and pairs in all tiles at hand.
TILE, TILE_COLUMNS, WIDE, FEW_ROWS, AT_HAND = 64, 4096, 512, 16, 1 << 18
LOWEST = -(2**63)
# Lines whose pairs are listed one by one.
FEW = 8
# Words ahead, of both lines together, among which two lines that part are sought to meet again.
AHEAD = 7

_BETWEEN = re.compile(r"[^\w\n]+")
IN_WORD = np.zeros(sys.maxunicode + 1, bool)
IN_WORD[[c.start() for c in re.finditer(r"[^\W_]", "".join(map(chr, range(len(IN_WORD)))))]] = True
# Lengths beyond two bytes count as the largest, which lets more pairs through to their verification.
RECORD = np.dtype([("chars", "<u2"), ("line", "<i8"), ("hash", "<u8", (2,))])
LINES = "line binary, hash binary, chars int, doc long, th long, at int"


def normalised(text: str) -> list[str]:
    """The normalised lines of a text."""
    return [line.strip(" ") for line in _BETWEEN.sub(" ", text.lower().replace("_", " ")).split("\n")]


def normalise(line: str) -> str:
    return normalised(line)[0]


def _votes(words: Iterable[bytes]) -> np.ndarray:
    """A row of ``BITS`` bytes for each word, one where its hash has a one, eight to a machine word."""
    # Hashing a word takes less time than finding its digest among those of many others.
    digests = b"".join(map(xxhash.xxh3_128_digest, words))
    return np.unpackbits(np.frombuffer(digests, np.uint8)).view("<u8").reshape(-1, BITS // 8)


def _majorities(votes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """SimHashes, as bytes, of lines whose distinct words' votes follow each other, ``sizes`` to a line.

    The ones of a bit are counted in bytes, eight to a machine word, 255 words of a line at a time.
    """
    parts = -(-sizes // 255)
    first = np.cumsum(parts) - parts
    nth = np.arange(parts.sum()) - np.repeat(first, parts)
    begins = np.repeat(np.cumsum(sizes) - sizes, parts) + 255 * nth
    counts = np.add.reduceat(votes, begins, axis=0).view(np.uint8).reshape(-1, BITS)
    total = np.add.reduceat(counts, first, axis=0, dtype=np.int32) if len(counts) > len(sizes) else counts.astype(np.int32)
    return np.packbits(2 * total > sizes[:, None], axis=1)


def simhashes(lines: Sequence[bytes]) -> list[bytes]:
    """SimHashes of normalised lines. Each distinct word votes once; else frequent words would make all long lines alike."""
    sets = [set(line.split(b" ")) for line in lines]
    sizes = np.array([len(words) for words in sets], np.int64)
    return [h.tobytes() for h in _majorities(_votes(chain.from_iterable(sets)), sizes)]


def _segments(text: str) -> Iterator[tuple[int, str]]:
    """(number of the first line, whole lines) of a text, about ``CUT_CHARS`` characters at a time."""
    begin = at = 0
    while (end := text.find("\n", begin + CUT_CHARS)) >= 0:
        yield at, text[begin:end]
        at += text.count("\n", begin, end) + 1
        begin = end + 1
    yield at, text[begin:]


def hashed_lines(texts: Sequence[str]) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash of the text, SimHash, characters, number of its text and number in it of every line of lower-case texts that counts.

    The texts are one array of characters; the words are its runs of letters and digits, and every distinct one is hashed once.
    """
    joined = "\n".join([*texts, ""])
    chars = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
    inside = IN_WORD[chars]
    after = np.append(False, inside[:-1])
    starts, ends = np.flatnonzero(inside & ~after), np.flatnonzero(after & ~inside)
    line_of = np.searchsorted(np.flatnonzero(chars == 10), starts)
    n_words = np.bincount(line_of, minlength=1)
    lines = np.flatnonzero(n_words >= MIN_WORDS)
    word_edge = np.append(0, np.cumsum(n_words))

    # What is between two words becomes one space; behind the last of a line it is cut off below.
    plain = np.where(inside, chars, np.uint32(32))[inside | after]
    data = plain.tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")
    sizes = np.uint8(1) + (plain >= 0x80) + (plain >= 0x800) + (plain >= 0x10000)
    char_at = np.append(0, np.cumsum(ends - starts + 1))
    byte_at = np.append(0, np.cumsum(sizes, dtype=np.int32))[char_at].astype(np.int32)
    first, behind = word_edge[lines], word_edge[lines + 1]
    n_chars = char_at[behind] - char_at[first] - 1
    places = zip(byte_at[first].tolist(), (byte_at[behind] - 1).tolist(), strict=True)
    keys = [hashlib.blake2b(data[low:high], digest_size=16).digest() for low, high in places]

    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(byte_at), pa.py_buffer(data)]).dictionary_encode()
    counted = np.repeat(np.arange(len(lines)), n_words[lines])
    code = words.indices.to_numpy()[(n_words >= MIN_WORDS)[line_of]]
    # Sorted by line and word, a word of a line is met once.
    pairs = np.sort(counted << 32 | code)
    pairs = pairs[np.append(True, pairs[1:] != pairs[:-1])] if len(pairs) else pairs
    votes = _votes(byte_items(words.dictionary, 1))
    hashes = np.empty((len(lines), BITS // 8), np.uint8)
    sizes, code = np.bincount(pairs >> 32, minlength=len(lines)), pairs & 0xFFFFFFFF
    edge = np.append(0, np.cumsum(sizes))
    low = 0
    while low < len(lines):
        high = max(low + 1, int(np.searchsorted(edge, edge[low] + HELD_WORDS, "right")) - 1)
        hashes[low:high] = _majorities(votes[code[edge[low] : edge[high]]], sizes[low:high])
        low = high

    heads = np.cumsum([0, *[text.count("\n") + 1 for text in texts]])
    text_of = np.searchsorted(heads, lines, "right") - 1
    return keys, hashes, n_chars, text_of, lines - heads[text_of]


def line_rows(keyed: DataFrame) -> DataFrame:
    """``LINES``: every line that counts, with the hash of its text, its SimHash and its number ``at`` in the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(at, 512) for whole in batches for at in range(0, whole.num_rows, 512)):
            parts, held = [], 0
            for doc, th, text in zip(*(batch[name].to_pylist() for name in ("doc", "th", "text")), strict=True):
                for at, lines in _segments(text.lower()):
                    parts.append((doc, th, at, lines))
                    held += len(lines)
                    if held >= CUT_CHARS:
                        yield made(parts)
                        parts, held = [], 0
            if parts:
                yield made(parts)

    def made(parts: list[tuple[int, int, int, str]]) -> pa.RecordBatch:
        docs, ths, begins, texts = zip(*parts, strict=True)
        keys, hashes, chars, part, at = hashed_lines(texts)
        doc, th, begin = (np.array(column, np.int64)[part] for column in (docs, ths, begins))
        edges = pa.py_buffer(16 * np.arange(len(keys) + 1, dtype=np.int32))
        line, simhash = (pa.Array.from_buffers(pa.binary(), len(keys), [None, edges, pa.py_buffer(data)]) for data in (b"".join(keys), hashes))
        numbers = (chars.astype(np.int32), doc, th, (begin + at).astype(np.int32))
        return pa.RecordBatch.from_arrays([line, simhash, *map(pa.array, numbers)], ["line", "hash", "chars", "doc", "th", "at"])

    return keyed.select("doc", "th", "text").mapInArrow(run, LINES)


def _values(hashes: np.ndarray, pair: tuple[int, int]) -> np.ndarray:
    """What the hashes hold in a pair of blocks."""
    raw = hashes.view(np.uint8).reshape(len(hashes), -1)
    one, other = pair
    return (raw[:, one].astype(np.uint16) << 8) | raw[:, other]


def _blocks(n: int) -> tuple[list[list[tuple[int, int]]], int, int]:
    """For ``n`` lines: the pairs of blocks whose lines come together, the bits they come together by and the buckets of each.

    A block is in the first place of several pairs, so lines with the same value of that block are sent once for all of them.
    A table of so many lines that those of one value would be too many sends them by both blocks, once per pair.
    """
    if n <= MOST_LINES << 8:
        return [[pair for pair in PAIRS if pair[0] == k] for k in range(BLOCKS)], 8, min(256, max(1, n // BUCKET_LINES))
    return [[pair] for pair in PAIRS], 16, n // BUCKET_LINES


def block_rows(distinct: DataFrame, n: int) -> DataFrame:
    """(bucket, lines): packed ``RECORD``s by block, or pair of blocks, and value."""
    together, bits, buckets = _blocks(n)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            out = np.empty(len(batch), RECORD)
            out["line"], out["chars"] = batch["id"].to_numpy(), np.minimum(batch["chars"].to_numpy(), 65_535)
            out["hash"] = np.frombuffer(b"".join(batch["hash"]), "<u8").reshape(len(batch), -1)
            hashes = np.ascontiguousarray(out["hash"])
            rows = []
            for nth, pairs in enumerate(together):
                value = _values(hashes, pairs[0]) >> (16 - bits)
                bucket = (value.astype(np.int64) * buckets) >> bits
                order = np.argsort(bucket, kind="stable")
                sorted_rows, at = out[order], bucket[order]
                cuts = [0, *(np.flatnonzero(np.diff(at)) + 1).tolist(), len(at)]
                rows += [(nth * buckets + int(at[i]), sorted_rows[i:j].tobytes()) for i, j in pairwise(cuts)]
            yield pd.DataFrame(rows, columns=["bucket", "lines"])

    return distinct.select("id", "hash", "chars").mapInPandas(run, "bucket long, lines binary")


def _join(label: np.ndarray, one: np.ndarray, other: np.ndarray) -> None:
    """Join lines pairwise: ``label`` has the smallest line each hangs together with, before and after."""
    while True:
        one, other = label[one], label[other]
        apart = one != other
        if not apart.any():
            return
        one, other = one[apart], other[apart]
        np.minimum.at(label, np.maximum(one, other), np.minimum(one, other))
        while not np.array_equal(further := label[label], label):
            label[:] = further


def _near_tiles(
    one_half: np.ndarray, other_half: np.ndarray, begin: np.ndarray, end: np.ndarray, label: np.ndarray, near_bits: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, columns, bits apart) of near hashes, some at a time: each of the first lines with lines ``begin`` to ``end``.

    Columns that ``label``, which may change meanwhile, has connected with all rows at hand are left.
    """
    for low in range(0, len(begin), TILE):
        high = min(low + TILE, len(begin))
        rows = slice(low, high)
        last = int(end[rows].max())
        for left in range(int(begin[rows].min()), last, TILE_COLUMNS):
            columns = np.arange(left, min(left + TILE_COLUMNS, last))
            if (label[rows] == label[low]).all():
                columns = columns[label[columns] != label[low]]
                if not len(columns):
                    continue
            apart = np.bitwise_count(one_half[rows, None] ^ one_half[columns])
            apart += np.bitwise_count(other_half[rows, None] ^ other_half[columns])
            at = np.flatnonzero(apart <= near_bits)
            if len(at):
                x, y = at // len(columns), columns[at % len(columns)]
                inside = (y >= begin[low + x]) & (y < end[low + x])
                yield low + x[inside], y[inside], apart.ravel()[at[inside]]


def _small_tiles(one_half: np.ndarray, other_half: np.ndarray, limit: np.ndarray, near_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, columns) of near hashes, some at a time: each line with those behind it, before its ``limit``.

    A tile is some lines in a row and all that one of them is compared with; tiles of about as many columns are compared at once.
    """
    n = len(limit)
    columns = limit - np.arange(1, n + 1)
    height = min(FEW_ROWS, 1 << max(2, int(columns.mean() / 2).bit_length()))
    heads = np.arange(0, n, height)
    width = np.maximum.reduceat(limit, heads) - heads - 1
    width[np.maximum.reduceat(columns, heads) == 0] = 0
    by_width = np.argsort(-width, kind="stable")
    by_width = by_width[: np.count_nonzero(width)]
    heads, width = heads[by_width], width[by_width]
    at = 0
    while at < len(heads):
        wide = int(width[at])
        first = heads[at : at + max(1, AT_HAND // (height * wide))]
        at += len(first)
        # The longer of the two lies in the last place, where numpy's loops are.
        if len(first) > wide:
            rows = first + np.arange(height)[:, None, None]
            others = first + 1 + np.arange(wide)[None, :, None]
        else:
            rows = first[:, None, None] + np.arange(height)[None, :, None]
            others = first[:, None, None] + 1 + np.arange(wide)
        rows, others = np.minimum(rows, n - 1), np.minimum(others, n - 1)
        apart = np.bitwise_count(one_half[rows] ^ one_half[others])
        apart += np.bitwise_count(other_half[rows] ^ other_half[others])
        near = np.flatnonzero(apart <= near_bits)
        if len(near):
            x, y = (np.broadcast_to(part, apart.shape)[np.unravel_index(near, apart.shape)] for part in (rows, others))
            inside = (y > x) & (y < limit[x])
            yield x[inside], y[inside]


def near_links(found: np.ndarray, value: np.ndarray, near_bits: int = NEAR_BITS) -> tuple[np.ndarray, np.ndarray]:
    """(a, b) links that connect the lines of one ``value`` whose hashes are near and whose lengths allow the similarity.

    Lines are sorted by value and length, so that those a line is compared with
    follow each other. Where they are many, lines already connected are left.
    """
    n = len(found)
    if not n:
        return found["line"], found["line"]
    key = value.astype(np.uint64) << np.uint64(16) | found["chars"]
    if n <= 1 << 32:
        order = np.sort(key << np.uint64(32) | np.arange(n, dtype=np.uint64)).astype(np.uint32).astype(np.int64)
    else:
        order = np.argsort(key)
    key, value = key[order], value[order]
    halves = np.ascontiguousarray(found["hash"])
    one_half, other_half = halves[:, 0][order], halves[:, 1][order]
    # The first line of the same value that is too long for this one.
    too_long = 5 * (key & np.uint64(0xFFFF)) // np.uint64(4)
    limit = np.searchsorted(key, (key & ~np.uint64(0xFFFF)) + np.minimum(too_long, np.uint64(0xFFFF)), "right")
    behind = np.arange(1, n + 1)
    starts = np.flatnonzero(np.append(True, value[1:] != value[:-1]))
    sizes = np.diff(np.append(starts, n))
    many = np.add.reduceat(limit - behind, starts) >= WIDE * sizes
    few = np.where(np.repeat(many, sizes), behind, limit)
    label = np.arange(n)
    held: list[tuple[np.ndarray, np.ndarray]] = []
    for pairs in _small_tiles(one_half, other_half, few, near_bits):
        held.append(pairs)
        if sum(len(x) for x, _ in held) > AT_HAND:
            _join(label, *map(np.concatenate, zip(*held, strict=True)))
            held.clear()
    if held:
        _join(label, *map(np.concatenate, zip(*held, strict=True)))
    for low, size in zip(starts[many].tolist(), sizes[many].tolist(), strict=True):
        run, own = slice(low, low + size), np.arange(size)
        for x, y, _ in _near_tiles(one_half[run], other_half[run], behind[run] - low, limit[run] - low, own, near_bits):
            _join(own, x, y)
        label[run] = own + low
    one = np.flatnonzero(label != np.arange(n))
    return found["line"][order[label[one]]], found["line"][order[one]]


def _block_links(n: int):
    together, _, buckets = _blocks(n)

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        found = np.frombuffer(b"".join(rows["lines"]), RECORD)
        # Lines of one length stay in this order, so that a group has the same links in every bucket.
        found = found[np.argsort(found["line"])]
        hashes = np.ascontiguousarray(found["hash"])
        links = [near_links(found, _values(hashes, pair)) for pair in together[key[0] // buckets]]
        one, other = (np.concatenate(ends) for ends in zip(*links, strict=True))
        return pd.DataFrame({"a": np.minimum(one, other), "b": np.maximum(one, other)}).drop_duplicates()

    return run


def _bits(number: int, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(number.to_bytes(-(-n // 8), "little"), np.uint8), count=n, bitorder="little").view(np.int8)


def edit_distance(one: str, other: str, most: int) -> int:
    """Levenshtein distance, or some number above ``most`` if it is larger; one big-integer step per character (Myers)."""
    start = 0
    while start < min(len(one), len(other)) and one[start] == other[start]:
        start += 1
    end = 0
    while end < min(len(one), len(other)) - start and one[len(one) - 1 - end] == other[len(other) - 1 - end]:
        end += 1
    one, other = one[start : len(one) - end], other[start : len(other) - end]
    if len(one) > len(other):
        one, other = other, one
    if not one or len(other) - len(one) > most:
        return len(other)
    ones = (1 << len(one)) - 1
    where: dict[str, int] = {}
    for i, c in enumerate(one):
        where[c] = where.get(c, 0) | 1 << i
    up, down = ones, 0
    behind = np.arange(len(one) - 1, -1, -1)
    for begin in range(0, len(other), 64):
        for c in other[begin : begin + 64]:
            hit = where.get(c, 0) | down
            across = (((hit & up) + up) ^ up) | hit
            left_up = (down | (ones ^ ((across | up) & ones))) << 1 | 1
            left_down = (up & across) << 1
            up, down = ones & left_down | (ones ^ ((left_up | across) & ones)), left_up & across & ones
        # The last row's entry in this column, from the steps down the column.
        seen = min(begin + 64, len(other))
        distance = seen + up.bit_count() - down.bit_count()
        left = len(other) - seen
        if distance - left > most:
            return most + 1
        # From no entry of this column the last one can be reached with fewer edits than their lengths differ by.
        if len(one) > 64 and left:
            rise = _bits(up, len(one)) - _bits(down, len(one))
            if min(seen + abs(len(one) - left), int((seen + np.cumsum(rise, dtype=np.int32) + np.abs(behind - left)).min())) > most:
                return most + 1
    return distance


def edits_by_words(one: str, other: str, most: int) -> int:
    """The edits of one way, often a short one, from a line to another, word by word; some number above ``most`` if it is longer.

    Where the words part, the nearest place where they meet again is taken: no distance is below what this says it is at most.
    """
    a, b = one.split(" "), other.split(" ")
    i = j = edits = 0
    while i < len(a) and j < len(b):
        if a[i] == b[j]:
            i += 1
            j += 1
            continue
        skip = next(((x, d - x) for d in range(1, AHEAD) for x in range(d + 1) if a[i + x : i + x + 1] == b[j + d - x : j + d - x + 1] != []), None)
        if skip is None:
            break
        edits += max(sum(map(len, a[i : i + skip[0]])) + skip[0], sum(map(len, b[j : j + skip[1]])) + skip[1])
        if edits > most:
            return edits
        i, j = i + skip[0], j + skip[1]
    return edits + max(sum(map(len, a[i:])) + len(a) - i, sum(map(len, b[j:])) + len(b) - j)


def similar(one: str, other: str) -> bool:
    longer = max(len(one), len(other))
    most = int((1 - SIMILARITY) * longer)
    return edits_by_words(one, other, most) <= most or edit_distance(one, other, most) <= most


def _pairs(texts: list[str], hashes: np.ndarray, first: int | None, near_bits: int) -> list[tuple[int, int]]:
    """The candidate pairs of few lines, the nearest first."""
    numbers, sizes = [int.from_bytes(h.tobytes()) for h in hashes], list(map(len, texts))
    pairs = combinations(range(len(texts)), 2) if first is None else product(range(first), range(first, len(texts)))
    near = [((numbers[i] ^ numbers[j]).bit_count(), i, j) for i, j in pairs if 4 * sizes[i] <= 5 * sizes[j] and 4 * sizes[j] <= 5 * sizes[i]]
    return [(i, j) for apart, i, j in sorted(near) if apart <= near_bits]


def verified_links(texts: list[str], hashes: np.ndarray, first: int | None, near_bits: int = NEAR_BITS) -> list[int]:
    """Smallest index connected with each line by verified candidate pairs.

    With ``first`` only pairs across the first lines and the others are compared.
    """
    n = len(texts)
    above: dict[int, int] = {}

    def root(i: int) -> int:
        top = i
        while top in above:
            top = above[top]
        while i != top:
            above[i], i = top, above[i]
        return top

    def verify(pairs: Iterable[tuple[int, int]], texts: list[str]) -> None:
        for one, two in pairs:
            i, j = root(one), root(two)
            if i != j and similar(texts[one], texts[two]):
                above[max(i, j)] = min(i, j)

    if n <= FEW:
        verify(_pairs(texts, hashes, first, near_bits), texts)
        return [root(i) for i in range(n)]
    chars = np.array([len(t) for t in texts])
    rows = n if first is None else first
    # Both sides in the order of their lengths.
    order = np.concatenate([np.argsort(chars[:rows], kind="stable"), rows + np.argsort(chars[rows:], kind="stable")])
    chars, halves, texts = chars[order], hashes[order], [texts[i] for i in order.tolist()]
    across = chars[:rows] if first is None else chars[rows:]
    begin = np.arange(1, n + 1) if first is None else rows + np.searchsorted(across, -(-4 * chars[:rows] // 5))
    end = n - len(across) + np.searchsorted(across, 5 * chars[:rows] // 4, "right")
    label = np.arange(n)
    for x, y, near in _near_tiles(np.ascontiguousarray(halves[:, 0]), np.ascontiguousarray(halves[:, 1]), begin, end, label, near_bits):
        new = label[x] != label[y]
        x, y, near = x[new], y[new], near[new]
        # The nearest first, so that most pairs are connected before their turn comes.
        by_near, before = np.argsort(near, kind="stable"), len(above)
        verify(zip(x[by_near].tolist(), y[by_near].tolist(), strict=True), texts)
        if len(above) > before:
            joined = np.array(list(above))
            _join(label, joined, np.array([above[i] for i in joined.tolist()]))
    least = np.full(n, n)
    np.minimum.at(least, label, order)
    out = np.empty(n, np.int64)
    out[order] = least[label]
    return out.tolist()


def _cell_links(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Verified links inside the candidate groups of a cell, one per connected line."""
    out = []
    rows = rows.sort_values(["root", "slice", "id"])
    roots, lines, texts = rows["root"].tolist(), rows["id"].tolist(), rows["text"].tolist()
    low = rows["slice"].to_numpy() == key[1]
    hashes = np.frombuffer(b"".join(rows["hash"]), "<u8").reshape(len(rows), -1)
    edges = [0, *[i for i in range(1, len(roots)) if roots[i] != roots[i - 1]], len(roots)]
    for begin, end in pairwise(edges):
        first = None if key[1] == key[2] else int(low[begin:end].sum())
        label = verified_links(texts[begin:end], hashes[begin:end], first)
        out += [(lines[begin + i], lines[begin + k]) for i, k in enumerate(label) if i != k]
    return pd.DataFrame(out, columns=["a", "b"]).astype("int64")


def _normalise_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = pa.array([normalise(text) for text in batch["text"].to_pylist()], pa.string())
        yield batch.set_column(batch.schema.get_field_index("text"), "text", texts)


@F.pandas_udf(StringType())
def _without(texts: pd.Series, gone: pd.Series) -> pd.Series:
    """The texts without the lines of the given numbers."""
    out = []
    for text, numbers in zip(texts, gone, strict=True):
        if numbers is not None and len(numbers):
            drop = set(numbers.tolist())
            text = "\n".join([line for at, line in enumerate(text.split("\n")) if at not in drop])
        out.append(text)
    return pd.Series(out)


# A filter on the texts stays above them; pushed below, it would make them a second time, in a second Python worker of the task.
_without = _without.asNondeterministic()


def fuzzy_groups(keyed: DataFrame, distinct: DataFrame) -> DataFrame:
    """(member, root): ids of lines connected by verified links. ``distinct`` has id, hash, chars and the first place."""
    return _verified_groups(keyed, candidate_lines(distinct))


def candidate_lines(distinct: DataFrame) -> DataFrame:
    """The lines of ``distinct`` that are in a candidate group, with its root, the slices of a large one and the line's own."""
    n = distinct.count()
    candidates = block_rows(distinct, n).groupBy("bucket").applyInPandas(_block_links(n), "a long, b long")
    groups = stored(connected_groups(candidates).select("root", F.col("member").alias("id")), "candidates")
    # The smaller side is hashed, so that the lines need not be sorted.
    lines = stored(distinct.join(groups.hint("shuffle_hash"), "id"), "candidate-lines")
    lines = lines.withColumn("_step", F.floor(F.log(STEP, "chars")))
    sizes = lines.groupBy("root", "_step").agg(F.count(F.lit(1)).alias("n"))
    slices = F.struct(F.col("_step").alias("step"), F.least(F.ceil(F.col("n") / SLICE), F.lit(MOST_SLICES)).alias("slices"))
    large = sizes.groupBy("root").agg(F.sum("n").alias("n"), F.collect_list(slices).alias("_parts")).where(F.col("n") > SLICE).drop("n")
    lines = lines.join(stored(large, "large-groups"), "root", "left")
    own = F.filter("_parts", lambda part: part["step"] == F.col("_step"))[0]["slices"]
    here = F.filter("_parts", lambda part: F.abs(part["step"] - F.col("_step")) <= 1)
    return lines.withColumns({"_parts": here, "slice": F.coalesce(_slice(F.col("_step"), F.pmod(F.xxhash64("id"), own)), F.lit(0))}).drop("_step")


def _slice(step: Column, nth: Column) -> Column:
    return step * MOST_SLICES + nth


def dealt_lines(sliced: DataFrame) -> DataFrame:
    """The cells (i, j) of every candidate line: its slice with each slice of its group that holds lines of a length near enough."""
    others = F.transform("_parts", lambda part: F.transform(F.sequence(F.lit(0), part["slices"] - 1), lambda nth: _slice(part["step"], nth)))
    others = F.coalesce(F.flatten(others), F.array(F.col("slice")))
    cells = F.transform(others, lambda other: F.struct(F.least("slice", other).alias("i"), F.greatest("slice", other).alias("j")))
    return sliced.select("id", "slice", F.col("_parts").isNotNull().alias("_large"), F.inline(cells))


def _verified_groups(keyed: DataFrame, sliced: DataFrame) -> DataFrame:
    asked = sliced.groupBy("doc", "th").agg(F.collect_list(F.struct("root", "id", "hash", "at")).alias("asked"))
    texts = keyed.join(asked.hint("shuffle_hash"), ["doc", "th"])
    # A text is cut into its lines once, and only those asked for are sent to Python.
    picked = F.transform(F.array(F.split("text", "\n", -1)), lambda lines: F.transform("asked", lambda a: F.struct(a["root"], a["id"], a["hash"], lines[a["at"]])))
    texts = texts.select(F.inline(picked[0]).alias("root", "id", "hash", "text"))
    texts = texts.mapInArrow(_normalise_texts, "root long, id long, hash binary, text string")

    dealt = dealt_lines(sliced).join(texts, "id")
    # Small groups share a cell; a large group has its own.
    count = max(1, sliced.count() // CELL_LINES)
    cell = F.when(F.col("_large"), F.xxhash64("root")).otherwise(F.pmod(F.xxhash64("root"), F.lit(count)))
    links = dealt.select("root", "id", "hash", "text", "slice", cell.alias("_cell"), "i", "j")
    return connected_groups(links.groupBy("_cell", "i", "j").applyInPandas(_cell_links, "a long, b long"))


def _keyed(docs: DataFrame, *more: Column) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LOWEST))
    return docs.select(doc.alias("doc"), F.xxhash64(text).alias("th"), text.alias("text"), *more)


def dedup_lines(docs: DataFrame, row: Column | None = None) -> DataFrame:
    """doc_id, kept text, n_lines, n_removed, n_fuzzy (removed for a line that is not equal) of every document.

    ``row``, where given, is carried along under that name.
    """
    keyed = _keyed(docs)
    lines = stored(line_rows(keyed), "lines")
    first = F.min(F.struct("doc", "th", "at")).alias("_first")
    distinct = lines.groupBy("line").agg(first, F.first("hash").alias("hash"), F.first("chars").alias("chars"), F.count(F.lit(1)).alias("times"))
    # Stored, a line keeps its number.
    distinct = stored(distinct.select(F.monotonically_increasing_id().alias("id"), "line", "hash", "chars", "times", "_first.*"), "distinct")
    sliced = candidate_lines(distinct)
    groups = stored(_verified_groups(keyed, sliced).withColumnRenamed("member", "id"), "line-groups")

    here = F.struct("doc", "th", "at")
    grouped = sliced.select("id", "line", here.alias("_first")).join(groups, "id")
    keepers = grouped.groupBy("root").agg(F.min(F.struct("_first", "id"))["id"].alias("keeper"))
    others = grouped.join(keepers, "root").where("id <> keeper")
    # Only lines met again, or not the first of their group, can be gone.
    marked = distinct.where("times > 1").select("line", here.alias("_first"), F.lit(False).alias("fuzzy"))
    marked = marked.unionByName(others.select("line", "_first", F.lit(True).alias("fuzzy")))
    gone = lines.select("line", "doc", "th", "at").join(marked.hint("shuffle_hash"), "line").where(F.col("fuzzy") | (here != F.col("_first")))
    # Dealt out once, for both groupings and the join with the texts.
    gone = gone.repartition("doc", "th").groupBy("doc", "th", "at").agg(F.max("fuzzy").alias("fuzzy"))
    per_doc = gone.groupBy("doc", "th").agg(F.collect_list("at").alias("gone"), F.sum(F.col("fuzzy").cast("bigint")).alias("fuzzy"))
    carried = [] if row is None else [row.alias("row")]
    rows = _keyed(docs, *carried).join(per_doc.hint("shuffle_hash"), ["doc", "th"], "left")
    return rows.select(
        F.nullif("doc", F.lit(LOWEST)).alias("doc_id"),
        # Texts that keep all their lines are not sent to Python.
        F.coalesce(_without(F.when(F.size("gone") > 0, F.col("text")), "gone"), "text").alias("kept"),
        (F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"))) + 1).cast("bigint").alias("n_lines"),
        F.greatest(F.size("gone"), F.lit(0)).cast("bigint").alias("n_removed"),
        F.coalesce("fuzzy", F.lit(0)).alias("n_fuzzy"),
        *["row" for _ in carried],
    )


def dedup_digests(docs: DataFrame) -> DataFrame:
    """The counts of every document with a hash in place of its kept text."""
    return dedup_lines(docs).select("doc_id", "n_lines", "n_removed", "n_fuzzy", F.sha2("kept", 256).alias("kept_sha256"))
