"""Encoding with a tokenizers file, one library call per distinct word instead of per occurrence.

Byte-level BPE never merges across the pieces its pattern cuts a text into. So
ids are kept by piece, and the library encodes only pieces that are new. Texts
with characters outside a plain set, on which two libraries' character classes
could differ, are encoded whole by the library, as are texts that spell one of the tokenizer's
own tokens, which the library finds before it cuts, and all texts of tokenizers
with another layout.

Where the pattern is ``WORD_PATTERN`` many texts are cut at once by the kinds of their characters: its pieces hold no
white space and only depend on the characters next to them. Each piece is then looked up once for all these texts.
"""

from __future__ import annotations

import functools
import json
from operator import itemgetter
import os
import re
import struct

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from prefkit.llm.common import byte_items

# Spark has a task for every core already.
os.environ["TOKENIZERS_PARALLELISM"] = "false"

# The plain set: tab to carriage return, printable ASCII, Latin letters to U+012F, dashes and quotes; no other digits.
LETTERS, DIGITS = "A-Za-zªµºÀ-ÖØ-öø-į", "0-9"
PLAIN = re.compile(r"[\t-\r\x20-\x7e\xa1-\xb1\xb4-\xb8\xba\xbb\xbf-į‐-‧]*+")
# Fixed value: the pattern of byte-level BPE.
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Fixed value: the pattern of word-level BPE.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WHITE = b"\t\n\v\f\r "
SPACE, LETTER, DIGIT, MARK = range(4)
# The kind of every plain character.
KINDS = np.full(0x2028, MARK, np.uint8)
KINDS[list(WHITE)], KINDS[48:58] = SPACE, DIGIT
KINDS[[c for c in range(len(KINDS)) if re.match(f"[{LETTERS}]", chr(c))]] = LETTER
# Characters cut at once, and characters whose pieces are looked up at once.
CUT_CHARS, LOOK_CHARS = 1 << 19, 1 << 22
# Two generations of so many pieces are some 190 MB of a task's memory.
MOST_PIECES = 300_000
# Byte-level BPE writes a printable byte as its own character and the others, in order, from U+0100 on.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
_OTHERS = [b for b in range(256) if b not in _PRINTED]
BYTE_CHARACTERS = {b: 256 + n for n, b in enumerate(_OTHERS)}
PRINTED = re.compile(f"[{re.escape(''.join(map(chr, _PRINTED)))}]*+")


@functools.cache
def _opened(path: str) -> tuple[Tokenizer, dict]:
    """A tokenizer and its layout without the vocabulary, once per file and Python worker."""
    with open(path, encoding="utf-8") as file:
        layout = json.load(file)
    layout["model"] = {"dropout": layout["model"].get("dropout")}
    return Tokenizer.from_file(path), layout


class WordCache(dict):
    """Piece to its ids as little-endian unsigned 32-bit integers; full, it starts anew and keeps what is still used.

    A task has its own, so that its memory is free for the tasks that come after it in the same worker.
    """

    def __init__(self, path: str, most: int | None = None):
        super().__init__()
        self.most = most or MOST_PIECES
        self._tokenizer, layout = _opened(path)
        self._model = self._tokenizer.model
        self._pattern, self._lower = _fast_path(layout)
        self._by_kind = self._lower and layout["pre_tokenizer"]["pretokenizers"][0]["pattern"].get("Regex") == WORD_PATTERN
        self._own = [token["content"].lower() for token in layout.get("added_tokens", [])]
        self._older: dict[str | bytes, bytes] = {}
        self.vocabulary = self._tokenizer.get_vocab_size()

    def _library(self, text: str) -> bytes:
        return np.asarray(self._tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __missing__(self, piece: str | bytes) -> bytes:
        ids = self._older.get(piece)
        if ids is None:
            data = piece.encode() if isinstance(piece, str) else piece
            # Printable bytes are their own characters.
            characters = data.decode("latin-1")
            if not PRINTED.fullmatch(characters):
                characters = characters.translate(BYTE_CHARACTERS)
            found = [token.id for token in self._model.tokenize(characters)]
            ids = struct.pack(f"<{len(found)}I", *found)
        self[piece] = ids
        return ids

    def _turn(self) -> None:
        if len(self) >= self.most:
            self._older = dict(self)
            self.clear()

    def ids_of(self, texts: list[str]) -> list[bytes]:
        """``ids`` of each of many texts."""
        if not self._by_kind:
            return [self.ids(text) for text in texts]
        out, cuts, fast = [b""] * len(texts), [], []
        cut_chars = look_chars = 0
        for i, text in enumerate(texts):
            small = text.lower()
            if not PLAIN.fullmatch(text) or any(token in small for token in self._own):
                out[i] = self._library(text)
                continue
            fast.append((i, small))
            cut_chars += len(small)
            if cut_chars >= CUT_CHARS:
                cuts.append(([i for i, _ in fast], *_cut([small for _, small in fast])))
                look_chars += cut_chars
                fast, cut_chars = [], 0
            if look_chars >= LOOK_CHARS:
                self._look_up(out, cuts)
                cuts, look_chars = [], 0
        if fast:
            cuts.append(([i for i, _ in fast], *_cut([small for _, small in fast])))
        self._look_up(out, cuts)
        return out

    def _look_up(self, out: list[bytes], cuts: list[tuple[list[int], pa.Array, np.ndarray]]) -> None:
        """Puts the ids of cut texts to their places in ``out``."""
        if not cuts:
            return
        self._turn()
        coded = pa.chunked_array([pieces for _, pieces, _ in cuts]).dictionary_encode().chunks
        known = [self[piece] for piece in byte_items(coded[-1].dictionary)]
        ids, sizes = np.frombuffer(b"".join(known), "<u4"), np.fromiter(map(len, known), np.int64, len(known)) >> 2
        begins = np.cumsum(sizes) - sizes
        for (places, _, first), chunk in zip(cuts, coded, strict=True):
            nth = chunk.indices.to_numpy()
            counts = sizes[nth]
            ends = np.cumsum(counts)
            at = np.repeat(begins[nth] - ends + counts, counts) + np.arange(counts.sum())
            data = ids[at].tobytes()
            edges = (4 * np.append(0, ends)[first]).tolist()
            for i, low, high in zip(places, edges, edges[1:], strict=False):
                out[i] = data[low:high]

    def ids(self, text: str) -> bytes:
        """The ids of a whole text, as bytes."""
        if self._pattern is None or not PLAIN.fullmatch(text):
            return self._library(text)
        small = text.lower()
        if any(token in small for token in self._own):
            return self._library(text)
        pieces = self._pattern.findall(small if self._lower else text)
        self._turn()
        # One look for each piece, new or not; of one piece alone the getter would return no tuple.
        if len(pieces) < 2:
            return b"".join(map(self.__getitem__, pieces))
        return b"".join(itemgetter(*pieces)(self))


def _cut(texts: list[str]) -> tuple[pa.Array, np.ndarray]:
    """The pieces of plain lower-case texts by ``WORD_PATTERN``, and the number of the first one of each text and of an empty one at the end."""
    # White space parts the texts and stands where a contraction looks ahead.
    joined = "\n".join([*texts, "\n\n"])
    chars = np.frombuffer(joined.encode("utf-32-le"), "<u4")
    kind = KINDS[chars]
    begin = np.append(True, kind[1:] != kind[:-1]) | (kind == DIGIT)
    # An apostrophe amid marks belongs to them; any other may begin a contraction, which ends where its letters do or amid a word.
    quotes = np.flatnonzero(begin & (chars == 39))
    one, two = chars[quotes + 1], chars[quotes + 2]
    short = np.isin(one, [ord(c) for c in "stmd"])
    long = ((two == ord("e")) & ((one == ord("r")) | (one == ord("v")))) | ((one == ord("l")) & (two == ord("l")))
    begin[quotes[short | long] + 1] = False
    begin[quotes[short] + 2] = True
    begin[quotes[long] + 3] = True
    starts = np.flatnonzero(begin & (kind != SPACE))
    sizes = (kind != SPACE) * (np.uint8(1) + (chars >= 0x80) + (chars >= 0x800))
    ends = np.cumsum(sizes, dtype=np.int32)
    data = joined.encode().translate(None, WHITE)
    offsets = np.append((ends - sizes)[starts], len(data)).astype(np.int32)
    pieces = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    heads = np.cumsum([0, *[len(text) + 1 for text in texts]])
    return pieces, np.searchsorted(starts, heads)


def _plain(pattern: str) -> re.Pattern:
    """A tokenizer's pattern with its letter and digit classes spelled out for plain texts."""
    for classes, plain in (
        (r"\s\p{L}\p{N}", rf"\s{LETTERS}{DIGITS}"),
        (r"[\p{L}]", f"[{LETTERS}]"),
        (r"[\p{N}]", f"[{DIGITS}]"),
        (r"\p{L}", f"[{LETTERS}]"),
        (r"\p{N}", f"[{DIGITS}]"),
    ):
        pattern = pattern.replace(classes, plain)
    return re.compile(pattern)


def _fast_path(layout: dict) -> tuple[re.Pattern | None, bool]:
    """The pattern that cuts texts into pieces and whether they are lower-cased first; none for an unknown layout."""
    cut, normal = layout["pre_tokenizer"] or {}, layout["normalizer"]
    if layout["model"].get("dropout"):
        return None, False
    if cut.get("type") == "ByteLevel" and cut["use_regex"] and not cut["add_prefix_space"] and normal is None:
        return _plain(BYTE_PATTERN), False
    steps = cut.get("pretokenizers", [])
    normals = [n["type"] for n in (normal or {}).get("normalizers", [])]
    if (
        [s["type"] for s in steps] == ["Split", "ByteLevel"]
        and steps[0]["behavior"] == "Removed"
        and steps[0]["invert"]
        and not steps[1]["use_regex"]
        and not steps[1]["add_prefix_space"]
        and normals == ["NFC", "Replace", "Lowercase"]
        and normal["normalizers"][1] == {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}
    ):
        return _plain(steps[0]["pattern"]["Regex"]), True
    return None, False
