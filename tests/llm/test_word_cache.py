"""Cached encoding against the library's."""

from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from prefkit.llm import word_cache
from prefkit.llm.word_cache import PLAIN, WordCache

FILES = ("byte_bpe_50k.json", "word_bpe_49k.json")
ODD = st.text(st.characters(codec="utf-8"), max_size=60)
USUAL = st.text(st.sampled_from("abcXYZ äÉßįº'’—!?#12 \t\n\r.sSdDtT<|>«²½"), max_size=80)


@pytest.fixture(scope="module", params=FILES)
def pair(request):
    path = public_tokenizers.path(request.param)
    library = Tokenizer.from_file(path)
    return WordCache(path), library


@settings(max_examples=300, deadline=None)
@given(text=ODD | USUAL)
def test_same_ids_as_the_library(pair, text):
    cache, library = pair
    ids = np.frombuffer(cache.ids(text), "<u4").tolist()
    assert ids == library.encode(text, add_special_tokens=False).ids


def test_texts_of_every_kind(pair):
    cache, library = pair
    for text in ("", " ", "  a  b ", "it's IT'S we'll", "<|endoftext|> x", "hello <|endoftext|> world", "a <|EndOfText|>b", "<|startoftext|>", "<|endof text|>", "日本 語", "a\x1cb", "İstanbul ΑΣ", "x" * 5000, "\n\n\n a"):
        assert np.frombuffer(cache.ids(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert PLAIN.fullmatch("Été – “sûr”") and not PLAIN.fullmatch("x²")


def test_full_cache_starts_anew(monkeypatch):
    monkeypatch.setattr(word_cache, "MOST_PIECES", 5)
    path = public_tokenizers.path(FILES[0])
    cache, plain = WordCache(path), WordCache(path)
    for text in ("one two three four five six", "one two seven", "eight nine ten one two"):
        assert cache.ids(text) == plain._library(text)
    assert len(cache) < 12


def test_marks_of_the_tokenizer_are_its_own_ids():
    cache = WordCache(public_tokenizers.path(FILES[0]))
    ids = np.frombuffer(cache.ids("hello <|endoftext|> world"), "<u4").tolist()
    assert 50256 in ids and len(ids) == 4


MIXED = st.text(st.sampled_from("abdelmrstvXé0'’.!- \t\n"), max_size=60)


@settings(max_examples=300, deadline=None)
@given(texts=st.lists(MIXED | USUAL | ODD, max_size=6))
def test_many_texts_have_the_ids_of_each(pair, texts):
    cache, library = pair
    texts = [*texts, "it's we'll'd 're''s '", "<|endoftext|> x", "", "x'l", "'", "12 3"]
    for text, ids in zip(texts, cache.ids_of(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_a_piece_of_many_texts_is_looked_up_once(monkeypatch):
    asked = Counter()

    class Counted(WordCache):
        def __getitem__(self, piece):
            asked[piece] += 1
            return super().__getitem__(piece)

    cache = Counted(public_tokenizers.path(FILES[1]))
    texts = [f"It's the same line, the same words: number {i}" for i in range(500)]
    assert cache.ids_of(texts) == [cache._library(text) for text in texts] and max(asked.values()) == 1
    # Cut and looked up a few at a time, and with a cache that is full again and again, the ids stay.
    monkeypatch.setattr(word_cache, "CUT_CHARS", 100)
    monkeypatch.setattr(word_cache, "LOOK_CHARS", 1000)
    assert WordCache(public_tokenizers.path(FILES[1]), 5).ids_of(texts) == [cache._library(text) for text in texts]
