"""What removing lines does less of than it did, with the same results."""

import hashlib
import random

import numpy as np
import pandas as pd
import pytest
import xxhash
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from prefkit.llm import components, line_dedup
from tests.llm.test_operators import levenshtein

ODD = ["", "\n", "É_a b-c  d e\n\n a b c d\n__x y z w v u__", "ΣΑΣ ΟΔΟΣ a b cΣ\n", " İ ı ß ﬃ x 日本 語 y", "\U0001F600 a \U00010400b c d e f"]


def one_by_one(texts):
    rows = []
    for n, text in enumerate(texts):
        for at, line in enumerate(line_dedup.normalised(text)):
            if len(line.split(" ")) >= line_dedup.MIN_WORDS:
                data = line.encode("utf-8", "surrogatepass")
                rows.append((hashlib.blake2b(data, digest_size=16).digest(), line_dedup.simhashes([data])[0], len(line), n, at))
    return rows


def many(texts):
    keys, hashes, *numbers = line_dedup.hashed_lines([text.lower() for text in texts])
    return list(zip(keys, [h.tobytes() for h in hashes], *[n.tolist() for n in numbers], strict=True))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("abÉß_-'1 \t\n 日"), max_size=60), min_size=1, max_size=5))
def test_lines_hashed_together(texts):
    assert many(texts) == one_by_one(texts)


def test_odd_and_long_lines_hashed_together(monkeypatch):
    texts = [*ODD, "w " * 300 + "\n" + "x%d " * 5, " ".join(f"w{i}" for i in range(700))]
    assert many(texts) == one_by_one(texts)
    monkeypatch.setattr(line_dedup, "HELD_WORDS", 3)
    assert many(texts) == one_by_one(texts)


def test_a_word_is_hashed_once(monkeypatch):
    asked = []
    digest = xxhash.xxh3_128_digest
    monkeypatch.setattr(line_dedup.xxhash, "xxh3_128_digest", lambda word: asked.append(word) or digest(word))
    line_dedup.hashed_lines([f"the same five words again {i}" for i in range(200)])
    assert len(asked) == 205


def test_long_texts_are_cut_between_lines(spark, monkeypatch):
    text = "\n".join(f"line number {i} of this text" if i % 3 else "" for i in range(50))
    monkeypatch.setattr(line_dedup, "CUT_CHARS", 40)
    parts = list(line_dedup._segments(text))
    assert len(parts) > 10 and "\n".join(p for _, p in parts) == text
    assert [at for at, _ in parts] == [text[: text.index(p)].count("\n") for _, p in parts]


def test_a_line_is_sent_once_per_block(spark):
    hashes = [bytes(random.Random(i).randrange(256) for _ in range(16)) for i in range(300)]
    distinct = spark.createDataFrame([(i, bytearray(h), 40) for i, h in enumerate(hashes)], "id long, hash binary, chars int")
    sent = line_dedup.block_rows(distinct, 300).agg(F.sum(F.octet_length("lines"))).first()[0]
    assert sent == 300 * line_dedup.BLOCKS * line_dedup.RECORD.itemsize


@pytest.mark.parametrize("n", [600, 10**12])
def test_either_way_of_sending_finds_the_pairs_that_meet(monkeypatch, spark, n):
    monkeypatch.setattr(line_dedup, "BUCKET_LINES", n // 3)
    rnd = np.random.default_rng(3)
    one = rnd.integers(0, 256, (300, 16), dtype=np.uint8)
    other = np.packbits(np.unpackbits(one, axis=1) ^ (rnd.random((300, 128)) < 0.12), axis=1)
    hashes = np.concatenate([one, other])
    distinct = spark.createDataFrame([(i, bytearray(h.tobytes()), 40) for i, h in enumerate(hashes)], "id long, hash binary, chars int")
    found = line_dedup.block_rows(distinct, n).groupBy("bucket").applyInPandas(line_dedup._block_links(n), "a long, b long").distinct().collect()
    meet = lambda a, b: any(a[x] == b[x] and a[y] == b[y] for x, y in line_dedup.PAIRS)
    near = np.bitwise_count(one ^ other).sum(axis=1) <= line_dedup.NEAR_BITS
    expect = {(i, i + 300) for i in range(300) if near[i] and meet(one[i], other[i])}
    assert len(expect) > 100 and {(r["a"], r["b"]) for r in found} == expect


def connected(n, pairs):
    root = list(range(n))
    for a, b in pairs:
        one, other = sorted((root[a], root[b]))
        root = [one if r == other else r for r in root]
    return root


def alike(rnd, n, kinds):
    """Hashes of ``kinds`` kinds, near and not so near within a kind, and lengths."""
    kind = rnd.integers(0, 256, (kinds, 16), dtype=np.uint8)[rnd.integers(0, kinds, n)]
    return np.packbits(np.unpackbits(kind, axis=1) ^ (rnd.random((n, 128)) < 0.1), axis=1), rnd.integers(20, 90, n)


@pytest.mark.parametrize(("wide", "at_hand"), [(512, 1 << 18), (512, 40), (1, 1 << 18), (5, 100)])
def test_many_lines_of_one_value_against_brute_force(monkeypatch, wide, at_hand):
    monkeypatch.setattr(line_dedup, "WIDE", wide)
    monkeypatch.setattr(line_dedup, "AT_HAND", at_hand)
    rnd = np.random.default_rng(wide)
    for n in (0, 1, 5, 300):
        hashes, chars = alike(rnd, n, 15)
        found = np.empty(n, line_dedup.RECORD)
        found["line"], found["hash"], found["chars"] = np.arange(n), hashes.view("<u8").reshape(n, 2), chars
        value = rnd.integers(0, 4, n).astype(np.uint16)
        links = list(zip(*(ends.tolist() for ends in line_dedup.near_links(found, value)), strict=True))
        apart = np.bitwise_count(hashes[:, None] ^ hashes).sum(axis=2)
        near = (apart <= line_dedup.NEAR_BITS) & (value[:, None] == value) & (5 * np.minimum(chars[:, None], chars) >= 4 * np.maximum(chars[:, None], chars))
        assert connected(n, links) == connected(n, np.argwhere(near).tolist())
        assert n < 300 or len(links) > 60


def test_hashes_are_compared_many_with_many(monkeypatch):
    rnd = np.random.default_rng(9)
    found = np.empty(3000, line_dedup.RECORD)
    found["line"], found["hash"], found["chars"] = np.arange(3000), rnd.integers(0, 2**63, (3000, 2)), rnd.integers(100, 120, 3000)
    calls, count = [], np.bitwise_count
    monkeypatch.setattr(line_dedup.np, "bitwise_count", lambda x: calls.append(x.size) or count(x))
    line_dedup.near_links(found, (found["line"] % 3).astype(np.uint16))
    assert len(calls) < 300 and sum(calls) < 2.5 * 3 * 1000 * 1000


@pytest.mark.parametrize("first", [None, 0, 50, 130])
def test_verified_pairs_of_many_lines(monkeypatch, first):
    rnd = random.Random(12)
    base = [" ".join(rnd.choice(["one", "two", "three", "four"]) for _ in range(rnd.randrange(5, 12))) for _ in range(30)]
    texts = [" ".join([*rnd.choice(base).split(" ")[rnd.randrange(2) :], rnd.choice(["end", "other end"])]) for _ in range(130)]
    hashes, _ = alike(np.random.default_rng(2), 130, 5)
    apart = np.bitwise_count(hashes[:, None] ^ hashes).sum(axis=2)
    links = [
        (i, j)
        for j in range(130)
        for i in range(j)
        if apart[i, j] <= line_dedup.NEAR_BITS and (first is None or i < first <= j) and 5 * levenshtein(texts[i], texts[j]) <= max(len(texts[i]), len(texts[j]))
    ]
    assert line_dedup.verified_links(texts, hashes.view("<u8").reshape(130, 2), first) == connected(130, links)
    monkeypatch.setattr(line_dedup, "FEW", 200)
    assert line_dedup.verified_links(texts, hashes.view("<u8").reshape(130, 2), first) == connected(130, links)


def test_slices_meet_those_of_like_lengths_alone(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "SLICE", 20)
    chars = [9 + 6 * i for i in range(300)] + [100] * 100
    rows = [(i, bytearray(16 * [7]), c) for i, c in enumerate(chars)] + [(i, bytearray(16 * [200]), 40) for i in range(500, 510)]
    distinct = spark.createDataFrame(rows, "id long, hash binary, chars int")
    cells = {}
    for r in line_dedup.dealt_lines(line_dedup.candidate_lines(distinct)).collect():
        cells.setdefault(r["id"], set()).add((r["i"], r["j"]))
        assert r["slice"] in (r["i"], r["j"]) and r["_large"] == (r["id"] < 500)
    fits = lambda a, b: 5 * min(chars[a], chars[b]) >= 4 * max(chars[a], chars[b])
    large = sorted(i for i in cells if i < 500)
    assert len(large) > 390 and all(cells[i] == {(0, 0)} for i in range(500, 510))
    assert all(cells[a] & cells[b] for a in large for b in large if fits(a, b))
    # Twenty slices at least; before, a line met them all.
    assert np.mean([len(cells[i]) for i in large]) < 14


def test_edits_by_words_are_never_too_few(monkeypatch):
    rnd = random.Random(6)
    for _ in range(800):
        a = " ".join(rnd.choice(["a", "bb", "cé", "ddd"]) for _ in range(rnd.randrange(1, 12)))
        words = a.split(" ")
        for _ in range(rnd.randrange(4)):
            at = rnd.randrange(len(words) + 1)
            words[at : at + rnd.randrange(2)] = rnd.choice([[], ["x"], ["a", "yy"]])
        b, most = " ".join(words), rnd.randrange(12)
        true, found = levenshtein(a, b), line_dedup.edits_by_words(a, b, most)
        assert found > most or found >= true
        assert line_dedup.similar(a, b) == (5 * true <= max(len(a), len(b)))
    monkeypatch.setattr(line_dedup, "edit_distance", None)
    line = " ".join(f"word{i}" for i in range(30))
    assert line_dedup.similar(line, line.replace("word7", "other").replace(" word20", "").replace("word25", "word25 more"))


def test_edit_distance_of_long_lines():
    rnd = random.Random(8)
    for _ in range(60):
        a, b = ("".join(rnd.choice("abé") for _ in range(rnd.randrange(50, 300))) for _ in range(2))
        true = levenshtein(a, b)
        for most in (true - 1, true, 999):
            found = line_dedup.edit_distance(a, b, most)
            assert found == true if most >= true else found > most


def test_a_task_joins_up_its_links(monkeypatch):
    chain = pd.DataFrame({"a": range(1, 100), "b": range(99)})
    (out,) = components.joined_up(iter([chain.sample(frac=1, random_state=1)]))
    assert sorted(zip(out["a"], out["b"])) == [(i, 0) for i in range(1, 100)]
    monkeypatch.setattr(components, "AT_ONCE", 1)
    assert [len(x) for x in components.joined_up(iter([chain[:3], chain[3:5], chain[:0]]))][:2] == [3, 2]
