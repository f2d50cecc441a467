"""Every text operator against a plain version, and on odd tables."""

from collections import Counter, defaultdict
import hashlib
import os
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer
import xxhash

from prefkit.llm import (
    common,
    components,
    compression_quality,
    fair_mix,
    isolation_rules,
    line_dedup,
    lsh_forest,
    merkle,
    packing,
    prefix_parsing,
    token_files,
    url_filter,
)
from prefkit.llm.common import table
from tests.llm.helpers import documents, odd_documents, plain, with_clashes

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def labels_of(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


OPERATORS = {
    "rules": lambda spark, docs: isolation_rules.judge(docs, labels_of(spark, [(5, 1, 0), (8, 0, 0), (None, 1, 0), (6, None, 0)])),
    "packing": lambda spark, docs: packing.packed_digests(docs, BYTE_BPE).drop("sequence_id", "offset"),
    "token_files": lambda spark, docs: token_files.round_trip(docs, WORD_BPE),
    "line_dedup": lambda spark, docs: line_dedup.dedup_digests(docs),
    "merkle": lambda spark, docs: merkle.edited_fingerprints(docs),
    "repeats": lambda spark, docs: prefix_parsing.removed_digests(docs),
    "mix": lambda spark, docs: fair_mix.taken_words(docs),
    "classifier": lambda spark, docs: compression_quality.score_quality(docs, labels_of(spark, [(5, 1, 0), (8, 0, 0), (None, 1, 0)])),
    "jaccard": lambda spark, docs: lsh_forest.jaccard_join(docs),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows_and_clashing_columns(spark, name):
    docs = odd_documents(spark)
    run = OPERATORS[name]
    rows = run(spark, docs).collect()
    if name != "packing":
        assert Counter(r["doc_id"] for r in rows) == Counter(r["doc_id"] for r in docs.collect())
        assert plain(rows) == plain(run(spark, with_clashes(docs)).collect())
    else:
        assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in docs.collect()}


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name](spark, documents(spark, [])).collect() == []


def test_rule_counts():
    text = "a b c x a b c\nsame line\n\nsame line\n \n same line # $"
    assert isolation_rules.text_statistics(text)[:5] == (15, 33, 2, 1, 12)
    assert isolation_rules.text_statistics("")[:5] == (0, 0, 0, 0, 0)
    assert isolation_rules.text_statistics("a a a a")[4] == 4
    assert isolation_rules.text_statistics("a b\u00a0c\x1cd")[0] == 2


def test_forest_cuts_off_what_clean_rows_do_not_hold():
    random_rows = np.random.default_rng(1).normal(size=(600, 3))
    strange = random_rows[:40] + [9, 0, 0]
    forest = isolation_rules.grow_forest(random_rows, np.concatenate([random_rows, strange]))
    assert forest.score(strange).min() > np.quantile(forest.score(random_rows), 0.99)


def test_rules_on_held_out_labels(spark, data):
    rows = isolation_rules.judge(table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels"))
    labelled = rows.join(table(spark, "/root/testdata/sf0.01", "labels"), "doc_id").where(F.expr("crc32(cast(doc_id as string)) % 4 = 2"))
    good, bad = (labelled.where(f"quality = {q} and not base_failed").agg(F.avg(F.col("kept").cast("int"))).first()[0] for q in (1, 0))
    assert good > 0.97 and (bad or 0) < 0.2


def test_classifier_on_held_out_labels(spark, data):
    scores = compression_quality.score_quality(table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels"))
    held = scores.where("held_out").join(table(spark, "/root/testdata/sf0.01", "labels"), "doc_id")
    right = held.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()[0]
    assert right > 0.93


def test_classifier_ignores_all_but_the_text(spark):
    texts = [(i, f"plain words number {i} in a row " * 5) for i in range(1, 40)] + [(i, f"#{i}$$ %% {i} && ** " * 9) for i in range(40, 80)]
    marks = labels_of(spark, [(i, int(i < 40), 0) for i, _ in texts])
    one = compression_quality.score_quality(documents(spark, texts), marks).select("doc_id", "score").collect()
    other = documents(spark, texts).withColumn("source", F.lit("x")).withColumn("lang", F.lit("y"))
    assert plain(one) == plain(compression_quality.score_quality(other, marks).select("doc_id", "score").collect())


def test_packed_pieces_hold_every_id_once(spark):
    docs = [(i, "the quick brown fox " * (i * 37 % 900)) for i in range(60)] + [(60, None)]
    rows = packing.packed_digests(documents(spark, docs).repartition(3), BYTE_BPE).collect()
    library = Tokenizer.from_file(BYTE_BPE)
    ids = {i: np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for i, t in docs}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
        assert zlib.crc32(ids[r["doc_id"]][r["start"] : r["start"] + r["length"]].tobytes()) == r["ids_crc32"]
        assert r["doc_tokens"] == len(ids[r["doc_id"]])
    for key, place, size in ((by_doc, "start", None), (by_sequence, "offset", 2048)):
        for name, pieces in key.items():
            at = 0
            for r in sorted(pieces, key=lambda r: r[place]):
                assert r[place] == at
                at += r["length"]
            assert at == len(ids[name]) if size is None else at <= size and (at == size or at & (at - 1) == 0)


def test_assignment_balances_cost():
    sizes = np.random.default_rng(3).integers(20, 900, 400).tolist()
    total = sum(sizes)
    capacities = [2048] * (total // 2048) + packing.powers_of_two(total % 2048)
    placed = packing.assign([(i, 0, n) for i, n in enumerate(sizes)], capacities)
    cost, used = np.zeros(len(capacities)), np.zeros(len(capacities), int)
    for (_, _, length), at, _ in placed:
        cost[at] += length + length**2 / 1024
        used[at] += length
    assert used.tolist() == capacities
    full = cost[used == 2048]
    assert full.std() / full.mean() < 0.1


def test_token_shards_and_single_documents(spark, tmp_path):
    docs = documents(spark, [(i, f"document {i} " * (i % 7)) for i in range(40)]).repartition(4)
    path = f"{tmp_path}/files"
    token_files.write_token_files(docs, WORD_BPE, path)
    library = Tokenizer.from_file(WORD_BPE)
    expect = {i: np.array([*library.encode(f"document {i} " * (i % 7), add_special_tokens=False).ids, 2], "<u4").tobytes() for i in range(40)}
    assert {r["doc_id"]: bytes(r["ids"]) for r in token_files.read_documents(spark, path, [3, 17, 99]).collect()} == {i: expect[i] for i in (3, 17)}
    rows = {r["doc_id"]: r for r in token_files.round_trip(docs, WORD_BPE).collect()}
    start = 0
    for i in range(40):
        assert (rows[i]["start"], rows[i]["n_tokens"], rows[i]["ids_crc32"]) == (start, len(expect[i]) // 4, zlib.crc32(expect[i]))
        start += len(expect[i]) // 4


def shard_writer():
    return token_files.ShardWriter(b"dictionary one" * 10, 2, token_files.SHARD_BYTES)


def test_shard_refuses_another_dictionary_and_damage():
    writer = shard_writer()
    writer.add(4, np.array([1, 2, 3], "<u4").tobytes())
    data = writer.close(0, 0) + b"\n"
    shard = token_files.Shard(data)
    assert np.frombuffer(shard.ids(0, shard.reader(b"dictionary one" * 10)), "<u4").tolist() == [1, 2, 3]
    with pytest.raises(ValueError):
        shard.reader(b"another")
    for at in (token_files.HEAD_BYTES, len(data) - 2):
        with pytest.raises(ValueError, match="damaged"):
            token_files.Shard(data[:at] + bytes([data[at] ^ 1]) + data[at + 1 :])


def test_files_keep_every_byte(spark, tmp_path):
    blobs = [bytes(range(256)) * 3, b"", b"\n\r\n", b"\xff\xfe\x00\xed\xa0\x80", bytes(reversed(range(256)))]
    rows = spark.createDataFrame([(bytearray(b),) for b in blobs], "blob binary").coalesce(1)
    common.raw_files(rows, f"{tmp_path}/raw")
    back = spark.read.format("binaryFile").load(f"{tmp_path}/raw").orderBy("path").select("content").collect()
    assert [bytes(r[0]) for r in back] == [b + b"\n" for b in blobs]


def test_single_documents_open_few_shards(spark, tmp_path):
    docs = documents(spark, [(i, f"document {i} of many words " * 20) for i in range(300)] + [(None, "no id")])
    path = f"{tmp_path}/files"
    token_files.write_token_files(docs.repartition(3), WORD_BPE, path, shard_bytes=1000)
    index = token_files.read_index(spark, path).orderBy("low").collect()
    assert len(index) > 8 and sum(r["n"] for r in index) == sum(r["n_tokens"] for r in token_files.read_token_files(spark, path).collect())
    # All other shards may be gone.
    holds = [r for r in index if r["low"] is not None and r["low"] <= 123 <= r["high"]]
    for r in index:
        if r not in holds:
            os.remove(r["path"].removeprefix("file:"))
    (found,) = token_files.read_documents(spark, path, [123]).collect()
    library = Tokenizer.from_file(WORD_BPE)
    assert bytes(found["ids"]) == np.array([*library.encode("document 123 of many words " * 20, add_special_tokens=False).ids, 2], "<u4").tobytes()


def test_dictionary_sample_is_bounded_and_read_by_all_tasks(spark):
    docs = documents(spark, [(i % 9 or None, f"text {i % 120}") for i in range(900)]).repartition(6)
    sample = token_files.sampled(docs, 50)
    assert sample.count() == 50 and sample.rdd.getNumPartitions() == 1
    plan = sample._jdf.queryExecution().executedPlan().toString()
    assert "Coalesce" not in plan and "SinglePartition" in plan
    assert token_files.sampled(docs.where("doc_id = 1"), 50).count() <= 40


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_edit_distance():
    rnd = random.Random(2)
    for _ in range(1500):
        a, b = ("".join(rnd.choice("abé") for _ in range(rnd.randrange(14))) for _ in range(2))
        most, true = rnd.randrange(9), levenshtein(a, b)
        assert line_dedup.edit_distance(a, b, 99) == true
        assert (line_dedup.edit_distance(a, b, most) <= most) == (true <= most)


def test_line_hashes_against_brute_force():
    lines = [b" ".join(str(i % 900).encode() for i in range(n)) for n in (1, 2, 254, 255, 256, 510, 511, 2000)]
    for line, found in zip(lines, line_dedup.simhashes(lines), strict=True):
        words = set(line.split(b" "))
        ones = sum(np.unpackbits(np.frombuffer(xxhash.xxh3_128_digest(w), np.uint8)).astype(int) for w in words)
        assert found == np.packbits(2 * ones > len(words)).tobytes()


def test_lines_against_brute_force(spark):
    rnd = random.Random(4)
    vocabulary = [f"w{i}" for i in range(400)]
    base = [" ".join(rnd.choices(vocabulary, k=rnd.randrange(6, 40))) for _ in range(60)]

    def variant(line):
        words = line.split()
        words[rnd.randrange(len(words))] = "Changed!"
        return " ".join(words)

    docs = [(i, "\n".join(rnd.choice([line, line.upper(), variant(line), "few words"]) for line in rnd.sample(base, 6))) for i in range(50)]
    rows = {r["doc_id"]: r["kept"] for r in line_dedup.dedup_lines(documents(spark, docs)).collect()}
    # Near pairs that share a block make candidate groups; near pairs inside a group are verified and connected.
    first = {}
    for doc, text in docs:
        for at, raw in enumerate(text.split("\n")):
            line = line_dedup.normalise(raw)
            if len(line.split(" ")) >= line_dedup.MIN_WORDS:
                first.setdefault(line, (doc, at))
    lines = list(first)
    hashes = [np.frombuffer(h, np.uint8) for h in line_dedup.simhashes([x.encode() for x in lines])]

    def groups(pairs):
        root = list(range(len(lines)))
        for i, j in pairs:
            a, b = root[i], root[j]
            root = [a if r == b else r for r in root]
        return root

    near = []
    for j in range(len(lines)):
        for i in range(j):
            short, long = sorted((len(lines[i]), len(lines[j])))
            if int(np.bitwise_count(hashes[i] ^ hashes[j]).sum()) <= line_dedup.NEAR_BITS and 5 * short >= 4 * long:
                near.append((i, j))
    meet = lambda a, b: any(a[x] == b[x] and a[y] == b[y] for x, y in line_dedup.PAIRS)
    candidate = groups([(i, j) for i, j in near if meet(hashes[i], hashes[j])])
    links = [
        (i, j) for i, j in near if candidate[i] == candidate[j] and 5 * levenshtein(lines[i], lines[j]) <= max(len(lines[i]), len(lines[j]))
    ]
    root, linked = groups(links), len(links)
    assert linked > 20
    keeper = {}
    for i, line in enumerate(lines):
        keeper[root[i]] = min(keeper.get(root[i], first[line]), first[line])
    for doc, text in docs:
        kept = []
        for at, raw in enumerate(text.split("\n")):
            line = line_dedup.normalise(raw)
            if line not in first or keeper[root[lines.index(line)]] == (doc, at):
                kept.append(raw)
        assert rows[doc] == "\n".join(kept)


def test_near_hashes_always_meet():
    rnd = np.random.default_rng(5)
    for _ in range(3000):
        one = rnd.integers(0, 256, 16, dtype=np.uint8)
        bits = np.unpackbits(one)
        bits[rnd.choice(128, 7, replace=False)] ^= 1
        other = np.packbits(bits)
        assert any(one[x] == other[x] and one[y] == other[y] for x, y in line_dedup.PAIRS)


def test_links_of_real_lines_are_found(spark):
    """Recall over every fifteenth line of the data against all lines, by edit distance alone: no hash and no block."""
    folder = "/root/testdata/sf0.01"
    docs = table(spark, folder, "documents")
    keyed = line_dedup._keyed(docs)
    lines = line_dedup.line_rows(keyed)
    distinct = lines.groupBy("line").agg(F.min(F.struct("doc", "th", "at")).alias("_f"), F.first("hash").alias("hash"), F.first("chars").alias("chars"))
    distinct = common.stored(distinct.select(F.monotonically_increasing_id().alias("id"), "line", "hash", "chars", "_f.*"), "distinct")
    root = dict(line_dedup.fuzzy_groups(keyed, distinct).collect())
    texts = {r["doc_id"]: r["text"] or "" for r in docs.select("doc_id", "text").collect()}
    known = [(r["id"], line_dedup.normalised(texts[r["doc"]])[r["at"]]) for r in distinct.select("id", "doc", "at").collect()]
    known.sort(key=lambda x: x[1])
    alphabet = {c: i for i, c in enumerate(sorted({c for _, t in known for c in t}))}
    counts = np.zeros((len(known), len(alphabet)), np.int16)
    for i, (_, t) in enumerate(known):
        for c, n in Counter(t).items():
            counts[i, alphabet[c]] = n
    sizes = counts.sum(axis=1)
    links = found = 0
    for i in range(0, len(known), 15):
        apart = counts - counts[i]
        # No edit distance is below the characters one line has more of than the other.
        least = np.maximum(np.where(apart > 0, apart, 0).sum(axis=1), np.where(apart < 0, -apart, 0).sum(axis=1))
        for j in np.flatnonzero(5 * least <= np.maximum(sizes, sizes[i])):
            if i != j and line_dedup.similar(known[i][1], known[j][1]):
                links += 1
                one, other = known[i][0], known[j][0]
                found += root.get(one, one) == root.get(other, other)
    assert links > 25 and found >= 0.9 * links, (found, links)


def test_large_group_of_lines_is_verified_in_cells(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "SLICE", 16)
    words = " ".join(f"word{i}" for i in range(60))
    docs = [(i, f"{words} last{i}") for i in range(100)]
    kept = {r["doc_id"]: r["kept"] for r in line_dedup.dedup_lines(documents(spark, docs)).collect()}
    assert kept[0] == docs[0][1] and sum(map(bool, kept.values())) <= 3


def test_connected_groups(spark):
    chain = [(f"{i:04d}", f"{i + 1:04d}") for i in range(0, 300)]
    star = [("x", f"y{i}") for i in range(300)] + [("alone", "alone")]
    found = dict(components.connected_groups(spark.createDataFrame(chain + star, "a string, b string")).collect())
    assert {found[f"{i:04d}"] for i in range(301)} == {"0000"} and {found[f"y{i}"] for i in range(300)} == {"x"} and found["alone"] == "alone"


def test_urls():
    segments_of = {"net/": 0, "example.net/en/": 1, "example.com/de/": 0, "org/fr/": 1, "bad.example.com": 2}

    class Known:
        lengths = np.array([0, 1, 4])

        def find(self, digests, keys):
            return np.array([segments_of.get(k.decode(), -1) for k in keys])

    found = url_filter.probe(
        ["a.example.net", "example.net", "xexample.net", "a.bad.example.com", "notnet", "fr.org", "net", ""], ["/en/x", "/EN/", "/en/", "", "/", "/fr/", "", "/"], [Known()]
    )
    assert found["rule"].tolist() == ["example.net/en/", "net/", "net/", None, None, "org/fr/", None, None]
    assert found["listed"].tolist() == [False, False, False, True, False, False, False, False]


def test_url_table(spark):
    urls = ["HTTP://A.Example.NET/en/x?q", "https://spam-x.example.com?/de/", "example.net/en/", None, "x://", "a://ÄB.net/#/", "https://ok.example.com/de/1", "s://www.ads.org/fr/", "t://u://v.net/p"]
    pages = spark.createDataFrame([(i, u, "h", "p") for i, u in enumerate(urls)], "page_id long, url string, host string, path string")
    rows = {r["page_id"]: tuple(r)[1:5] for r in url_filter.judge_pages(pages).collect()}
    assert rows == {
        0: ("a.example.net", "/en/x", "example.net/en/", "allow"),
        1: ("spam-x.example.com", "", None, "block"),
        2: ("", "", None, "allow"),
        3: ("", "", None, "allow"),
        4: ("", "", None, "allow"),
        5: ("Äb.net", "/", "net/", "block"),
        6: ("ok.example.com", "/de/1", "example.com/de/", "block"),
        7: ("www.ads.org", "/fr/", "org/fr/", "allow"),
        8: ("u:", "//v.net/p", None, "allow"),
    }
    assert url_filter.judge_pages(pages.where("false")).collect() == []


def test_equal_digests_are_told_apart(tmp_path):
    import struct

    entries = [b"one", b"two", b"three"]
    offsets = np.array([0, 3, 6, 11], "<u8")
    head = struct.pack(url_filter.HEAD, url_filter.MAGIC, 3, 1)
    blob = head + np.array([0], "<i8").tobytes() + np.array([7, 7, 9], "<i8").tobytes() + offsets.tobytes() + bytes([2, 1, 0]) + b"".join(entries)
    (tmp_path / "s").write_bytes(blob + b"\n")
    segment = url_filter.Segment(str(tmp_path / "s"))
    assert segment.find(np.array([7, 7, 7, 9, 99]), [b"two", b"one", b"none", b"three", b"x"]).tolist() == [1, 2, -1, 0, -1]


def test_fingerprints_locate_edits(spark):
    a = "title\n\nfirst paragraph\nsecond\n\n" + "long " * 60
    b = a.replace("second", "changed")
    docs = documents(spark, [(1, a), (2, b), (3, a), (4, "")])
    trees = {r["doc_id"]: r for r in merkle.fingerprints(docs).collect()}
    assert trees[1]["fingerprint"] == trees[3]["fingerprint"] != trees[2]["fingerprint"]
    both = spark.createDataFrame([(a, b)], "a string, b string").select(merkle.changed_paragraphs(merkle.sections(F.col("a")), merkle.sections(F.col("b"))))
    assert [tuple(x) for x in both.first()[0]] == [(1, 1)]
    near = {r["doc_id"]: r for r in merkle.edited_fingerprints(docs).collect()}
    assert near[3]["near_next"] == 0.0 and near[1]["near_edited"] < 1.0 and near[2]["edited_sha256"] == hashlib.sha256((b[: len(b) - len(b) // 4] + a[: len(b) // 4]).encode()).hexdigest()


def test_repeats_against_brute_force(spark):
    rnd = random.Random(6)
    blocks = ["".join(rnd.choice("abcdefgh é") for _ in range(rnd.randrange(60, 400))) for _ in range(12)]
    docs = [(i, "".join(rnd.choice([rnd.choice(blocks), rnd.choice(blocks)[: rnd.randrange(400)], "x" * rnd.randrange(300)]) for _ in range(4))) for i in range(40)]
    seen, expect = set(), {}
    for i, text in docs:
        data = text.encode()
        gone = bytearray(len(data))
        for s in range(len(data) - 99):
            if data[s : s + 100] in seen:
                gone[s : s + 100] = b"\1" * 100
            seen.add(data[s : s + 100])
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        spans = sum(g and (not i or not gone[i - 1]) for i, g in enumerate(gone))
        expect[i] = (i, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    found = {r["doc_id"]: tuple(r) for r in prefix_parsing.removed_digests(documents(spark, docs).repartition(5)).collect()}
    assert found == expect and sum(r[2] for r in expect.values()) > 1000


def test_triggers_fill_their_buckets_evenly(spark):
    rnd = random.Random(8)
    docs = [(i, "".join(rnd.choice("abcdefgh ") for _ in range(20_000))) for i in range(20)]
    keyed = spark.createDataFrame([(d, i, bytearray(t.encode())) for i, (d, t) in enumerate(docs)], "doc long, th long, data binary")
    sizes = [r["n"] for r in prefix_parsing.parse_texts(keyed, 8).where("bucket >= 0").groupBy("bucket").agg(F.sum(F.octet_length("phrases")).alias("n")).collect()]
    assert len(sizes) == 8 and max(sizes) < 1.2 * min(sizes)


def test_long_texts_are_parsed_in_parts(monkeypatch):
    monkeypatch.setattr(prefix_parsing, "BATCH_BYTES", 1 << 12)
    data = bytes(np.random.default_rng(1).integers(97, 123, 30_000, dtype=np.uint8))
    units = [(1, 2, at, data[at : at + 4096 + 99]) for at in range(0, len(data) - 99, 4096)]
    found = np.sort(prefix_parsing.parse(units), order="lo")
    assert found["lo"][0] == 0 and (found["lo"][1:] == found["lo"][:-1] + found["n"][:-1]).all() and found["lo"][-1] + found["n"][-1] == len(data) - 99
    assert found["n"].max() <= 61 and (found["rel"] <= 60).all()


def test_mix_meets_targets(spark):
    docs = documents(spark, [(i, "w " * (i % 9 + 1), ["a", "b", "c", None][i % 4]) for i in range(400)])
    rows = fair_mix.taken_words(docs).collect()
    again = fair_mix.taken_words(docs.repartition(7)).collect()
    assert plain(rows) == plain(again)
    taken, target = Counter(), {}
    for r in rows:
        taken[r["target"], r["source_size"]] += r["taken"]
        target[r["target"], r["source_size"]] = r["target"]
        assert 0 <= r["taken"] <= 3 * r["size"]
    assert all(abs(taken[k] - v) <= 1 for k, v in target.items())
    total = sum(r["size"] for r in rows)
    assert abs(sum(target.values()) - total) < 1e-6 and total - 4 <= sum(taken.values()) <= total


def test_excess_is_shared_again(spark):
    docs = documents(spark, [(1, "w " * 10, "a"), (2, "w " * 100, "b"), (3, "w " * 1000, "c"), (4, None, "d")])
    rows = {r["doc_id"]: r["target"] for r in fair_mix.taken_words(docs).collect()}
    assert rows[1] == 30 and rows[2] == 300 and rows[3] == pytest.approx(780) and rows[4] == 0


def jaccard_brute(docs):
    sets = defaultdict(list)
    for k, t in docs:
        w = (t or "").encode().split()
        m = min(5, len(w))
        sets[frozenset(tuple(w[i : i + m]) for i in range(len(w) - m + 1)) if w else frozenset()].append(k)
    keys = list(sets)
    root = list(range(len(keys)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    links = Counter()
    for j, b in enumerate(keys):
        for i, a in enumerate(keys[:j]):
            if a and b and 5 * len(a & b) >= 4 * len(a | b):
                links[i] += 1
                links[j] += 1
                root[find(j)] = find(i)
    group = defaultdict(list)
    for i, k in enumerate(keys):
        group[find(i)] += sets[k]
    return {d: (min(sets[k]), len(sets[k]), min(group[find(i)]), links[i]) for i, k in enumerate(keys) for d in sets[k]}


@pytest.mark.parametrize("small, block", [(24, 512), (3, 8)])
def test_jaccard_join_against_brute_force(spark, monkeypatch, small, block):
    monkeypatch.setattr(lsh_forest, "SMALL_NODE", small)
    monkeypatch.setattr(lsh_forest, "BLOCK", block)
    rnd = random.Random(8)
    docs = []
    for family in range(6):
        base = [f"f{family}w{i}" for i in range(120)]
        for copy in range(4 + 8 * (family == 0)):
            words = list(base)
            for _ in range(copy % 4):
                words[rnd.randrange(120)] = f"edit{rnd.randrange(10**6)}"
            docs.append((len(docs), " ".join(words)))
    docs += [(len(docs), docs[0][1]), (len(docs) + 1, "few words"), (len(docs) + 2, "few  words"), (len(docs) + 3, "")]
    found = {r["doc_id"]: tuple(r)[1:] for r in lsh_forest.join_digests(documents(spark, docs)).collect()}
    assert found == jaccard_brute(docs)
    assert sum(r[3] for r in found.values()) > 30


def test_forest_recall():
    assert lsh_forest.recall(lsh_forest.prefix_depth()) >= lsh_forest.TARGET_RECALL
    assert lsh_forest.prefix_depth(0.5) > lsh_forest.prefix_depth(0.999)


def test_common_prefixes():
    paths = np.array([[1, 2, 3], [1, 2, 4], [1, 2, 4], [7, 2, 4], [7, 2, 4]])
    assert lsh_forest.common_prefixes(np.array([0, 0, 0, 0, 1]), paths).tolist() == [2, 3, 0, 0]


@pytest.mark.parametrize("batch, parts", [(1, 1), (2, 3), (10_000, 1)])
def test_forest_keeps_what_shares_a_prefix(spark, batch, parts):
    rnd = random.Random(3)
    labels = [b"".join(rnd.choice([0, 1, 2]).to_bytes(2, "big") for _ in range(lsh_forest.TREES * lsh_forest.DEPTH)) for _ in range(300)]
    rows = [(bytearray([i // 256, i % 256]), 9, bytearray(x)) for i, x in enumerate(labels)]
    classes = spark.createDataFrame(rows, "cls binary, n long, labels binary")
    size, count = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"), spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        found = {(r["tree"], bytes(r["path"]), bytes(r["cls"])) for r in lsh_forest.forest(classes, 6).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        spark.conf.set("spark.sql.shuffle.partitions", count)
    width, need = 2 * lsh_forest.DEPTH, set()
    for tree in range(lsh_forest.TREES):
        paths = [(x[tree * width : (tree + 1) * width], bytes(r[0])) for x, r in zip(labels, rows, strict=True)]
        met = Counter(p[:12] for p, _ in paths)
        need |= {(tree, p, c) for p, c in paths if met[p[:12]] > 1}
    # The ends of a partition stay, too.
    assert need <= found and len(found - need) <= 2 * parts and need


def test_forest_shortens_by_document(spark):
    rnd = random.Random(4)

    def edited(base, changes):
        words = list(base)
        for at in rnd.sample(range(len(words)), changes):
            words[at] = f"edit{rnd.randrange(10**9)}"
        return " ".join(words)

    docs = []
    for family in range(8):
        # Copies with one changed word in 300, and with some 2 % of the words changed.
        base = [f"f{family}w{i}" for i in range(300)]
        changes = 1 if family % 2 else 6
        docs += [(len(docs) + i, t) for i, t in enumerate([" ".join(base), edited(base, changes)])]
    docs.append((len(docs), " ".join(f"alone{i}" for i in range(300))))
    table = documents(spark, docs)
    signed = lsh_forest.signatures(table)
    classes = signed.selectExpr("cls", "n", "labels", "doc_id as rep_id", "th as rep_th")
    _, depths = lsh_forest.forest_links(table, classes)
    known = {r["rep_id"]: r["depth"] for r in depths.join(classes, "cls").collect()}
    assert all(known[i] == lsh_forest.DEPTH for i in range(16) if (i // 2) % 2)
    least = {d: (1 - (1 - lsh_forest.TARGET_RECALL) ** (1 / lsh_forest.TREES)) ** (1 / d) for d in (7, 8)}
    similarity = spark.range(1).select(*[lsh_forest.shortened(lsh_forest.F.lit(s)).alias(n) for n, s in {"a": least[8] + 0.001, "b": least[7] + 0.001, "c": 0.8, "d": None}.items()])
    assert tuple(similarity.first()) == (8, 7, 6, 6)
    assert len({d for i, d in known.items()}) > 1


def test_common_counts():
    rnd = np.random.default_rng(5)
    sets = [np.unique(rnd.integers(0, 9000, rnd.integers(1, 3000)).astype(np.uint64)) for _ in range(9)]
    expect = [[len(np.intersect1d(a, b)) for b in sets[4:]] for a in sets[:4]]
    assert lsh_forest.common_counts(sets[:4], sets[4:]).tolist() == expect
