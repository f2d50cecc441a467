"""The pipeline's stages on small tables, each against a plain version of what it may keep."""

from collections import Counter, defaultdict
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as cp
from prefkit.llm import compression_quality, fair_mix, line_dedup, lsh_forest
from tests.llm.helpers import SCHEMA, odd_documents
from tests.llm.test_operators import levenshtein

WORD = re.compile(r"[^\x20\x09-\x0D]+")
CLASHES = ("_id", "_key", "_words", "_th", "_nth", "_place", "_size", "id", "th", "nth", "row", "kept", "words", "size", "keeper")


def sentences(rnd, n):
    common = "the of and a in to it is was that for on with as by".split()
    return "\n".join(" ".join(rnd.choice(common) if rnd.random() < 0.4 else "".join(rnd.choice("abcdefghilmnoprstu") for _ in range(rnd.randint(3, 9))) for _ in range(rnd.randint(7, 14))) + "." for _ in range(n))


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rnd = random.Random(11)
    texts = [sentences(rnd, rnd.randint(3, 8)) for _ in range(70)]
    texts += [" ".join(rnd.choice(["#$%", "&&*|", "<>##", "%%%$"]) for _ in range(60)) for _ in range(30)]
    texts += [texts[0], texts[1] + " one more", texts[2].split("\n")[0] + "\n" + texts[3], "", None, texts[4].upper()]
    rows = [(i, t, "en", f"source {i % 4}" if i % 9 else None, 7) for i, t in enumerate(texts)]
    rows += [rows[5], (None, texts[6], None, None, None)]
    folder = str(tmp_path_factory.mktemp("corpus"))
    docs = spark.createDataFrame(rows, SCHEMA)
    docs.write.parquet(f"{folder}/documents.parquet")
    labels = [(i, int(i < 70), 0) for i in range(100)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, docs


def plain_rows(df):
    return Counter(map(tuple, df.collect()))


def test_classifier_stage_keeps_what_the_classifier_accepts(spark, corpus):
    folder, docs = corpus
    scores = compression_quality.score_quality(docs, spark.read.parquet(f"{folder}/labels.parquet")).collect()
    refused = {r["doc_id"] for r in scores if not r["predicted"]}
    kept = cp.quality_classifier(spark, docs, folder)
    assert plain_rows(kept) == Counter(tuple(r) for r in docs.collect() if r["doc_id"] not in refused)
    assert refused >= set(range(70, 100)) and len(refused & set(range(70))) < 8


def test_line_stage_against_brute_force(spark, corpus):
    folder, docs = corpus
    rows = sorted({tuple(r) for r in docs.collect()}, key=lambda r: (-1 if r[0] is None else r[0]))
    seen: list[str] = []
    expect = {}
    for r in rows:
        kept = []
        for raw in (r[1] or "").split("\n"):
            line = line_dedup.normalise(raw)
            if len(line.split(" ")) >= line_dedup.MIN_WORDS:
                if any(levenshtein(line, s) * 5 <= max(len(line), len(s)) for s in seen if 4 * max(len(line), len(s)) <= 5 * min(len(line), len(s))):
                    continue
                seen.append(line)
            kept.append(raw)
        expect[r[0]] = "\n".join(kept)
    out = cp.line_dedup_stage(spark, docs, folder).collect()
    assert all(r["text"] == expect[r["doc_id"]] and r["n_chars"] == len(r["text"]) for r in out)
    gone = set(expect) - {r["doc_id"] for r in out}
    assert all(not WORD.search(expect[i]) for i in gone) and {100, 105} <= gone


def test_filtered_columns_of_python_are_made_once(spark, corpus):
    folder, docs = corpus
    pairs = spark.createDataFrame([(b"a", b"b")], "a binary, b binary")
    sets = spark.createDataFrame([(b"a", b"12345678"), (b"b", b"12345678")], "cls binary, shingles binary")
    for made in (cp.line_dedup_stage(spark, docs, folder), lsh_forest.verified_pairs(pairs, sets)):
        assert made._jdf.queryExecution().sparkPlan().toString().count("ArrowEvalPython") == 1


def test_join_stage_against_brute_force(spark, corpus):
    folder, docs = corpus
    rows = [tuple(r) for r in docs.collect()]

    def shingle_set(text):
        words = (text or "").encode().split()
        n = min(5, len(words))
        return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set()

    sets = [shingle_set(r[1]) for r in rows]
    root = list(range(len(rows)))
    for j in range(len(rows)):
        for i in range(j):
            both = len(sets[i] & sets[j])
            if sets[i] == sets[j] or (both and 5 * both >= 4 * len(sets[i] | sets[j])):
                a, b = root[i], root[j]
                root = [a if x == b else x for x in root]
    groups = defaultdict(set)
    for i, r in enumerate(rows):
        groups[root[i]].add(r)
    smallest = {min((r for r in g if r[0] is not None), key=lambda r: r[0], default=next(iter(g))) for g in groups.values()}
    assert plain_rows(cp.jaccard_join(spark, docs, folder)) == Counter(smallest)


def test_mix_stage_takes_what_the_mix_says(spark, corpus):
    folder, docs = corpus
    taken = Counter()
    for r in fair_mix.taken_words(docs).collect():
        taken[r["doc_id"]] += r["taken"]
    out = Counter()
    texts = defaultdict(set)
    for r in docs.collect():
        texts[r["doc_id"]].add(r["text"])
    for r in cp.source_mix(spark, docs, folder).collect():
        out[r["doc_id"]] += len(WORD.findall(r["text"]))
        assert any(t and t.startswith(r["text"]) for t in texts[r["doc_id"]]) and r["n_chars"] in (7, None, len(r["text"]))
    assert out == Counter({k: n for k, n in taken.items() if n})


def test_pipeline_packs_what_the_stages_keep(spark, corpus):
    folder, docs = corpus
    kept = docs
    for _, stage in cp.STAGES[:-1]:
        before, kept = kept, stage(spark, kept, folder)
        assert kept.columns == before.columns and set(kept.dtypes) == set(before.dtypes)
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = Counter()
    for r in kept.collect():
        data = np.array([*library.encode(r["text"] or "", add_special_tokens=False).ids, 1], "<u4")
        ids[r["doc_id"], len(data)] += len(data)
    packed = Counter()
    for r in cp.run(spark, folder).collect():
        packed[r["doc_id"], r["doc_tokens"]] += r["length"]
    assert packed == ids and 104 not in {doc for doc, _ in packed}


@pytest.mark.parametrize("name", [name for name, _ in cp.STAGES])
def test_stages_on_odd_tables(spark, corpus, name):
    folder, _ = corpus
    stage, docs = dict(cp.STAGES)[name], odd_documents(spark)
    if name == "packing":
        assert cp.packed(spark, docs.limit(0), folder).collect() == []
        return
    clashing = docs.withColumns({c: F.col("doc_id") * 3 for c in CLASHES})
    got = stage(spark, clashing, folder)
    assert got.columns == clashing.columns
    plain = stage(spark, docs, folder).collect()
    assert Counter(tuple(r)[:5] for r in got.collect()) == Counter(map(tuple, plain))
    # Columns that no stage knows stay with their documents.
    assert all(r[c] == (None if r["doc_id"] is None else r["doc_id"] * 3) for r in got.collect() for c in CLASHES)
    assert stage(spark, docs.limit(0), folder).collect() == []
