"""Past the broadcast limit only rare words meet the large table."""

import numpy as np
from pyspark.sql import functions as F
import pytest

from prefkit.operators import bradley_terry as bt, lexical_reward as lr, lookup as lk, vocabulary as vo
from prefkit.operators.positions import seed_hash
from prefkit.session import fresh_path
from prefkit.sources import derived
from prefkit.streaming.replay import write_slices

LIMIT = 64 * 5 + 60  # four or five words a table


@pytest.fixture(scope="module")
def texts(spark):
    rows = [(i, f"the of and the rare{i} <|im_end|> of") for i in range(300)] + [(7, "of zz the"), (7, "and of zz the"), (None, "the x"), (400, None), (401, "")]
    return spark.createDataFrame(rows, "row_id bigint, text string").repartition(4)


@pytest.fixture(scope="module")
def words(texts):
    return vo.build_vocabulary(texts.where("row_id < 200"), F.col("text"))


def kept_rows(monkeypatch, module):
    kept = []
    written = module.written
    monkeypatch.setattr(module, "written", lambda df, label: kept.append(written(df, label)) or kept[-1])
    return kept


def rows_of(df):
    return sorted(df.collect(), key=repr)


def test_only_rare_words_are_stored(texts, words, monkeypatch):
    one = {"ids": F.col("text")}
    expected = rows_of(vo.encode(texts, "row_id", one, words, with_text=True))
    cut = rows_of(vo.encode(texts, "row_id", one, words, max_len=3))
    ids = vo.encode(texts, "row_id", one, words)
    decoded = [rows_of(vo.decode(ids, "row_id", "ids", words, skip_special=s)) for s in (False, True)]
    monkeypatch.setattr(lk, "BROADCAST_BYTES", LIMIT)
    kept = kept_rows(monkeypatch, vo)
    assert rows_of(vo.encode(texts, "row_id", one, words, with_text=True)) == expected
    # One row a text and one for each of its rare words, not one for each word.
    assert kept[0].count() <= 305 + 302 + 10
    assert rows_of(vo.encode(texts, "row_id", one, words, max_len=3)) == cut
    assert [rows_of(vo.decode(ids, "row_id", "ids", words, skip_special=s)) for s in (False, True)] == decoded


def test_unknown_ids_decode_to_nothing_on_either_path(spark, words, monkeypatch):
    rows = spark.createDataFrame([(1, [6, 999_999, None, 7]), (1, [7, 6]), (2, None), (3, [])], "k bigint, ids array<int>")
    small = rows_of(vo.decode(rows, "k", "ids", words))
    monkeypatch.setattr(lk, "BROADCAST_BYTES", LIMIT)
    assert rows_of(vo.decode(rows, "k", "ids", words)) == small


def test_scores_meet_the_table_with_rare_words_only(texts, monkeypatch):
    weights = lr.fit_log_odds(texts, F.col("text"), F.lit("the of of"))
    score = lambda: rows_of(lr.log_odds_scorer(weights)(texts, ["row_id"], {"a": F.col("text"), "b": F.concat_ws(" ", "text", F.lit("of new"))}))
    expected = score()
    monkeypatch.setattr(lk, "BROADCAST_BYTES", LIMIT)
    kept = kept_rows(monkeypatch, lr)
    assert score() == expected
    assert kept[0].count() <= 2 * (305 + 302) + 305 + 10


def test_unlabelled_texts_are_not_moved(spark, tmp_path, monkeypatch):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"), F.lit("en").alias("lang"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    docs.where("doc_id < 40").select("doc_id", (F.col("doc_id") % 4 == 0).cast("int").alias("quality")).write.parquet(f"{tmp_path}/labels.parquet")
    spark.range(5).select(F.col("id").alias("item_id"), F.concat(F.lit("question "), "id").alias("text")).write.parquet(f"{tmp_path}/benchmark.parquet")
    pairs = derived.labelled_preferences(spark, str(tmp_path))
    assert pairs.count() == 10
    found = {r["row_id"]: r for r in pairs.collect()}
    by_hash = lambda ids: [r["doc_id"] for r in spark.createDataFrame([(i,) for i in ids], "doc_id bigint").orderBy(seed_hash("pair", F.col("doc_id"))).collect()]
    good, bad = by_hash(range(0, 40, 4)), by_hash(i for i in range(40) if i % 4)
    asked = by_hash(range(5))
    for rank, doc in enumerate(good):
        assert found[doc]["rejected"] == f"text {bad[rank % len(bad)]}" and found[doc]["question"] == f"question {asked[rank % 5]}"
        assert found[doc]["chosen"] == f"text {doc}"
    # No join of texts sorts them, and all texts that are shuffled have met the labels.
    plan = pairs._jdf.queryExecution().sparkPlan().toString()
    assert "ShuffledHashJoin" in plan and "LeftSemi" in plan


def test_pairs_are_counted_without_a_row_per_word(spark, monkeypatch):
    rows = [(1, "a b a", "b c"), (1, "c", None), (2, None, ""), (3, "a a", "a")]
    pairs = spark.createDataFrame(rows, "row_id bigint, chosen string, rejected string")
    seen = []
    written = bt.written
    monkeypatch.setattr(bt, "written", lambda df, label: seen.append(df) or written(df, label))
    found = {r["row_id"]: dict(zip(r["places"], r["values"])) for r in bt.pair_vectors(pairs, F.col("chosen"), F.col("rejected"), "row_id", 1 << 20).collect()}
    plan = seen[0]._jdf.queryExecution().sparkPlan().toString()
    assert "Generate" not in plan
    at = {w: spark.range(1).select(bt.place_of(F.lit(w), 1 << 20)).first()[0] for w in "abc"}
    # Rows of one key are one pair: a 2, b 1, c 1 against b 1, c 1.
    assert found[1] == pytest.approx({at["a"]: 2 / 6**0.5, at["b"]: 1 / 6**0.5 - 1 / 2**0.5, at["c"]: 1 / 6**0.5 - 1 / 2**0.5})
    assert found[2] == {} and found[3] == {}
    weights = np.zeros(1 << 20)
    weights[[at["a"], at["b"]]] = 0.25, -1.5
    scores = bt.bradley_terry_scorer(bt.BradleyTerry(weights, 0.0, 0.1))(pairs, ["row_id"], {"c": F.col("chosen"), "r": F.col("rejected")})
    got = {r["row_id"]: (r["c"], r["r"]) for r in scores.collect()}
    assert got[1] == pytest.approx(((2 * 0.25 - 1.5) / 6**0.5, -1.5 / 2**0.5)) and got[2] == (None, 0.0) and got[3] == (0.25, 0.25)


def test_a_replay_has_few_files_however_its_table_is_cut(spark):
    path = fresh_path(spark, "slices")
    rows = spark.range(400, numPartitions=16).select("id", F.timestamp_seconds(100_000 + F.col("id")).alias("ts"))
    write_slices(rows, "ts", path, 4)
    back = spark.read.parquet(path)
    assert len(back.inputFiles()) <= 8 and back.distinct().count() == 400
