"""Splits, samples, ranks and draws against brute force."""

import hashlib
import math
import random

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F
import pytest

from prefkit.operators import batching, positions as ps, sampling as sa, splits as sp


def frame(spark, keys, parts=3):
    return spark.createDataFrame([(k,) for k in keys], "row_id bigint").repartition(parts)


def hashed(keys, seed=42):
    return sorted(keys, key=lambda k: (hashlib.md5(f"{seed}|{k}".encode()).hexdigest(), k))


def test_keys(rows, name="test"):
    return {r["row_id"] for r in rows.where(F.col("split") == name).collect()}


test_keys.__test__ = False

KEYS = st.sets(st.integers(-(2**63), 2**63 - 1), max_size=40)
RELAXED = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@RELAXED
@given(keys=KEYS)
def test_ordered_split(spark, keys):
    ordered = sorted(keys)
    size = math.ceil(0.1 * len(ordered))
    got = test_keys(sp.ordered_split(frame(spark, keys), 0.1))
    assert got == set(ordered[len(ordered) - size :])


@RELAXED
@given(keys=KEYS)
def test_seeded_split(spark, keys):
    got = test_keys(sp.seeded_split(frame(spark, keys), 0.05, 42))
    assert got == set(hashed(keys)[: math.ceil(0.05 * len(keys))])


def test_whole_and_empty_test_sides(spark):
    rows = frame(spark, range(5))
    assert len(test_keys(sp.ordered_split(rows, 1.0))) == 5
    assert len(test_keys(sp.ordered_split(rows, 0.0))) == 0
    assert len(test_keys(sp.seeded_split(rows, 1.0, 1))) == 5
    assert len(test_keys(sp.seeded_split(rows, 0.0, 1))) == 0


def test_split_is_the_same_in_any_layout_and_nested(spark):
    keys = range(0, 3000, 3)
    sides = [test_keys(sp.seeded_split(frame(spark, keys, p), 0.05, 42)) for p in (1, 4, 16)]
    assert sides[0] == sides[1] == sides[2] and len(sides[0]) == 50
    assert sides[0] < test_keys(sp.seeded_split(frame(spark, keys), 0.1, 42))
    assert sides[0] != test_keys(sp.seeded_split(frame(spark, keys), 0.05, 43))


@pytest.mark.parametrize("first, expected", [(None, 10), (4, 4), (0, 0), (100, 10)])
def test_eval_rows(spark, first, expected):
    keys = range(100)
    got = {r[0] for r in sp.eval_rows(frame(spark, keys), 0.1, 42, first).collect()}
    assert got == set(hashed(keys)[:expected])


@pytest.mark.parametrize("n, expected", [(None, 30), (0, 30), (7, 7), (30, 30), (31, 30)])
def test_sample_rows(spark, n, expected):
    got = {r[0] for r in sa.sample_rows(frame(spark, range(30)), n, 5).collect()}
    assert got == set(hashed(range(30), 5)[:expected])


def test_hash_rank_with_a_hot_group(spark):
    keys = {"hot": list(range(2000)), "cold": [5000, 5001]}
    rows = spark.createDataFrame([(g, k) for g, ks in keys.items() for k in ks], "g string, row_id bigint")
    got = ps.hash_rank(rows, "row_id", 42, by=["g"]).collect()
    for g, ks in keys.items():
        assert {r["row_id"]: r["rank"] for r in got if r["g"] == g} == {k: i for i, k in enumerate(hashed(ks), 1)}
        assert {r["rank_of"] for r in got if r["g"] == g} == {len(ks)}


def test_number_rows(spark):
    values = [(k, k % 7) for k in range(500)]
    random.Random(1).shuffle(values)
    rows = spark.createDataFrame(values, "row_id bigint, v int").repartition(6)
    got = {r["row_id"]: r["pos"] for r in ps.number_rows(rows, F.desc("v"), F.asc("row_id")).collect()}
    assert got == {k: i for i, (k, _) in enumerate(sorted(values, key=lambda t: (-t[1], t[0])))}


def test_rows_at(spark):
    keys = [k * 11 for k in range(300)]
    wanted = [0, 0, 5, 299, 150]
    positions = spark.createDataFrame(list(enumerate(wanted)), "slot int, pos bigint")
    got = ps.rows_at(frame(spark, keys), "row_id", 42, positions).collect()
    assert {(r["slot"], r["row_id"]) for r in got} == {(s, hashed(keys)[p]) for s, p in enumerate(wanted)}


@pytest.mark.parametrize("n", [8, 9, 50, 10**12])
def test_step_draws_are_distinct_and_in_range(spark, n):
    rows = sa.step_draws(spark, n, 40, 8, 42).collect()
    assert len(rows) == 320
    for step in range(40):
        drawn = [r["pos"] for r in rows if r["step"] == step]
        assert len(set(drawn)) == 8 and min(drawn) >= 0 and max(drawn) < n
    if n == 8:
        assert len({tuple(r["pos"] for r in rows if r["step"] == s) for s in range(40)}) > 30


def test_step_draws_cover_all_places_evenly(spark):
    counts = sa.step_draws(spark, 20, 1000, 8, 42).groupBy("pos").count().collect()
    assert len(counts) == 20
    assert all(330 < r["count"] < 470 for r in counts)


def test_too_large_a_batch(spark):
    with pytest.raises(ValueError):
        sa.step_draws(spark, 7, 1, 8, 42)


def test_length_draws(spark):
    rows = spark.range(5000).select(sa.length_draw(42, F.col("id"), F.lit(0)).alias("n")).agg(F.min("n"), F.max("n")).first()
    assert (rows[0], rows[1]) == (32, 255)


def test_micro_batches(spark):
    got = batching.micro_batches(frame(spark, range(0, 700, 7)), 4, 8).collect()
    assert all((r["pos"], r["micro_batch"], r["batch_id"]) == (r["row_id"] // 7, r["row_id"] // 28, r["row_id"] // 224) for r in got)
    seeded = batching.micro_batches(frame(spark, range(100)), 4, 8, seed=1).collect()
    assert {r["row_id"]: r["pos"] for r in seeded} == {k: i for i, k in enumerate(hashed(range(100), 1))}


def test_pad_batches(spark):
    rows = spark.createDataFrame([(1, 0, [1]), (2, 0, [1, 2, 3]), (3, 1, [9]), (4, 1, [])], "row_id bigint, batch_id bigint, ids array<int>")
    got = {r["row_id"]: (r["ids"], r["mask"]) for r in batching.pad_batches(rows, "ids", 0).collect()}
    assert got == {1: ([1, 0, 0], [1, 0, 0]), 2: ([1, 2, 3], [1, 1, 1]), 3: ([9], [1]), 4: ([0], [0])}


def test_a_row_without_a_key_is_an_error(spark):
    rows = spark.createDataFrame([(1,), (None,), (3,)], "row_id bigint")
    for split in (lambda d: sp.ordered_split(d, 0.5), lambda d: sp.seeded_split(d, 0.5, 1)):
        with pytest.raises(Exception, match="a row has no key"):
            split(rows).collect()


def test_draws_from_more_than_a_million_places(spark):
    got = sa.step_draws(spark, 5_000_000, 40, 8, 3).collect()
    assert len({(r["step"], r["pos"]) for r in got}) == 320 and max(r["pos"] for r in got) > 4_000_000


def test_batches_are_numbered_apart_on_each_side(spark):
    rows = spark.range(100).select(F.col("id").alias("row_id"), F.when(F.col("id") % 4 == 0, "test").otherwise("train").alias("split"), F.lit("x").alias("wide"))
    placed = batching.micro_batches(rows, rows=4, accumulate=2, seed=1, keys=rows.select("split", "row_id"), by=["split"]).collect()
    for name, n in (("test", 25), ("train", 75)):
        mine = [r for r in placed if r["split"] == name]
        assert sorted(r["pos"] for r in mine) == list(range(n)) and all(r["batch_id"] == r["pos"] // 8 and r["wide"] == "x" for r in mine)
