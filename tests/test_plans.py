"""What the plans must and must not contain."""

import pytest
from pyspark.sql import functions as F

from prefkit.catalog.queries import CATALOG
from prefkit.operators import batching, lookup as lk, positions as ps, sampling as sa, splits as sp, vocabulary as vo
from prefkit.operators.vocabulary import build_vocabulary, decode, encode
from prefkit.session import fresh_path
from prefkit.sources import sinks

PYTHON = {"batch_udf_scores", "compare_sample_50", "generate_responses", "encode_with_hook"}
# Their answers are written by the query itself; what is left is a scan.
STORED = {"generated_rollouts", "bradley_terry", "step_metrics_log", "export_pairs", "csv_round_trip"}
BATCH = sorted(name for name in set(CATALOG) - STORED if not name.startswith("stream_"))


@pytest.fixture
def plain(spark):
    """Static plans, without automatic broadcast of test-sized tables."""
    saved = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    for k, v in saved.items():
        spark.conf.set(k, v)


def listed(seq):
    return [seq.apply(i) for i in range(seq.size())]


def nodes(plan):
    yield plan
    for child in [*listed(plan.children()), *listed(plan.subqueries())]:
        yield from nodes(child)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan()


def reads_rows(plan):
    """Whether some path down to a table meets no aggregate on its way."""
    if "Aggregate" in plan.nodeName():
        return False
    children = listed(plan.children())
    return any(reads_rows(c) for c in children) if children else "Scan" in plan.nodeName() and "OneRow" not in plan.nodeName()


@pytest.mark.parametrize("name", BATCH)
def test_scales(plain, data, name):
    for node in nodes(plan_of(CATALOG[name](plain, data))):
        kind = node.nodeName()
        assert "Cartesian" not in kind and "NestedLoop" not in kind, kind
        if name not in PYTHON:
            assert not any(w in kind for w in ("Python", "Pandas", "Arrow")), kind
        if kind == "Exchange" and "SinglePartition" in node.outputPartitioning().toString():
            assert not reads_rows(node), node.toString()
        assert kind not in ("TakeOrderedAndProject", "CollectLimit", "GlobalLimit"), kind


def exchanges(df):
    return [n for n in nodes(plan_of(df)) if n.nodeName() == "Exchange"]


@pytest.fixture
def stored(plain, tmp_path):
    path = str(tmp_path / "rows")
    plain.range(1000).select(F.col("id").alias("row_id"), F.col("id").cast("string").alias("text")).write.parquet(path)
    return plain.read.parquet(path)


def scans(df):
    return [n.toString() for n in nodes(plan_of(df)) if n.nodeName().startswith("Scan parquet")]


@pytest.mark.parametrize("split", [lambda d: sp.ordered_split(d, 0.1), lambda d: sp.seeded_split(d, 0.05, 42)])
def test_a_split_filters_the_table_in_place(stored, split):
    df = split(stored)
    top = [n.nodeName() for n in _spine(plan_of(df))]
    assert "Exchange" not in top and "Sort" not in top
    narrow = [s for s in scans(df) if "text" not in s.split("Location")[0]]
    assert len(scans(df)) - len(narrow) == 1


def _spine(plan):
    yield plan
    for child in listed(plan.children()):
        yield from _spine(child)


def test_a_sample_moves_no_rows(stored):
    assert "Exchange" not in [n.nodeName() for n in _spine(plan_of(sa.sample_rows(stored, 5, 1)))]


def test_ranking_shuffles_rows_once(stored):
    wide = [e for e in exchanges(ps.hash_rank(stored, "row_id", 1)) if "text" in e.child().output().toString()]
    assert len(wide) == 1


def test_encoding_moves_the_text_and_nothing_else(stored):
    words = build_vocabulary(stored, F.col("text"))
    df = encode(stored, "row_id", {"ids": F.col("text")}, words)
    # The other exchanges count the vocabulary's own partitions.
    (moved,) = [e for e in exchanges(df) if "row_id" in e.outputPartitioning().toString()]
    assert "text" in moved.child().output().toString()


def test_scoring_aggregates_before_it_shuffles(stored):
    from prefkit.operators.lexical_reward import fit_log_odds, log_odds_scorer

    weights = fit_log_odds(stored, F.col("text"), F.col("text"))
    df = log_odds_scorer(weights)(stored, ["row_id"], {"score": F.col("text")})
    (moved,) = exchanges(df)
    below = [n.nodeName() for n in _spine(moved.child())]
    assert "Aggregate" in next(n for n in below if not n.startswith("WholeStageCodegen"))


def test_a_large_vocabulary_meets_each_text_once(stored, monkeypatch):
    """Past the broadcast limit one explosion is stored, as distinct words with places; tokens are in no shuffle."""
    words = build_vocabulary(stored, F.col("text"))
    expected = sorted(encode(stored, "row_id", {"ids": F.col("text")}, words).collect())
    monkeypatch.setattr(lk, "BROADCAST_BYTES", 0)
    kept = []
    monkeypatch.setattr(vo, "written", lambda df, label: kept.append(df) or df.checkpoint())
    df = encode(stored, "row_id", {"ids": F.col("text")}, words)
    assert not [n for n in nodes(plan_of(df)) if n.nodeName() == "Generate" and "text" in n.toString()]
    (entries,) = kept
    (moved,) = exchanges(entries)
    assert "text" in moved.child().output().toString()
    assert len([n for n in nodes(plan_of(entries)) if n.nodeName() == "Generate"]) == 2  # sides, then words
    assert sorted(df.collect()) == expected
    ids = df.select("row_id", "ids")
    assert sorted(decode(ids, "row_id", "ids", words).collect()) == sorted((r["row_id"], r["text"]) for r in stored.collect())


def test_scores_past_the_broadcast_limit(stored, monkeypatch):
    from prefkit.operators import lexical_reward as lr

    weights = lr.fit_log_odds(stored, F.col("text"), F.lit("1 2 3"))
    rows = stored.select("row_id", F.concat_ws(" ", "text", "text", F.lit("3 new")).alias("text"))
    expected = sorted(lr.log_odds_scorer(weights)(rows, ["row_id"], {"score": F.col("text")}).collect())
    monkeypatch.setattr(lk, "BROADCAST_BYTES", 0)
    assert sorted(lr.log_odds_scorer(weights)(rows, ["row_id"], {"score": F.col("text")}).collect()) == expected


def test_padding_moves_the_ids_once(stored):
    words = build_vocabulary(stored, F.col("text"))
    ids = encode(stored, "row_id", {"ids": F.col("text")}, words)
    placed = batching.micro_batches(ids, rows=8, accumulate=1, seed=1, keys=stored)
    df = batching.pad_batches(placed, "ids", 0)
    moved = [e for e in exchanges(df) if "ids" in [a.name() for a in listed(e.child().output())]]
    assert len(moved) == 1 and "batch_id" in moved[0].outputPartitioning().toString()


def test_a_batch_is_read_from_its_bucket(plain):
    path = fresh_path(plain, "bucketed")
    table = f"bucketed_{path.rsplit('-', 1)[1]}"
    rows = plain.range(4000).select(F.col("id").alias("row_id"), F.floor(F.col("id") / 32).alias("batch_id"), F.lit("train").alias("split"))
    sinks.export_training_set(rows, table, path, buckets=16)
    one = sinks.read_batch(plain, table, "train", 7)
    (scan,) = [n for n in nodes(plan_of(one)) if n.nodeName().startswith("Scan parquet")]
    assert sorted(r["row_id"] for r in one.collect()) == list(range(224, 256))
    # Rows of the batch's bucket alone are read; batches of other buckets lie on either side of its number.
    assert 32 <= scan.metrics().apply("numOutputRows").value() < 1000
    widths = plain.table(table).groupBy("batch_id").count()
    assert not exchanges(widths) and {r["count"] for r in widths.collect()} == {32}
    again = f"{table}_again"
    sinks.open_training_set(plain, again, path, rows.schema, buckets=16)
    assert sorted(sinks.read_batch(plain, again, "train", 7).collect()) == sorted(one.collect())
