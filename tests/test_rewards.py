import math
import random

import numpy as np
from pyspark.sql import functions as F
import pytest

from prefkit.operators import bradley_terry as bt, metrics
from prefkit.operators.inference import batch_score_udf, encode_udf, generate, model_scorer
from prefkit.operators.lexical_reward import fit_log_odds, log_odds_scorer
from prefkit.plans import model_comparison as cmp
from prefkit.plans.pairwise_eval import judged, pairwise_eval, score_pairs
from prefkit.sources.derived import labelled_preferences

# Published reward scores of two models on ten questions, and the printed lifts.
SCORES_A = (-3.83, -3.81, 3.95, -2.91, -3.22, 0.28, -3.70, -3.81, -4.13, -4.09)
SCORES_B = (3.98, -3.33, 4.06, -4.03, -3.69, -4.19, -3.42, -3.70, -2.89, 4.06)
LIFTS = (7.81, 0.48, 0.11, -1.13, -0.47, -4.47, 0.28, 0.11, 1.23, 8.16)


def test_published_scores(spark):
    rows = spark.createDataFrame([(i, "q", a, b) for i, (a, b) in enumerate(zip(SCORES_A, SCORES_B))], "i int, q string, a double, b double")
    got = metrics.comparison_summary(rows, "a", "b").first()
    assert (got["n"], got["wins"]) == (10, 7)
    assert [got[c] for c in ("mean_a", "mean_b", "lift", "win_rate")] == pytest.approx([-2.527, -1.315, 1.212, 70.0])
    long = metrics.long_report(rows, ["i"], {"a": ("q", "a"), "b": ("q", "b")})
    lifts = {r["i"]: r["lift"] for r in long.where("model = 'b'").collect()}
    assert all(abs(lifts[i] - lift) < 0.011 for i, lift in enumerate(LIFTS))
    assert long.where("model = 'a' and lift is null").count() == 10
    wide = {r["i"]: (r["a"], r["b"]) for r in metrics.wide_report(long, ["i"], ["a", "b"]).collect()}
    assert wide == dict(enumerate(zip(SCORES_A, SCORES_B)))


def test_odd_scores_count_in_the_total_only(spark):
    nan = float("nan")
    rows = spark.createDataFrame([(2.0, 1.0), (1.0, 1.0), (nan, 0.0), (None, 0.0), (1.0, nan)], "chosen_score double, rejected_score double")
    got = metrics.pairwise_summary(rows).first()
    assert (got["total"], got["correct"], got["accuracy"]) == (5, 1, 20.0)
    assert [r["correct"] for r in judged(rows).collect()] == [True, False, False, False, False]
    empty = metrics.pairwise_summary(rows.where("false")).first()
    assert (empty["total"], empty["correct"], empty["accuracy"]) == (0, 0, None)
    nothing = metrics.comparison_summary(rows.where("false"), "chosen_score", "rejected_score").first()
    assert (nothing["n"], nothing["wins"], nothing["win_rate"], nothing["lift"]) == (0, 0, None, None)


def test_loss(spark):
    rows = spark.createDataFrame([(1.0, 0.5), (-2.0, 3.0)], "chosen_score double, rejected_score double")
    got = metrics.pairwise_loss(rows, center=0.01).first()
    rank = (math.log(1 + math.exp(-0.5)) + math.log(1 + math.exp(5.0))) / 2
    assert (got["rank_loss"], got["center_loss"]) == pytest.approx((rank, 0.01 * (1.5**2 + 1.0) / 2))
    assert got["loss"] == pytest.approx(got["rank_loss"] + got["center_loss"])


PAIRS = [(1, "q", "good good nice", "bad"), (2, "q", "nice", "bad awful"), (3, "q", "same", "same"), (4, "q", "", "bad")]


@pytest.fixture(scope="module")
def pairs(spark):
    return spark.createDataFrame(PAIRS, "row_id bigint, question string, chosen string, rejected string").repartition(2)


@pytest.fixture(scope="module")
def weights(pairs):
    return fit_log_odds(pairs, F.col("chosen"), F.col("rejected"))


def test_log_odds(weights):
    got = {r["tok"]: (r["c"], r["r"], r["weight"]) for r in weights.collect()}
    assert got["good"] == (2, 0, round(math.log(3), 9))
    assert got["bad"] == (0, 3, round(math.log(1 / 4), 9))
    assert got["same"] == (1, 1, 0.0)


def test_log_odds_scores(pairs, weights):
    scored = log_odds_scorer(weights)(pairs, ["row_id"], {"c": F.col("chosen"), "r": F.concat_ws(" ", "rejected", F.lit("new"))})
    got = {r["row_id"]: (r["c"], r["r"]) for r in scored.collect()}
    assert got[1] == pytest.approx(((2 * math.log(3) + math.log(3)) / 3, math.log(1 / 4) / 2))
    assert got[4][0] == 0.0


def test_equal_texts_score_equal(spark, weights):
    """Sums must not depend on the order in which rows arrive."""
    rng = random.Random(3)
    text = " ".join(rng.choice(["good", "bad", "nice", "awful", "same", "new"]) for _ in range(400))
    rows = spark.createDataFrame([(i, text) for i in range(200)], "row_id bigint, t string").repartition(13)
    assert log_odds_scorer(weights)(rows, ["row_id"], {"s": F.col("t")}).select("s").distinct().count() == 1


def test_cut_texts(pairs):
    cut = fit_log_odds(pairs, F.col("chosen"), F.col("rejected"), max_len=1)
    assert {r["tok"]: r["c"] for r in cut.collect()} == {"good": 1, "nice": 1, "same": 1, "bad": 0}
    scored = log_odds_scorer(cut, max_len=1)(pairs, ["row_id"], {"c": F.col("chosen")}, keep=["question"])
    got = {r["row_id"]: (r["c"], r["question"]) for r in scored.collect()}
    assert got[1] == (pytest.approx(math.log(2)), "q")


def test_swapping_the_sides(spark, data):
    rows = labelled_preferences(spark, data)
    weights = fit_log_odds(rows, F.col("chosen"), F.col("rejected"))
    scored = score_pairs(rows, log_odds_scorer(weights), "s").persist()
    right = metrics.pairwise_summary(scored).first()
    swapped = scored.select(F.col("rejected_score").alias("chosen_score"), F.col("chosen_score").alias("rejected_score"))
    wrong = metrics.pairwise_summary(swapped).first()
    ties = scored.where("chosen_score = rejected_score").count()
    assert right["correct"] + wrong["correct"] + ties == right["total"]


def test_shuffled_labels_are_near_chance(spark):
    """The pipeline itself does not peek: sides swapped by a hash leave nothing to learn."""
    folder = "/root/testdata/sf0.01"
    rows = labelled_preferences(spark, folder)
    flip = F.pmod(F.xxhash64("row_id"), F.lit(2)) == 0
    mixed = rows.select(
        "row_id", "question",
        F.when(flip, F.col("rejected")).otherwise(F.col("chosen")).alias("chosen"),
        F.when(flip, F.col("chosen")).otherwise(F.col("rejected")).alias("rejected"),
    )
    from prefkit.operators.splits import seeded_split, side
    from prefkit.plans.training_sets import pair_texts

    train = side(seeded_split(mixed, 0.3, 42), "train")
    got = pairwise_eval(mixed, log_odds_scorer(fit_log_odds(train, *pair_texts("s"))), "s", None, 0.3).first()
    assert 25 < got["accuracy"] < 75


def test_first_rows_clamp(pairs, weights):
    got = pairwise_eval(pairs, log_odds_scorer(weights), "s", first=100, fraction=0.5).first()
    assert got["total"] == 2


def dense_optimum(vectors, reg, features):
    """The same fit by plain gradient descent in memory."""
    rows = vectors.collect()
    x = np.zeros((len(rows), features))
    for i, r in enumerate(rows):
        x[i, r["places"]] = r["values"]
    w = np.zeros(features)
    for _ in range(3000):
        w -= (reg * w - (x / (1 + np.exp(x @ w))[:, None]).mean(0)) / (reg + 1)
    return w


def test_bradley_terry(spark, pairs):
    model = bt.fit_bradley_terry(pairs, F.col("chosen"), F.col("rejected"), features=64, distance=1e-9)
    got = {r["row_id"]: (r["c"], r["r"]) for r in bt.bradley_terry_scorer(model)(pairs, ["row_id"], {"c": F.col("chosen"), "r": F.col("rejected")}).collect()}
    assert got[1][0] > got[1][1] and got[2][0] > got[2][1] and got[3][0] == got[3][1] and got[4][0] == 0.0
    vectors = bt.pair_vectors(pairs, F.col("chosen"), F.col("rejected"), "row_id", 64)
    assert model.distance <= 1e-9 and np.allclose(model.weights, dense_optimum(vectors, 0.1, 64), atol=1e-8)
    # Swapping the sides turns the reward round.
    swapped = bt.fit_bradley_terry(pairs, F.col("rejected"), F.col("chosen"), features=64, distance=1e-9)
    assert np.allclose(model.weights, -swapped.weights, atol=1e-8)


def test_the_gradient_is_that_of_the_loss(pairs):
    vectors = bt.pair_vectors(pairs, F.col("chosen"), F.col("rejected"), "row_id", 16)
    weights = np.linspace(-1, 1, 16)
    loss, gradient = bt.loss_and_gradient(vectors, weights, 0.1)
    for i in (0, 3, 9):
        step = np.eye(16)[i] * 1e-6
        up, down = (bt.loss_and_gradient(vectors, w, 0.1)[0] for w in (weights + step, weights - step))
        assert (up - down) / 2e-6 == pytest.approx(gradient[i], abs=1e-6)


def test_bradley_terry_of_nothing(spark, pairs):
    model = bt.fit_bradley_terry(pairs.where("false"), F.col("chosen"), F.col("rejected"), features=16)
    assert not model.weights.any() and model.gradient == 0.0
    nulls = spark.createDataFrame([(1, None, "bad")], "row_id bigint, c string, r string")
    fitted = bt.fit_bradley_terry(pairs, F.col("chosen"), F.col("rejected"), features=16)
    assert bt.bradley_terry_scorer(fitted)(nulls, ["row_id"], {"c": F.col("c"), "r": F.col("r")}).first()["c"] is None


def test_a_null_answer_has_no_score_and_never_wins(spark, weights):
    rows = [(1, "q", None, "bad"), (2, "q", "good", None), (3, "q", "good", "bad"), (4, None, "good", "bad"), (5, "q", "", "bad")]
    rows = spark.createDataFrame(rows, "row_id bigint, question string, chosen string, rejected string")
    scored = {r["row_id"]: (r["chosen_score"], r["rejected_score"]) for r in score_pairs(rows, log_odds_scorer(weights), "s").collect()}
    assert scored[1][0] is None and scored[2][1] is None and scored[4] == (None, None)
    assert scored[1][1] is not None and scored[5][0] is not None
    verdicts = {r["row_id"]: r["verdict"] for r in judged(score_pairs(rows, log_odds_scorer(weights), "s")).collect()}
    assert verdicts == {1: "Incorrect", 2: "Incorrect", 3: "Correct", 4: "Incorrect", 5: "Correct"}


def test_means_and_lift_are_over_the_pairs(spark):
    rows = spark.createDataFrame([(1.0, None), (2.0, 5.0), (None, 9.0), (None, None), (4.0, 3.0)], "a double, b double")
    got = metrics.comparison_summary(rows, "a", "b").first().asDict()
    assert got == {"n": 5, "n_answered_a": 3, "n_answered_b": 3, "n_paired": 2, "mean_a": 3.0, "mean_b": 4.0, "lift": 1.0, "wins": 1, "win_rate": 50.0}
    text = cmp.summary_text(metrics.comparison_summary(rows, "a", "b")).first()["report"].splitlines()
    assert text[:2] == ["Questions: 5", "Answered by both: 2"] and len(text) == 7
    none = metrics.comparison_summary(rows.where("a is null"), "a", "b").first()
    assert (none["n"], none["n_paired"], none["lift"], none["win_rate"]) == (2, 0, None, None)


def test_an_unanswered_question_keeps_its_row(spark, weights):
    asked = spark.createDataFrame([("sample", i, f"q {i}") for i in range(4)], "source string, row_id bigint, question string")
    of = lambda ids: spark.createDataFrame([("sample", i, "good nice") for i in ids], "source string, row_id bigint, response string")
    rows = {r["row_id"]: r for r in cmp.compare(asked, of([0, 1]), of([1, 2]), log_odds_scorer(weights)).collect()}
    assert len(rows) == 4 and rows[1]["score_diff"] == 0.0
    assert rows[0]["ppo_rm_score"] is None and rows[2]["sft_rm_score"] is None and rows[3]["score_diff"] is None


def test_a_tokenizer_is_given_lists(spark):
    sizes = spark.sparkContext.accumulator(0)

    def make():
        def encode(texts):
            assert isinstance(texts, list) and None not in texts and len(texts) <= 7
            sizes.add(1)
            return [[len(t), 1] for t in texts]

        return encode

    texts = spark.createDataFrame([(i, None if i % 5 == 0 else "x" * i) for i in range(50)], "i int, t string").coalesce(1)
    got = {r["i"]: r["ids"] for r in texts.select("i", encode_udf(make, batch_size=7)("t").alias("ids")).collect()}
    assert got == {i: None if i % 5 == 0 else [i, 1] for i in range(50)} and sizes.value == 6


def lengths():
    return lambda texts: [float(len(t)) for t in texts]


def test_batch_model(spark):
    texts = spark.createDataFrame([(i, "x" * i) for i in range(100)], "i int, t string").repartition(4)
    scored = texts.select("i", batch_score_udf(lengths, batch_size=7)("t").alias("s"))
    assert {r["i"]: r["s"] for r in scored.collect()} == {i: float(i) for i in range(100)}
    assert dict(scored.dtypes)["s"] == "float"
    both = model_scorer(lengths)(texts, ["i"], {"a": F.col("t"), "b": F.concat("t", "t")}, keep=["t"])
    assert all(r["b"] == 2 * r["a"] == 2 * len(r["t"]) for r in both.collect())


def test_model_scores_only_the_chosen_rows(spark):
    from prefkit.operators.sampling import sample_rows

    seen = spark.sparkContext.accumulator(0)

    def counting():
        def score(texts):
            seen.add(len(texts))
            return [0.0] * len(texts)

        return score

    texts = spark.range(1000).select(F.col("id").alias("row_id"), F.col("id").cast("string").alias("t")).repartition(4)
    sample_rows(texts, 9, 1).select("row_id", batch_score_udf(counting)("t").alias("s")).collect()
    assert seen.value == 9


def test_generate(spark):
    rows = spark.createDataFrame([(1, 2, "a b c", 2), (1, 3, "d", 5)], "step int, slot int, prompt string, gen_len int")
    got = generate(rows, lambda: lambda p, n: [" ".join(t.split()[:k]) for t, k in zip(p, n)], ["step", "slot"]).collect()
    assert {(r["step"], r["slot"], r["response"]) for r in got} == {(1, 2, "a b"), (1, 3, "d")}
