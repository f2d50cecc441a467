"""Aggregates over scored pairs, compared models and rollout steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from prefkit.functions.scores import beats, pair_loss, percent


def n_rows() -> Column:
    return F.count(F.lit(1))


def pairwise_summary(scored: DataFrame) -> DataFrame:
    """total, correct and accuracy; the accuracy of no rows is null."""
    right = F.count_if(beats(F.col("chosen_score"), F.col("rejected_score")))
    return scored.agg(n_rows().alias("total"), right.alias("correct"), percent(right, n_rows()).alias("accuracy"))


def pairwise_loss(scored: DataFrame, center: float = 0.01) -> DataFrame:
    """Mean ranking loss, the centring term and their sum."""
    chosen, rejected = F.col("chosen_score"), F.col("rejected_score")
    rank = F.avg(pair_loss(chosen, rejected))
    middle = F.lit(float(center)) * F.avg((chosen + rejected) * (chosen + rejected))
    return scored.agg(rank.alias("rank_loss"), middle.alias("center_loss"), (rank + middle).alias("loss"))


def comparison_summary(rows: DataFrame, a: str, b: str, by: list[str] | None = None) -> DataFrame:
    """Counts, mean scores, lift, wins of ``b`` and win rate, over everything or by group.

    ``n`` counts all rows, ``n_answered_a`` and ``n_answered_b`` the scored ones of each side, ``n_paired`` those
    scored on both. Means, lift, wins and rate are over the pairs, so both sides answer the same
    questions and the lift is the mean difference.
    """
    one, two = F.col(a), F.col(b)
    paired = one.isNotNull() & two.isNotNull()
    wins, pairs = F.count_if(beats(two, one)), F.count_if(paired)
    mean_a, mean_b = F.avg(F.when(paired, one)), F.avg(F.when(paired, two))
    return rows.groupBy(*(by or [])).agg(
        n_rows().alias("n"),
        F.count(one).alias("n_answered_a"),
        F.count(two).alias("n_answered_b"),
        pairs.alias("n_paired"),
        mean_a.alias("mean_a"),
        mean_b.alias("mean_b"),
        (mean_b - mean_a).alias("lift"),
        wins.alias("wins"),
        percent(wins, pairs).alias("win_rate"),
    )


def long_report(rows: DataFrame, keys: list[str], models: dict[str, tuple[str, str]]) -> DataFrame:
    """One row per question and model; the last model carries the lift over the first.

    ``models`` maps a model's name to its response and score columns, in order.
    """
    names = list(models)
    base, last = models[names[0]][1], models[names[-1]][1]
    entries: list[Column] = []
    for name, (response, score) in models.items():
        lift = F.col(last) - F.col(base) if name == names[-1] else F.lit(None).cast("double")
        entries.append(
            F.struct(F.lit(name).alias("model"), F.col(response).alias("response"), F.col(score).alias("score"), lift.alias("lift"))
        )
    return rows.select(*keys, F.inline(F.array(*entries)))


def wide_report(long: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """Back from ``long_report``: a score column per model."""
    return long.groupBy(*keys).pivot("model", names).agg(F.max("score"))


def step_rewards(rollouts: DataFrame) -> DataFrame:
    """Number of rollouts and mean reward per run and step."""
    return rollouts.groupBy("run_id", "step").agg(
        n_rows().alias("n"), F.avg(F.col("reward").cast("double")).alias("mean_reward")
    )


def progress_steps(steps: DataFrame, every: int = 10) -> DataFrame:
    return steps.where(F.col("step") % every == 0)


def snapshot_steps(steps: DataFrame, every: int = 50) -> DataFrame:
    """Steps after which a snapshot is kept, with its number counted from 1."""
    return steps.where((F.col("step") + 1) % every == 0).withColumn("snapshot", (F.col("step") + 1).cast("bigint"))
