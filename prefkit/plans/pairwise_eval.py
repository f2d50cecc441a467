"""How often a scorer prefers the chosen answer."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from prefkit.functions.chat import CHATML, ChatTemplate
from prefkit.functions.scores import beats, verdict
from prefkit.operators.inference import Scorer
from prefkit.operators.metrics import pairwise_summary
from prefkit.operators.splits import eval_rows
from prefkit.plans.training_sets import pair_texts


def score_pairs(df: DataFrame, scorer: Scorer, system: str, template: ChatTemplate = CHATML) -> DataFrame:
    """row_id and both scores; both sides are scored in one pass."""
    chosen, rejected = pair_texts(system, template)
    return scorer(df, ["row_id"], {"chosen_score": chosen, "rejected_score": rejected})


def judged(scored: DataFrame) -> DataFrame:
    """Adds ``correct`` and its label."""
    chosen, rejected = F.col("chosen_score"), F.col("rejected_score")
    return scored.withColumn("correct", beats(chosen, rejected)).withColumn("verdict", verdict(chosen, rejected))


def pairwise_eval(
    df: DataFrame,
    scorer: Scorer,
    system: str,
    first: int | None = None,
    fraction: float = 0.05,
    seed: int = 42,
    template: ChatTemplate = CHATML,
) -> DataFrame:
    """total, correct, accuracy on the whole test side of the reward split, or its ``first`` rows where given."""
    held_out = eval_rows(df, fraction, seed, first)
    return pairwise_summary(score_pairs(held_out, scorer, system, template))
