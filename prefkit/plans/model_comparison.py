"""Two models' answers to the same questions, scored and compared."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from prefkit.functions.chat import CHATML, ChatTemplate, answered_messages, render
from prefkit.functions.scores import four_places, two_places_percent
from prefkit.operators.inference import Scorer
from prefkit.operators.positions import number_rows
from prefkit.operators.sampling import sample_rows
from prefkit.session import shared_folder

KEYS = ["source", "row_id"]
# The result columns of a comparison, in file order.
RESULT_COLUMNS = ["question", "sft_response", "ppo_response", "sft_rm_score", "ppo_rm_score", "score_diff"]


def comparison_questions(df: DataFrame, common: DataFrame, n: int | None = None, seed: int = 42) -> DataFrame:
    """source, row_id, question: ``df`` or a sample of ``n`` of it, and all common questions, duplicates kept."""
    sampled = sample_rows(df.select("row_id", "question"), n, seed).withColumn("source", F.lit("sample"))
    return sampled.unionByName(common.select("row_id", "question").withColumn("source", F.lit("common"))).select(
        *KEYS, "question"
    )


def compare(
    questions: DataFrame,
    sft: DataFrame,
    ppo: DataFrame,
    scorer: Scorer,
    system: str = "",
    template: ChatTemplate = CHATML,
) -> DataFrame:
    """One row per question with both responses, both scores and their difference.

    Responses are keyed like the questions, so all three meet in one partitioning.
    A question without a response keeps its row; what is missing is null.
    """
    answered = questions.join(sft.withColumnRenamed("response", "sft_response"), KEYS, "left").join(
        ppo.withColumnRenamed("response", "ppo_response"), KEYS, "left"
    )
    texts = {
        f"{model}_rm_score": render(answered_messages(system, F.col("question"), F.col(f"{model}_response")), template)
        for model in ("sft", "ppo")
    }
    scored = scorer(answered, KEYS, texts, keep=RESULT_COLUMNS[:3])
    for model in ("sft", "ppo"):
        has_response = F.col(f"{model}_response").isNotNull()
        scored = scored.withColumn(f"{model}_rm_score", F.when(has_response, F.col(f"{model}_rm_score")))
    diff = (F.col("ppo_rm_score") - F.col("sft_rm_score")).alias("score_diff")
    return scored.select(*KEYS, *RESULT_COLUMNS[:-1], diff)


def in_input_order(rows: DataFrame) -> DataFrame:
    """Sampled questions first, then the common ones, each by key."""
    return rows.orderBy(F.col("source").desc(), "row_id")


def common_report(rows: DataFrame) -> DataFrame:
    """question_no and the printed text of each common question."""
    shared_folder(rows.sparkSession)
    # Range sorting samples its input first; a checkpoint keeps that from scoring twice.
    common = number_rows(rows.where(F.col("source") == "common").checkpoint(), F.asc("row_id"), name="_pos")
    text = F.concat_ws(
        "\n",
        F.concat(F.lit("SFT: "), "sft_response"),
        F.concat(F.lit("SFT score: "), four_places(F.col("sft_rm_score"))),
        F.concat(F.lit("PPO: "), "ppo_response"),
        F.concat(F.lit("PPO score: "), four_places(F.col("ppo_rm_score"))),
        F.concat(F.lit("Difference: "), four_places(F.col("score_diff"))),
    )
    return common.select((F.col("_pos") + 1).alias("question_no"), "question", text.alias("report"))


def summary_text(summary: DataFrame, a: str = "SFT", b: str = "PPO") -> DataFrame:
    """The printed form of ``comparison_summary``: one column ``report``; lines of missing figures are left out."""
    lines = F.concat_ws(
        "\n",
        F.concat(F.lit("Questions: "), F.col("n").cast("string")),
        F.when(F.col("n_paired") < F.col("n"), F.concat(F.lit("Answered by both: "), F.col("n_paired").cast("string"))),
        F.concat(F.lit(f"Mean {a} score: "), four_places(F.col("mean_a"))),
        F.concat(F.lit(f"Mean {b} score: "), four_places(F.col("mean_b"))),
        F.concat(F.lit("Lift: "), four_places(F.col("lift"))),
        F.concat(F.lit(f"{b} wins: "), F.col("wins").cast("string")),
        F.concat(F.lit("Win rate: "), two_places_percent(F.col("win_rate"))),
    )
    return summary.select(lines.alias("report"))
