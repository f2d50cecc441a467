"""Rollouts of one fixed policy: drawn prompts, responses and rewards per step."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from prefkit.functions.chat import CHATML, ChatTemplate, prompt_messages, render
from prefkit.functions.text import words
from prefkit.operators.inference import Generator, Scorer, generate
from prefkit.operators.positions import rows_at
from prefkit.operators.sampling import length_draw, step_draws
from prefkit.operators.vocabulary import unmarked
from prefkit.session import shared_folder

SLOT = ["step", "slot"]
# Takes rows (step, slot, row_id, gen_len, query) and returns (step, slot, response).
Responder = Callable[[DataFrame], DataFrame]


def stored_responder(responses: DataFrame) -> Responder:
    """Answers from a table (row_id, response), cut to the drawn length in words."""

    def respond(prompts: DataFrame) -> DataFrame:
        found = prompts.select(*SLOT, "row_id", "gen_len").join(responses, "row_id")
        return found.select(*SLOT, F.array_join(F.slice(words(F.col("response")), 1, F.col("gen_len")), " ").alias("response"))

    return respond


def generated_responder(make_generator: Callable[[], Generator]) -> Responder:
    return lambda prompts: generate(prompts, make_generator, SLOT, prompt="query")


def step_prompts(
    train: DataFrame, system: str, steps: int = 200, batch: int = 8, seed: int = 42, template: ChatTemplate = CHATML
) -> DataFrame:
    """step, slot, row_id, gen_len, query of every draw, checkpointed as the plan of a run."""
    shared_folder(train.sparkSession)
    draws = step_draws(train.sparkSession, train.count(), steps, batch, seed)
    draws = draws.withColumn("gen_len", length_draw(seed, F.col("step"), F.col("slot")))
    rows = rows_at(train.select("row_id", "question"), "row_id", seed, draws)
    query = render(prompt_messages(system, F.col("question")), template, opener=True)
    return rows.select(*SLOT, "row_id", "gen_len", query.alias("query")).checkpoint()


def rollouts(prompts: DataFrame, respond: Responder, scorer: Scorer, run_id: str = "run") -> DataFrame:
    """run_id, step, slot, row_id, gen_len, query, response, reward (float32).

    The reward reads prompt and response without chat markers. Answered
    prompts are checkpointed: what is scored is what was answered, however
    often a stage is run, and stored answers are read once. A prompt without an
    answer keeps its row with a null response and reward.
    """
    shared_folder(prompts.sparkSession)
    answered = prompts.join(respond(prompts), SLOT, "left").checkpoint()
    text = unmarked(F.concat_ws(" ", "query", "response"))
    kept = ["row_id", "gen_len", "query", "response"]
    scored = scorer(answered, SLOT, {"score": text}, keep=kept)
    reward = F.when(F.col("response").isNotNull(), F.col("score").cast("float"))
    return scored.select(F.lit(run_id).alias("run_id"), *SLOT, *kept, reward.alias("reward"))
