"""A file stream of questions answered and scored as it arrives."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from prefkit.functions.chat import CHATML, ChatTemplate, answered_messages, prompt_messages, render
from prefkit.functions.text import is_stop_word
from prefkit.operators.inference import Generator, generate


def question_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int = 1000) -> DataFrame:
    """Rows of the parquet files below ``path``, new ones as they appear."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def open_prompts(questions: DataFrame, system: str, thinking: bool = False, template: ChatTemplate = CHATML) -> DataFrame:
    """Adds ``prompt``; rows that only say the stop word are left out."""
    prompt = render(prompt_messages(system, F.col("question")), template, opener=True, thinking=thinking)
    return questions.where(~is_stop_word(F.col("question"))).withColumn("prompt", prompt)


def stored_answers(responses: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """Adds ``response`` from a table (row_id, response), read anew for every micro-batch; null where there is none.

    Large tables want large micro-batches; see ``files_per_trigger``.
    """
    return lambda prompts: prompts.join(responses, "row_id", "left")


def generated_answers(make_generator: Callable[[], Generator], max_new: int) -> Callable[[DataFrame], DataFrame]:
    """Adds ``response`` from a caller's generator."""

    def answer(prompts: DataFrame) -> DataFrame:
        limited = prompts.withColumn("gen_len", F.lit(max_new))
        return generate(limited, make_generator, ["row_id", "question", "prompt"])

    return answer


def joined_answers(prompts: DataFrame, answers: DataFrame, late: str, wait: str) -> DataFrame:
    """Prompts with the answers another stream brings, as (row_id, question, prompt, response).

    ``prompts`` has row_id, question, prompt, asked_at, ``answers`` row_id, response, answered_at. An answer counts when
    it is given within ``wait`` of its question; a question that gets none comes out once, with
    a null, when the watermark says that none can come any more. Both sides are
    kept only for as long: state is bounded by the rows of ``late`` and ``wait``, not by the tables.
    """
    asked = prompts.select("row_id", "question", "prompt", "asked_at").withWatermark("asked_at", late)
    given = answers.select(F.col("row_id").alias("_answers"), "response", "answered_at").withWatermark("answered_at", late)
    in_time = F.expr(f"answered_at >= asked_at and answered_at <= asked_at + interval {wait}")
    joined = asked.join(given, (F.col("row_id") == F.col("_answers")) & in_time, "left_outer")
    return joined.select("row_id", "question", "prompt", "response")


def answered_stream(
    prompts: DataFrame,
    answer: Callable[[DataFrame], DataFrame],
    score: Column,
    system: str,
    template: ChatTemplate = CHATML,
) -> DataFrame:
    """Answers every prompt and scores the conversation. No state is kept.

    ``score`` is a column over ``text``, for example a batch model; it is given
    an empty text, and its result dropped, where there is no answer.
    """
    return scored_answers(answer(prompts), score, system, template)


def scored_answers(answered: DataFrame, score: Column, system: str, template: ChatTemplate = CHATML) -> DataFrame:
    """row_id, prompt, response and the score of the conversation, null without an answer."""
    text = render(answered_messages(system, F.col("question"), F.col("response")), template)
    answered = answered.withColumn("text", F.coalesce(text, F.lit("")))
    return answered.select("row_id", "prompt", "response", F.when(F.col("response").isNotNull(), score).alias("score"))


def append_to(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Reads what has arrived and appends it to a parquet table exactly once."""
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
