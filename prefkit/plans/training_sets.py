"""The three training sets made from a preference table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from prefkit.functions.chat import CHATML, ChatTemplate, answered_messages, prompt_messages, render
from prefkit.functions.tokens import attention_mask
from prefkit.operators.splits import ordered_split, seeded_split
from prefkit.operators.vocabulary import Vocabulary, encode


def pair_texts(system: str, template: ChatTemplate = CHATML):
    """Rendered columns of both conversations of a preference row."""
    question = F.col("question")
    return (
        render(answered_messages(system, question, F.col("chosen")), template),
        render(answered_messages(system, question, F.col("rejected")), template),
    )


def build_sft(df: DataFrame, system: str, fraction: float = 0.1) -> DataFrame:
    """row_id, messages (chosen answers), split; the tail of the table is the test side."""
    messages = answered_messages(system, F.col("question"), F.col("chosen"))
    return ordered_split(df.select("row_id", messages.alias("messages")), fraction)


def build_pairs(
    df: DataFrame,
    system: str,
    vocabulary: Vocabulary,
    max_len: int | None = None,
    fraction: float = 0.05,
    seed: int = 42,
    template: ChatTemplate = CHATML,
) -> DataFrame:
    """row_id, ids and masks of both conversations, split.

    The split depends on the key alone, so it is added after encoding without a
    join. Texts are cut only where ``max_len`` is given.
    """
    chosen, rejected = pair_texts(system, template)
    ids = encode(df, "row_id", {"chosen": chosen, "rejected": rejected}, vocabulary, max_len)
    shaped = ids.select(
        "row_id",
        F.col("chosen").alias("input_ids_chosen"),
        attention_mask(F.col("chosen")).alias("attention_mask_chosen"),
        F.col("rejected").alias("input_ids_rejected"),
        attention_mask(F.col("rejected")).alias("attention_mask_rejected"),
        (F.col("chosen_cut") | F.col("rejected_cut")).alias("was_truncated"),
    )
    return seeded_split(shaped, fraction, seed, keys=df.select("row_id"))


def build_prompts(
    df: DataFrame,
    system: str,
    vocabulary: Vocabulary,
    max_len: int | None = None,
    fraction: float = 0.1,
    seed: int = 42,
    template: ChatTemplate = CHATML,
) -> DataFrame:
    """row_id, input_ids of the prompt left open for an answer, the ids as text, split."""
    prompt = render(prompt_messages(system, F.col("question")), template, opener=True)
    ids = encode(df, "row_id", {"input_ids": prompt}, vocabulary, max_len, with_text=True)
    shaped = ids.select(
        "row_id", "input_ids", F.col("input_ids_text").alias("query"), F.col("input_ids_cut").alias("was_truncated")
    )
    return seeded_split(shaped, fraction, seed, keys=df.select("row_id"))
