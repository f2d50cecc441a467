"""Hooks for a caller's own models. Each is built once per Python worker."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame, functions as F, types as T

# Scores a batch of texts.
TextModel = Callable[[Sequence[str]], Sequence[float]]
# Scores the named texts of every row: scorer(df, keys, texts, keep) returns the
# keys, the kept columns and one score column per text, under its name.
Scorer = Callable[..., DataFrame]
# Answers a batch of prompts, each with its own limit of new tokens.
Generator = Callable[[Sequence[str], Sequence[int]], Sequence[str]]


def batch_score_udf(make_model: Callable[[], TextModel], batch_size: int = 64):
    """A column function text -> float32 score that feeds the model whole batches."""

    def load():
        model = make_model()
        return lambda texts: np.asarray(model(list(texts)), dtype=np.float32)

    return predict_batch_udf(load, return_type=T.FloatType(), batch_size=batch_size)


def model_scorer(make_model: Callable[[], TextModel], batch_size: int = 64) -> Scorer:
    """A batch model as a scorer; it adds columns and moves no rows."""
    udf = batch_score_udf(make_model, batch_size)

    def score(df: DataFrame, keys: list[str], texts: dict[str, Column], keep: list[str] | None = None) -> DataFrame:
        return df.select(*keys, *(keep or []), *[udf(t).cast("double").alias(n) for n, t in texts.items()])

    return score


def generate(
    df: DataFrame, make_generator: Callable[[], Generator], keys: list[str], prompt: str = "prompt", limit: str = "gen_len"
) -> DataFrame:
    """(keys…, response) from a generator, one Arrow batch at a time. Works on streams as well."""
    rows = df.select(*dict.fromkeys([*keys, prompt, limit]))
    schema = T.StructType([*(rows.schema[k] for k in keys), T.StructField("response", T.StringType())])

    def answer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        generator = make_generator()
        for batch in batches:
            texts = list(generator(batch[prompt].tolist(), batch[limit].tolist()))
            yield batch[keys].assign(response=texts)

    return rows.mapInPandas(answer, schema)


def encode_udf(make_encoder: Callable[[], Callable[[Sequence[str]], Sequence[Sequence[int]]]], batch_size: int = 1024):
    """A column function text -> ids for a caller's tokenizer, in place of the word vocabulary.

    The tokenizer is given lists of at most ``batch_size`` texts; a null text is not shown to it and has null ids.
    """

    @F.pandas_udf("array<int>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = make_encoder()
        for texts in batches:
            given = texts.dropna()
            ids: list = []
            for low in range(0, len(given), batch_size):
                ids += [list(found) for found in encoder(given.iloc[low : low + batch_size].tolist())]
            yield pd.Series(ids, index=given.index, dtype=object).reindex(texts.index).where(texts.notna(), None)

    return encode
