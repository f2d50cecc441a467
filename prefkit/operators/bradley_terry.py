"""A linear reward fitted on pairs, its loss and gradient aggregated by Spark.

A text is the counts of its words, hashed to ``features`` places and scaled to length one. A pair is one sparse
vector, the difference of its two texts: the probability that a is preferred to b is the
logistic function of w.(x(a) - x(b)). The loss, with its penalty, has one optimum, and the
length of the gradient says how far the weights can be from it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from prefkit.functions.text import words
from prefkit.operators.inference import Scorer
from prefkit.sources.files import written

FEATURES = 1 << 14
# Weights are kept to nine places and summed as whole numbers, so that equal texts get equal scores.
UNITS = 1_000_000_000
# Steps the solver remembers.
MEMORY = 8
# Rows whose words are counted at once.
ROWS = 256


def place_of(word: Column, features: int) -> Column:
    """The place a word is hashed to; md5 because any engine has it."""
    return (F.conv(F.substring(F.md5(word), 1, 8), 16, 10).cast("bigint") % features).cast("int")


def _place_lists(df: DataFrame, keys: list[str], texts: dict[str, Column], features: int) -> DataFrame:
    """(keys…, per text its places and ``<name>_given``): one row per key; what moves is a number for each word.

    Rows of one key are taken together. Words are counted afterwards, some rows at a time, so that a task
    holds no table of all its words.
    """
    places = [F.transform(words(t), lambda w: place_of(w, features)).alias(n) for n, t in texts.items()]
    given = [t.isNotNull().alias(f"{n}_given") for n, t in texts.items()]
    laid = df.select(*keys, *places, *given).repartition(*keys)
    lists = [F.flatten(F.collect_list(n)).alias(n) for n in texts]
    return laid.groupBy(*keys).agg(*lists, *[F.max(f"{n}_given").alias(f"{n}_given") for n in texts])


def _counts(lists: pa.ListArray, features: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places with their row as ``row * features + place``, ascending, how often each comes, and the length of each row's counts."""
    row = np.repeat(np.arange(len(lists)), pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
    at, n = np.unique(row * features + lists.flatten().to_numpy(zero_copy_only=False), return_counts=True)
    return at, n, np.sqrt(np.bincount(at // features, (n * n).astype(float), len(lists)))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low in range(0, batch.num_rows, ROWS):
            yield batch.slice(low, ROWS)


def _vectors(features: int, key: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, places, values): the difference of each pair's two texts, both scaled to length one, where it is not zero."""
    for batch in _slices(batches):
        sides = [_counts(batch.column(n), features) for n in ("chosen", "rejected")]
        at = np.union1d(*[places for places, _, _ in sides])
        row, parts = at // features, []
        for places, n, length in sides:
            part = np.zeros(len(at))
            here = np.searchsorted(at, places)
            part[here] = n / length[row[here]]
            parts.append(part)
        value = parts[0] - parts[1]
        at, value = at[value != 0], value[value != 0]
        ends = np.searchsorted(at // features, np.arange(batch.num_rows + 1)).astype(np.int32)
        lists = [pa.ListArray.from_arrays(ends, pa.array(v)) for v in ((at % features).astype(np.int32), value)]
        yield pa.RecordBatch.from_arrays([batch.column(key), *lists], names=[key, "places", "values"])


def pair_vectors(df: DataFrame, chosen: Column, rejected: Column, key: str, features: int) -> DataFrame:
    """(key, places, values) of every pair, written once below the shared folder.

    Pairs without a difference stay, as empty vectors.
    """
    lists = _place_lists(df, [key], {"chosen": chosen, "rejected": rejected}, features)
    schema = T.StructType([lists.schema[key], T.StructField("places", T.ArrayType(T.IntegerType())), T.StructField("values", T.ArrayType(T.DoubleType()))])
    vectors = lists.select(key, "chosen", "rejected").mapInArrow(lambda batches: _vectors(features, key, batches), schema)
    return written(vectors, "pair-vectors")


def _sums(weights: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(place, v): the pairs' pull on each weight; their number at place -1, their loss at -2."""
    pull, loss, n = np.zeros(len(weights)), 0.0, 0
    for batch in batches:
        lists = batch.column("places")
        places, values = lists.flatten().to_numpy(zero_copy_only=False), batch.column("values").flatten().to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(batch.num_rows), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
        margin = np.bincount(row, values * weights[places], batch.num_rows)
        wrong = np.exp(-np.logaddexp(0, margin))
        pull += np.bincount(places, values * wrong[row], len(weights))
        loss += float(np.logaddexp(0, -margin).sum())
        n += batch.num_rows
    at = np.flatnonzero(pull)
    place, v = np.append(at, [-1, -2]), np.append(pull[at], [n, loss])
    yield pa.RecordBatch.from_arrays([pa.array(place.astype(np.int32)), pa.array(v)], names=["place", "v"])


def loss_and_gradient(vectors: DataFrame, weights: np.ndarray, reg: float) -> tuple[float, np.ndarray]:
    """Mean loss with its penalty, and its gradient. What leaves Spark is one number per feature."""
    shared = vectors.sparkSession.sparkContext.broadcast(weights)
    try:
        parts = vectors.select("places", "values").mapInArrow(lambda batches: _sums(shared.value, batches), "place int, v double")
        sums = parts.groupBy("place").agg(F.sum("v").alias("v")).toPandas()
    finally:
        shared.destroy()
    place, v = sums["place"].to_numpy(), sums["v"].to_numpy()
    n, loss = float(v[place == -1].sum()), float(v[place == -2].sum())
    if n == 0:
        return 0.0, reg * weights
    gradient = reg * weights
    gradient[place[place >= 0]] -= v[place >= 0] / n
    return loss / n + reg / 2 * float(weights @ weights), gradient


def minimise(measure: Callable[[np.ndarray], tuple[float, np.ndarray]], size: int, curvature: float, short: float, most: int) -> tuple[np.ndarray, float]:
    """Weights and the length of their gradient, by L-BFGS from zero; a step that does not lower the loss is retried as a short one.

    ``curvature`` bounds that of the loss, so a step of its inverse along the gradient always lowers it.
    """
    weights = np.zeros(size)
    loss, gradient = measure(weights)
    moves: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(most):
        length = float(np.linalg.norm(gradient))
        if length <= short:
            break
        step, along = gradient.copy(), []
        for move, change in reversed(moves):
            a = (move @ step) / (move @ change)
            along.append(a)
            step -= a * change
        step *= (moves[-1][0] @ moves[-1][1]) / (moves[-1][1] @ moves[-1][1]) if moves else 1 / curvature
        for (move, change), a in zip(moves, reversed(along), strict=True):
            step += move * (a - (change @ step) / (move @ change))
        lower, following = measure(weights - step)
        if not lower <= loss:
            step, moves = gradient / curvature, []
            lower, following = measure(weights - step)
        moves = [*moves, (-step, following - gradient)][-MEMORY:]
        weights, loss, gradient = weights - step, lower, following
    return weights, float(np.linalg.norm(gradient))


@dataclass(frozen=True)
class BradleyTerry:
    """The fitted weights and the length of the loss's gradient there.

    The loss curves at least as much as its penalty, so the only optimum is within ``distance`` of the weights,
    and a pair's margin within that, times the length of its vector, of its own.
    """

    weights: np.ndarray
    gradient: float
    reg: float

    @property
    def distance(self) -> float:
        return self.gradient / self.reg

    def table(self, spark: SparkSession) -> DataFrame:
        """(place, weight); as many rows as features."""
        columns = pa.table({"place": pa.array(np.arange(len(self.weights), dtype=np.int32)), "weight": pa.array(self.weights)})
        return spark.createDataFrame(columns)


def fit_bradley_terry(
    df: DataFrame,
    chosen: Column,
    rejected: Column,
    features: int = FEATURES,
    reg: float = 0.1,
    distance: float = 1e-5,
    max_iter: int = 100,
    key: str = "row_id",
) -> BradleyTerry:
    """Logistic regression without intercept on the pairs' difference vectors, to within ``distance`` of its optimum."""
    vectors = pair_vectors(df, chosen, rejected, key, features)
    # A difference of two vectors of length one is at most two long; the logistic loss curves by a quarter at most.
    weights, gradient = minimise(lambda w: loss_and_gradient(vectors, w, reg), features, reg + 1.0, distance * reg, max_iter)
    return BradleyTerry(weights, gradient, reg)


def bradley_terry_scorer(model: BradleyTerry) -> Scorer:
    """w.x of a text; 0 for a text without words, null for a null text."""
    features = len(model.weights)

    def score(df: DataFrame, keys: list[str], texts: dict[str, Column], keep: list[str] | None = None) -> DataFrame:
        lists = _place_lists(df, keys, texts, features)
        scaled = model.weights * UNITS
        units = df.sparkSession.sparkContext.broadcast((np.sign(scaled) * np.floor(np.abs(scaled) + 0.5)).astype(np.int64))
        names = list(texts)
        schema = T.StructType([*(lists.schema[k] for k in keys), *(T.StructField(n, T.DoubleType()) for n in names)])

        def reward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in _slices(batches):
                columns = [batch.column(k) for k in keys]
                for name in names:
                    at, n, length = _counts(batch.column(name), features)
                    row, total = at // features, np.zeros(batch.num_rows, np.int64)
                    np.add.at(total, row, units.value[at % features] * n)
                    value = np.divide(total.astype(float), length, out=np.zeros(len(length)), where=length > 0) / UNITS
                    columns.append(pc.if_else(batch.column(f"{name}_given"), pa.array(value), pa.scalar(None, pa.float64())))
                yield pa.RecordBatch.from_arrays(columns, names=[*keys, *names])

        scores = lists.mapInArrow(reward, schema)
        return df.select(*keys, *keep).join(scores, keys) if keep else scores

    return score
