"""Conversations that end when their user says so."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from prefkit.functions.text import is_stop_word


def says_stop(role: Column, text: Column) -> Column:
    return F.coalesce((role == "user") & is_stop_word(text), F.lit(False))


def until_stop(turns: DataFrame) -> DataFrame:
    """The turns (conv_id, turn, role, text) of each conversation before the one with the stop word.

    One number per stopped conversation is found before anything is joined. Turns without a
    number come before all others.
    """
    stops = turns.where(says_stop(F.col("role"), F.col("text"))).groupBy(F.col("conv_id").alias("_conv"))
    stops = stops.agg(F.min(F.coalesce("turn", F.lit(-(2**63)))).alias("_stop"))
    here = F.coalesce("turn", F.lit(-(2**63)))
    joined = turns.join(stops, F.col("conv_id").eqNullSafe(F.col("_conv")), "left")
    return joined.where(F.col("_stop").isNull() | (here < F.col("_stop"))).drop("_conv", "_stop")


def open_sessions(turns: DataFrame, time: str, late: str, idle_ms: int) -> DataFrame:
    """The same on a stream of turns, in append mode; keeps conv_id, turn, role, text and ``time``.

    State is one turn number per conversation that has stopped, for as long as its turns may still come:
    it is given up when the watermark is ``idle_ms`` past its last turn. Conversations that go on hold no state
    once their turns are through. Turns have to arrive in order, or within one micro-batch.
    """
    columns = ["conv_id", "turn", "role", "text", time]
    extra = [F.coalesce("turn", F.lit(-(2**63))).alias("_turn"), F.unix_millis(time).alias("_ms"), says_stop(F.col("role"), F.col("text")).alias("_stops")]
    rows = turns.select(*columns, *extra).withWatermark(time, late)
    schema = rows.select(*columns).schema

    def go_on(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        frame = pd.concat(list(batches), ignore_index=True)
        stop = state.get[0] if state.exists else None
        said = frame.loc[frame["_stops"], "_turn"]
        if len(said):
            stop = min([int(said.min()), *([] if stop is None else [stop])])
        if stop is not None:
            state.update((stop,))
            state.setTimeoutTimestamp(max(int(frame["_ms"].max()), state.getCurrentWatermarkMs()) + idle_ms)
            frame = frame[frame["_turn"] < stop]
        yield frame[columns]

    grouped = rows.groupBy("conv_id")
    return grouped.applyInPandasWithState(go_on, schema, "stop long", "append", GroupStateTimeout.EventTimeTimeout)
