"""Reward per step while rollouts arrive."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from prefkit.sources.files import child_folders, delete

KEYS = ["run_id", "step"]
STEPS = "run_id string, step int, n long, mean_reward double"
# Rewards are float32; whole billionths of them add up to the same sum in any order.
UNITS = 1_000_000_000


def running_rewards(rollouts: DataFrame) -> DataFrame:
    """n and mean reward per run and step so far; state holds one row per step."""
    mean = [F.count(F.lit(1)).alias("n"), F.avg(F.col("reward").cast("double")).alias("mean_reward")]
    return rollouts.groupBy(*KEYS).agg(*mean)


def closed_rewards(rollouts: DataFrame, batch: int, late: str, idle_ms: int) -> DataFrame:
    """Each step once, when it is final: ``STEPS`` and ``complete``, by appending.

    A step is final when its ``batch`` rollouts are in, or when the watermark of the rollouts' own time
    ``rollout_ts`` is ``idle_ms`` past the last of them. State is the count and sum of an open step; of a
    closed one a mark stays until its time is over, so that a rollout too many opens it no second time. Rows
    without a run_id only move the watermark on.
    """
    timed = rollouts.select(*KEYS, "reward", F.unix_millis("rollout_ts").alias("_ms"), "rollout_ts").withWatermark("rollout_ts", late)
    # The condition names the time as well, so that it is not tested below the watermark, which every row moves.
    timed = timed.where(F.col("run_id").isNotNull() | F.col("rollout_ts").isNull())

    def row(key: tuple, n: int, scored: int, units: int) -> pd.DataFrame:
        mean = units / scored / UNITS if scored else None
        return pd.DataFrame({"run_id": [key[0]], "step": [key[1]], "n": [n], "mean_reward": [mean], "complete": [n >= batch]})

    def close(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n, scored, units, closed = state.get if state.exists else (0, 0, 0, False)
        if state.hasTimedOut:
            state.remove()
            if not closed:
                yield row(key, n, scored, units)
            return
        newest = state.getCurrentWatermarkMs()
        for frame in batches:
            newest = max(newest, int(frame["_ms"].max()))
            if not closed:
                rewards = frame["reward"].dropna().astype("float64")
                n += len(frame)
                scored += len(rewards)
                units += int((rewards * UNITS).round().astype("int64").sum())
        if not closed and n >= batch:
            closed = True
            yield row(key, n, scored, units)
        state.update((n, scored, units, closed))
        state.setTimeoutTimestamp(newest + idle_ms)

    return timed.groupBy(*KEYS).applyInPandasWithState(
        close, f"{STEPS}, complete boolean", "n long, scored long, units long, closed boolean", "append", GroupStateTimeout.EventTimeTimeout
    )


class StepStore:
    """The newest state of every step of an updating stream, in files that stay few.

    Every micro-batch writes its changed steps to ``updates/batch=N``. Every ``every`` batches the newest
    snapshot and the updates since are merged to ``snapshots/upto=N``, and what the two newest
    snapshots do not need is deleted: a reader that began before the last merge still finds its files. A batch that runs again after a failure
    replaces its own folder.
    """

    def __init__(self, spark: SparkSession, path: str, every: int = 10):
        self._spark, self._path, self._every = spark, path, every

    def _numbers(self, kind: str, name: str) -> list[int]:
        """Numbers of the complete folders of a kind, ascending."""
        return sorted(int(f.rsplit("=", 1)[1]) for f in child_folders(self._spark, f"{self._path}/{kind}", complete=True) if f"{name}=" in f)

    def read(self, upto: int | None = None) -> DataFrame:
        """``STEPS``: the newest state of every step, up to a batch where given."""
        snapshots = [n for n in self._numbers("snapshots", "upto") if upto is None or n <= upto]
        newest = snapshots[-1] if snapshots else -1
        updates = [n for n in self._numbers("updates", "batch") if n > newest and (upto is None or n <= upto)]
        found = self._spark.createDataFrame([], f"{STEPS}, batch long")
        if snapshots:
            found = found.unionByName(self._spark.read.schema(f"{STEPS}, batch long").parquet(f"{self._path}/snapshots/upto={newest}"))
        for n in updates:
            part = self._spark.read.schema(STEPS).parquet(f"{self._path}/updates/batch={n}")
            found = found.unionByName(part.withColumn("batch", F.lit(n).cast("bigint")))
        return latest_steps(found)

    def write(self, batch: DataFrame, number: int) -> None:
        batch.select("run_id", "step", "n", "mean_reward").write.mode("overwrite").parquet(f"{self._path}/updates/batch={number}")
        if (number + 1) % self._every == 0:
            self._compact(number)

    def _compact(self, number: int) -> None:
        merged = self.read(number).withColumn("batch", F.lit(number).cast("bigint"))
        merged.write.mode("overwrite").parquet(f"{self._path}/snapshots/upto={number}")
        snapshots = self._numbers("snapshots", "upto")
        if len(snapshots) > 1:
            needed = snapshots[-2]
            for kind, name, keep_from in (("updates", "batch", needed + 1), ("snapshots", "upto", needed)):
                for n in self._numbers(kind, name):
                    if n < keep_from:
                        delete(self._spark, f"{self._path}/{kind}/{name}={n}")

    def keep(self, stream: DataFrame, checkpoint: str) -> StreamingQuery:
        """Reads what has arrived and stores every changed step."""
        return (
            stream.writeStream.foreachBatch(self.write)
            .outputMode("update")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )


def latest_steps(updates: DataFrame) -> DataFrame:
    """The newest state of each step from rows with the number of their ``batch``."""
    newest = F.max_by(F.struct("n", "mean_reward"), "batch").alias("v")
    return updates.groupBy(*KEYS).agg(newest).select(*KEYS, "v.n", "v.mean_reward")
