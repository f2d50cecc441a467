"""Times the named queries and prints one JSON line.

Input tables (preferences, exchanges, vocabulary, word weights) are derived
and stored first, under ``prepare_*``; the queries then read them, as they
would read a table on disk. ``value`` is the sum of the medians.
"""

from __future__ import annotations

import argparse
import json
import os
import statistics
import time

from prefkit.catalog import inputs
from prefkit.catalog.queries import CATALOG
from prefkit.session import local_session

HEADLINE = [
    "split_ordered",
    "split_seeded_5",
    "split_seeded_10",
    "sample_questions",
    "render_chat",
    "messages_pairs",
    "vocab",
    "encode_documents",
    "decode_texts",
    "pad_batch",
    "token_log_odds",
    "score_preferences",
    "pairwise_accuracy",
    "pairwise_loss",
    "bradley_terry",
    "batch_udf_scores",
    "compare_rows",
    "compare_summary",
    "compare_long",
    "rollout_table",
    "step_rewards",
    "build_sft_set",
    "build_pair_set",
    "build_prompt_set",
    "stream_prompts",
    "stream_step_rewards",
]
PREPARE = {
    "prepare_preferences": inputs.preferences,
    "prepare_exchanges": inputs.exchanges,
    "prepare_vocabulary": inputs.vocabulary,
    "prepare_weights": inputs.weights,
}


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    options = argparse.ArgumentParser()
    options.add_argument("names", nargs="*", default=HEADLINE)
    options.add_argument("--runs", type=int, default=int(os.environ.get("BENCH_RUNS", "2")))
    args = options.parse_args()
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cores, shuffle_partitions=cores)
    spark.sparkContext.setLogLevel("ERROR")

    seconds: dict[str, float] = {}
    for name, make in PREPARE.items():
        started = time.perf_counter()
        make(spark, folder)
        seconds[name] = round(time.perf_counter() - started, 3)
    for name in args.names:
        taken = []
        for attempt in range(args.runs):
            started = time.perf_counter()
            run(CATALOG[name](spark, folder))
            taken.append(time.perf_counter() - started)
        # The first run warms the JVM up; it counts only when it is the only one.
        seconds[name] = round(statistics.median(taken[1:] or taken), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds over named queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
                "cores": cores,
            }
        )
    )


if __name__ == "__main__":
    main()
