from pyspark.sql import functions as F

from prefkit import schemas
from prefkit.operators.inference import batch_score_udf
from prefkit.operators.metrics import step_rewards
from prefkit.session import fresh_path
from prefkit.sources.files import child_folders
from prefkit.streaming import questions as qs, step_rewards as sr
from prefkit.streaming.replay import write_end, write_slices
from prefkit.streaming.sessions import open_sessions, until_stop


def lengths():
    return lambda texts: [float(len(t)) for t in texts]


def test_stream_equals_batch(spark):
    source, out = fresh_path(spark, "q"), fresh_path(spark, "a")
    rows = spark.createDataFrame(
        [(i, f"question {i}" if i % 5 else " Exit\n") for i in range(40)], schemas.QUESTIONS
    )
    rows.repartition(6).write.parquet(source)
    answers = spark.createDataFrame([(i, f"answer {i}") for i in range(0, 40, 2)], schemas.RESPONSES)
    score = batch_score_udf(lengths)("text")

    stream = qs.question_stream(spark, source, schemas.QUESTIONS, files_per_trigger=2)
    query = qs.append_to(qs.answered_stream(qs.open_prompts(stream, "s"), qs.stored_answers(answers), score, "s"), out, f"{out}-progress")
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 3
    batch = qs.answered_stream(qs.open_prompts(rows, "s"), qs.stored_answers(answers), score, "s")
    got = sorted(spark.read.parquet(out).collect())
    assert got == sorted(batch.collect()) and len(got) == 32

    again = qs.append_to(qs.answered_stream(qs.open_prompts(stream, "s"), qs.stored_answers(answers), score, "s"), out, f"{out}-progress")
    again.awaitTermination()
    assert spark.read.parquet(out).count() == 32


def rollout_rows(spark, n=400, steps=25):
    return spark.range(n).select(
        F.lit("run").alias("run_id"), (F.col("id") % steps).cast("int").alias("step"), (F.col("id") / 7).cast("float").alias("reward")
    )


def flat(df):
    return sorted((r["step"], r["n"], round(r["mean_reward"], 9)) for r in df.collect())


def test_running_rewards(spark):
    source, out = fresh_path(spark, "r"), fresh_path(spark, "m")
    rows = rollout_rows(spark)
    rows.repartition(8).write.parquet(source)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 3).parquet(source)
    store = sr.StepStore(spark, out, every=2)
    store.keep(sr.running_rewards(stream), f"{out}-progress").awaitTermination()
    assert flat(store.read()) == flat(step_rewards(rows))


def test_a_step_store_keeps_few_files(spark):
    out = fresh_path(spark, "store")
    store, latest = sr.StepStore(spark, out, every=10), {}
    for number in range(100):
        rows = [("run", step, number + 1, float(number)) for step in (number % 7, 50 + number % 3)]
        latest |= {r[1]: r[2:] for r in rows}
        store.write(spark.createDataFrame(rows, sr.STEPS), number)
        # Updates since the newest but one snapshot, and two snapshots.
        assert len(child_folders(spark, f"{out}/updates")) <= 20 and len(child_folders(spark, f"{out}/snapshots")) <= 2
    # A batch that runs again replaces its own rows.
    store.write(spark.createDataFrame([("run", 0, 7, 7.0)], sr.STEPS), 100)
    store.write(spark.createDataFrame([("run", 0, 8, 8.0)], sr.STEPS), 100)
    assert {r["step"]: (r["n"], r["mean_reward"]) for r in store.read().collect()} == latest | {0: (8, 8.0)}


def state_rows(query):
    return [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]


def test_closed_rewards_give_each_step_once(spark):
    source, out = fresh_path(spark, "w"), fresh_path(spark, "wm")
    # Four rollouts a step an hour apart from the next; every tenth step lacks one, every twentieth has one too many.
    rows = spark.range(400).select(
        F.lit("run").alias("run_id"), F.floor(F.col("id") / 4).cast("int").alias("step"), (F.col("id") % 4).cast("float").alias("reward"),
        F.timestamp_seconds(100_000 + F.floor(F.col("id") / 4) * 3600 + F.col("id") % 4).alias("rollout_ts"), (F.col("id") % 4).alias("slot"),
    )
    rows = rows.where("not (step % 10 = 3 and slot = 2)").unionByName(rows.where("step % 20 = 0 and slot = 3")).drop("slot")
    late = write_slices(rows, "rollout_ts", source, 10)
    write_end(rows, "rollout_ts", source)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(source)
    query = qs.append_to(sr.closed_rewards(stream, 4, late, idle_ms=60_000), out, f"{out}-progress")
    query.awaitTermination()
    got = {r["step"]: (r["n"], r["mean_reward"], r["complete"]) for r in spark.read.parquet(out).collect()}
    assert spark.read.parquet(out).count() == 100 == len(got)
    # What is too much may come in the same micro-batch, and then counts.
    assert all(got[s] == ((3, 4 / 3, False) if s % 10 == 3 else (4, 1.5, True)) for s in got if s % 20)
    assert all(got[s][2] and got[s][0] in (4, 5) for s in got if s % 20 == 0)
    held = state_rows(query)
    assert max(held) < 60 and held[-1] == 0


def test_joined_answers(spark):
    asked_at, given_at, out = fresh_path(spark, "asked"), fresh_path(spark, "given"), fresh_path(spark, "joined")
    ids = spark.range(200).withColumnRenamed("id", "row_id")
    asked = ids.select("row_id", F.concat(F.lit("question "), "row_id").alias("question"), F.timestamp_seconds(100_000 + F.col("row_id") * 60).alias("asked_at"))
    # Every fourth is never answered, every tenth too late.
    delay = F.when(F.col("row_id") % 10 == 0, 400).otherwise(100)
    given = ids.where("row_id % 4 <> 0").select("row_id", F.concat(F.lit("answer "), "row_id").alias("response"), F.timestamp_seconds(100_000 + F.col("row_id") * 60 + delay).alias("answered_at"))
    late = [write_slices(df.repartition(2), time, path, 4) for df, time, path in ((asked, "asked_at", asked_at), (given, "answered_at", given_at))][0]
    write_end(asked, "asked_at", asked_at, row_id=-1, question="")
    write_end(given, "answered_at", given_at, row_id=-2)
    streams = [spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 2).parquet(path) for df, path in ((asked, asked_at), (given, given_at))]
    joined = qs.joined_answers(qs.open_prompts(streams[0], "s"), streams[1], late, "5 minutes")
    query = qs.append_to(qs.scored_answers(joined, batch_score_udf(lengths)("text"), "s"), out, f"{out}-progress")
    query.awaitTermination()
    got = spark.read.parquet(out).collect()
    assert len([p for p in query.recentProgress if p["numInputRows"]]) > 3
    assert sorted(r["row_id"] for r in got) == list(range(200))
    for r in got:
        answered = r["row_id"] % 4 and r["row_id"] % 10
        assert r["response"] == (f"answer {r['row_id']}" if answered else None) and (r["score"] is None) == (not answered)
    # Only the two last rows of all remain, which no time passes.
    held = state_rows(query)
    assert max(held) > 10 and held[-1] <= 4


def test_a_stop_word_ends_its_conversation(spark):
    source, out = fresh_path(spark, "turns"), fresh_path(spark, "sessions")
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"turn {t}") for c in range(20) for t in range(12)]
    rows = [(c, t, r, "EXIT\u3000" if c % 3 == 0 and t == 4 else "exit" if c % 5 == 0 and t in (7, 8) else x) for c, t, r, x in rows]
    turns = spark.createDataFrame(rows, schemas.CONVERSATIONS)
    # An assistant that says the word ends nothing.
    expected = sorted(r for r in rows if not (r[0] % 3 == 0 and r[1] >= 4) and not (r[0] % 5 == 0 and r[1] >= 8))
    assert sorted(tuple(r) for r in until_stop(turns).collect()) == expected
    timed = turns.withColumn("ts", F.timestamp_seconds(100_000 + F.col("turn") * 3600 + F.col("conv_id")))
    late = write_slices(timed, "ts", source, 6)
    write_end(timed, "ts", source, conv_id=-1, turn=0)
    stream = spark.readStream.schema(timed.schema).option("maxFilesPerTrigger", 1).parquet(source)
    query = qs.append_to(open_sessions(stream, "ts", late, idle_ms=12 * 3_600_000), out, f"{out}-progress")
    query.awaitTermination()
    got = spark.read.schema(timed.schema).parquet(out).where("conv_id >= 0").drop("ts")
    assert sorted(tuple(r) for r in got.collect()) == expected
    held = state_rows(query)
    # Only conversations that stopped hold state, and give it up.
    assert max(held) == len({r[0] for r in rows if r[0] % 3 == 0 or r[0] % 5 == 0}) and held[-1] == 0


def test_until_stop_with_nulls(spark):
    rows = [(None, 0, "user", "a"), (None, 1, "user", "exit"), (None, 2, "user", "b"), (1, None, "user", "c"), (1, 1, None, "exit"), (1, 2, "user", None)]
    got = until_stop(spark.createDataFrame(rows, schemas.CONVERSATIONS)).collect()
    assert {(r["conv_id"], r["turn"]) for r in got} == {(None, 0), (1, None), (1, 1), (1, 2)}
