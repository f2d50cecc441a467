import csv
import glob

from pyspark.sql import functions as F
import pytest

from prefkit import schemas
from prefkit.operators import metrics
from prefkit.plans import model_comparison as cmp
from prefkit.session import fresh_path
from prefkit.sources import derived, sinks, tables
from prefkit.sources.questions import COMMON_QUESTIONS, question_list

AWKWARD = ['plain', 'a "quoted" word', "comma, here", "line\nbreak", "back\\slash", "  leading", "好　的", ""]


def preferences(spark):
    rows = [(i, t, t[::-1], t + "!") for i, t in enumerate(AWKWARD)]
    return spark.createDataFrame(rows, schemas.PREFERENCES)


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json", "csv"])
def test_formats(spark, fmt):
    path, rows = fresh_path(spark, fmt), preferences(spark).where("question <> ''")
    writer = rows.write.options(**{k: v for k, v in tables.CSV_OPTIONS.items() if k != "multiLine"}) if fmt == "csv" else rows.write
    writer.format(fmt).save(path)
    back = tables.load_preferences(spark, path, fmt=fmt)
    assert sorted(back.collect()) == sorted(rows.collect())


def test_named_split_reads_only_its_folder(spark):
    path = fresh_path(spark, "split")
    rows = preferences(spark).withColumn("split", F.when(F.col("row_id") < 3, "test").otherwise("train"))
    tables.cached_copy(rows, path, "split")
    train = tables.load_preferences(spark, path, split="train")
    assert {r["row_id"] for r in train.collect()} == set(range(3, len(AWKWARD)))
    assert "PartitionFilters: [isnotnull(split" in train._jdf.queryExecution().executedPlan().toString()


def test_cached_copy_is_made_once_and_never_from_half_a_write(spark, tmp_path):
    path, source = str(tmp_path / "copy"), str(tmp_path / "source")
    spark.range(5).write.parquet(source)
    spark.range(3).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(path)
    rows = spark.read.parquet(source)
    assert tables.cached_copy(rows, path).count() == 5
    files = set(glob.glob(f"{path}/part-*"))
    assert tables.cached_copy(spark.read.parquet(source), path).count() == 5 and set(glob.glob(f"{path}/part-*")) == files


def test_a_copy_follows_its_source(spark, tmp_path):
    path, source = str(tmp_path / "copy"), str(tmp_path / "source")
    assert tables.cached_copy(spark.range(3), path).count() == 3
    assert tables.cached_copy(spark.range(9), path).count() == 9
    spark.range(4).write.parquet(source)
    assert tables.cached_copy(spark.read.parquet(source), path).count() == 4
    spark.range(4, 6).write.mode("append").parquet(source)
    assert tables.cached_copy(spark.read.parquet(source), path).count() == 6
    spark.range(7).write.mode("overwrite").parquet(source)
    assert tables.cached_copy(spark.read.parquet(source), path).count() == 7
    # Another question over the same files, and other columns.
    assert tables.cached_copy(spark.read.parquet(source).where("id > 2"), path).count() == 4
    assert tables.cached_copy(spark.read.parquet(source).withColumn("v", F.lit(1)), path).columns == ["id", "v"]
    assert tables.assign_row_ids(spark.read.parquet(source), path).count() == 7


def test_missing_keys_are_refused(spark, tmp_path):
    path = str(tmp_path / "p")
    preferences(spark).withColumn("row_id", F.when(F.col("row_id") > 0, F.col("row_id"))).write.parquet(path)
    with pytest.raises(ValueError, match="without row_id"):
        tables.load_preferences(spark, path)


def test_plain_csv_is_split_over_tasks(spark, tmp_path):
    path = str(tmp_path / "csv")
    rows = spark.range(20_000).select(F.col("id").alias("row_id"), *[F.concat(F.lit("t "), "id").alias(c) for c in ("question", "chosen", "rejected")])
    rows.coalesce(1).write.option("header", True).csv(path)
    saved = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        split, whole = (tables.read_table(spark, path, schemas.PREFERENCES, "csv", line_ends) for line_ends in (False, True))
        assert split.rdd.getNumPartitions() > 4 and whole.rdd.getNumPartitions() == 1
        assert split.count() == whole.count() == 20_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", saved)


def test_row_ids(spark):
    rows = tables.assign_row_ids(spark.range(100).repartition(5).select(F.col("id").alias("v")), fresh_path(spark, "ids"))
    assert rows.select("row_id").distinct().count() == 100
    assert rows.orderBy("row_id").collect() == rows.orderBy("row_id").collect()


def comparison(spark):
    rows = [("sample" if i < 4 else "common", i, t, t, t[::-1], i / 3, 1.0, 1.0 - i / 3) for i, t in enumerate(AWKWARD)]
    types = "source string, row_id bigint, question string, sft_response string, ppo_response string, sft_rm_score double, ppo_rm_score double, score_diff double"
    return spark.createDataFrame(rows, types).repartition(3)


def test_csv(spark, tmp_path):
    path = str(tmp_path / "csv")
    sinks.write_comparison_csv(comparison(spark), path)
    lines = []
    for part in sorted(glob.glob(f"{path}/part-*.csv")):
        with open(part, newline="", encoding="utf-8") as f:
            lines += list(csv.DictReader(f))
    assert list(lines[0]) == cmp.RESULT_COLUMNS
    assert [r["question"] for r in lines] == AWKWARD
    assert [r["ppo_response"] for r in lines] == [t[::-1] for t in AWKWARD]
    assert [float(r["sft_rm_score"]) for r in lines] == [i / 3 for i in range(len(AWKWARD))]
    back = sinks.read_comparison_csv(spark, path)
    assert sorted(r["question"] or "" for r in back.collect()) == sorted(AWKWARD)


def test_common_report(spark):
    got = cmp.common_report(comparison(spark)).orderBy("question_no").collect()
    assert [r["question_no"] for r in got] == [1, 2, 3, 4]
    assert got[0]["report"].splitlines()[1] == "SFT score: 1.3333"


def test_questions_keep_duplicates(spark):
    rows = spark.createDataFrame([(1, COMMON_QUESTIONS[0]), (2, COMMON_QUESTIONS[0])], schemas.QUESTIONS)
    asked = cmp.comparison_questions(rows, question_list(spark), n=None)
    assert asked.count() == 12 and asked.where(F.col("question") == COMMON_QUESTIONS[0]).count() == 3


def test_metrics_log_appends(spark):
    path = fresh_path(spark, "log")
    for run in ("a", "b"):
        steps = metrics.step_rewards(spark.createDataFrame([(run, 0, 1.0), (run, 0, 2.0)], "run_id string, step int, reward float"))
        sinks.append_step_metrics(steps, path)
    got = tables.read_table(spark, path, schemas.STEP_METRICS).collect()
    assert {(r["run_id"], r["step"], r["n"], r["mean_reward"]) for r in got} == {("a", 0, 2, 1.5), ("b", 0, 2, 1.5)}


def test_exported_batches_stay_together(spark):
    path = fresh_path(spark, "export")
    rows = spark.range(400).select(F.col("id").alias("row_id"), F.floor(F.col("id") / 32).alias("batch_id"), F.lit("train").alias("split"))
    sinks.export_training_set(rows.repartition(7), f"export_{path.rsplit('-', 1)[1]}", path, buckets=4)
    back = spark.read.parquet(path).withColumn("file", F.input_file_name())
    assert back.count() == 400
    assert back.groupBy("batch_id").agg(F.countDistinct("file").alias("n")).where("n > 1").count() == 0


def test_step_filters(spark):
    steps = spark.range(200).select(F.col("id").cast("int").alias("step"))
    assert [r[0] for r in metrics.progress_steps(steps).orderBy("step").collect()] == list(range(0, 200, 10))
    assert [r["snapshot"] for r in metrics.snapshot_steps(steps).orderBy("step").collect()] == [50, 100, 150, 200]


def test_pairing_copies_hot_rejected_documents(spark, tmp_path, monkeypatch):
    """One bad document for all good ones of a language: same pairs with many copies as with one."""
    documents = [(i, f"text {i}", "xx" if i < 300 else "yy") for i in range(310)]
    spark.createDataFrame(documents, "doc_id bigint, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(i, 0 if i in (7, 301, 302) else 1, 0) for i in range(310)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(i, f"q{i}") for i in range(3)], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    plain = sorted(derived.labelled_preferences(spark, str(tmp_path)).collect())
    monkeypatch.setattr(derived, "USES_PER_COPY", 4)
    assert sorted(derived.labelled_preferences(spark, str(tmp_path)).collect()) == plain
    assert len(plain) == 307 and sum(r["rejected_id"] == 7 for r in plain) == 299


def test_turn_numbers_that_do_not_fit(spark):
    bad = spark.createDataFrame([(1, 1 << 32)], "c bigint, t bigint").select(derived.exchange_id(F.col("c"), F.col("t")))
    with pytest.raises(Exception, match="out of range"):
        bad.collect()
