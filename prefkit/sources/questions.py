"""Literal question lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from prefkit import schemas

# The ten common questions of the published comparison.
COMMON_QUESTIONS = (
    "你好",
    "天气怎么样",
    "吃饭了吗",
    "今天星期几",
    "你是谁",
    "能帮我个忙吗",
    "最近怎么样",
    "你在干什么",
    "现在几点了",
    "你会说英文吗",
)


def question_list(spark: SparkSession, questions: tuple[str, ...] = COMMON_QUESTIONS) -> DataFrame:
    """row_id from 1 and question."""
    return spark.createDataFrame(list(enumerate(questions, 1)), schemas.QUESTIONS)
