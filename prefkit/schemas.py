"""Declared schemas of the tables this package reads and writes."""

from pyspark.sql import types as T

MESSAGE = T.StructType([T.StructField("role", T.StringType()), T.StructField("content", T.StringType())])
MESSAGES = T.ArrayType(MESSAGE)

PREFERENCES = T.StructType(
    [
        T.StructField("row_id", T.LongType(), False),
        T.StructField("question", T.StringType()),
        T.StructField("chosen", T.StringType()),
        T.StructField("rejected", T.StringType()),
    ]
)

RESPONSES = T.StructType(
    [T.StructField("row_id", T.LongType(), False), T.StructField("response", T.StringType())]
)

QUESTIONS = T.StructType(
    [T.StructField("row_id", T.LongType(), False), T.StructField("question", T.StringType())]
)

CONVERSATIONS = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("turn", T.LongType()),
        T.StructField("role", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)

STEP_METRICS = T.StructType(
    [
        T.StructField("step", T.IntegerType()),
        T.StructField("n", T.LongType()),
        T.StructField("mean_reward", T.DoubleType()),
        T.StructField("run_id", T.StringType()),
    ]
)
