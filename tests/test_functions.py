from pyspark.sql import functions as F
import pytest

from prefkit.functions import chat, scores as sc, text as tx, tokens as tk
from prefkit.functions.tokens import padding_id

NAN = float("nan")


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "a, b, wins",
    [(2.0, 1.0, True), (1.0, 2.0, False), (1.0, 1.0, False), (NAN, 1.0, False), (1.0, NAN, False), (None, 1.0, False), (1.0, None, False)],
)
def test_beats(spark, a, b, wins):
    row = spark.createDataFrame([(a, b)], "a double, b double").select(
        sc.beats(F.col("a"), F.col("b")).alias("w"), sc.verdict(F.col("a"), F.col("b")).alias("v")
    ).first()
    assert row["w"] is wins
    assert row["v"] == ("Correct" if wins else "Incorrect")


def test_pair_loss_does_not_overflow(spark):
    row = spark.createDataFrame([(1000.0, -1000.0), (-1000.0, 1000.0), (0.0, 0.0)], "c double, r double")
    got = [r[0] for r in row.select(sc.pair_loss(F.col("c"), F.col("r"))).collect()]
    assert got == pytest.approx([0.0, 2000.0, 0.6931471805599453])


def test_percent_of_nothing_is_null(spark):
    assert one(spark, sc.percent(F.lit(0), F.lit(0))) is None
    assert one(spark, sc.percent(F.lit(7), F.lit(10))) == 70.0


def test_formats(spark):
    assert one(spark, sc.four_places(F.lit(1.23456))) == "1.2346"
    assert one(spark, sc.two_places_percent(F.lit(70.0))) == "70.00%"


@pytest.mark.parametrize(
    "raw, stripped, stops",
    [(" exit\n", "exit", True), ("\tEXIT　", "EXIT", True), ("　a b ", "a b", False), ("", "", False), ("exit now", "exit now", False)],
)
def test_strip_and_stop(spark, raw, stripped, stops):
    df = spark.createDataFrame([(raw,)], "t string")
    row = df.select(tx.strip_all(F.col("t")).alias("s"), tx.is_stop_word(F.col("t")).alias("x")).first()
    assert (row["s"], row["x"]) == (stripped, stops)
    assert raw.strip() == stripped


def test_words(spark):
    df = spark.createDataFrame([(" a\t b　c\n\n",), ("",), ("   ",)], "t string")
    assert [r[0] for r in df.select(tx.words(F.col("t"))).collect()] == [["a", "b", "c"], [], []]


@pytest.mark.parametrize("value, expected", [("", "d"), (None, "d"), ("x", "x")])
def test_default(spark, value, expected):
    df = spark.createDataFrame([(value,)], "t string")
    assert df.select(tx.or_default(F.col("t"), "d")).first()[0] == expected


def test_render(spark):
    row = spark.createDataFrame([('say "hi", \\ it\n',)], "q string")
    messages = chat.answered_messages("", F.col("q"), F.lit("好"))
    assert row.select(chat.render(messages)).first()[0] == (
        '<|im_start|>system\n<|im_end|>\n<|im_start|>user\nsay "hi", \\ it\n<|im_end|>\n<|im_start|>assistant\n好<|im_end|>\n'
    )
    prompt = chat.prompt_messages("s", F.col("q"))
    opened = row.select(chat.render(prompt, opener=True)).first()[0]
    assert opened.endswith("<|im_start|>assistant\n")
    assert row.select(chat.render(prompt, opener=True, thinking=False)).first()[0] == opened + "<think>\n\n</think>\n\n"


def test_own_template(spark):
    mine = chat.ChatTemplate(open="[", close="]", no_thinking="!")
    messages = chat.prompt_messages("s", F.lit("q"))
    assert one(spark, chat.render(messages, mine, opener=True, thinking=False)) == "[system\ns]\n[user\nq]\n[assistant\n!"


def ids(*values):
    return F.array(*[F.lit(v) for v in values]).cast("array<int>")


def test_id_arrays(spark):
    assert one(spark, tk.truncate(ids(1, 2, 3), 2)) == [1, 2]
    assert one(spark, tk.truncate(ids(1, 2, 3), 9)) == [1, 2, 3]
    assert one(spark, tk.truncate(ids(1, 2, 3), None)) == [1, 2, 3]
    assert one(spark, tk.join_ids(ids(1), ids(2, 3))) == [1, 2, 3]
    assert one(spark, tk.attention_mask(ids(5, 6))) == [1, 1]
    assert one(spark, tk.drop_ids(ids(0, 7, 2, 8), [0, 2])) == [7, 8]
    assert one(spark, tk.drop_ids(ids(0, 2), [0, 2])) == []


@pytest.mark.parametrize("full, prompt, rest", [((1, 2, 3), (1, 2), [3]), ((1, 2), (1, 2), []), ((1,), (1, 2), []), ((1, 2), (), [1, 2])])
def test_strip_prompt(spark, full, prompt, rest):
    assert one(spark, tk.strip_prompt(ids(*full), ids(*prompt))) == rest


def test_padding(spark):
    assert one(spark, tk.pad_right(ids(1), F.lit(3), 0)) == [1, 0, 0]
    assert one(spark, tk.pad_left(ids(1), F.lit(3), 0)) == [0, 0, 1]
    assert one(spark, tk.pad_mask(ids(1), F.lit(3))) == [1, 0, 0]
    assert one(spark, tk.pad_mask(ids(1), F.lit(3), left=True)) == [0, 0, 1]
    assert (padding_id(None, 4), padding_id(0, 4)) == (4, 0)


def test_a_message_without_a_text_renders_to_null(spark):
    rows = spark.createDataFrame([(1, "q", "a"), (2, None, "a"), (3, "q", None), (4, "", "")], "i int, q string, a string")
    messages = chat.answered_messages("s", F.col("q"), F.col("a"))
    got = {r["i"]: r["t"] for r in rows.select("i", chat.render(messages).alias("t")).collect()}
    assert got[1] and got[4] and got[2] is None and got[3] is None
