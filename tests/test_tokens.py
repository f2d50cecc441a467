from pyspark.sql import functions as F
import pytest

from prefkit.operators import lookup as lk
from prefkit.operators.inference import encode_udf
from prefkit.operators.vocabulary import SPECIALS, UNK_ID, build_vocabulary, decode, encode, unmarked

TEXTS = [(1, "a b a\tc"), (2, ""), (3, None), (4, "a <|im_start|>b<|im_end|>"), (5, "  　 "), (6, "b zz a")]
FIRST = len(SPECIALS)


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(TEXTS, "row_id bigint, t string").repartition(3)


@pytest.fixture(scope="module")
def words(texts):
    return build_vocabulary(texts.where("row_id < 6"), F.col("t"))


def test_vocabulary(words):
    got = [tuple(r) for r in words.table.orderBy("id").collect()]
    assert got == [("a", 3, FIRST), ("b", 2, FIRST + 1), ("c", 1, FIRST + 2)]


def encoded(texts, words, **how):
    return {r["row_id"]: r for r in encode(texts, "row_id", {"ids": F.col("t")}, words, **how).collect()}


EXPECTED = {
    1: [FIRST, FIRST + 1, FIRST, FIRST + 2],
    2: [],
    3: [],
    4: [FIRST, 2, FIRST + 1, 3],
    5: [],
    6: [FIRST + 1, UNK_ID, FIRST],
}


def test_encode(texts, words):
    got = encoded(texts, words)
    assert {k: r["ids"] for k, r in got.items()} == EXPECTED
    assert not any(r["ids_cut"] for r in got.values())


def test_encode_beyond_the_broadcast_limit(texts, words, monkeypatch):
    monkeypatch.setattr(lk, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(lk, "HOT_PARTS", 3)
    assert {k: r["ids"] for k, r in encoded(texts, words).items()} == EXPECTED


def test_truncation_keeps_the_head(texts, words):
    got = encoded(texts, words, max_len=2, with_text=True)
    assert (got[1]["ids"], got[1]["ids_cut"], got[1]["ids_text"]) == (EXPECTED[1][:2], True, "a b")
    assert (got[6]["ids"], got[6]["ids_cut"], got[6]["ids_text"]) == (EXPECTED[6][:2], True, "b <unk>")
    assert got[2]["ids_cut"] is False


@pytest.mark.parametrize("limit", [None, 0])
def test_decode(texts, words, limit, monkeypatch):
    if limit is not None:
        monkeypatch.setattr(lk, "BROADCAST_BYTES", limit)
    ids = encode(texts, "row_id", {"ids": F.col("t")}, words)
    kept = {r["row_id"]: r["text"] for r in decode(ids, "row_id", "ids", words).collect()}
    assert kept == {1: "a b a c", 2: "", 3: "", 4: "a <|im_start|> b <|im_end|>", 5: "", 6: "b <unk> a"}
    plain = {r["row_id"]: r["text"] for r in decode(ids, "row_id", "ids", words, skip_special=True).collect()}
    assert plain == {1: "a b a c", 2: "", 3: "", 4: "a b", 5: "", 6: "b a"}


def test_lookup_paths_agree(spark):
    tokens = spark.createDataFrame([(i, f"t{i % 9}" if i % 5 else None) for i in range(200)], "i int, tok string")
    table = spark.createDataFrame([(f"t{j}", 100 - 10 * j, j) for j in range(7)], "tok string, cnt bigint, v bigint")
    small = lk.lookup(tokens, table, "tok").select("i", "tok", "v")
    large = lk.lookup(tokens, table, "tok", small=False).select("i", "tok", "v")
    order = lambda df: sorted((r["i"], r["tok"] or "", -1 if r["v"] is None else r["v"]) for r in df.collect())
    assert order(small) == order(large) and large.count() == 200


def test_unmarked(spark):
    row = spark.createDataFrame([("<|im_start|>user\nhi  there<|im_end|>\n",)], "t string").select(unmarked(F.col("t"))).first()
    assert row[0] == "user hi there"


def test_own_tokenizer(texts):
    encode_bytes = encode_udf(lambda: lambda texts: [t.encode() for t in texts])
    got = {r["row_id"]: r["ids"] for r in texts.select("row_id", encode_bytes("t").alias("ids")).collect()}
    assert got == {k: None if t is None else list(t.encode()) for k, t in TEXTS}
