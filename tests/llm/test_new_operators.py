"""Conversation repair, secret links and fill-in-middle on small tables, against SQL and plain versions."""

from itertools import product
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from prefkit.llm import fill_middle as fm, oracle, secret_links as sl, turn_repair as tr
from tests.llm.helpers import SCHEMA, documents, odd_documents, plain, with_clashes
from tests.oracle_check import rows_of, spark_rows

TURNS = "conv_id long, turn long, role string, text string"


def sql_of(name, table, rows, schema):
    """The rows of a query's SQL over a small table."""
    db = duckdb.connect()
    types = {"long": "BIGINT", "string": "VARCHAR"}
    fields = [f.split() for f in schema.split(", ")]
    db.execute(f"CREATE TABLE {table} ({', '.join(f'{n} {types[t]}' for n, t in fields)})")
    if rows:
        db.executemany(f"INSERT INTO {table} VALUES ({', '.join('?' * len(fields))})", rows)
    result = db.execute(oracle.SQL[name])
    return rows_of([c[0] for c in result.description], result.fetchall())


# Conversation repair


def cheapest(rows):
    """All edits and insertions tried: (cost, audit) of a pattern of classes."""
    found = []
    longest = len(rows) + 4
    for turns in range(longest + 1):
        for first in ("", "s"):
            goal = first + "ua" * turns
            if (first and not turns) or len(goal) > longest:
                continue
            best = {0: (0, "")}
            # Places in the goal reached after each row, with insertions of user and assistant turns between.
            def closed(at):
                for j in range(len(goal)):
                    if j in at and goal[j] in "ua":
                        value = (at[j][0] + tr.INSERT, at[j][1] + "I")
                        at[j + 1] = min(at.get(j + 1, value), value)
                return at

            best = closed(best)
            for kind in rows:
                after = {}
                for j, (cost, audit) in best.items():
                    moves = [(j, tr.DELETE, "D")]
                    if kind not in tr.MUST_GO and j < len(goal):
                        extra = tr.TRUNCATED if kind.isupper() else 0
                        if kind.lower() == goal[j]:
                            moves.append((j + 1, extra, "K"))
                        if goal[j] in "ua":
                            moves.append((j + 1, extra + tr.REROLE, "R"))
                    for k, more, letter in moves:
                        value = (cost + more, audit + letter)
                        after[k] = min(after.get(k, value), value)
                best = closed(after)
            if len(goal) in best:
                found.append(best[len(goal)])
    return min(found)


@pytest.mark.parametrize("length", [1, 2, 3])
def test_cells_hold_the_cheapest_repair(length):
    for kinds in product("suaoUA0", repeat=length):
        assert tr.best(tr.parse("".join(kinds))) == cheapest(kinds), kinds


def test_cells_of_any_split_agree():
    draw = random.Random(3)
    for _ in range(40):
        kinds = "".join(draw.choices("suaoSUA01", k=draw.randint(2, 12)))
        at = draw.randint(1, len(kinds) - 1)
        assert tr.combined(tr.parse(kinds[:at]), tr.parse(kinds[at:])) == tr.parse(kinds)
        assert tr.best(tr.parse(kinds)) == cheapest(kinds)


def odd_turns():
    rows = [
        (1, 0, "system", "Be kind."), (1, 1, "user", "Hello?"), (1, 2, "assistant", "Hi."),
        (2, 0, "user", "One."), (2, 0, "user", "One."), (2, 5, None, None), (2, None, "assistant", "  "),
        (3, 3, "assistant", "No question."), (3, 4, "assistant", "cut of"),
        (None, 1, "user", "Who?"), (None, None, "", "Nobody."), (None, 1, "user", "Who?"),
        (4, 7, "tool", "ünï　"), (4, 8, "user", "日本\n\v"), (4, 9, "assistant", "x" * 30_000 + "!"),
    ]
    draw = random.Random(5)
    for conv in range(10, 60):
        for turn in range(draw.randint(1, 9)):
            rows.append((conv, turn * draw.choice([1, 1, 2]), draw.choice(["user", "assistant", "system", "user", "assistant", "odd"]), draw.choice(["Yes.", "No!", "maybe", "", "Why?"])))
    return rows


def test_repair_equals_sql(spark, monkeypatch):
    rows = odd_turns()
    expected = sql_of("op11_turn_repair", "conversations", rows, TURNS)
    turns = spark.createDataFrame(rows, TURNS)
    assert spark_rows(tr.repaired_digests(turns)) == expected
    # Tiny blocks: every conversation spans several and is combined in rounds.
    monkeypatch.setattr(tr, "BLOCK", 2)
    monkeypatch.setattr(tr, "FAN", 2)
    clashing = turns.withColumns({c: F.lit(9) for c in ("conv", "pos", "block", "kind", "edit", "n", "cost", "_row", "blank")})
    assert spark_rows(tr.repaired_digests(clashing)) == expected


def test_repaired_rows_follow_the_pattern(spark):
    found, rows = tr.repair(spark.createDataFrame(odd_turns(), TURNS))
    by_conv: dict[str, str] = {}
    for r in rows.orderBy("conv", "pos", "nth").collect():
        by_conv[r["conv"]] = by_conv.get(r["conv"], "") + r["role"][0]
    assert all(re.fullmatch("(s?(ua)+)?", roles) for roles in by_conv.values()) and by_conv["1"] == "sua"
    kept = {r["conv"]: len(r["audit"].replace("D", "")) for r in found.collect()}
    assert {c: n for c, n in kept.items() if n} == {c: len(roles) for c, roles in by_conv.items()}


def test_repair_of_one_long_conversation(spark):
    rows = [(1, i, "user" if i % 3 else "assistant", f"turn {i % 700}.") for i in range(3000)]
    seen, pattern = set(), ""
    for _, _, role, text in rows:
        pattern += "0" if (role, text) in seen else role[0]
        seen.add((role, text))
    found, _ = tr.repair(spark.createDataFrame(rows, TURNS))
    (row,) = found.collect()
    assert (row["cost"], row["audit"]) == tr.best(tr.parse(pattern))
    assert row["duplicate"] == pattern.count("0") and row["gaps"] == 0


def test_repair_of_nothing(spark):
    empty = spark.createDataFrame([], TURNS)
    assert tr.repaired_digests(empty).collect() == []
    # crc32("3:0") % 20 decides; every row of a conversation may be dropped.
    lost = [(c, t, "user", "x.") for c in range(200) for t in range(1)]
    assert spark_rows(tr.repaired_digests(spark.createDataFrame(lost, TURNS))) == sql_of("op11_turn_repair", "conversations", lost, TURNS)


# Secret links

KEY, TOKEN, HEX = "AKIA" + "ABCD1234" * 2, "Zx8kQ2mN9pL4vT7bR1", "0123456789abcdef" * 2


def secret_texts():
    far = " word" * 60
    return [
        f"password = hunter22 and {KEY} then {HEX}",
        f"user: alice{far} password: hunter22",
        f"user: alice with password: hunter22 at https://example.org/login",
        f"a bare {TOKEN} alone", f"{KEY} near {TOKEN}", f"{KEY}{far} {TOKEN}", f"client_id={TOKEN}", f"login={TOKEN} https://example.org",
        "see https://example.org/path?x=1 only", "PASSWORD:'abcdef' Token=ab api_key= xyz123", "token:token:abcdef secret=secret=abc",
        "ünï pässword password: ünsafe1 日本 api-key api_key:日本 apikey:abcdef", "", None, HEX * 40 + " " + KEY + "X" * 300,
        f"{KEY} {TOKEN}\n" * 700, "Key toKen: abcdefgh ſecret: abcdefgh", f"account = bob token={TOKEN}, redis://cache:6379/0", "word " * 2000,
    ]


def test_secrets_equal_sql(spark):
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(secret_texts())]
    rows += [(3, secret_texts()[4], "en", "s", 0), (None, secret_texts()[4], "en", "s", 0), rows[4], rows[4], rows[2]]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = spark_rows(sl.secret_digests(docs))
    assert got == sql_of("op12_secret_links", "documents", rows, SCHEMA)
    spans = " ".join(r[got[0].index("spans")] for r in got[1])
    assert all(f"{kind}:" in spans for kind in sl.KINDS)


def test_weak_parts_need_their_complement(spark):
    rows = {r["doc_id"]: r["kinds"] for r in sl.secret_rows(documents(spark, list(enumerate(secret_texts())))).groupBy("doc_id").agg(
        F.sort_array(F.collect_set("kind")).alias("kinds")).collect()}
    assert rows[2] == ["assign", "login", "url"] and rows[4] == ["access", "token"]
    assert rows[1] == ["assign"] and rows[5] == ["access"] and not {3, 6, 8} & set(rows)


def test_running_sums(spark):
    for n in (0, 1, 255, 256, 257, 3000):
        numbers = [i % 7 for i in range(n)]
        row = spark.range(1).select(sl.running_sums(F.lit(numbers).cast("array<bigint>") if n else F.array().cast("array<bigint>")).alias("s")).first()
        assert row["s"] == np.cumsum(numbers).tolist()


def test_secret_spans_of_odd_documents(spark):
    docs = odd_documents(spark)
    expected = plain(sl.secret_digests(docs).collect())
    assert len(expected) == docs.count() and expected == plain(sl.secret_digests(with_clashes(docs)).collect())
    assert sl.secret_digests(docs.limit(0)).collect() == []


# Fill in the middle


def test_units_are_found_by_rank():
    draw = random.Random(7)
    for _ in range(60):
        texts = ["".join(draw.choices("aé日👍\x00 z", k=draw.choice([0, 1, 2, 7, 8, 9, 40]))) for _ in range(draw.randint(1, 6))]
        data = [t.encode() for t in texts]
        offsets = np.cumsum([0, *map(len, data)])
        one, two = (np.array([draw.getrandbits(32) for _ in texts]) for _ in range(2))
        units, first, second, a, b = fm.cut_places(memoryview(b"".join(data)), offsets, one, two)
        assert units.tolist() == [len(t) for t in texts]
        for i, t in enumerate(texts):
            cuts = sorted((int(one[i]) % (len(t) + 1), int(two[i]) % (len(t) + 1)))
            assert [first[i], second[i]] == cuts
            assert [a[i] - offsets[i], b[i] - offsets[i]] == [len(t[:c].encode()) for c in cuts]


def test_fill_middle_equals_sql(spark, monkeypatch):
    rows = [tuple(r) for r in odd_documents(spark).collect()]
    rows += [(100 + i, f"text {i} " + "é日👍x"[i % 4] * (i % 23), "en", "s", 0) for i in range(150)]
    rows += [(900, "holds <S> inside", "en", "s", 0), (901, "<P", "en", "s", 0), (902, "a<", "en", "s", 0), (903, "<<S<M", "en", "s", 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    expected = sql_of("op13_fill_middle", "documents", rows, SCHEMA)
    assert spark_rows(fm.fill_middle_digests(docs)) == expected
    forms = {r[expected[0].index("form")] for r in expected[1]}
    assert forms == {"plain", "psm", "spm"}
    assert spark_rows(fm.fill_middle_digests(with_clashes(docs))) == expected
    assert fm.fill_middle_digests(docs.limit(0)).collect() == []
