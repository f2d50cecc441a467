"""A word vocabulary built from a table, and encoding with it."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from prefkit.functions.chat import CLOSE, END_OF_TEXT, OPEN
from prefkit.functions.text import words
from prefkit.functions.tokens import truncate
from prefkit.operators.lookup import ends, find_known, frequent, is_small, lookup, merged
from prefkit.operators.positions import number_rows
from prefkit.sources.files import written

# Ids below the first word: padding, unknown word and the chat markers.
SPECIALS = (END_OF_TEXT, "<unk>", OPEN, CLOSE, "<think>", "</think>")
PAD_ID, UNK_ID = 0, 1


def chat_words(text: Column) -> Column:
    """Words of a rendered text with every marker standing alone.

    No marker overlaps another, so plain replacements do, and they are cheaper than a pattern.
    """
    return words(reduce(lambda t, mark: F.replace(t, F.lit(mark), F.lit(f" {mark} ")), SPECIALS, text))


def unmarked(text: Column) -> Column:
    """The words of a rendered text without its markers, joined by single spaces."""
    return F.array_join(F.filter(chat_words(text), lambda w: ~w.isin(list(SPECIALS))), " ")


@dataclass(frozen=True)
class Vocabulary:
    """``table`` holds tok, cnt, id; specials take the first ids."""

    table: DataFrame
    specials: tuple[str, ...] = field(default=SPECIALS)

    def marks(self) -> DataFrame:
        return self.table.sparkSession.createDataFrame(
            [(tok, 0, i) for i, tok in enumerate(self.specials)], "tok string, cnt bigint, id bigint"
        )

    def lookup_table(self) -> DataFrame:
        return self.table.unionByName(self.marks())

    def frequent(self, key: str) -> DataFrame:
        """The markers and the most frequent words, as many as may be broadcast."""
        return frequent(self.table, key).unionByName(self.marks())

    def attach(self, df: DataFrame, row_key: str, keys: list[str], key: str, explode: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """Explodes ``df`` and looks every item up in the broadcast table: (keys…, ``key``, pos, looked up values).

        The rows are laid out by their key before they are exploded: what moves is
        the text, which is smaller than its tokens, and collecting the tokens again moves nothing.
        """
        rows = explode(df.repartition(row_key))
        return lookup(rows.select(*keys, key, "pos"), self.lookup_table(), key, small=True)

    def attach_packed(self, lists: DataFrame, items: str, keys: list[str], key: str, value: Column) -> DataFrame:
        """The same past the broadcast limit, with ``items`` as lists: (keys…, known, ``key``, pos, looked up values).

        A list has one row with what the frequent words say of its items, ``known``, and one for each other item; only
        those meet the whole table. Both are stored once.
        """
        known = self.frequent(key).select(key, value.alias("v"))
        rows = find_known(lists, items, known, key, "v")
        none = {"known": rows.schema["known"].dataType, "pos": "int", key: lists.schema[items].dataType.elementType}
        none = {name: F.lit(None).cast(kind).alias(name) for name, kind in none.items()}
        whole = F.struct(F.col("known"), none["pos"], none[key])
        others = F.transform("rest", lambda e: F.struct(none["known"], e["pos"].alias("pos"), e[key].alias(key)))
        entries = rows.select(*keys, F.inline(F.concat(F.array(whole), others)))
        stored = written(entries, "text-entries")
        found = lookup(stored.where(F.col(key).isNotNull()).drop("known"), self.lookup_table(), key, small=False)
        return stored.where(F.col("known").isNotNull()).select(*keys, "known").unionByName(found, allowMissingColumns=True)


def build_vocabulary(df: DataFrame, *texts: Column) -> Vocabulary:
    """Every distinct word, most frequent first, ties by the word itself."""
    tokens = df.select(F.explode(F.concat(*[chat_words(t) for t in texts])).alias("tok"))
    counts = tokens.where(~F.col("tok").isin(list(SPECIALS))).groupBy("tok").agg(F.count(F.lit(1)).alias("cnt"))
    ranked = number_rows(counts, F.desc("cnt"), F.asc("tok"), name="_rank")
    return Vocabulary(ranked.select("tok", "cnt", (F.col("_rank") + len(SPECIALS)).alias("id")))


def word_lists(df: DataFrame, key: str, texts: Mapping[str, Column], max_len: int | None = None) -> DataFrame:
    """(key, side, cut, w): the words of the named texts, and whether a text was cut at ``max_len``."""
    sides = F.array(*[F.struct(F.lit(name).alias("side"), chat_words(text).alias("w")) for name, text in texts.items()])
    cut = F.lit(False) if max_len is None else F.size("w") > max_len
    return df.select(key, F.inline(sides)).select(key, "side", cut.alias("cut"), truncate(F.col("w"), max_len).alias("w"))


def token_rows(df: DataFrame, key: str, texts: Mapping[str, Column], max_len: int | None = None) -> DataFrame:
    """(key, side, cut, pos, tok) of the named texts.

    A text without words keeps one row with a null ``tok``.
    """
    return word_lists(df, key, texts, max_len).select(key, "side", "cut", F.posexplode_outer("w").alias("pos", "tok"))


def _collect(value: Column, when: Column, item: str) -> Column:
    """Values in text order. One list never exceeds one text."""
    pairs = F.collect_list(F.when(when & F.col(item).isNotNull(), F.struct(F.col("pos"), value.alias("v"))))
    return F.transform(F.array_sort(pairs), lambda p: p["v"])


def encode(
    df: DataFrame,
    key: str,
    texts: Mapping[str, Column],
    vocabulary: Vocabulary,
    max_len: int | None = None,
    with_text: bool = False,
) -> DataFrame:
    """(key, ids and ``<name>_cut`` per text). Unknown words get the unknown id.

    ``with_text`` adds ``<name>_text``, what decoding the ids would give, without a second lookup.
    """
    number = F.coalesce(F.col("id"), F.lit(UNK_ID)).cast("int")
    known = F.when(F.col("id").isNull(), vocabulary.specials[UNK_ID]).otherwise(F.col("tok"))
    keys = [key, "side", "cut"]
    if not is_small(vocabulary.lookup_table(), "tok"):
        lists = word_lists(df.repartition(key), key, texts, max_len)
        rows = vocabulary.attach_packed(lists, "w", keys, "tok", F.col("id").cast("int"))
        return _packed(rows, key, vocabulary, {name: F.col("side") == name for name in texts}, "tok", number, known if with_text else None)
    rows = vocabulary.attach(df, key, keys, "tok", lambda laid: token_rows(laid, key, texts, max_len))
    out = []
    for name in texts:
        here = F.col("side") == name
        out += [_collect(number, here, "tok").alias(name), F.max(here & F.col("cut")).alias(f"{name}_cut")]
        if with_text:
            out.append(F.array_join(_collect(known, here, "tok"), " ").alias(f"{name}_text"))
    return rows.groupBy(key).agg(*out)


def _packed(
    rows: DataFrame, key: str, vocabulary: Vocabulary, names: Mapping[str, Column], item: str, number: Column | None, word: Column | None
) -> DataFrame:
    """Rows of ``attach_packed`` put together again: per name ids with ``<name>_cut``, and words in ``<name>_text``, as asked for."""
    given = (word if number is None else number).isNotNull()
    out, cuts = [], [F.lit(None).cast("boolean").alias("cut")] * ("cut" not in rows.columns)
    rows = rows.select("*", *cuts)
    for name, here in names.items():
        found = F.struct("pos", *([number.alias("id")] if number is not None else []), *([word.alias("tok")] if word is not None else []))
        out.append(F.collect_list(F.when(here, F.col("known"))).alias(f"{name}_known"))
        out.append(F.collect_list(F.when(here & F.col(item).isNotNull() & given, found)).alias(f"{name}_found"))
        out.append(F.max(here & F.col("cut")).alias(f"{name}_cut"))
    table = vocabulary.frequent(item).select("id", "tok").toArrow().combine_chunks() if word is not None else None
    shared = rows.sparkSession.sparkContext.broadcast(table)

    def words_of(ids: pa.Array) -> pa.Array:
        id_, tok = (shared.value[c].combine_chunks() for c in ("id", "tok"))
        return tok.cast(pa.string()).take(pc.index_in(ids.cast(pa.int64()), value_set=id_.cast(pa.int64())))

    def part(found: pa.Array, field: str) -> pa.Array:
        return pa.ListArray.from_arrays(ends(found).astype("int32"), found.flatten().field(field))

    @F.arrow_udf("array<int>")
    def put_ids(known: pa.Array, found: pa.Array) -> pa.Array:
        return merged(known, part(found, "pos"), part(found, "id"), lambda ids: ids)

    @F.arrow_udf("string")
    def put_words(known: pa.Array, found: pa.Array) -> pa.Array:
        return pc.binary_join(merged(known, part(found, "pos"), part(found, "tok"), words_of), " ")

    grouped, columns = rows.repartition(key).groupBy(key).agg(*out), []
    for name in names:
        both = (f"{name}_known", f"{name}_found")
        columns += [put_ids(*both).alias(name), F.col(f"{name}_cut")] * (number is not None)
        columns += [put_words(*both).alias(f"{name}_text")] * (word is not None)
    return grouped.select(key, *columns)


def decode(df: DataFrame, key: str, ids: str, vocabulary: Vocabulary, skip_special: bool = False, name: str = "text") -> DataFrame:
    """(key, text): the words of an id array, joined by single spaces.

    With a vocabulary past the broadcast limit ``df`` is read twice: once for its rare ids, which alone meet the table.
    """
    wanted = F.filter(ids, lambda i: i >= len(vocabulary.specials)) if skip_special else F.col(ids)
    if not is_small(vocabulary.lookup_table(), "id"):
        lists = df.select(key, wanted.alias("known"))
        rare = find_known(lists.withColumn("w", F.col("known").cast("array<bigint>")).drop("known"), "w", vocabulary.frequent("id").select("id", F.col("id").alias("v")), "id", "v")
        rare = written(rare.select(key, F.inline("rest")).where(F.col("id").isNotNull()), "rare-ids")
        rows = lists.unionByName(lookup(rare, vocabulary.lookup_table(), "id", small=False), allowMissingColumns=True)
        found = _packed(rows, key, vocabulary, {name: F.lit(True)}, "id", None, F.col("tok"))
        return found.select(key, F.col(f"{name}_text").alias(name))

    def explode(laid: DataFrame) -> DataFrame:
        items = laid.select(key, F.posexplode_outer(wanted).alias("pos", "_id"))
        return items.select(key, "pos", F.col("_id").cast("bigint").alias("id"))

    found = vocabulary.attach(df, key, [key], "id", explode)
    return found.groupBy(key).agg(F.array_join(_collect(F.col("tok"), F.lit(True), "id"), " ").alias(name))
