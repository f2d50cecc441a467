"""A reward fitted from word counts: how much likelier a word is in chosen texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from prefkit.functions.tokens import truncate
from prefkit.operators.inference import Scorer
from prefkit.operators.lookup import find_known, frequent, is_small, lookup
from prefkit.operators.vocabulary import chat_words
from prefkit.session import shared_folder
from prefkit.sources.files import written


# Weights are kept to nine places and summed as whole numbers, so that equal
# texts get equal scores whatever order Spark adds them up in.
UNITS = 1_000_000_000


def fit_log_odds(df: DataFrame, chosen: Column, rejected: Column, max_len: int | None = None) -> DataFrame:
    """(tok, c, r, cnt, weight) with weight ``ln((c + 1) / (r + 1))`` to nine places.

    Both sides are counted in one pass, combined before the shuffle. The table
    is checkpointed because every scoring job reads it.
    """
    shared_folder(df.sparkSession)
    sides = F.array(
        F.struct(F.lit(1).alias("c"), truncate(chat_words(chosen), max_len).alias("w")),
        F.struct(F.lit(0).alias("c"), truncate(chat_words(rejected), max_len).alias("w")),
    )
    tokens = df.select(F.inline(sides)).select("c", F.explode("w").alias("tok"))
    counts = tokens.groupBy("tok").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("cnt"))
    rejections = F.col("cnt") - F.col("c")
    return counts.select(
        "tok",
        "c",
        rejections.alias("r"),
        "cnt",
        F.round(F.log((F.col("c") + 1).cast("double") / (rejections + 1)), 9).alias("weight"),
    ).checkpoint()


def log_odds_scorer(weights: DataFrame, max_len: int | None = None) -> Scorer:
    """The mean weight of a text's words; an unseen word weighs nothing, a null text has no score.

    Before a table too large to broadcast is met, a text is reduced to the sum over its frequent words and the few others.
    """

    def score(df: DataFrame, keys: list[str], texts: dict[str, Column], keep: list[str] | None = None) -> DataFrame:
        sides = F.array(
            *[
                F.struct(F.lit(n).alias("_of"), t.isNotNull().alias("_given"), truncate(chat_words(t), max_len).alias("_w"))
                for n, t in texts.items()
            ]
        )
        lists = df.select(*keys, F.inline(sides))
        units = F.round(F.col("weight") * UNITS).cast("bigint").alias("units")
        table = weights.select("tok", "cnt", units)
        if is_small(table, "tok"):
            tokens = lists.select(*keys, "_of", "_given", F.explode_outer("_w").alias("tok"))
            found = lookup(tokens, table, "tok", small=True).withColumn("_n", F.col("tok").isNotNull().cast("bigint"))
        else:
            found = _summed(lists, [*keys, "_of", "_given"], table)

        def mean(name: str) -> Column:
            here = F.col("_of") == name
            total = F.sum(F.when(here, F.coalesce("units", F.lit(0).cast("bigint")))).cast("double")
            words = F.sum(F.when(here, F.col("_n"))).cast("double")
            value = F.coalesce(F.try_divide(total, words) / UNITS, F.lit(0.0))
            return F.when(F.max(here & F.col("_given")), value).alias(name)

        scores = found.groupBy(*keys).agg(*[mean(n) for n in texts])
        return df.select(*keys, *keep).join(scores, keys) if keep else scores

    return score


def _summed(lists: DataFrame, keys: list[str], table: DataFrame) -> DataFrame:
    """(keys…, units, _n): a row per text with the sum over its frequent words and its number of words, one for each other word."""
    known = find_known(lists, "_w", frequent(table, "tok"), "tok", "units")
    total = F.aggregate("known", F.lit(0).cast("bigint"), lambda s, u: s + F.coalesce(u, F.lit(0).cast("bigint")))
    none = F.lit(None).cast("bigint")
    whole = F.struct(total.alias("units"), F.size("known").cast("bigint").alias("_n"), F.lit(None).cast("string").alias("tok"))
    others = F.transform("rest", lambda e: F.struct(none.alias("units"), F.lit(0).cast("bigint").alias("_n"), e["tok"].alias("tok")))
    stored = written(known.select(*keys, F.inline(F.concat(F.array(whole), others))), "text-words")
    found = lookup(stored.where(F.col("tok").isNotNull()).drop("units"), table, "tok", small=False)
    return stored.where(F.col("tok").isNull()).drop("tok").unionByName(found.drop("tok"))
