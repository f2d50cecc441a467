"""Merkle fingerprints of texts, with SQL functions only.

A text is split at empty lines into sections, a section at line ends into
paragraphs and a paragraph into pieces of up to ``PIECE`` code points. Digests
go upwards from the pieces to the root. Nothing is lost in the splits, so equal
roots mean equal texts; where roots differ, only branches that differ need to
be followed to find the edit. Likeness is twice the number of common
pieces over all pieces of both texts, 1 where the roots are equal.

Cases: a null text counts as empty and has the fingerprint of the empty text;
an empty text is unlike any other; a null doc_id comes first in the order;
documents of one doc_id are ordered by a hash of their texts; repeated rows
are one document for the order and each get its result; the only document is
its own successor; an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from prefkit.llm.common import stored, texts_of
from prefkit.operators.positions import number_rows

PIECE = 100
LOWEST = -(2**63)


def _digest(kind: str, children: Column) -> Column:
    return F.sha2(F.concat(F.lit(kind), F.array_join(children, "")), 256)


def pieces(paragraph: Column, size: int = PIECE) -> Column:
    return F.regexp_extract_all(paragraph, F.lit(rf"[^\n]{{1,{size}}}"), F.lit(0))


def sections(text: Column) -> Column:
    """The tree below the root: an array of sections with their digest and their paragraphs' digests."""

    def section(part: Column) -> Column:
        digests = F.transform(F.split(part, "\n"), lambda p: _digest("p", F.transform(pieces(p), lambda x: F.sha2(x, 256))))
        return F.struct(_digest("s", digests).alias("digest"), digests.alias("paragraphs"))

    return F.transform(F.split(text, "\n\n"), section)


def root(tree: Column) -> Column:
    return _digest("r", F.transform(tree, lambda s: s["digest"]))


def leaves(text: Column) -> Column:
    """The distinct pieces of a text as whole numbers."""
    return F.array_distinct(F.transform(F.flatten(F.transform(F.split(text, "\n"), lambda p: pieces(p))), lambda p: F.xxhash64(p)))


def likeness(one: Column, other: Column, equal: Column) -> Column:
    """From 0 to 1; ``equal`` says whether the roots are equal."""
    total = F.size(one) + F.size(other)
    return F.when(equal, F.lit(1.0)).when(total == 0, F.lit(0.0)).otherwise(2.0 * F.size(F.array_intersect(one, other)) / total)


def changed_paragraphs(one: Column, other: Column) -> Column:
    """(section, paragraph) numbers, from 0, at which two trees differ; equal branches are not opened."""

    def inside(pair: Column, at: Column) -> Column:
        a, b = (F.coalesce(pair[side]["paragraphs"], F.array().cast("array<string>")) for side in "ab")
        numbers = F.transform(F.arrays_zip(a.alias("a"), b.alias("b")), lambda p, i: F.when(~p["a"].eqNullSafe(p["b"]), i))
        return F.transform(
            F.filter(numbers, lambda i: i.isNotNull()), lambda i: F.struct(at.alias("section"), i.alias("paragraph"))
        )

    zipped = F.arrays_zip(one.alias("a"), other.alias("b"))
    found = F.transform(zipped, lambda p, i: F.when(~p["a"]["digest"].eqNullSafe(p["b"]["digest"]), inside(p, i)))
    return F.flatten(F.filter(found, lambda x: x.isNotNull()))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, fingerprint and its tree, of every document."""
    return (
        texts_of(docs)
        .select("doc_id", F.length("text").cast("bigint").alias("n_chars"), sections(F.col("text")).alias("tree"))
        .select("doc_id", "n_chars", root(F.col("tree")).alias("fingerprint"), "tree")
    )


def _keyed(docs: DataFrame) -> DataFrame:
    return texts_of(docs).select(F.coalesce("doc_id", F.lit(LOWEST)).alias("_id"), F.xxhash64("text").alias("_th"), "text")


def successors(keyed: DataFrame) -> DataFrame:
    """(_id, _th, _quarter, _next_id, _next_th): each document's next one, the last one's being the first."""
    keys = keyed.groupBy("_id", "_th").agg(F.first(F.length("text")).alias("_n"))
    placed = stored(number_rows(keys, F.col("_id"), F.col("_th")), "order")
    total = max(placed.count(), 1)
    following = placed.select(F.col("_id").alias("_next_id"), F.col("_th").alias("_next_th"), F.col("pos").alias("_at"))
    here = placed.select("_id", "_th", F.floor(F.col("_n") / 4).cast("int").alias("_quarter"), ((F.col("pos") + 1) % total).alias("_at"))
    return here.join(following, "_at").drop("_at")


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Every document against its edited text, whose last quarter is the beginning of the next document, and against that document."""
    keyed = _keyed(docs)
    links = stored(successors(keyed), "successors")
    after = links.select(
        F.col("_id").alias("_of"), F.col("_th").alias("_of_th"), "_quarter", F.col("_next_id").alias("_id"), F.col("_next_th").alias("_th")
    )
    # Both joins read the texts in one layout, so they move once.
    heads = (
        keyed.join(after, ["_id", "_th"])
        .select(
            F.col("_of").alias("_id"),
            F.col("_of_th").alias("_th"),
            "_quarter",
            F.expr("substring(text, 1, _quarter)").alias("_head"),
            leaves(F.col("text")).alias("_next_leaves"),
            F.sha2("text", 256).alias("_next_sha"),
        )
        .groupBy("_id", "_th")
        .agg(F.first(F.struct("_quarter", "_head", "_next_leaves", "_next_sha")).alias("_next"))
        .select("_id", "_th", "_next.*")
    )
    joined = keyed.join(heads, ["_id", "_th"]).withColumn("n_chars", F.length("text").cast("bigint"))
    edited = joined.withColumn("edited", F.expr("concat(substring(text, 1, cast(n_chars as int) - _quarter), _head)"))
    printed = edited.select(
        F.nullif("_id", F.lit(LOWEST)).alias("doc_id"),
        "n_chars",
        F.sha2("text", 256).alias("_sha"),
        F.sha2("edited", 256).alias("edited_sha256"),
        "_next_sha",
        root(sections(F.col("text"))).alias("fingerprint"),
        root(sections(F.col("edited"))).alias("edited_fingerprint"),
        leaves(F.col("text")).alias("_leaves"),
        leaves(F.col("edited")).alias("_edited_leaves"),
        "_next_leaves",
    )
    return printed.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("_leaves"), F.col("_edited_leaves"), F.col("fingerprint") == F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("_leaves"), F.col("_next_leaves"), F.col("_sha") == F.col("_next_sha")).alias("near_next"),
    )
