"""Small tables every text operator has to cope with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 701} and{i % 13}" for i in range(15_000))


def documents(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """(doc_id, text[, source]) rows as a documents table."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def odd_documents(spark: SparkSession) -> DataFrame:
    """Null and empty texts, a null doc_id, repeated rows, one doc_id twice, a very long text, ties."""
    text = "\n".join(" ".join(f"w{i}x{j}" for j in range(12)) for i in range(12))
    return documents(
        spark,
        [
            (1, None),
            (2, ""),
            (3, " \n\t "),
            (None, text, None),
            (5, text, "b"),
            (5, text, "b"),
            (6, text, "a"),
            (7, "other text " + text, "a"),
            (7, "second text of the same id\n" + text[:300], None),
            (8, LONG, "a"),
            (9, "ünï\u3000çødé 日本語 \x00 end", "c"),
            (10, "short", "c"),
        ],
    )


def with_clashes(docs: DataFrame) -> DataFrame:
    """The same rows with extra columns whose names the operators use inside or return."""
    names = ["words", "kept", "score", "line", "th", "doc", "size", "_key", "row", "gone", "ids", "path", "host", "begins", "label", "quality", "predicted"]
    out = docs
    for i, name in enumerate(names):
        out = out.withColumn(name, docs["doc_id"] * i)
    return out


def plain(rows) -> list[tuple]:
    return sorted((tuple(r) for r in rows), key=repr)
