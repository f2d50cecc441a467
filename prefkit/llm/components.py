"""Connected groups of a table of links, without a collected neighbour list."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from prefkit.llm.common import stored

# Links a task joins up at once.
AT_ONCE = 200_000


def joined_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each node of a task's links with the smallest one it hangs together with there, ``AT_ONCE`` links or one batch at a time."""
    least: dict = {}

    def root(node):
        while (above := least.setdefault(node, node)) != node:
            least[node] = node = least[above]
        return node

    def made() -> pd.DataFrame:
        pairs = [(node, root(node)) for node in list(least)]
        least.clear()
        return pd.DataFrame([(a, b) for a, b in pairs if a != b], columns=["a", "b"])

    seen = 0
    for batch in batches:
        for a, b in zip(batch["a"].tolist(), batch["b"].tolist(), strict=True):
            one, other = root(a), root(b)
            if one != other:
                least[max(one, other)] = min(one, other)
        seen += len(batch)
        if seen >= AT_ONCE:
            yield made()
            seen = 0
    if seen:
        yield made()


def _stars(edges: DataFrame, larger_only: bool) -> DataFrame:
    """Each neighbour of a node gets an edge to the smallest of them; ``larger_only`` re-hangs neighbours above the node."""
    if larger_only:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("_m")).select("a", F.least("a", "_m").alias("m"))
    joined = both.join(least, "a")
    if larger_only:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def connected_groups(links: DataFrame) -> DataFrame:
    """(member, root): the smallest member of the group of every member of ``links`` (a, b).

    Large and small stars take turns until nothing changes, each turn
    written to the shared folder; the number of turns grows with the logarithm of
    the longest chain, after each task has joined up the links it holds. Links to oneself count as a member without others.
    A turn's tasks, each of which writes a file, follow the number of links and not that of the shuffle's partitions.
    """
    edges = stored(links.where("a is not null and b is not null").select("a", "b").distinct(), "links")
    members = edges.select(F.col("a").alias("member")).unionByName(edges.select(F.col("b").alias("member"))).distinct()
    edges = edges.where("a <> b")
    tasks = max(2 * links.sparkSession.sparkContext.defaultParallelism, -(-edges.count() // AT_ONCE))
    edges, state = stored(edges.coalesce(tasks).mapInPandas(joined_up, edges.schema), "joined"), None
    while True:
        edges = stored(_stars(_stars(edges, True), False).coalesce(tasks).mapInPandas(joined_up, edges.schema), "stars")
        row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if (row["n"], row["s"]) == state:
            break
        state = (row["n"], row["s"])
    roots = edges.select(F.col("a").alias("member"), F.col("b").alias("_root"))
    return members.join(roots, "member", "left").select("member", F.coalesce("_root", "member").alias("root"))
