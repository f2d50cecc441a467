"""Jaccard join of documents on word shingles by a MinHash LSH forest.

A document's set of ``SHINGLE``-word shingles gets ``TREES`` labels of ``DEPTH``
minimum hashes each. A label is a path in a prefix trie; the labels of a tree,
range sorted, are the trie, and a label's common prefix with its neighbours says
how deep it meets another one. Documents first meet at whole labels, and these
pairs are verified. Then each document shortens its prefix in all trees until its
recall reaches the target: a document whose least similar link so far would be
found at a depth with that probability stops there, one without links goes on until
that holds for the threshold itself. Two documents meet at the shorter of their
prefixes. All pairs that meet are verified exactly on their sets.

Documents with equal sets are one class and enter the forest once. Small nodes
list their pairs. Members of large nodes would give too many: they are grouped
by the large nodes they share, and each group is verified in cells of two
blocks, where only counts and one link per member leave a task.

Cases: a text of fewer words than a shingle has one shingle of all its words;
texts without words (null texts too) are one class without links; repeated rows
are copies in one class; null doc_ids are kept and never represent others;
an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
import xxhash

from prefkit.llm.common import map_slices, stored, texts_of
from prefkit.llm.components import connected_groups

SHINGLE = 5
# The similarity of a link, as a fraction.
THRESHOLD = (4, 5)
TREES, DEPTH, TARGET_RECALL = 24, 8, 0.999
SMALL_NODE = 24
# Members of a block of a large group, and shingles in all its sets.
BLOCK, BLOCK_SHINGLES = 512, 1_000_000
SEED = 5

_random = np.random.default_rng(SEED)
MULTIPLIERS = _random.integers(1, 2**63, TREES * DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
ADDENDS = _random.integers(0, 2**63, TREES * DEPTH, dtype=np.uint64)
SIGNED = "doc_id long, th long, cls binary, n long, labels binary"


def recall(depth: int, trees: int = TREES, similarity: float = THRESHOLD[0] / THRESHOLD[1]) -> float:
    """Probability that two documents of this similarity share a prefix of ``depth`` in some tree."""
    return 1 - (1 - similarity**depth) ** trees


def prefix_depth(target: float = TARGET_RECALL, similarity: float = THRESHOLD[0] / THRESHOLD[1]) -> int:
    """The longest prefix at which two documents of this similarity meet with the target probability."""
    depth = DEPTH
    while depth > 1 and recall(depth, similarity=similarity) < target:
        depth -= 1
    return depth


def shortened(least: Column) -> Column:
    """The depth at which a document reaches the target recall, by its least similar link; without one, by the threshold."""
    floor = prefix_depth()
    enough = 1 - (1 - TARGET_RECALL) ** (1 / TREES)
    steps = [F.when(least >= enough ** (1 / depth), 1).otherwise(0) for depth in range(floor + 1, DEPTH + 1)]
    return sum(steps, F.lit(floor)).cast("int")


class Words(dict):
    """Word to 64-bit hash, kept for a batch of texts."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word, SEED)
        return value


def shingles(text: str, words: Words, length: int = SHINGLE) -> np.ndarray:
    """Sorted distinct shingle hashes of a text."""
    found = text.encode("utf-8", "surrogatepass").split()
    hashes = np.fromiter(map(words.__getitem__, found), np.uint64, len(found))
    if not len(hashes):
        return hashes
    length = min(length, len(hashes))
    n = len(hashes) - length + 1
    value = np.full(n, length, np.uint64)
    for i in range(length):
        value = (value ^ hashes[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
        value ^= value >> np.uint64(29)
    return np.unique(value)


def labels(values: np.ndarray) -> bytes:
    """``TREES`` times ``DEPTH`` minimum hashes of 16 bits, big-endian, so that labels sort as tries."""
    least = np.full(len(MULTIPLIERS), 2**64 - 1, np.uint64)
    for low in range(0, len(values), 4096):
        part = values[low : low + 4096]
        least = np.minimum(least, (MULTIPLIERS[:, None] * part + ADDENDS[:, None]).min(axis=1))
    least = (least ^ (least >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return (least >> np.uint64(48)).astype(">u2").tobytes()


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, th (text hash), cls (hash of the set), n (its size), labels."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            words, rows = Words(), []
            for text in batch["text"]:
                values = shingles(text, words)
                rows.append((hashlib.blake2b(values.tobytes(), digest_size=16).digest(), len(values), labels(values)))
            out = pd.DataFrame(rows, columns=["cls", "n", "labels"])
            out.insert(0, "th", batch["th"].to_numpy())
            out.insert(0, "doc_id", batch["doc_id"].astype("Int64").array)
            yield out

    return map_slices(texts_of(docs).select("doc_id", F.xxhash64("text").alias("th"), "text"), run, SIGNED)


def common_prefixes(trees: np.ndarray, paths: np.ndarray) -> np.ndarray:
    """How many leading hashes each label shares with the one after it; none with one of another tree."""
    same = (paths[1:] == paths[:-1]).astype(np.int64).cumprod(axis=1).sum(axis=1)
    return np.where(trees[1:] == trees[:-1], same, 0)


def forest(classes: DataFrame, shortest: int) -> DataFrame:
    """(tree, path, cls, n) in order: the labels that share at least ``shortest`` hashes with a neighbour in their trie.

    Labels at the ends of a partition stay, as their other neighbour is not seen.
    """
    schema = "tree int, path binary, cls binary, n long"
    paths = [F.struct(F.lit(t).alias("tree"), F.substring("labels", 2 * DEPTH * t + 1, 2 * DEPTH).alias("path")) for t in range(TREES)]
    leaves = classes.where("n > 0").select(F.inline(F.array(*paths)), "cls", "n")
    order = ["tree", "path", "cls"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, before = None, DEPTH
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks().to_batches()[0]
            trees = rows["tree"].to_numpy(zero_copy_only=False)
            after = common_prefixes(trees, np.frombuffer(b"".join(rows["path"].to_pylist()), ">u2").reshape(-1, DEPTH))
            # The last row waits for the one after it.
            deepest = np.maximum(np.concatenate([[before], after[:-1]]), after) if len(after) else after
            kept = rows.slice(0, rows.num_rows - 1).filter(pa.array(deepest >= shortest))
            held, before = rows.slice(rows.num_rows - 1), int(after[-1]) if len(after) else before
            yield kept
        if held is not None:
            yield held

    return leaves.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, schema)


def nodes(trie: DataFrame, depths: DataFrame, shortest: int) -> DataFrame:
    """(node, cls, n, members, centre) of the nodes in which some class that stops at their depth meets another.

    ``depths`` (cls, depth) says where a class stops; it is found in every node above, too.
    """
    placed = trie.join(depths, "cls").withColumn("at", F.explode(F.sequence(F.lit(shortest), F.col("depth"))))
    node = F.xxhash64("tree", "at", F.expr("substring(path, 1, 2 * at)")).alias("node")
    placed = placed.select(node, "cls", "n", (F.col("depth") == F.col("at")).alias("asks"))
    met = placed.groupBy("node").agg(F.count(F.lit(1)).alias("members"), F.min("cls").alias("centre"), F.max("asks").alias("asked"))
    return placed.join(met.where("members > 1 and asked").drop("asked"), "node").drop("asks")


def _similar(inter, one, other):
    return (THRESHOLD[0] + THRESHOLD[1]) * inter >= THRESHOLD[0] * (one + other)


def small_pairs(members: DataFrame) -> DataFrame:
    """Distinct (a, b) with a < b that meet in a node of at most ``SMALL_NODE`` members and whose sizes allow the threshold."""
    lists = members.where(F.col("members") <= SMALL_NODE).groupBy("node").agg(F.array_sort(F.collect_list(F.struct("cls", "n"))).alias("m"))

    def partners(one, i):
        near = F.filter(F.slice("m", i + 2, SMALL_NODE), lambda x: _similar(F.least(one["n"], x["n"]), one["n"], x["n"]))
        return F.transform(near, lambda x: F.struct(one["cls"].alias("a"), x["cls"].alias("b")))

    return lists.select(F.inline(F.flatten(F.transform("m", partners)))).distinct()


def shingle_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(cls, n, shingles) of the representatives (rep_id, rep_th) of wanted classes (with n)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            words = Words()
            yield pd.DataFrame({"cls": batch["cls"], "n": batch["n"], "shingles": [shingles(t, words).tobytes() for t in batch["text"]]})

    texts = texts_of(docs).select("doc_id", F.xxhash64("text").alias("th"), "text")
    match = texts["doc_id"].eqNullSafe(wanted["rep_id"]) & (texts["th"] == wanted["rep_th"])
    rows = texts.join(wanted, match).select("cls", "n", "text")
    # A representative that is repeated gives equal rows.
    return map_slices(rows, run, "cls binary, n long, shingles binary").dropDuplicates(["cls"])


def verified_pairs(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets reach the threshold, and their similarity."""

    @F.pandas_udf("double")
    def similarity(one: pd.Series, other: pd.Series) -> pd.Series:
        out = []
        for a, b in zip(one, other, strict=True):
            x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
            union = len(np.union1d(x, y))
            inter = len(x) + len(y) - union
            out.append(inter / union if _similar(inter, len(x), len(y)) else None)
        return pd.Series(out, dtype=float)

    # Computed once; the filter on it would be pushed below and compute it again, in a second Python worker of the task.
    similarity = similarity.asNondeterministic()
    first = sets.select(F.col("cls").alias("a"), F.col("shingles").alias("_a"))
    second = sets.select(F.col("cls").alias("b"), F.col("shingles").alias("_b"))
    return pairs.join(first, "a").join(second, "b").select("a", "b", similarity("_a", "_b").alias("least")).where("least is not null")


def common_counts(one: list[np.ndarray], other: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of two lists of sets, by products of 0/1 matrices over a slice of the values at a time."""
    values = np.concatenate([*one, *other]) if one or other else np.empty(0, np.uint64)
    owner = np.repeat(np.arange(len(one) + len(other)), [len(v) for v in [*one, *other]])
    known, at, counts = np.unique(values, return_inverse=True, return_counts=True)
    # Values of a single set are in no intersection.
    several = counts > 1
    column = np.cumsum(several) - 1
    keep = several[at]
    owner, at = owner[keep], column[at[keep]]
    order = np.argsort(at, kind="stable")
    owner, at = owner[order], at[order]
    total = np.zeros((len(one), len(other)), np.float32)
    width = 4096
    for low in range(0, int(several.sum()), width):
        part = slice(*np.searchsorted(at, [low, low + width]))
        dense = np.zeros((len(one) + len(other), width), np.float32)
        dense[owner[part], at[part] - low] = 1
        total += dense[: len(one)] @ dense[len(one) :].T
    return total.astype(np.int64)


def least_labels(linked: np.ndarray) -> np.ndarray:
    """Smallest index in each connected group of a symmetric matrix of links."""
    label = np.arange(len(linked))
    while True:
        lower = np.minimum(label, np.where(linked, label[None, :], len(linked)).min(axis=1, initial=len(linked)))
        lower = lower[lower]
        if (lower == label).all():
            return label
        label = lower


def _cell(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Links inside a cell: each member's count, its least similarity and one link towards its group."""
    rows = rows.sort_values(["block", "cls"], ignore_index=True)
    sets = [np.frombuffer(s, np.uint64) for s in rows["shingles"]]
    sizes = np.array([len(s) for s in sets], np.int64)
    first = int((rows["block"] == key[1]).sum())
    linked = np.zeros((len(sets), len(sets)), bool)
    alike = np.full(linked.shape, np.inf)

    def compare(one: slice, other: slice) -> tuple[np.ndarray, np.ndarray]:
        inter, total = common_counts(sets[one], sets[other]), sizes[one, None] + sizes[None, other]
        near = _similar(inter, sizes[one, None], sizes[None, other])
        return near, np.where(near, inter / (total - inter), np.inf)

    if key[1] == key[2]:
        linked[:], alike[:] = compare(slice(None), slice(None))
        np.fill_diagonal(linked, False)
        np.fill_diagonal(alike, np.inf)
    else:
        low, high = slice(None, first), slice(first, None)
        linked[low, high], alike[low, high] = compare(low, high)
        linked[high, low], alike[high, low] = linked[low, high].T, alike[low, high].T
    label = least_labels(linked)
    least = alike.min(axis=1, initial=np.inf)
    return pd.DataFrame(
        {"a": rows["cls"], "b": rows["cls"].to_numpy()[label], "links": linked.sum(axis=1).astype(np.int64), "least": np.where(np.isinf(least), np.nan, least)}
    )


def group_links(grouped: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, links, least) of groups (root, cls): ``links`` counts a member's links in one cell, b is a member it is connected with."""
    rows = grouped.join(sets.select("cls", "n"), "cls")
    sizes = rows.groupBy("root").agg(F.count(F.lit(1)).alias("_size"), F.sum("n").alias("_all"))
    blocks = F.ceil(F.greatest(F.col("_size") / BLOCK, F.col("_all") / BLOCK_SHINGLES)).cast("int")
    placed = rows.join(sizes, "root").select("root", "cls", blocks.alias("_blocks"), F.pmod(F.xxhash64("cls"), blocks).cast("int").alias("block"))
    cells = F.transform(
        F.sequence(F.lit(0), F.col("_blocks") - 1), lambda other: F.struct(F.least("block", other).alias("i"), F.greatest("block", other).alias("j"))
    )
    dealt = placed.select("root", "cls", "block", F.inline(cells)).join(sets.drop("n"), "cls")
    return dealt.groupBy("root", "i", "j").applyInPandas(_cell, "a binary, b binary, links long, least double")


def links_at(members: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, links, least): the verified links of classes that meet in the given nodes.

    ``links`` summed over a is its number of links, ``least`` the similarity of
    the least similar one (null where there is none); b connects a to its group.
    """
    large = members.where(F.col("members") > SMALL_NODE)
    grouped = connected_groups(large.select(F.col("cls").alias("a"), F.col("centre").alias("b")))
    grouped = stored(grouped.select("root", F.col("member").alias("cls")), "groups")
    pairs = small_pairs(members)
    one_root, other_root = (grouped.select(F.col("cls").alias(c), F.col("root").alias(f"_{c}")) for c in "ab")
    pairs = pairs.join(one_root, "a", "left").join(other_root, "b", "left")
    # Pairs inside a group are verified in its cells.
    pairs = pairs.where("_a is null or _b is null or _a <> _b").select("a", "b")
    found = stored(verified_pairs(pairs, sets), "pairs")
    both = found.unionByName(found.select(F.col("b").alias("a"), F.col("a").alias("b"), "least"))
    both = both.select("a", "b", F.lit(1).cast("bigint").alias("links"), "least")
    return stored(both.unionByName(group_links(grouped, sets)), "verified")


def forest_links(docs: DataFrame, classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The links of ``links_at`` between classes, and (cls, depth): the prefix each matched class was shortened to."""
    shortest = prefix_depth()
    trie = stored(forest(classes, shortest), "trie")
    matched = stored(trie.select("cls").distinct(), "matched")
    sets = stored(shingle_sets(docs, classes.select("cls", "n", "rep_id", "rep_th").join(matched, "cls")), "sets")
    whole = links_at(stored(nodes(trie, matched.withColumn("depth", F.lit(DEPTH)), DEPTH), "members"), sets)
    known = whole.groupBy(F.col("a").alias("cls")).agg(F.min("least").alias("least"))
    depths = stored(matched.join(known, "cls", "left").select("cls", shortened(F.col("least")).alias("depth")), "depths")
    return links_at(stored(nodes(trie, depths, shortest), "members"), sets), depths


def _representative() -> Column:
    """The document with the smallest doc_id; one without a doc_id only where there is no other."""
    one = F.struct("doc_id", "th")
    return F.coalesce(F.min(F.when(F.col("doc_id").isNotNull(), one)), F.min(one)).alias("_rep")


def jaccard_join(docs: DataFrame) -> DataFrame:
    """doc_id, th (xxhash64 of the text), class_id, n_copies, group_id, n_links, keeper of every document.

    class_id is the smallest doc_id with the same set, n_copies the number of
    its documents, n_links the number of other classes at the threshold or
    above, group_id the smallest doc_id connected through links, keeper true for
    the document (and its repeated rows) that stands for the group.
    """
    signed = stored(signatures(docs), "signatures")
    classes = signed.groupBy("cls").agg(_representative(), F.first("n").alias("n"), F.first("labels").alias("labels"), F.count(F.lit(1)).alias("n_copies"))
    classes = stored(
        classes.select("cls", "n", "labels", "n_copies", F.col("_rep.doc_id").alias("rep_id"), F.col("_rep.th").alias("rep_th")), "classes"
    )
    links, _ = forest_links(docs, classes)

    totals = links.groupBy(F.col("a").alias("cls")).agg(F.sum("links").alias("n_links"))
    roots = connected_groups(links.select("a", "b")).select(F.col("member").alias("cls"), "root")
    known = classes.select("cls", "rep_id", "rep_th", "n_copies").join(totals, "cls", "left").join(roots, "cls", "left")
    known = known.withColumn("root", F.coalesce("root", "cls"))
    known = known.withColumnsRenamed({"rep_id": "doc_id", "rep_th": "th"})
    smallest = known.groupBy("root").agg(_representative())
    n_links = F.coalesce("n_links", F.lit(0)).alias("n_links")
    labelled = known.join(smallest, "root").select("cls", F.col("doc_id").alias("class_id"), "n_copies", n_links, "_rep")
    here = F.struct("doc_id", "th")
    return (
        signed.select("doc_id", "th", "cls")
        .join(labelled, "cls")
        .select("doc_id", "th", "class_id", "n_copies", F.col("_rep.doc_id").alias("group_id"), "n_links", here.eqNullSafe(F.col("_rep")).alias("keeper"))
    )


def join_digests(docs: DataFrame) -> DataFrame:
    return jaccard_join(docs).drop("th", "keeper")
