"""Conversation structure repair by weighted CYK interval parsing.

A conversation should be ``(s?(ua)+)?`` in role initials: an optional system turn, then user
and assistant in turn. Each row is kept, given another role or deleted, and
empty turns can be inserted, at the least cost; among the cheapest repairs the
one whose audit, the string of edit initials (``K``, ``R``, ``D``, ``I``), is least in ASCII wins.

The grammar is in Chomsky normal form. A nonterminal ``[p q]`` covers the spans
that lead the pattern from place p to place q (0 nothing yet, 1 after the system turn, 2 after a
user turn, 3 after an assistant turn), and every binary rule is ``[p r] -> [p q] [q r]``.
Terminal rules are the edits of one row, closed under insertions on either
side. A cell holds the least (cost, audit) of each nonterminal over its span; cells are combined bottom-up,
spans of 1, 2, 4, … rows. Because ``[p r]`` has a rule for every q, all splits of a
span give the same cell, and one split per span is enough. For one span the cost
follows from the audit's letters, so of two equally cheap audits neither begins with the other, and the least of
a concatenation is made of least parts.

Rows are numbered by one range sort, so a conversation of any length is
spread. Blocks of ``BLOCK`` rows are parsed alone; the cells of longer conversations
are combined ``FAN`` at a time, in as many rounds as the logarithm of the longest.

Cases: null roles and texts count as one space, null conv_ids are one
conversation, null turns come first; rows of one turn are ordered by role and text, so repeated
rows are neighbours; an empty table gives an empty one; other columns are
ignored. Texts are compared by their sha256, roles and texts are never shortened.
"""

from __future__ import annotations

from collections.abc import Iterator
import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from prefkit.llm.common import numbered, stored

# Costs of the edits, and of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
BLOCK, FAN = 512, 16
# Results of repeated patterns kept per worker.
MOST_PATTERNS, PATTERN_CHARS = 20_000, 64

PLACES = range(4)
# Where a turn of each role leads from each place.
STEP = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
INSERTED = {(0, 2): 1, (1, 2): 1, (3, 2): 1, (2, 3): 1, (0, 3): 2, (1, 3): 2}
# A row's class: its initial in small letters, in capitals when truncated; a digit when it has to go.
INITIALS, MUST_GO = "suao", "0123"
LEGAL = {"su", "ua", "au"}

Cell = dict[tuple[int, int], tuple[int, str]]
FAULTS = "n_rows long, gaps long, blank long, duplicate long, truncated long"


def combined(left: Cell, right: Cell) -> Cell:
    """The cell of two neighbouring spans, by all rules [p r] -> [p q] [q r]."""
    out: Cell = {}
    for (p, q), (cost, audit) in left.items():
        for r in PLACES:
            other = right.get((q, r))
            if other is not None:
                value = (cost + other[0], audit + other[1])
                if (p, r) not in out or value < out[p, r]:
                    out[p, r] = value
    return out


def _closure() -> Cell:
    """Empty spans, with the insertions that lead from place to place."""
    return {(p, p): (0, "") for p in PLACES} | {at: (n * INSERT, "I" * n) for at, n in INSERTED.items()}


def _leaf(kind: str) -> Cell:
    """The cell of one row of a class, closed under insertions."""
    cell: Cell = {(p, p): (DELETE, "D") for p in PLACES}
    if kind not in MUST_GO:
        extra = TRUNCATED if kind.isupper() else 0
        for role in "ua":
            cell |= {(p, q): (REROLE + extra, "R") for p, q in STEP[role].items()}
        cell |= {(p, q): (extra, "K") for p, q in STEP.get(kind.lower(), {}).items()}
    return combined(combined(_closure(), cell), _closure())


LEAVES = {kind: _leaf(kind) for kind in INITIALS + INITIALS.upper() + MUST_GO}


def joined(cells: list[Cell]) -> Cell:
    """The cell over all spans, bottom-up by span length."""
    while len(cells) > 1:
        pairs = [combined(cells[i], cells[i + 1]) for i in range(0, len(cells) - 1, 2)]
        cells = pairs + cells[2 * len(pairs) :]
    return cells[0]


def parse(pattern: str) -> Cell:
    return joined([LEAVES[kind] for kind in pattern])


def best(cell: Cell) -> tuple[int, str]:
    """The cheapest whole repair: nothing at all, or a pattern that ends with an assistant turn."""
    return min(cell[at] for at in ((0, 0), (0, 3)) if at in cell)


def initial_of(kind: str) -> str:
    return INITIALS[MUST_GO.index(kind)] if kind in MUST_GO else kind.lower()


def illegal_pairs(pattern: str) -> int:
    initials = [initial_of(k) for k in pattern]
    return sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))


CELLS = "conv string, block long, at array<int>, cost array<long>, audit array<string>, first string, last string, illegal long"


def _packed(conv: str, block: int, cell: Cell, first: str, last: str, illegal: int) -> tuple:
    return (conv, block, [4 * p + q for p, q in cell], [c for c, _ in cell.values()], [a for _, a in cell.values()], first, last, illegal)


def _cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Blocks of row classes to cells."""
    names = [c.split()[0] for c in CELLS.split(", ")]
    known: dict[str, tuple[Cell, int]] = {}
    for batch in batches:
        for low in range(0, len(batch), 256):
            rows = []
            part = batch.iloc[low : low + 256]
            for conv, block, pattern in zip(part["conv"], part["block"], part["pattern"], strict=True):
                result = known.get(pattern)
                if result is None:
                    result = parse(pattern), illegal_pairs(pattern)
                    if len(pattern) <= PATTERN_CHARS:
                        if len(known) >= MOST_PATTERNS:
                            known.clear()
                        known[pattern] = result
                rows.append(_packed(conv, block, result[0], initial_of(pattern[0]), initial_of(pattern[-1]), result[1]))
            yield pd.DataFrame(rows, columns=names)


def _merged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Up to ``FAN`` neighbouring cells of a conversation to one."""
    names = [c.split()[0] for c in CELLS.split(", ")]
    for batch in batches:
        for row in batch.itertuples():
            parts = row.parts
            cells = [{divmod(int(at), 4): (int(c), a) for at, c, a in zip(p["at"], p["cost"], p["audit"])} for p in parts]
            illegal = sum(int(p["illegal"]) for p in parts)
            illegal += sum(a["last"] + b["first"] not in LEGAL for a, b in zip(parts, parts[1:]))
            merged = _packed(row.conv, row.block, joined(cells), parts[0]["first"], parts[-1]["last"], illegal)
            yield pd.DataFrame([merged], columns=names)


def _parsed(cells: DataFrame) -> DataFrame:
    """One cell per conversation: the cells of a conversation combined in rounds until one is left."""
    cells = stored(cells, "cells")
    several = cells.groupBy("conv").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("conv")
    done = cells.join(several, "conv", "left_anti")
    rest = cells.join(several, "conv", "left_semi")
    while True:
        grouped = rest.groupBy("conv", F.expr(f"block div {FAN}").alias("block"))
        ordered = grouped.agg(F.array_sort(F.collect_list(F.struct("block", "at", "cost", "audit", "first", "last", "illegal"))).alias("parts"))
        # Every list has at most FAN cells.
        rest = stored(ordered.mapInPandas(_merged, CELLS), "merged")
        most = rest.groupBy("conv").agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n").alias("n")).first()["n"]
        if most is None or most == 1:
            return done.unionByName(rest)


def _best(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for conv, ats, costs, audits, illegal in zip(batch["conv"], batch["at"], batch["cost"], batch["audit"], batch["illegal"], strict=True):
            rows.append((conv, *best({divmod(int(at), 4): (int(c), a) for at, c, a in zip(ats, costs, audits)}), illegal))
        yield pd.DataFrame(rows, columns=["conv", "cost", "audit", "illegal"])


def _edits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(conv, pos, nth, edit, role) of every edit but Keep; an inserted turn has the place of the row behind it."""
    names, rows = ["conv", "pos", "nth", "edit", "role"], []
    for batch in batches:
        for conv, start, audit in zip(batch["conv"], batch["start"], batch["audit"], strict=True):
            # An odd number of turns begins with the system turn.
            turn, pos, nth = (len(audit) - audit.count("D")) % 2 - 1, int(start), 0
            for edit in audit:
                turn += edit != "D"
                role = "assistant" if turn % 2 else "user"
                if edit == "I":
                    rows.append((conv, pos, nth, edit, role))
                    nth += 1
                else:
                    if edit != "K":
                        rows.append((conv, pos, nth, edit, role))
                    pos, nth = pos + 1, 0
                if len(rows) >= 10_000:
                    yield pd.DataFrame(rows, columns=names)
                    rows = []
    yield pd.DataFrame(rows, columns=names)


def conv_key(conv_id: Column) -> Column:
    """A conversation's name, for nulls too."""
    return F.coalesce(conv_id.cast("string"), F.lit("null"))


def _filled(turns: DataFrame) -> DataFrame:
    """conv, turn, role, text alone, with a space for nulls."""
    space = F.lit(" ")
    return turns.select(
        conv_key(F.col("conv_id")).alias("conv"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), space).alias("role"),
        F.coalesce(F.col("text").cast("string"), space).alias("text"),
    )


def repair(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conversations, rows) of a table conv_id, turn, role, text.

    conversations: conv, ``FAULTS``, illegal, cost, audit. rows: conv, pos, nth,
    turn, edit (K, R or I), role, text of the repaired conversations; pos and nth give their order.
    """
    filled = _filled(turns)
    ending = F.substring(F.rtrim("text", F.lit(" \t\n\x0b\f\r")), -1, 1)
    initial = F.substring("role", 1, 1)
    place = F.coalesce(*[F.when(initial == c, i) for i, c in enumerate(INITIALS[:3], 1)], F.lit(len(INITIALS)))
    judged = filled.select(
        "*",
        (ending == "").alias("blank"),
        ((ending != "") & ~ending.isin(".", "!", "?")).alias("cut"),
        place.alias("initial"),
        F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256).alias("same"),
        # Told apart by row, equal rows can be dealt to several ranges.
        F.monotonically_increasing_id().alias("_row"),
    )
    rows = numbered(judged, F.asc("conv"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("text"), F.asc("_row"), label="turns")

    # First rows of equal ones meet all rows by place, never by the repeated text.
    block = F.expr(f"pos div {BLOCK}").alias("block")
    slim = rows.select("conv", block, "pos", "turn", "blank", "cut", "initial", F.lit(False).alias("first"))
    firsts = rows.groupBy("conv", "same").agg(F.min("pos").alias("pos"))
    nothing = [F.lit(None).cast(t).alias(c) for c, t in (("turn", "bigint"), ("blank", "boolean"), ("cut", "boolean"), ("initial", "int"))]
    firsts = firsts.select("conv", block, "pos", *nothing, F.lit(True).alias("first"))
    marked = slim.unionByName(firsts).repartition("conv", "block").groupBy("conv", "block", "pos")
    marked = marked.agg(*[F.max(c).alias(c) for c in ("turn", "blank", "cut", "initial", "first")])
    again = ~F.col("blank") & ~F.col("first")
    cut = F.col("cut") & ~again
    letter = F.when(F.col("blank") | again, F.lit(MUST_GO)).when(cut, F.lit(INITIALS.upper())).otherwise(F.lit(INITIALS))
    classed = marked.select("conv", "block", "pos", "turn", "blank", again.alias("again"), cut.alias("cut"), F.substring(letter, F.col("initial"), F.lit(1)).alias("kind"))
    inside = classed.groupBy("conv", "block").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "kind"))), lambda r: r["kind"]), "").alias("pattern"),
        F.min("pos").alias("start"),
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(c).alias(c) for c in ("blank", "again", "cut")],
        F.min("turn").alias("low"),
        F.max("turn").alias("high"),
        # Rows are in turn order, so a block holds each of its turns without gaps between.
        F.size(F.collect_set("turn")).alias("turns"),
    )
    inside = stored(inside, "patterns")
    cells = _parsed(inside.select("conv", "block", "pattern").mapInPandas(_cells, CELLS))
    results = cells.select("conv", "at", "cost", "audit", "illegal").mapInPandas(_best, "conv string, cost long, audit string, illegal long")

    # A turn that goes on in the next block is counted in both; blocks of a conversation meet by number.
    ends = inside.where("low is not null").select("conv", (F.col("block") + 1).alias("block"), F.col("high").alias("low"))
    shared = inside.join(ends, ["conv", "block", "low"], "left_semi").select("conv", "block", F.lit(1).alias("shared"))
    sums = inside.join(shared, ["conv", "block"], "left").groupBy("conv").agg(
        F.min("start").alias("start"),
        F.sum("n").alias("n_rows"),
        (F.max("high") - F.min("low") + 1 - (F.sum("turns") - F.sum(F.coalesce("shared", F.lit(0))))).alias("gaps"),
        F.sum("blank").alias("blank"),
        F.sum("again").alias("duplicate"),
        F.sum("cut").alias("truncated"),
    )
    found = stored(sums.join(results, "conv"), "repairs")
    found = found.withColumn("gaps", F.coalesce("gaps", F.lit(0)).cast("bigint"))

    edits = found.select("conv", "start", "audit").mapInPandas(_edits, "conv string, pos long, nth int, edit string, role string")
    edits = stored(edits, "edits")
    inserted = edits.where("edit = 'I'").select("conv", "pos", "nth", F.lit(None).cast("bigint").alias("turn"), "edit", "role", F.lit("").alias("text"))
    changed = edits.where("edit <> 'I'").select("pos", "edit", F.col("role").alias("new_role"))
    kept = rows.join(changed, "pos", "left").where("edit is null or edit <> 'D'")
    kept = kept.select(
        "conv", "pos", F.lit(2**31 - 1).alias("nth"), "turn", F.coalesce("edit", F.lit("K")).alias("edit"), F.coalesce("new_role", "role").alias("role"), "text"
    )
    return found.drop("start"), kept.unionByName(inserted)


def _hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """sha256 of each conversation's lines, which come in order; holds no conversation."""
    here, digest = None, None
    for batch in batches:
        done = []
        for conv, role, text in zip(batch["conv"], batch["role"], batch["text"], strict=True):
            line = f"{role}:{text}".encode("utf-8", "surrogatepass")
            if conv != here:
                if digest is not None:
                    done.append((here, digest.hexdigest()))
                here, digest = conv, hashlib.sha256(line)
            else:
                digest.update(b"\n")
                digest.update(line)
        yield pd.DataFrame(done, columns=["conv", "repaired_sha256"])
    if digest is not None:
        yield pd.DataFrame([(here, digest.hexdigest())], columns=["conv", "repaired_sha256"])


def conversation_hashes(rows: DataFrame) -> DataFrame:
    """(conv, repaired_sha256). A conversation's hash is one chain, so its rows stream through one task, sorted, not collected."""
    laid = rows.select("conv", "pos", "nth", "role", "text").repartition("conv").sortWithinPartitions("conv", "pos", "nth")
    return laid.select("conv", "role", "text").mapInPandas(_hashed, "conv string, repaired_sha256 string")


def damaged(turns: DataFrame) -> DataFrame:
    """The table with damages drawn by crc32 of ``conv_id:turn``: of twenty rows one dropped, emptied, unpunctuated, repeated, given to the user."""
    space = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    draw = F.crc32(name.cast("binary")) % 20
    text = F.coalesce(F.col("text").cast("string"), space)
    rows = turns.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), space).alias("role"), text.alias("text"), draw.alias("_draw"))
    rows = rows.where("_draw <> 0").select(
        "conv_id",
        "turn",
        F.when(F.col("_draw") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("_draw") == 1, "").when(F.col("_draw") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("_draw") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("_copy"),
    )
    return rows.drop("_copy")


def repaired_digests(turns: DataFrame) -> DataFrame:
    """Faults, cost, audit and hash of every conversation of the table, repaired after the damage above."""
    found, rows = repair(damaged(turns))
    found = found.join(conversation_hashes(rows), "conv", "left")
    everyone = turns.select("conv_id", conv_key(F.col("conv_id")).alias("conv")).distinct()
    out = everyone.join(found, "conv", "left")
    zero = F.lit(0).cast("bigint")
    counts = [F.coalesce(c, zero).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return out.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"))
