"""Quality rules and an isolation forest over their statistics.

Every text is reduced to rule statistics in one pass. A forest of random
splits, grown around the clean rows of a bounded labelled sample, gives each
row the mean length of its path: rows that few splits cut off are anomalous.
The score above which a row is rejected is taken from all labelled rows.

Cases: a null text counts as empty; an empty or short text fails the base
rules; repeated rows get equal results each; without labels of both kinds no
row is rejected by the forest; other columns are ignored. Long texts are read
whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from prefkit.llm.common import learnable, map_slices, stored, texts_of

# Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
WINDOW = 3
SPACES = " \t\n\v\f\r"

TREES, PER_TREE, DEPTH, SAMPLE_ROWS, SEED = 128, 256, 10, 8192, 11
MAX_GOOD_LOST = 0.005
BINS = 4096

STATISTICS = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, upper_chars long, mark_chars long, digit_chars long, n_distinct long"


def repeated_words(words: list[bytes]) -> tuple[int, int]:
    """(words inside a three-word window that occurs twice or more, distinct words)."""
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    if len(ids) < WINDOW + 1:
        return 0, len(seen)
    _, pairs = np.unique(ids[:-2] * len(seen) + ids[1:-1], return_inverse=True)
    _, window, counts = np.unique(pairs * len(seen) + ids[2:], return_inverse=True, return_counts=True)
    twice = counts[window] > 1
    covered = np.zeros(len(ids), bool)
    for shift in range(WINDOW):
        covered[shift : shift + len(twice)] |= twice
    return int(covered.sum()), len(seen)


def text_statistics(text: str) -> tuple[int, ...]:
    words = text.encode("utf-8", "surrogatepass").split()
    repeats, distinct = repeated_words(words)
    lines, dup_lines = set(), 0
    for line in text.split("\n"):
        if line.strip(SPACES):
            dup_lines += line in lines
            lines.add(line)
    upper = sum(map(str.isupper, text)) if not text.islower() else 0
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        dup_lines,
        repeats,
        upper,
        sum(map(text.count, "!?;:()[]{}=/\\_~^@+-\"'")),
        sum(map(text.count, "0123456789")),
        distinct,
    )


def _measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [part.split()[0] for part in STATISTICS.split(", ")]
    for batch in batches:
        rows = pd.DataFrame([text_statistics(t) for t in batch["text"]], columns=names[1:], dtype="int64")
        rows.insert(0, names[0], batch["doc_id"].astype("Int64").array)
        yield rows


def rule_statistics(docs: DataFrame) -> DataFrame:
    """One row of counts per document, ``STATISTICS``."""
    return map_slices(texts_of(docs), _measure, STATISTICS)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def _features(rows: pd.DataFrame) -> np.ndarray:
    """Shares that do not depend on the length of a text, spread by square roots so that small shares count."""
    words = np.maximum(rows["n_words"].to_numpy("float64"), 1)
    chars = np.maximum(rows["word_chars"].to_numpy("float64"), 1)
    share = lambda name, of: np.sqrt(rows[name].to_numpy("float64") / of)
    return np.column_stack(
        [
            np.log(chars / words),
            share("n_symbols", chars),
            share("n_dup_lines", words),
            share("n_repeat_words", words),
            share("upper_chars", chars),
            share("mark_chars", chars),
            share("digit_chars", chars),
            np.log(rows["n_distinct"].to_numpy("float64") + 1) / np.log(words + 2),
        ]
    )


def _mean_path(n: float) -> float:
    """Mean depth of an unsuccessful search among ``n`` rows."""
    return 0.0 if n <= 1 else 1.0 if n <= 2 else 2 * (np.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n


@dataclass(frozen=True)
class Forest:
    """Trees as arrays: node ``i`` splits ``feature[i]`` at ``cut[i]``, its children are ``left[i]`` and ``left[i] + 1``."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    path: np.ndarray
    roots: np.ndarray
    scale: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """From 0 to 1, higher for rows that are cut off sooner."""
        total = np.zeros(len(x))
        every = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            while (inner := self.feature[node] >= 0).any():
                at = node[inner]
                node[inner] = self.left[at] + (x[every[inner], self.feature[at]] >= self.cut[at])
            total += self.path[node]
        return 2.0 ** (-total / len(self.roots) / self.scale) if len(self.roots) else total


def grow_forest(
    clean: np.ndarray, every: np.ndarray, trees: int = TREES, per_tree: int = PER_TREE, depth: int = DEPTH, seed: int = SEED
) -> Forest:
    """Random splits around random samples of ``clean`` rows, at most ``per_tree`` in a tree.

    Split values are drawn over the range of ``every`` row, so that a region
    without clean rows is cut off near the root even where all clean rows
    have one value.
    """
    random = np.random.default_rng(seed)
    size = min(per_tree, len(clean))
    feature, cut, left, path, roots = [], [], [], [], []

    def node() -> int:
        feature.append(-1), cut.append(0.0), left.append(0), path.append(0.0)
        return len(feature) - 1

    for _ in range(trees if size else 0):
        roots.append(node())
        sample = clean[random.choice(len(clean), size, replace=False)]
        open_nodes = [(roots[-1], sample, every.min(axis=0), every.max(axis=0), 0)]
        while open_nodes:
            here, rows, low, high, level = open_nodes.pop()
            usable = np.flatnonzero(high > low)
            if level == depth or len(rows) <= 1 or not len(usable):
                path[here] = level + _mean_path(len(rows))
                continue
            f = int(random.choice(usable))
            c = random.uniform(low[f], high[f])
            feature[here], cut[here] = f, c
            left[here] = node()
            above, upper, lower = rows[:, f] >= c, high.copy(), low.copy()
            upper[f] = lower[f] = c
            open_nodes += [(left[here], rows[~above], low, upper, level + 1), (node(), rows[above], lower, high, level + 1)]
    scale = max(_mean_path(size), 1e-9)
    return Forest(np.array(feature, np.int64), np.array(cut), np.array(left, np.int64), np.array(path), np.array(roots, np.int64), scale)


def score_column(forest: Forest) -> Column:
    @F.pandas_udf("double")
    def anomaly(rows: pd.DataFrame) -> pd.Series:
        return pd.Series(forest.score(_features(rows)))

    return anomaly(F.struct(*[part.split()[0] for part in STATISTICS.split(", ")[1:]]))


def fit_forest(statistics: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Forest:
    """A forest from at most ``sample_rows`` labelled rows, those with the smallest hashes."""
    chosen = labels.orderBy(F.xxhash64(F.lit(SEED), "doc_id"), "doc_id").limit(sample_rows)
    # At most ``sample_rows`` keys are broadcast and as many rows of counts return.
    rows = statistics.where(~base_failed()).join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])
    rows = rows.orderBy("doc_id").limit(sample_rows).toPandas()
    features, clean = _features(rows), rows["quality"].to_numpy(int) == 1
    return grow_forest(features[clean] if clean.any() else features, features)


def fit_threshold(scored: DataFrame, labels: DataFrame, max_good_lost: float = MAX_GOOD_LOST) -> float:
    """The score above which rows are rejected.

    Of the cuts that reject at most ``max_good_lost`` of the good labelled
    rows, the one that rejects most bad ones; of equal cuts the highest.
    Reads a histogram of ``BINS`` bins over every labelled row.
    """
    counts = (
        scored.where(~F.col("base_failed"))
        .join(labels, "doc_id")
        .groupBy(F.floor(F.col("anomaly") * BINS).cast("int").alias("bin"))
        .agg(F.sum("quality").alias("good"), F.sum(1 - F.col("quality")).alias("bad"))
        .toPandas()
    )
    good, bad = np.zeros(BINS + 2), np.zeros(BINS + 2)
    np.add.at(good, counts["bin"].to_numpy(int) + 1, counts["good"].to_numpy(float))
    np.add.at(bad, counts["bin"].to_numpy(int) + 1, counts["bad"].to_numpy(float))
    if not good.sum() or not bad.sum():
        return 2.0
    # Rejecting from bin b on.
    lost, caught = good[::-1].cumsum()[::-1], bad[::-1].cumsum()[::-1]
    allowed = lost <= max_good_lost * good.sum()
    best = max(b for b in range(len(lost)) if allowed[b] and caught[b] == caught[allowed].max())
    # In the middle of the empty bins below the cut, if there are any.
    below = best
    while below > 1 and good[below - 1] + bad[below - 1] == 0:
        below -= 1
    return ((below + best) / 2 - 1) / BINS


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the rule statistics, base_failed, kept, anomaly, threshold."""
    statistics = stored(rule_statistics(docs), "rules")
    known = learnable(labels)
    forest = fit_forest(statistics, known)
    scored = statistics.withColumn("base_failed", base_failed()).withColumn("anomaly", score_column(forest))
    limit = fit_threshold(scored, known)
    return scored.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & (F.col("anomaly") < limit)).alias("kept"),
        "anomaly",
        F.lit(limit).alias("threshold"),
    )
