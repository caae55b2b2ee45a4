"""Quality rules: an isolation forest over rule statistics.

Random splits isolate unusual rows after few cuts. The forest is grown on a bounded
sample of documents labelled good, so what it isolates quickly is unlike good text.
Cuts are drawn from the whole box of values (see ``grow``). Where "quickly" begins is read off the scores of all labelled rows.

Fixed cases: a null or empty text has zero words and fails the base rules; repeated
rows and ids are judged one by one; labels that are null or contradict each other on
one id count once per row; without usable labels only the base rules reject.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import bounded, fresh, only, quoted
from terrace.llm.textstats import COUNTS, FEATURES, features, stats
from terrace.sources.tables import materialise

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

_BINS = 2000
_NO_LIMIT = 2.0  # scores stay at or below 1


# The features that rules of thumb look at. Cuts on others, such as length, tell nothing about junk.
_RULED = [FEATURES.index(name) for name in (
    "mean_word", "symbols", "dup_lines", "repeats", "upper", "adjacent", "exclaims", "pipes", "marks",
)]


@dataclass(frozen=True)
class Settings:
    """``fit_rows`` bounds the labelled rows the forest is grown on.

    ``good_cost`` says how many shares of bad texts one share of good texts is worth.
    """

    trees: int = 200
    tree_rows: int = 256
    depth: int = 10
    fit_rows: int = 20_000
    max_good_lost: float = 0.002
    good_cost: float = 20.0
    seed: int = 11


@dataclass(frozen=True)
class Forest:
    """Trees as arrays [tree, node]; a node whose children are itself is a leaf."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    length: np.ndarray
    depth: int
    normal: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """2 ** -(mean path length / expected length): near 1 for rows isolated at once."""
        total, rows = np.zeros(len(x)), np.arange(len(x))
        for feature, cut, left, right, length in zip(
            self.feature, self.cut, self.left, self.right, self.length, strict=True
        ):
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                at = np.where(x[rows, feature[at]] < cut[at], left[at], right[at])
            total += length[at]
        return 2.0 ** -(total / max(1, len(self.feature)) / self.normal)


def _expected(rows: int) -> float:
    """Mean path length of an unsuccessful search among ``rows`` keys of a binary tree."""
    if rows < 2:
        return 0.0
    return 2.0 * (np.log(rows - 1.0) + np.euler_gamma) - 2.0 * (rows - 1.0) / rows


def grow(x: np.ndarray, good: np.ndarray, settings: Settings) -> Forest | None:
    """Grow on the good rows of ``x``; None where there are fewer than two.

    Cuts are drawn from the box that all rows of ``x`` span, not from the range of the
    rows at a node. Good rows crowd a small part of that box and stay together cut after
    cut; a row in the empty part is alone as soon as one cut falls in between.
    """
    inside = x[good]
    if len(inside) < 2:
        return None
    rng = np.random.default_rng(settings.seed)
    size = min(settings.tree_rows, len(inside))
    nodes = 2 ** (settings.depth + 1) - 1
    shape = (settings.trees, nodes)
    feature, cut, length = np.zeros(shape, np.int64), np.zeros(shape), np.zeros(shape)
    left, right = np.tile(np.arange(nodes), (settings.trees, 1)), np.tile(np.arange(nodes), (settings.trees, 1))
    for tree in range(settings.trees):
        todo = [(0, 0, inside[rng.choice(len(inside), size, replace=False)], x.min(axis=0), x.max(axis=0))]
        while todo:
            node, level, rows, low, high = todo.pop()
            if level == settings.depth or len(rows) < 2:
                length[tree, node] = level + _expected(len(rows))
                continue
            f = int(rng.integers(x.shape[1]))
            c = rng.uniform(low[f], high[f])
            below, low_right, high_left = rows[:, f] < c, low.copy(), high.copy()
            low_right[f] = high_left[f] = c
            feature[tree, node], cut[tree, node] = f, c
            left[tree, node], right[tree, node] = 2 * node + 1, 2 * node + 2
            todo += [
                (2 * node + 1, level + 1, rows[below], low, high_left),
                (2 * node + 2, level + 1, rows[~below], low_right, high),
            ]
    return Forest(feature, cut, left, right, length, settings.depth, max(_expected(size), 1e-9))


def base_failed(stat: Column) -> Column:
    n_words, n_repeat = stat["n_words"], stat["n_repeat_words"]
    return (n_words < MIN_WORDS) | (n_repeat * 100 > n_words * MAX_REPEAT_PERCENT)


@dataclass(frozen=True)
class Rules:
    """A grown forest and the score above which a text is rejected."""

    forest: Forest | None
    limit: float

    def anomaly(self, stat: Column) -> Column:
        """Score of a statistics struct; 0 where no forest could be grown."""
        if self.forest is None:
            return F.lit(0.0)
        forest = self.forest

        @F.pandas_udf("double")
        def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
            for batch in batches:
                yield pd.Series(forest.scores(features(batch)[:, _RULED]))

        return score(stat)

    def kept(self, stat: Column) -> Column:
        return ~base_failed(stat) & (self.anomaly(stat) < self.limit)


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, stat) of every row, stored: labels, thresholds and verdicts read it again."""
    rows = only(docs, id=id_col, text=text_col)
    return materialise(rows.select("id", stats("text").alias("stat")), "rule-stats")


def fit(measured: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Rules:
    """Grow on good rows, then set the limit on all labelled rows that pass the base rules.

    The limit is the score that rejects most rows labelled bad, each share of rows labelled
    good counting ``good_cost`` times, with at most ``max_good_lost`` of the good rejected.
    Only a histogram of scores and the bounded sample reach the driver.
    """
    marked = only(labels, id="doc_id", quality="quality").filter("quality IN (0, 1)").distinct()
    known = measured.join(marked, "id").filter(~base_failed(F.col("stat")))
    sample = bounded(known.select("id", "quality", "stat.*"), settings.fit_rows, [F.col("id")], ["id", "quality", *COUNTS]).toPandas()
    forest = grow(features(sample)[:, _RULED], sample["quality"].to_numpy() == 1, settings)
    if forest is None:
        return Rules(None, _NO_LIMIT)
    score = Rules(forest, _NO_LIMIT).anomaly(F.col("stat"))
    # At most 2 x 2,001 rows.
    found = (
        known.select("quality", F.floor(score * _BINS).alias("bin"))
        .groupBy("quality", "bin").agg(F.count(F.lit(1)).alias("n")).toPandas()
    )
    held = {q: np.bincount(p["bin"], p["n"], _BINS + 1) for q, p in found.groupby("quality")}
    if 0 not in held or 1 not in held:
        return Rules(forest, _NO_LIMIT)
    # Share of rows in this bin and all higher ones.
    bad, good = (np.cumsum(held[q][::-1])[::-1] / held[q].sum() for q in (0, 1))
    worth = np.where(good <= settings.max_good_lost, bad - settings.good_cost * good, -np.inf)
    best = np.flatnonzero(worth == worth.max())
    # Several bins are equally good where no row lies: stay off the good ones.
    return Rules(forest, float(best[len(best) // 2]) / _BINS if worth.max() > 0 else _NO_LIMIT)


def judge(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    settings: Settings = Settings(),
) -> DataFrame:
    """One row per document: id, its statistics, base_failed, anomaly, kept."""
    measured = measure(docs, id_col, text_col)
    rules = fit(measured, labels, settings)
    stat = F.col("stat")
    return measured.withColumn("anomaly", rules.anomaly(stat)).select(
        F.col("id").alias(id_col), "stat.*", base_failed(stat).alias("base_failed"), "anomaly",
        (~base_failed(stat) & (F.col("anomaly") < rules.limit)).alias("kept"),
    )


def keep_good(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    settings: Settings = Settings(),
) -> DataFrame:
    """The documents that pass, with all their columns. Null ids are judged like any other."""
    # The statistics are stored with the rows: fitting and judging read them, no text is measured twice.
    stat = fresh(docs, "stat")
    rows = materialise(docs.withColumn(stat, stats(quoted(text_col))), "measured")
    rules = fit(rows.select(quoted(id_col).alias("id"), F.col(stat).alias("stat")), labels, settings)
    return rows.filter(rules.kept(F.col(stat))).drop(stat)
