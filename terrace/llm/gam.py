"""Quality classifier: an additive model of lookup tables with pairwise tables.

Every feature is cut into bins. Boosting visits the features in turn; each visit fits
a tree of a few leaves to that feature's gradient histogram and adds it to the
feature's table. Then the pairs that explain most of what is left get tables of their
own, fitted by trees with one cut on either axis. A score is a sum of table entries.

Fixed cases: a null or empty text has the features of no words and is scored like any
other; rows are scored one by one, so repeated ids and texts need nothing special;
without labels of both classes the score is the share of good labels, or 0.5 for none.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import bounded, only
from terrace.llm.textstats import COUNTS, features, log_odds, logistic, stats


@dataclass(frozen=True)
class Settings:
    """``fit_rows`` bounds the labelled rows used for training."""

    fit_rows: int = 20_000
    bins: int = 48
    pair_bins: int = 12
    rounds: int = 150
    pair_rounds: int = 60
    pairs: int = 8
    leaves: int = 3
    rate: float = 0.1
    ridge: float = 5.0


@dataclass
class Additive:
    start: float
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        for f, (edges, table) in enumerate(zip(self.edges, self.tables, strict=True)):
            total += table[np.searchsorted(edges, x[:, f], side="right")]
        if self.pairs:
            coarse = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(self.pair_edges)]
            for (a, b), table in zip(self.pairs, self.pair_tables, strict=True):
                total += table[coarse[a], coarse[b]]
        return total


def _edges(column: np.ndarray, bins: int) -> np.ndarray:
    """Cuts between bins of about equal counts, each value whole in one bin."""
    return np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1], method="higher"))


def _gain(g: np.ndarray, h: np.ndarray, ridge: float) -> np.ndarray:
    return g * g / (h + ridge)


def _tree(g: np.ndarray, h: np.ndarray, leaves: int, ridge: float) -> np.ndarray:
    """Newton steps of a best-first tree over the ordered bins of one feature."""
    parts = [(0, len(g))]
    cg, ch = np.concatenate([[0], np.cumsum(g)]), np.concatenate([[0], np.cumsum(h)])
    while len(parts) < leaves:
        best, choice = 1e-9, None
        for i, (lo, hi) in enumerate(parts):
            if hi - lo < 2:
                continue
            cuts = np.arange(lo + 1, hi)
            whole = _gain(cg[hi] - cg[lo], ch[hi] - ch[lo], ridge)
            gains = (
                _gain(cg[cuts] - cg[lo], ch[cuts] - ch[lo], ridge)
                + _gain(cg[hi] - cg[cuts], ch[hi] - ch[cuts], ridge) - whole
            )
            k = int(np.argmax(gains))
            if gains[k] > best:
                best, choice = gains[k], (i, int(cuts[k]))
        if choice is None:
            break
        i, cut = choice
        lo, hi = parts[i]
        parts[i : i + 1] = [(lo, cut), (cut, hi)]
    step = np.zeros(len(g))
    for lo, hi in parts:
        step[lo:hi] = -(cg[hi] - cg[lo]) / (ch[hi] - ch[lo] + ridge)
    return step


def _quadrants(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[float, np.ndarray]:
    """Best one-cut-per-axis tree over a pair's grid: (gain, Newton steps)."""
    cg, ch = np.cumsum(np.cumsum(g, 0), 1), np.cumsum(np.cumsum(h, 0), 1)
    if min(g.shape) < 2:
        return 0.0, np.zeros(g.shape)

    def corners(c: np.ndarray) -> list[np.ndarray]:
        low = c[:-1, :-1]
        top, side, all_ = c[:-1, -1:], c[-1:, :-1], c[-1, -1]
        return [low, top - low, side - low, all_ - top - side + low]

    cells = list(zip(corners(cg), corners(ch), strict=True))
    gains = sum(_gain(a, b, ridge) for a, b in cells) - _gain(cg[-1, -1], ch[-1, -1], ridge)
    i, j = np.unravel_index(int(np.argmax(gains)), gains.shape)
    leaf = [-a[i, j] / (b[i, j] + ridge) for a, b in cells]
    step = np.empty(g.shape)
    step[: i + 1, : j + 1], step[: i + 1, j + 1 :] = leaf[0], leaf[1]
    step[i + 1 :, : j + 1], step[i + 1 :, j + 1 :] = leaf[2], leaf[3]
    return float(gains[i, j]), step


def train(x: np.ndarray, y: np.ndarray, settings: Settings = Settings()) -> Additive:
    if len(y) == 0 or y.min() == y.max():
        return Additive(log_odds((y.sum() + 0.5) / (len(y) + 1.0)))
    model = Additive(log_odds(float(y.mean())))
    model.edges = [_edges(x[:, f], settings.bins) for f in range(x.shape[1])]
    binned = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(model.edges)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    z = np.full(len(y), model.start)
    for _ in range(settings.rounds):
        for at, table in zip(binned, model.tables, strict=True):
            p = logistic(z)
            g, h = np.bincount(at, p - y, len(table)), np.bincount(at, p * (1 - p), len(table))
            step = settings.rate * _tree(g, h, settings.leaves, settings.ridge)
            table += step
            z += step[at]

    model.pair_edges = [_edges(x[:, f], settings.pair_bins) for f in range(x.shape[1])]
    coarse = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(model.pair_edges)]
    sizes = [len(e) + 1 for e in model.pair_edges]

    def grid(a: int, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at, p, shape = coarse[a] * sizes[b] + coarse[b], logistic(z), (sizes[a], sizes[b])
        n = sizes[a] * sizes[b]
        return at, np.bincount(at, p - y, n).reshape(shape), np.bincount(at, p * (1 - p), n).reshape(shape)

    ranked = sorted(
        ((_quadrants(*grid(a, b)[1:], settings.ridge)[0], a, b) for a, b in combinations(range(len(sizes)), 2)),
        key=lambda found: (-found[0], found[1:]),
    )
    model.pairs = [(a, b) for gain, a, b in ranked[: settings.pairs] if gain > 0]
    model.pair_tables = [np.zeros((sizes[a], sizes[b])) for a, b in model.pairs]
    for _ in range(settings.pair_rounds):
        for (a, b), table in zip(model.pairs, model.pair_tables, strict=True):
            at, g, h = grid(a, b)
            step = settings.rate * _quadrants(g, h, settings.ridge)[1]
            table += step
            z += step.ravel()[at]
    return model


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    settings: Settings = Settings(),
) -> Additive:
    """Train on the documents of at most ``fit_rows`` labels, picked by a hash of the id.

    ``labels`` has (doc_id, quality); rows with another label than 0 or 1 teach nothing.
    Of several documents with one id, one is used.
    """
    marked = only(labels, id="doc_id", quality="quality").filter("id IS NOT NULL AND quality IN (0, 1)")
    chosen = bounded(marked, settings.fit_rows, [F.col("id")], ["id", "quality"])
    # Small by its bound, so the texts stay where they are.
    rows = only(docs, id=id_col, text=text_col).join(F.broadcast(chosen), "id")
    seen = (
        rows.select("id", "quality", stats("text").alias("stat"))
        .groupBy("id", "quality").agg(F.min("stat").alias("stat"))
        .orderBy("id", "quality").select("quality", "stat.*").toPandas()
    )
    return train(features(seen[list(COUNTS)]), seen["quality"].to_numpy(np.float64), settings)


def score(model: Additive, text: Column) -> Column:
    """Share of good expected for the text, 0 to 1."""

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(logistic(model.log_odds(features(batch))))

    return scored(stats(text))
