"""Statistics of one text: exact counts for rules, ratios for models."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.llm.common import BLANKS

SYMBOLS = "#*$%&|<>"
REPEAT_WINDOW = 5

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_distinct", "n_upper_words", "n_adjacent", "n_exclaim", "n_pipes",
    "n_digits", "n_marks", "n_long_words", "n_stops",
)
STATS_TYPE = T.StructType([T.StructField(name, T.LongType()) for name in COUNTS])

_MARKS = b".,;:?"
_DIGITS = b"0123456789"
_LONG_WORD = 15


def window_classes(ids: np.ndarray, width: int) -> np.ndarray:
    """Class numbers of all ``width``-word windows: equal exactly if the windows are."""
    n = len(ids) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    distinct = int(ids.max()) + 1
    bits = max(1, distinct.bit_length())
    if bits * width <= 63:
        code = np.zeros(n, np.int64)
        for k in range(width):
            code = (code << bits) | ids[k : k + n]
        return code
    # Too many words to pack: extend windows one word at a time, renumbering each time.
    classes = ids[:n].astype(np.int64)
    for k in range(1, width):
        _, classes = np.unique(classes * distinct + ids[k : k + n], return_inverse=True)
    return classes


def repeated_words(ids: np.ndarray, width: int = REPEAT_WINDOW) -> int:
    """Words inside windows of ``width`` words that occur twice or more, the first included."""
    codes = window_classes(ids, width)
    if len(codes) < 2:
        return 0
    order = np.argsort(codes, kind="stable")
    same = codes[order][1:] == codes[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(codes), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edges = np.zeros(len(ids) + 1, np.int64)
    starts = np.flatnonzero(twice)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + width, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


def counts(text: str | None) -> tuple[int, ...]:
    """The values of ``COUNTS``; all 0 for a null or empty text."""
    if not text:
        return (0,) * len(COUNTS)
    raw = text.encode()
    words = raw.split()
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    lines = [line for line in raw.split(b"\n") if line and not line.isspace()]
    return (
        len(words),
        len(text) - sum(map(text.count, BLANKS)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(ids),
        len(lines),
        len(numbers),
        sum(map(bytes.isupper, words)),
        int((ids[1:] == ids[:-1]).sum()),
        raw.count(b"!"),
        raw.count(b"|"),
        len(raw) - len(raw.translate(None, _DIGITS)),
        len(raw) - len(raw.translate(None, _MARKS)),
        sum(len(w) > _LONG_WORD for w in words),
        sum(len(w) <= 3 for w in words),
    )


@F.pandas_udf(STATS_TYPE)
def stats(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for texts in batches:
        yield pd.DataFrame([counts(t) for t in texts], columns=list(COUNTS), dtype="int64")


FEATURES = (
    "log_words", "mean_word", "symbols", "dup_lines", "repeats", "line_words", "distinct",
    "upper", "adjacent", "exclaims", "pipes", "digits", "marks", "long_words", "stops",
)


def features(table: pd.DataFrame) -> np.ndarray:
    """Size-free ratios, one row per text, in the order of ``FEATURES``; finite for empty texts."""
    c = {name: table[name].to_numpy(np.float64) for name in COUNTS}
    words, lines = np.maximum(c["n_words"], 1), np.maximum(c["n_lines"], 1)
    return np.column_stack([
        np.log1p(c["n_words"]),
        c["word_chars"] / words,
        c["n_symbols"] / words,
        c["n_dup_lines"] / lines,
        c["n_repeat_words"] / words,
        np.log1p(c["n_words"] / lines),
        # Distinct words against what a text of this length has at best: falls slowly with length.
        c["n_distinct"] / words ** 0.85,
        c["n_upper_words"] / words,
        c["n_adjacent"] / words,
        c["n_exclaim"] / words,
        c["n_pipes"] / words,
        c["n_digits"] / words,
        c["n_marks"] / words,
        c["n_long_words"] / words,
        c["n_stops"] / words,
    ])


def logistic(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35.0, 35.0)))


def log_odds(share: float) -> float:
    return math.log(share / (1.0 - share))
