"""Periodic runs of words, by online dyadic square catching.

A run is a stretch of words with smallest period q, at least ``least_powers`` times q and
``least_length`` words long, that no neighbouring word extends. Words are appended in
batches. Every completed block of 2**k words, aligned to a multiple of its length, is a
catcher for squares whose half is 2**k to 2**(k+1) - 1 words long (the shortest blocks also
catch all shorter ones): a word that is appended completes, on every level, one window that
ends with it, and that window is compared with the content of the catchers in its reach. An
equal window at distance q is a stretch that repeats itself q words later; binary jumps over
the levels' window hashes lead to both its ends. Stretches that reach the last word stay
open and move on with the next batch; closed ones of one period and start are one run.

No run is missed: its first ``least_powers - 1`` periods hold a whole aligned block of the
level of its period, and that block stands again one period later. A run found with a
multiple of its period has the same ends as the one with the smallest period, which wins.

Words are numbered within their text, so single words compare exactly, and longer windows by
64-bit hashes. State grows with 8 bytes per word and level, n log n for n words, and is kept
for one text at a time. Documents are independent: nothing is shuffled, and copies or hot
sources meet nowhere.

Fixed cases: null and empty texts, and texts without words, have no runs and collapse to the
empty text; repeated rows and rows with a null id are treated each by itself; ties (equal
stretches found on several levels) are one run; other columns pass through untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.llm.common import crc32_sql, small, word_list

LEAST_LENGTH = 24
LEAST_POWERS = 3
BATCH_WORDS = 8192

_MULTIPLIERS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93), np.uint64(0xBF58476D1CE4E5B9))
_SHIFT = np.uint64(32)


class _Growing:
    """An array that doubles its room when it is full."""

    def __init__(self):
        self._room, self.n = np.zeros(64, np.uint64), 0

    def extend(self, values: np.ndarray) -> None:
        end = self.n + len(values)
        if end > len(self._room):
            room = np.zeros(max(end, 2 * len(self._room)), np.uint64)
            room[: self.n] = self._room[: self.n]
            self._room = room
        self._room[self.n : end] = values
        self.n = end

    @property
    def values(self) -> np.ndarray:
        return self._room[: self.n]


def _scrambled(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _SHIFT)) * _MULTIPLIERS[2]
    return x ^ (x >> _SHIFT)


class Catchers:
    """The squares of a growing sequence of numbered words, merged into runs."""

    def __init__(self, least_length: int = LEAST_LENGTH, least_powers: int = LEAST_POWERS):
        if least_powers < 3 or least_length < least_powers:
            raise ValueError("runs hold three periods or more")
        self.least_length, self.least_powers = least_length, least_powers
        # The shortest catchers must lie in the first two thirds of the shortest run.
        room = least_length - least_length // least_powers
        self.base = max(((room + 1) // 2).bit_length() - 1, 0)
        self.levels = [_Growing()]
        self.compared: dict[int, int] = {}
        # Stretches [start, end) whose words stand again ``period`` later and that reach the last word.
        self.open = np.zeros((3, 0), np.int64)
        self.runs: dict[tuple[int, int], int] = {}

    @property
    def n(self) -> int:
        return self.levels[0].n

    def append(self, words: np.ndarray) -> None:
        self.levels[0].extend(_scrambled(words.astype(np.uint64) * _MULTIPLIERS[0] + _MULTIPLIERS[1]))
        caught = [self.open]
        level = 0
        while True:
            if level >= self.base:
                caught.extend(self._caught(level))
            level += 1
            if (1 << level) > max(self.n // self.least_powers, 1 << self.base) or (1 << level) > self.n:
                break
            self._complete(level)
        starts, ends, periods = np.concatenate(caught, axis=1)
        if not len(starts):
            return
        # Neighbouring blocks of one period belong to one stretch.
        order = np.lexsort((ends, starts, periods))
        starts, ends, periods = starts[order], ends[order], periods[order]
        follows = np.zeros(len(starts), bool)
        follows[1:] = (periods[1:] == periods[:-1]) & (starts[1:] <= ends[:-1]) & (starts[1:] >= starts[:-1])
        starts, ends, periods = starts[~follows], ends[~follows], periods[~follows]
        starts, ends = self._back(starts, periods), self._forth(ends, periods)
        _, first = np.unique(np.stack([periods, starts]), axis=1, return_index=True)
        starts, ends, periods = starts[first], ends[first], periods[first]
        growing = ends + periods == self.n
        self._judge(starts[~growing], ends[~growing], periods[~growing])
        self.open = self._needed(np.stack([starts, ends, periods])[:, growing])

    def finish(self) -> list[tuple[int, int, int]]:
        """(start, length, period) of all runs, by start, then period."""
        self._judge(*self.open)
        self.open = self.open[:, :0]
        return sorted((start, end - start, period) for (start, end), period in self.runs.items())

    def _complete(self, level: int) -> None:
        """Hashes of the windows of 2**level words that the appended words complete."""
        if level == len(self.levels):
            self.levels.append(_Growing())
        own, below, half = self.levels[level], self.levels[level - 1].values, 1 << (level - 1)
        start, stop = own.n, self.n - (1 << level) + 1
        if stop > start:
            own.extend(_scrambled(below[start:stop] * _MULTIPLIERS[0] + below[start + half : stop + half] * _MULTIPLIERS[1]))

    def _caught(self, level: int) -> Iterator[np.ndarray]:
        """Windows completed since last time that equal a catcher in reach, as (start, end, period)."""
        hashes, size = self.levels[level].values, 1 << level
        at = np.arange(self.compared.get(level, 0), len(hashes))
        self.compared[level] = len(hashes)
        past = at % size
        # The shortest catchers also look at their own nearest words.
        for back in ((0, size) if level == self.base else (size,)):
            period = past + back
            fits = (period > 0) & (at >= period)
            catcher = (at - period)[fits]
            equal = hashes[catcher] == hashes[at[fits]]
            if equal.any():
                block, period = catcher[equal], period[fits][equal]
                yield np.stack([block, block + size, period])

    def _forth(self, ends: np.ndarray, periods: np.ndarray) -> np.ndarray:
        """How far the words from ``ends`` on stand again one period later."""
        ends = ends.copy()
        for level in range(len(self.levels) - 1, -1, -1):
            hashes, size = self.levels[level].values, 1 << level
            move = np.arange(len(ends))
            while len(move):
                move = move[ends[move] + periods[move] < len(hashes)]
                move = move[hashes[ends[move]] == hashes[ends[move] + periods[move]]]
                ends[move] += size
        return ends

    def _back(self, starts: np.ndarray, periods: np.ndarray) -> np.ndarray:
        starts = starts.copy()
        for level in range(len(self.levels) - 1, -1, -1):
            hashes, size = self.levels[level].values, 1 << level
            move = np.arange(len(starts))
            while len(move):
                move = move[(starts[move] >= size) & (starts[move] - size + periods[move] < len(hashes))]
                move = move[hashes[starts[move] - size] == hashes[starts[move] - size + periods[move]]]
                starts[move] -= size
        return starts

    def _judge(self, starts: np.ndarray, ends: np.ndarray, periods: np.ndarray) -> None:
        stops = ends + periods
        long = stops - starts >= np.maximum(self.least_length, self.least_powers * periods)
        for start, stop, period in zip(starts[long].tolist(), stops[long].tolist(), periods[long].tolist(), strict=True):
            self.runs[start, stop] = min(period, self.runs.get((start, stop), period))

    def _needed(self, stretches: np.ndarray) -> np.ndarray:
        """Without multiples of a period already open from the same start: they end with it."""
        starts, ends, periods = stretches
        order = np.lexsort((periods, starts))
        starts, ends, periods = starts[order], ends[order], periods[order]
        first = np.ones(len(starts), bool)
        first[1:] = starts[1:] != starts[:-1]
        least = periods[first][np.cumsum(first) - 1] if len(starts) else periods
        # A multiple of the period that is itself shorter than the stretch so far.
        repeats = ~first & (periods % least == 0) & (ends - starts >= periods)
        return np.stack([starts, ends, periods])[:, ~repeats]


def find(words: list[bytes]) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of one text."""
    if len(words) < LEAST_LENGTH:
        return []
    numbers: dict[bytes, int] = {}
    codes = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    catchers = Catchers()
    for at in range(0, len(codes), BATCH_WORDS):
        catchers.append(codes[at : at + BATCH_WORDS])
    return catchers.finish()


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run holds after its first period."""
    if not runs:
        return words
    edges = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    inside = np.cumsum(edges[:-1]) > 0
    return [w for w, out in zip(words, inside.tolist(), strict=True) if not out]


FOUND_TYPE = T.StructType([
    T.StructField("runs", T.ArrayType(T.StructType([
        T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("period", T.LongType()),
    ]))),
    T.StructField("collapsed", T.StringType()),
])


@F.pandas_udf(FOUND_TYPE)
def _found(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for texts in small(batches):
        out = []
        for text in texts:
            words = word_list(text)
            runs = find(words)
            out.append((
                [{"start": s, "length": n, "period": p} for s, n, p in runs],
                b" ".join(collapsed(words, runs)).decode(),
            ))
        yield pd.DataFrame(out, columns=FOUND_TYPE.fieldNames())


def found(text: Column) -> Column:
    """Struct (runs, collapsed): all runs by start, then period, and the text without their repeats."""
    return _found(text)


def strongest(runs: Column) -> Column:
    """The run with the greatest length in periods; of equal ones the first. Null without runs."""
    return F.aggregate(
        runs, F.get(runs, F.lit(0)),
        lambda best, run: F.when(run["length"] * best["period"] > best["length"] * run["period"], run).otherwise(best),
    )


@F.pandas_udf(T.StringType())
def with_tail_repeated(texts: pd.Series, seeds: pd.Series) -> pd.Series:
    """The text's words, a tenth of the texts with a tail made periodic, as the seed (an unsigned hash) says.

    With h the seed, g = floor(h / 10) and n words: if h % 10 = 0, each word i >= a = g % n becomes
    word a + (i - a) % p, where p = 1 + floor((n - a) / (3 + g % 8)). A null seed leaves the text alone.
    """

    def shaped(text: str | None, seed: float | None) -> str | None:
        if text is None or pd.isna(seed) or int(seed) % 10:
            return text
        words, g = word_list(text), int(seed) // 10
        if words:
            start = g % len(words)
            period = 1 + (len(words) - start) // (3 + g % 8)
            words = words[:start] + [words[start + i % period] for i in range(len(words) - start)]
        return b" ".join(words).decode()

    return pd.Series([shaped(t, h) for t, h in zip(texts, seeds, strict=True)], dtype=object)


# The query in SQL for a table documents(doc_id, text) with unique ids. Periods to try are the distances
# at which some aligned block of eight words stands again; every run holds such a block.
ORACLE_SQL = rf"""
WITH hashed AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    {crc32_sql("doc_id")} AS h
  FROM documents
), shaped AS (
  SELECT doc_id, w, len(w) AS n, h % 10 = 0 AND len(w) > 0 AS periodic,
    CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a,
    CASE WHEN len(w) > 0 THEN 1 + (len(w) - (h // 10) % len(w)) // (3 + (h // 10) % 8) END AS p
  FROM hashed
), rebuilt AS (
  SELECT doc_id, n, CASE WHEN periodic THEN [w[CASE WHEN i < a THEN i ELSE a + (i - a) % p END + 1] for i in range(n)] ELSE w END AS w
  FROM shaped
), eights AS (
  SELECT doc_id, n, i, array_to_string(w[i + 1 : i + 8], ' ') AS block FROM (SELECT doc_id, n, w, unnest(range(n - 7)) AS i FROM rebuilt WHERE n >= 24)
), periods AS (
  SELECT DISTINCT x.doc_id, y.i - x.i AS q FROM eights x JOIN eights y ON x.doc_id = y.doc_id AND x.block = y.block
  WHERE x.i % 8 = 0 AND y.i > x.i AND 3 * (y.i - x.i) <= x.n
), equal AS (
  SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island
  FROM (SELECT p.doc_id, p.q, r.w, unnest(range(r.n - p.q)) AS i FROM periods p JOIN rebuilt r ON p.doc_id = r.doc_id)
  WHERE w[i + 1] = w[i + 1 + q]
), stretches AS (
  SELECT doc_id, q, min(i) AS s, max(i) + 1 + q AS e FROM equal GROUP BY doc_id, q, island
), runs AS (
  SELECT doc_id, s, e - s AS length, min(q) AS period FROM stretches
  WHERE e - s >= greatest(24, 3 * q) GROUP BY doc_id, s, e
), listed AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || length || ',' || period || chr(10), '' ORDER BY s, period) AS lines
  FROM runs GROUP BY doc_id
), best AS (
  SELECT x.* FROM runs x WHERE NOT EXISTS (
    SELECT 1 FROM runs y WHERE y.doc_id = x.doc_id AND (y.length * x.period > x.length * y.period
      OR (y.length * x.period = x.length * y.period AND (y.s, y.period) < (x.s, x.period))))
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(s + period, s + length)) AS i FROM runs
), kept AS (
  SELECT p.doc_id, string_agg(p.word, ' ' ORDER BY p.i) AS text
  FROM (SELECT doc_id, unnest(range(n)) AS i, unnest(w) AS word FROM rebuilt) p
  ANTI JOIN gone g ON p.doc_id = g.doc_id AND p.i = g.i GROUP BY p.doc_id
)
SELECT r.doc_id, coalesce(l.n_runs, 0)::BIGINT AS n_runs, b.s::BIGINT AS start, b.length::BIGINT AS length, b.period::BIGINT AS period,
  (1000 * b.length // b.period)::BIGINT AS exponent_milli, sha256(coalesce(l.lines, '')) AS runs_sha256,
  sha256(coalesce(k.text, '')) AS collapsed_sha256
FROM rebuilt r LEFT JOIN listed l ON r.doc_id = l.doc_id LEFT JOIN best b ON r.doc_id = b.doc_id LEFT JOIN kept k ON r.doc_id = k.doc_id
"""
