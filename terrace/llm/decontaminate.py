"""Benchmark decontamination: q-gram counting in diagonal bands, then banded alignment.

Every ``segment`` consecutive characters of a benchmark item count, at whatever offset. A
segment of length n that occurs in a document with at most k edits shares n - q + 1 - k q
of its q-grams with it (the q-gram lemma), on diagonals (document place minus item place)
at most k apart. Shared q-grams are gathered per item and band of diagonals; bands overlap,
so that any k neighbouring diagonals lie in one. Where the places of enough q-grams fit into
one segment, all segments around them are aligned, within the band, and stay if the edit
distance keeps to the budget. Nothing that the definition calls a leak is lost.

Both sides are lower-cased and every run of blanks counts as one space. The benchmark is
read in blocks of bounded size, each sent with the tasks; documents are never shuffled.

Fixed cases: null and empty texts hold no leaks; items without text or with fewer than
``q`` characters match nothing; repeated items all count; an item counts once per document
with its best place; null item ids are reported as null; repeated rows fare alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.llm.common import fresh, only, pieces, quoted


@dataclass(frozen=True)
class Settings:
    """A leak is any ``segment`` consecutive characters of an item (the whole item if shorter)
    with at most one edit in ``chars_per_edit`` characters. ``block_chars`` bounds what is sent
    with a task."""

    q: int = 8
    segment: int = 80
    chars_per_edit: int = 10
    block_chars: int = 2_000_000

    def budget(self, length: int) -> int:
        # Never so many edits that the lemma's bound falls below one shared q-gram.
        return min(length // self.chars_per_edit, max(0, (length - self.q) // self.q))


LEAK = T.StructType([
    T.StructField("item_id", T.LongType()),
    T.StructField("item_from", T.IntegerType()),
    T.StructField("found_at", T.IntegerType()),
    T.StructField("edits", T.IntegerType()),
])

_BAND = 16
_GAP = 0x110000  # no character: parts the documents of a batch
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BATCH_CHARS = 1_000_000
_ALIGNED = 2_000
_FILTER_BITS = 22
_COUNT_BITS = 20


def normalised(text: str | None) -> str:
    return " ".join(text.lower().split()) if text else ""


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def _grams(codes: np.ndarray, q: int) -> np.ndarray:
    """64-bit hashes of all q-grams."""
    n = len(codes) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    wide, h = codes.astype(np.uint64), np.zeros(n, np.uint64)
    for j in range(q):
        h *= _BASE
        h += wide[j : j + n]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h


class Index:
    """The q-grams of one block of items, and where they stand in which item."""

    def __init__(self, items: list[tuple[int | None, str | None]], settings: Settings = Settings()):
        self.settings, q = settings, settings.q
        plain = [(item_id, _codes(normalised(text))) for item_id, text in items]
        plain = [(item_id, codes) for item_id, codes in plain if len(codes) >= q]
        self.ids = [item_id for item_id, _ in plain]
        self.texts = np.concatenate([codes for _, codes in plain]) if plain else np.zeros(0, np.uint32)
        sizes = np.array([len(codes) for _, codes in plain], np.int64)
        self.offset = np.cumsum(sizes) - sizes
        self.longest = int(sizes.max(initial=settings.segment))
        # Of each item: its segments' length, budget and bound, and the last one's start.
        self.length = np.minimum(sizes, settings.segment)
        self.allowed = np.array([settings.budget(n) for n in self.length.tolist()], np.int64)
        self.bound = self.length - q + 1 - self.allowed * q
        self.last = sizes - self.length
        if plain:
            grams = np.concatenate([_grams(codes, q) for _, codes in plain])
            owner = np.repeat(np.arange(len(plain)), sizes - q + 1)
            place = np.concatenate([np.arange(n - q + 1) for n in sizes.tolist()])
            order = np.argsort(grams, kind="stable")
            self.grams, first = np.unique(grams[order], return_index=True)
            self.owner, self.place = owner[order], place[order]
            self.first = np.append(first, len(order))
        else:
            self.grams, self.first = np.zeros(0, np.uint64), np.zeros(1, np.int64)
            self.owner = self.place = np.zeros(0, np.int64)
        self.sieve = np.zeros(1 << _FILTER_BITS, bool)
        self.sieve[(self.grams >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
        # More than any budget: no alignment within budget reaches over the gap.
        self.gap = int(self.allowed.max(initial=0)) + q + 1

    @cached_property
    def item(self) -> list[int | None]:
        """The item of every segment."""
        return [item_id for item_id, last in zip(self.ids, self.last.tolist(), strict=True) for _ in range(last + 1)]

    @cached_property
    def codes(self) -> list[np.ndarray]:
        """The characters of every segment."""
        spans = zip(self.offset.tolist(), self.last.tolist(), self.length.tolist(), strict=True)
        return [self.texts[at + i : at + i + n] for at, last, n in spans for i in range(last + 1)]

    @cached_property
    def budget(self) -> np.ndarray:
        """The edits allowed in every segment."""
        return np.repeat(self.allowed, self.last + 1)

    def _candidates(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(item, start of the segment, band) where enough q-grams are shared."""
        none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        h = _grams(codes, self.settings.q)
        at = np.flatnonzero(self.sieve[(h >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
        slot = np.searchsorted(self.grams, h[at])
        slot[slot == len(self.grams)] = 0
        hit = self.grams[slot] == h[at] if len(self.grams) else np.zeros(len(at), bool)
        at, slot = at[hit], slot[hit]
        if not len(at):
            return none
        # One row per occurrence of the q-gram in an item.
        many = self.first[slot + 1] - self.first[slot]
        entry = np.repeat(self.first[slot] - np.cumsum(many) + many, many) + np.arange(many.sum())
        owner, place = self.owner[entry], self.place[entry]
        diagonal = np.repeat(at, many) - place + (self.longest + 2 * _BAND)
        # A diagonal lies in its own band and in the one that began a step before.
        band = diagonal // _BAND
        bands = int(band.max()) + 2
        own = owner * bands + band
        group, place = np.concatenate([own, own - 1]), np.tile(place, 2)
        # Count by a hash of the group first: few can reach the bound, and only they are sorted.
        cell = ((group.astype(np.uint64) * _BASE) >> np.uint64(64 - _COUNT_BITS)).astype(np.int64)
        likely = np.bincount(cell, minlength=1 << _COUNT_BITS)[cell] >= self.bound[group // bands]
        key = group[likely] * self.longest + place[likely]
        # A q-gram place counts once, however often it is met in the band.
        group, place = np.divmod(np.unique(key), self.longest)
        if not len(group):
            return none
        owner = group // bands
        # Places in order: from each one, the bound is reached at ``until``, within one segment or not.
        reach = self.length[owner] - self.settings.q
        until = np.arange(len(group)) + self.bound[owner] - 1
        inside = until < len(group)
        until[~inside] = 0
        enough = np.flatnonzero(inside & (group[until] == group) & (place[until] - place <= reach))
        if not len(enough):
            return none
        group, owner = group[enough], owner[enough]
        low = np.maximum(place[until[enough]] - reach[enough], 0)
        high = np.minimum(place[enough], self.last[owner])
        # Both ends only grow within a group: what the place before has covered is left out.
        low[1:] = np.where(group[1:] == group[:-1], np.maximum(low[1:], high[:-1] + 1), low[1:])
        many = np.maximum(high - low + 1, 0)
        start = np.repeat(low - np.cumsum(many) + many, many) + np.arange(many.sum())
        return np.repeat(owner, many), start, np.repeat(group % bands, many)

    def _align(self, codes: np.ndarray, item: np.ndarray, start: np.ndarray, band: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(edits, end in codes) of the best alignment of each segment along its band."""
        best, end = np.zeros(len(item), np.int64), np.zeros(len(item), np.int64)
        for n in np.unique(self.length[item]).tolist():
            alike = np.flatnonzero(self.length[item] == n)
            k = int(self.allowed[item[alike[0]]])
            width = 2 * _BAND + 2 * k
            for rows in np.split(alike, range(_ALIGNED, len(alike), _ALIGNED)):
                low = band[rows] * _BAND - (self.longest + 2 * _BAND) - k + start[rows]
                pattern = self.texts[(self.offset[item[rows]] + start[rows])[:, None] + np.arange(n)]
                places = low[:, None] + np.arange(width + n)
                inside = (places >= 0) & (places < len(codes))
                text = np.where(inside, codes[np.clip(places, 0, len(codes) - 1)], _GAP)
                # Column c of row i stands for text place low + i + c; any start and end is free.
                steps, cost = np.arange(width, dtype=np.int16), np.zeros((len(rows), width), np.int16)
                for i in range(n):
                    pair = cost + (text[:, i : i + width] != pattern[:, i : i + 1])
                    pair[:, :-1] = np.minimum(pair[:, :-1], cost[:, 1:] + 1)
                    cost = np.minimum.accumulate(pair - steps, axis=1) + steps
                best[rows] = cost.min(axis=1)
                end[rows] = low + n + cost.argmin(axis=1)
        return best, end

    def leaks(self, texts: list[str | None]) -> list[list[tuple]]:
        """Per text its leaks: (item, place in the item, place in the normalised text, edits)."""
        plain = [normalised(t) for t in texts]
        sizes = np.array([len(t) for t in plain], np.int64)
        starts = np.cumsum(sizes + self.gap) - sizes
        codes = np.full(int(sizes.sum()) + self.gap * (len(texts) + 1), _GAP, np.uint32)
        for t, start in zip(plain, starts.tolist(), strict=True):
            codes[start : start + len(t)] = _codes(t)
        item, start, band = self._candidates(codes)
        found: list[list[tuple]] = [[] for _ in texts]
        if not len(item):
            return found
        edits, end = self._align(codes, item, start, band)
        best: dict[tuple, tuple] = {}
        within = np.flatnonzero(edits <= self.allowed[item])
        for s, at, e, stop in zip(*(x[within].tolist() for x in (item, start, edits, end)), strict=True):
            doc = int(np.searchsorted(starts, stop - 1, side="right")) - 1
            leak = (e, at, max(0, stop - int(self.length[s]) - int(starts[doc])))
            key = (doc, self.ids[s])
            best[key] = min(best.get(key, leak), leak)
        for (doc, item_id), (e, item_from, at) in best.items():
            found[doc].append((item_id, item_from, at, e))
        return [sorted(x, key=lambda leak: (leak[0] is None, leak[0] or 0)) for x in found]


def indexes(
    benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", settings: Settings = Settings()
) -> list[Index]:
    """Indexes of blocks of the benchmark; one block's texts are on the driver at a time."""
    items = only(benchmark, id=id_col, text=text_col).filter("text IS NOT NULL")
    blocks: list[Index] = []
    block, size = [], 0
    for row in items.toLocalIterator():
        block.append((row["id"], row["text"]))
        size += len(row["text"])
        if size >= settings.block_chars:
            blocks.append(Index(block, settings))
            block, size = [], 0
    if block or not blocks:
        blocks.append(Index(block, settings))
    return blocks


def leaks(blocks: list[Index], text: Column) -> Column:
    """array<LEAK> of the benchmark items that a text holds; empty where there are none."""

    def by(index: Index) -> Column:
        @F.pandas_udf(T.ArrayType(LEAK))
        def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for series in batches:
                texts = series.tolist()
                rows: list[list[tuple]] = []
                for part in pieces(len(texts), [len(t or "") for t in texts], _BATCH_CHARS):
                    rows += index.leaks(texts[part])
                names = LEAK.fieldNames()
                yield pd.Series([[dict(zip(names, leak, strict=True)) for leak in row] for row in rows], dtype=object)

        return found(text)

    return F.concat(*[by(index) for index in blocks]) if len(blocks) > 1 else by(blocks[0])


def clean(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", settings: Settings = Settings()
) -> DataFrame:
    """The documents that hold no benchmark item, with all their columns."""
    found = fresh(docs, "leaks")
    blocks = indexes(benchmark, settings=settings)
    return docs.withColumn(found, leaks(blocks, quoted(text_col))).filter(F.size(found) == 0).drop(found)
