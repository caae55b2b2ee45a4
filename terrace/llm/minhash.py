"""Near-duplicates by b-bit MinHash.

Texts with equal shingle sets form a class; from then on classes are the rows. Of every
class's minima, bands of whole minima make bucket keys, and the low bits are packed into a
signature. Two classes of one bucket are candidates if the collision-corrected similarity
of their signatures, from bit counts, is not clearly below the threshold, and if the exact
bound of their parity sketches does not refute them; candidates are confirmed on full sets.
How buckets become components without expanding them into pairs is told in ``linking``.

At the threshold a pair meets in no band with a chance below 5e-7 (25 bands of 5 at 85 %; 5e-8
for 32 of 4 at 80 %), and the estimate refutes it with one below 1e-8 (six deviations). Every
other step is exact.

Fixed cases: null or empty texts and texts without words have empty sets and link with
nothing; rows with a null id link with nothing, get a null component and are kept; rows
with one id are one document that links by each of its texts with words; repeated rows all
stay; a very long text is one set, held by one task while it is signed; other columns,
whatever their names, are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.llm.common import fresh, mixed, only, quoted, shingle_sets, small
from terrace.llm.components import components
from terrace.llm.linking import SMALL_BUCKET, Comparison, digest, linked, linked_in_small, own_links, with_component
from terrace.llm.parity import possible, sketch
from terrace.operators.joins import balanced_join
from terrace.sources.tables import materialise


@dataclass(frozen=True)
class Settings:
    """Link where 100 * shared >= percent * union of the sets of ``shingle``-word shingles."""

    shingle: int = 5
    percent: int = 80
    minima: int = 128
    bits: int = 4
    band_rows: int = 4
    bands: int = 32
    rounds: int = 6

    def __post_init__(self):
        if self.bits != 4 or self.minima % 16 or self.bands * self.band_rows > self.minima:
            raise ValueError("signatures are packed in nibbles, sixteen to a long, and bands must fit the minima")

    @property
    def least_matches(self) -> int:
        """Equal nibbles expected at the threshold, less six standard deviations."""
        chance = 2.0**-self.bits
        equal = chance + (1 - chance) * self.percent / 100
        return math.floor(self.minima * equal - 6 * math.sqrt(self.minima * equal * (1 - equal)))


_CHUNK = 4096


def minima(hashes: np.ndarray, count: int) -> np.ndarray:
    """Minimum of each of ``count`` random affine orders over the hashes."""
    rng = np.random.default_rng(2024)
    scale = rng.integers(0, 2**64, count, np.uint64)[:, None] | np.uint64(1)
    shift = rng.integers(0, 2**64, count, np.uint64)[:, None]
    best = np.full(count, 2**64 - 1, np.uint64)
    for at in range(0, len(hashes), _CHUNK):
        np.minimum(best, (hashes[None, at : at + _CHUNK] * scale + shift).min(axis=1), out=best)
    return best


def packed(low: np.ndarray) -> np.ndarray:
    """Nibbles sixteen to a signed long."""
    places = np.arange(16, dtype=np.uint64) * np.uint64(4)
    return np.bitwise_or.reduce(low.reshape(-1, 16) << places, axis=1).view(np.int64)


def matches(a: Column, b: Column, longs: int) -> Column:
    """Equal nibbles of two signatures, by counting bits."""
    ones = 0x1111111111111111
    total = F.lit(longs * 16)
    for i in range(longs):
        x = F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))
        spread = x
        for k in (1, 2, 3):
            spread = spread.bitwiseOR(F.shiftrightunsigned(x, k))
        total = total - F.bit_count(spread.bitwiseAND(F.lit(ones)))
    return total


_SIGNED = T.StructType([
    T.StructField("n_shingles", T.LongType()),
    T.StructField("cls", T.BinaryType()),
    T.StructField("sig", T.ArrayType(T.LongType())),
    T.StructField("bands", T.ArrayType(T.LongType())),
    T.StructField("sketch", T.ArrayType(T.LongType())),
])


def _signed(settings: Settings, text: Column) -> Column:
    rows = settings.bands * settings.band_rows

    @F.pandas_udf(_SIGNED)
    def signed(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        seeds = mixed(np.arange(1, settings.bands + 1, dtype=np.uint64))
        for texts in small(batches):
            out = []
            for s in shingle_sets(texts, settings.shingle):
                if not len(s):
                    out.append((0, None, None, None, None))
                    continue
                low = mixed(minima(s, settings.minima))
                band = seeds.copy()
                for column in low[:rows].reshape(settings.bands, settings.band_rows).T:
                    band = mixed(band + column)
                out.append((len(s), digest(s), packed(low & np.uint64(15)), band.view(np.int64), sketch(s)))
            yield pd.DataFrame(out, columns=_SIGNED.fieldNames())

    return signed(text)


def _comparison(settings: Settings) -> Comparison:
    longs = settings.minima // 16

    def equal(x: str, y: str) -> Column:
        return matches(F.col(f"{x}.sig"), F.col(f"{y}.sig"), longs)

    def likely(x: str, y: str) -> Column:
        a, b = F.col(f"{x}.n_shingles"), F.col(f"{y}.n_shingles")
        sized = F.least(a, b) * 100 >= F.greatest(a, b) * settings.percent
        # The estimate comes first; what it lets through also has to pass an exact bound.
        return F.when(sized & (equal(x, y) >= settings.least_matches), possible(x, y, settings.percent)).otherwise(False)

    return Comparison(
        settings.shingle, settings.percent, ("n_shingles", "sig", "sketch"), likely, lambda x, y: -equal(x, y), settings.rounds
    )


def link(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()
) -> DataFrame:
    """One row per document: id, n_shingles, component_id, kept."""
    rows = only(docs, id=id_col, text=text_col)
    signed = materialise(rows.select("id", _signed(settings, F.col("text")).alias("s")).select("id", "s.*"), "signed")
    named = signed.filter("cls IS NOT NULL AND id IS NOT NULL")
    classes = materialise(
        named.groupBy("cls").agg(F.min("id").alias("rep"), *[F.first(c).alias(c) for c in _SIGNED.fieldNames() if c != "cls"]), "classes"
    )
    placed = classes.select("cls", F.explode("bands").alias("key"))
    crowded = materialise(placed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "buckets")
    members = materialise(balanced_join(placed, crowded, "key", "inner", keys_from=placed), "members")
    how = _comparison(settings)
    small = F.col("n") <= SMALL_BUCKET
    roots = linked_in_small(rows, classes, members.filter(small).select("key", "cls"), components(own_links(named)), how)
    roots = linked(rows, classes, members.filter(~small).select("key", "cls"), roots, how)
    done = with_component(signed.select("id", "n_shingles", "cls"), classes, roots)
    return done.select(
        F.col("id").alias(id_col), "n_shingles", F.col("component").alias("component_id"),
        F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"),
    )


def keep_one(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()
) -> DataFrame:
    """The documents with the smallest id of their group, with all their columns.

    Rows without an id, and rows that repeat the kept id, all stay.
    """
    name = fresh(docs, "gone")
    gone = link(docs, id_col, text_col, settings).filter("NOT kept").select(quoted(id_col).alias(name)).distinct()
    return docs.join(materialise(gone, "gone"), quoted(id_col) == F.col(name), "left_anti")
