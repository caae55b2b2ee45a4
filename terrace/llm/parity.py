"""Jaccard join of shingle sets by parity sketches.

Every shingle's hash names one bit of a virtual sketch of 2**64 bits; a set's sketch is the
XOR of its bits. Two sketches differ in at most as many bits as the sets differ in shingles,
and folding a sketch (XOR of its halves) or cutting it in pieces never adds a difference.
That bound is used twice:

* Candidates, by pigeonhole. Sets are banded by size. In the scheme of a band, linked sets
  differ in at most ``spread`` shingles, so of ``blocks`` > ``spread`` equal pieces of their
  sketches at least ``blocks - spread`` are equal. Every piece is known by the XOR of its
  shingles' hashes, and classes that share a piece share a bucket. Pieces without a bit are
  left out: they say nothing and nearly all sets have some. A pair can depend on them only
  if both sets leave ``blocks - spread`` pieces or more empty; such hollow sets, about one in
  a thousand by the choice of ``blocks``, emit their empty pieces too. No link is lost.
* Fewer candidates, by the same count. A linked pair shares ``told - spread`` buckets or more,
  where ``told`` is the number of a set's pieces that are not empty. So each class may leave out
  all but one of as many buckets: the most crowded ones, in an order that holds for all classes.
  Of the buckets that a linked pair shares neither leaves out the least crowded one. Pieces that
  hold nothing but a passage found in many texts go this way, before anything is compared.
* Refutation. Sketches folded to four to eight bits per shingle are compared bit by bit: a
  Hamming distance beyond the allowed difference refutes a pair without its sets.

What is left is verified on full sets. Texts with equal sets form a class; from then on
classes are the rows. A bucket is not expanded into pairs: in each round every class is
verified against the likeliest of one pick per bucket, and what links is joined into
components. Then, in buckets that still hold several components, classes outside the largest
one are compared with the others, in pieces of bounded size spread over tasks, and only pairs
that the sketches cannot refute leave the join. Two classes of one component need no
comparison: a link between them would change nothing.

Fixed cases: null or empty texts and texts without words have empty sets and link with
nothing; texts with fewer words than a shingle have their whole sequence as one shingle;
rows with a null id link with nothing and get a null component; rows with one id are one
document that links by each of its texts; repeated rows all stay; a very long text is one
set, held by one task while it is signed; other columns are not looked at. Shingles and sets are
equal if 64 and 128 hash bits are.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.llm.common import mixed, only, pieces, shingle_sets, small
from terrace.llm.components import components
from terrace.llm.linking import Comparison, digest, linked, own_links, with_component
from terrace.sources.tables import materialise


@dataclass(frozen=True)
class Settings:
    """Link where 100 * shared >= percent * union of the sets of ``shingle``-word shingles."""

    shingle: int = 5
    percent: int = 80
    rounds: int = 6
    rows_per_piece: int = 1000


@dataclass(frozen=True)
class Scheme:
    """How pairs are met whose smaller set has ``least`` to ``most`` shingles."""

    number: int
    least: int
    most: int
    spread: int
    blocks: int


_BAND_RATIO = 1.4
_SIZES = 1 << 40


def _blocks(least: int, spread: int) -> int:
    """Fewest pieces that leave a set of ``least`` shingles hollow about once in a thousand."""
    for n in range(spread + 1, 2 * max(least, spread) + 2):
        if spread == 0:
            return n
        if n <= 60:  # all shingles in some choice of ``spread`` pieces
            if math.comb(n, spread) * (spread / n) ** least <= 1e-3:
                return n
        else:  # the number of empty pieces is about normal
            one, two = (1 - 1 / n) ** least, (1 - 2 / n) ** least
            mean, variance = n * one, max(n * one + n * (n - 1) * two - (n * one) ** 2, 0.0)
            if n - spread > mean + 3.1 * math.sqrt(variance):
                return n
    return 2 * max(least, spread) + 2


@lru_cache(maxsize=4096)
def _scheme(number: int, least: int, most: int, percent: int) -> Scheme:
    spread = (most + 100 * most // percent) * (100 - percent) // (100 + percent)
    return Scheme(number, least, most, spread, _blocks(least, spread))


@lru_cache(maxsize=8)
def _bands() -> list[int]:
    edges = [1]
    while edges[-1] < _SIZES:
        edges.append(max(edges[-1] + 1, int(edges[-1] * _BAND_RATIO)))
    return edges


@lru_cache(maxsize=65536)
def schemes(size: int, percent: int) -> tuple[Scheme, ...]:
    """The scheme of the set's own band, and those of lower bands that hold a possible smaller partner."""
    edges, out = _bands(), []
    k = bisect_right(edges, size) - 1
    while k >= 0:
        scheme = _scheme(k, edges[k], edges[k + 1] - 1, percent)
        if scheme.most < size and size * percent > 100 * scheme.most:
            break
        out.append(scheme)
        k -= 1
    return tuple(out)


def sketch(hashes: np.ndarray) -> np.ndarray:
    """The parity sketch folded to a power of two of four to eight bits per shingle, 64 bits to a long."""
    bits = max(64, 1 << (4 * len(hashes) - 1).bit_length())
    at = mixed(hashes + np.uint64(0x9E3779B97F4A7C15)) & np.uint64(bits - 1)
    odd = np.bincount(at.astype(np.int64), minlength=bits).astype(np.uint8) & 1
    return np.packbits(odd, bitorder="little").view(np.int64)


_SCHEME_BITS = 6


def _pieces(hashes: np.ndarray, scheme: Scheme) -> tuple[np.ndarray, np.ndarray]:
    """(numbers of the pieces with a shingle, where each starts): sorted hashes lie piece by piece."""
    piece = ((hashes >> np.uint64(32)) * np.uint64(scheme.blocks)) >> np.uint64(32)
    starts = np.flatnonzero(np.diff(piece, prepend=np.uint64(scheme.blocks)))
    return piece[starts], starts


def slack(hashes: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """(scheme, buckets that a linked set shares at least) for all schemes of a set."""
    out, high = [], hashes >> np.uint64(32)
    for scheme in schemes(len(hashes), percent):
        piece = (high * np.uint64(scheme.blocks)) >> np.uint64(32)
        told = 1 + int(np.count_nonzero(piece[1:] != piece[:-1]))
        out.append((scheme.number, max(told - scheme.spread, 1)))
    return out


def piece_keys(hashes: np.ndarray, percent: int) -> np.ndarray:
    """Bucket keys of a set (sorted distinct hashes) in all its schemes; the low bits tell the scheme."""
    out = []
    own = mixed(hashes ^ np.uint64(0xD6E8FEB86659FD93))
    for scheme in schemes(len(hashes), percent):
        piece, starts = _pieces(hashes, scheme)
        base = np.uint64((scheme.number + 1) << 40)
        keys = [mixed(np.bitwise_xor.reduceat(own, starts) + mixed(piece + base))]
        if len(starts) <= scheme.spread:
            empty = np.setdiff1d(np.arange(scheme.blocks, dtype=np.uint64), piece)
            keys.append(mixed(empty + base + np.uint64(1 << 39)))
        low = np.uint64((1 << _SCHEME_BITS) - 1)
        out.append((np.concatenate(keys) & ~low) | (np.uint64(scheme.number) & low))
    return np.concatenate(out).view(np.int64)


def _short(cls: bytes) -> int:
    return int.from_bytes(cls[:8], "little", signed=True)


_SIGNED = T.StructType([
    T.StructField("n_shingles", T.LongType()),
    T.StructField("cls", T.BinaryType()),
    T.StructField("short", T.LongType()),
    T.StructField("sketch", T.ArrayType(T.LongType())),
    T.StructField("slack", T.ArrayType(T.StructType([T.StructField("scheme", T.LongType()), T.StructField("least", T.LongType())]))),
])


def _signed(settings: Settings, text: Column) -> Column:
    @F.pandas_udf(_SIGNED)
    def signed(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in small(batches):
            out = []
            for s in shingle_sets(texts, settings.shingle):
                if not len(s):
                    out.append((0, None, 0, None, None))  # a null would make pandas round the longs
                    continue
                cls = digest(s)
                told = [{"scheme": k, "least": n} for k, n in slack(s, settings.percent)]
                out.append((len(s), cls, _short(cls), sketch(s), told))
            yield pd.DataFrame(out, columns=_SIGNED.fieldNames())

    return signed(text)


_KNOWN_CLASSES = 1_000_000
_BYTES_AT_ONCE = 1 << 21


def _piece_rows(rows: DataFrame, settings: Settings) -> DataFrame:
    """(key, short): the pieces of every class, once per task however many copies it meets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()
        for batch in batches:
            texts = batch.column("text")
            for part in pieces(len(texts), pc.fill_null(pc.binary_length(texts), 0).to_pylist(), _BYTES_AT_ONCE):
                keys, shorts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
                for s in shingle_sets(texts.slice(part.start, part.stop - part.start).to_pylist(), settings.shingle):
                    if not len(s):
                        continue
                    short = _short(digest(s))
                    if short in met:
                        continue
                    if len(met) >= _KNOWN_CLASSES:
                        met.clear()
                    met.add(short)
                    keys.append(piece_keys(s, settings.percent))
                    shorts.append(np.full(len(keys[-1]), short, np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.concatenate(shorts))], names=["key", "short"])

    return rows.select("text").mapInArrow(run, "key long, short long")


def _members(rows: DataFrame, classes: DataFrame, settings: Settings) -> DataFrame:
    """(key, cls): the buckets that classes share, but for the most crowded ones that each may leave out.

    One exchange brings the pieces of a bucket together, 24 bytes each; a bucket streams through its task.
    """
    bucket = Window.partitionBy("key")
    told = _piece_rows(rows, settings).select(
        "key", "short", F.lag("short").over(bucket.orderBy("short")).alias("before"), F.min("short").over(bucket).alias("lo"),
        F.max("short").over(bucket).alias("hi"), F.count(F.lit(1)).over(bucket).alias("n"),
    )
    shared = told.filter((F.col("lo") != F.col("hi")) & (F.col("before").isNull() | (F.col("short") != F.col("before"))))
    shared = shared.select("key", "short", "n", F.col("key").bitwiseAND(F.lit((1 << _SCHEME_BITS) - 1)).alias("scheme"))
    least = classes.select("cls", "short", F.explode("slack").alias("slack")).select("cls", "short", "slack.*")
    # A class has no more buckets than shingles. Any one order of the buckets will do.
    crowded_first = Window.partitionBy("cls", "scheme").orderBy(F.desc("n"), "key")
    ranked = shared.join(least, ["short", "scheme"]).withColumn("rank", F.row_number().over(crowded_first))
    return materialise(ranked.filter(F.col("rank") >= F.col("least")).select("key", "cls"), "members")


def hamming(a: Column, b: Column) -> Column:
    """Differing bits of two sketches, the longer one folded to the other's length."""

    def fitted(x: Column, other: Column) -> Column:
        n = F.size(other)
        halves = F.zip_with(F.slice(x, F.lit(1), n), F.slice(x, n + 1, n), lambda u, v: u.bitwiseXOR(v))
        return F.when(F.size(x) > n, halves).otherwise(x)

    ones = F.zip_with(fitted(a, b), fitted(b, a), lambda u, v: F.bit_count(u.bitwiseXOR(v)))
    return F.aggregate(ones, F.lit(0), lambda total, n: total + F.coalesce(n, F.lit(0)))


def possible(x: str, y: str, percent: int) -> Column:
    """Whether sizes and sketches leave a link possible. Sizes come first: they spare the bits."""
    a, b = F.col(f"{x}.n_shingles"), F.col(f"{y}.n_shingles")
    sized = F.least(a, b) * 100 >= F.greatest(a, b) * percent
    near = hamming(F.col(f"{x}.sketch"), F.col(f"{y}.sketch")) * (100 + percent) <= (a + b) * (100 - percent)
    return F.when(sized, near).otherwise(False)


def link(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()
) -> DataFrame:
    """One row per document: id, n_shingles, component_id."""
    rows = only(docs, id=id_col, text=text_col)
    signed = materialise(rows.select("id", _signed(settings, F.col("text")).alias("s")).select("id", "s.*"), "signed")
    named = signed.filter("cls IS NOT NULL AND id IS NOT NULL")
    classes = materialise(
        named.groupBy("cls").agg(F.min("id").alias("rep"), *[F.first(c).alias(c) for c in _SIGNED.fieldNames() if c != "cls"]), "classes"
    )
    members = _members(rows.filter("id IS NOT NULL"), classes, settings)
    how = Comparison(
        settings.shingle, settings.percent, ("n_shingles", "sketch"),
        lambda x, y: possible(x, y, settings.percent), lambda x, y: hamming(F.col(f"{x}.sketch"), F.col(f"{y}.sketch")),
        settings.rounds, settings.rows_per_piece,
    )
    roots = linked(rows, classes, members, components(own_links(named)), how)
    return with_component(signed.select("id", "n_shingles", "cls"), classes, roots).select(
        F.col("id").alias(id_col), "n_shingles", F.col("component").alias("component_id")
    )


def oracle_sql(shingle: int, percent: int, kept: bool = False) -> str:
    """The links' components in SQL, for a table documents(doc_id, text) with unique ids."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return rf"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + {shingle - 1}], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {shingle - 1}, 1) + 1)) AS i FROM split WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS met
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY x.doc_id, y.doc_id
), links AS (
  SELECT a, b FROM pairs JOIN sizes m ON m.doc_id = a JOIN sizes n ON n.doc_id = b
  WHERE 100 * met >= {percent} * (m.n + n.n - met)
), reached AS (
  SELECT doc_id AS a, doc_id AS b FROM sizes
  UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
), lowest AS (
  SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY a
)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(l.component_id, d.doc_id) AS component_id{
    ", coalesce(l.component_id = d.doc_id, true) AS kept" if kept else ""}
FROM documents d LEFT JOIN sizes n ON n.doc_id = d.doc_id LEFT JOIN lowest l ON l.doc_id = d.doc_id
"""
