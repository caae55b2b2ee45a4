"""Substring de-duplication: every window of ``width`` words that started earlier is cut out.

Windows are compared by Rabin-Karp hashes that Spark counts over all documents. Windows
that cannot repeat are not shuffled: each contains ``width - anchor + 1`` shorter ones, of
which the one with the smallest hash is its anchor, and equal windows have equal anchors.
Only windows whose anchor occurs in two different texts are counted, which loses none. Repeats
within a document need no exchange at all. Overlapping repeated windows merge into maximal spans.

A window is earlier if it starts in a document with a smaller id, or earlier in the same
text. Copies of a whole text meet by hash first and take no part in the counting. Window
hashes have 96 bits between documents, 64 within one, text hashes 128.

Fixed cases: null and empty texts have no words; texts shorter than a window lose
nothing; null ids come after all others and take nothing from each other; rows with one
id take nothing from each other, only from smaller ids and from earlier in their own
text; rows equal in id and text fare alike. Other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.llm.common import Words, fresh, in_pieces, mixed, only, quoted, raw_texts, words_of
from terrace.sources.tables import materialise


@dataclass(frozen=True)
class Settings:
    width: int = 20
    anchor: int = 6


_BASES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)


def rolled(hashes: np.ndarray, width: int, base: int = 0) -> np.ndarray:
    """Rabin-Karp hash of every window: the words as digits of a number modulo 2**64.

    Windows are put together from shorter ones, half as long or shorter by one word.
    """
    if len(hashes) < width:
        return np.zeros(0, np.uint64)
    digit = int(_BASES[base])
    out, wide = hashes.astype(np.uint64), 1
    for bit in f"{width:b}"[1:]:
        out, wide = out[:-wide] * np.uint64(pow(digit, wide, 1 << 64)) + out[wide:], 2 * wide
        if bit == "1":
            out, wide = out[:-1] * np.uint64(digit) + hashes[wide:], wide + 1
    out ^= out >> np.uint64(31)
    out *= np.uint64(0x94D049BB133111EB)
    return out ^ (out >> np.uint64(29))


def anchors(hashes: np.ndarray, settings: Settings) -> np.ndarray:
    """For every window the smallest hash of the short windows it contains."""
    least, wide, span = rolled(hashes, settings.anchor), 1, settings.width - settings.anchor + 1
    if len(least) < span:
        return np.zeros(0, np.uint64)
    while wide < span:
        step = min(wide, span - wide)
        least, wide = np.minimum(least[:-step], least[step:]), wide + step
    return least


def _places(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, text) of every window that lies within one text."""
    text = words.text_of
    at = np.flatnonzero(text[: max(len(text) - width + 1, 0)] == text[width - 1 :])
    return at, text[at]


def _distinct(text: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Places of the first of each value in each text."""
    order = np.lexsort((value, text))
    new = np.ones(len(order), bool)
    new[1:] = (text[order][1:] != text[order][:-1]) | (value[order][1:] != value[order][:-1])
    return order[new]


def _repeated(text: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Places of values that stand earlier in the same text."""
    # Most values are alone. A sorted copy shows the others; which of them are of one text is looked at then.
    mark = value ^ mixed(text.astype(np.uint64) + np.uint64(1))
    ordered = np.sort(mark)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return np.zeros(0, np.int64)
    at = np.flatnonzero(twice[np.minimum(np.searchsorted(twice, mark), len(twice) - 1)] == mark)
    return np.delete(at, _distinct(text[at], value[at]))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, part, text): ``part`` tells apart the rows without an id."""
    rows = only(docs, id=id_col, text=text_col)
    return rows.select("id", F.when(F.col("id").isNull(), F.xxhash64("text")).otherwise(0).alias("part"), "text")


def _same(left: str, right: str) -> list:
    return [F.col(f"{left}.id").eqNullSafe(F.col(f"{right}.id")), F.col(f"{left}.part") == F.col(f"{right}.part")]


def copies(rows: DataFrame) -> DataFrame:
    """(id, part, text_hash) of the texts that a smaller id holds whole."""
    hashed = rows.filter("text IS NOT NULL").select(
        "id", "part", F.xxhash64("text").alias("text_hash"), F.xxhash64(F.lit(1), "text").alias("check")
    )
    first = materialise(
        hashed.groupBy("text_hash", "check").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"))
        .filter("n > 1 AND first IS NOT NULL").drop("n"), "copied",
    )
    later = F.coalesce(F.col("id") > F.col("first"), F.lit(True))
    return hashed.join(first, ["text_hash", "check"]).filter(later).select("id", "part", "text_hash").distinct()


def _anchor_rows(rows: DataFrame, settings: Settings) -> DataFrame:
    """(id, part, text_hash, mark): each text's anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in in_pieces(batch.column("text")):
                cut = batch.slice(part.start, part.stop - part.start)
                words = words_of(*raw_texts(cut.column("text")))
                at, text = _places(words, settings.width)
                mark = anchors(words.hashes, settings)[at]
                # Windows side by side mostly have one anchor.
                turn = np.ones(len(at), bool)
                turn[1:] = (mark[1:] != mark[:-1]) | (text[1:] != text[:-1])
                mark, text = mark[turn], text[turn]
                own = _distinct(text, mark)
                kept = [cut.column(c).take(pa.array(text[own])) for c in ("id", "part", "text_hash")]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(mark[own].view(np.int64))], names=["id", "part", "text_hash", "mark"])

    schema = T.StructType([*rows.select("id", "part", "text_hash").schema, T.StructField("mark", T.LongType())])
    return rows.mapInArrow(run, schema)


def _window_rows(rows: DataFrame, settings: Settings) -> DataFrame:
    """(id, part, hash, check): each text's distinct windows whose anchor is listed in ``marks``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in in_pieces(batch.column("text")):
                cut = batch.slice(part.start, part.stop - part.start)
                words = words_of(*raw_texts(cut.column("text")))
                at, text = _places(words, settings.width)
                # Every text lists those of its anchors that occur elsewhere: what one of them lists, all that have it do.
                listed = np.unique(cut.column("marks").flatten().to_numpy(zero_copy_only=False).view(np.uint64))
                mark = anchors(words.hashes, settings)[at]
                if len(listed):
                    met = listed[np.minimum(np.searchsorted(listed, mark), len(listed) - 1)] == mark
                else:
                    met = np.zeros(len(mark), bool)
                at, text = at[met], text[met]
                hash_ = rolled(words.hashes, settings.width)[at]
                own = _distinct(text, hash_)
                check = rolled(words.hashes, settings.width, 1)[at[own]] >> np.uint64(33)
                kept = [cut.column(c).take(pa.array(text[own])) for c in ("id", "part")]
                made = [pa.array(hash_[own].view(np.int64)), pa.array(check.astype(np.int32))]
                yield pa.RecordBatch.from_arrays([*kept, *made], names=["id", "part", "hash", "check"])

    schema = T.StructType([*rows.select("id", "part").schema, T.StructField("hash", T.LongType()), T.StructField("check", T.IntegerType())])
    return rows.mapInArrow(run, schema)


def earlier_windows(rows: DataFrame, copied: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(id, part, hashes): windows of a document that a smaller id holds too."""
    hashed = rows.filter("text IS NOT NULL").withColumn("text_hash", F.xxhash64("text"))
    marks = materialise(_anchor_rows(hashed, settings), "anchors")
    # A mark in copies of one text only says nothing, however often: the copies are dealt with, and so are repeats within it.
    repeated = materialise(
        marks.groupBy("mark").agg(F.min("text_hash").alias("lo"), F.max("text_hash").alias("hi")).filter("lo <> hi").select("mark"),
        "repeated-anchors",
    )
    asked = marks.join(repeated, "mark", "left_semi").groupBy("id", "part", "text_hash").agg(F.collect_list("mark").alias("marks"))
    asked = asked.alias("x").join(
        copied.alias("c"), [*_same("x", "c"), F.col("x.text_hash") == F.col("c.text_hash")], "left_anti"
    )
    asked = materialise(asked, "asked")
    met = hashed.alias("d").join(
        asked.alias("x"), [*_same("d", "x"), F.col("d.text_hash") == F.col("x.text_hash")]
    ).select("d.id", "d.part", "d.text", "x.marks")
    windows = materialise(_window_rows(met, settings), "windows")
    first = materialise(
        windows.groupBy("hash", "check").agg(
            F.min("id").alias("first"), F.max("id").alias("last"), F.max(F.col("id").isNull()).alias("unnamed")
        ).filter("first IS NOT NULL AND (first < last OR unnamed)").select("hash", "check", "first"), "repeated-windows",
    )
    later = F.coalesce(F.col("id") > F.col("first"), F.lit(True))
    return windows.join(first, ["hash", "check"]).filter(later).groupBy("id", "part").agg(
        F.collect_set("hash").alias("hashes")
    )


_CUT = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("spans", T.ArrayType(T.StructType([
        T.StructField("from_word", T.IntegerType()), T.StructField("to_word", T.IntegerType()),
    ]))),
    T.StructField("kept_text", T.StringType()),
])


def cut(texts: pa.Array, earlier: pa.Array, copied: pa.Array, settings: Settings = Settings()) -> pa.Array:
    """Of each text (words, removed spans [from, to), kept words joined by blanks), as ``_CUT``."""
    raw, edges = raw_texts(texts)
    words = words_of(raw, edges)
    first = words.first
    n = np.diff(first)
    at, text = _places(words, settings.width)
    window = rolled(words.hashes, settings.width)[at]
    gone = np.zeros(len(at), bool)
    gone[_repeated(text, window)] = True
    bounds = np.searchsorted(text, np.arange(len(n) + 1))
    for i in np.flatnonzero(pc.fill_null(pc.list_value_length(earlier), 0).to_numpy(zero_copy_only=False)).tolist():
        own = slice(bounds[i], bounds[i + 1])
        gone[own] |= np.isin(window[own].view(np.int64), earlier[i].values.to_numpy(zero_copy_only=False))
    turns = np.zeros(len(words.hashes) + 1, np.int64)
    starts = at[gone]
    turns[starts] += 1
    turns[starts + settings.width] -= 1
    covered = np.cumsum(turns[:-1]) > 0
    whole = copied.to_numpy(zero_copy_only=False).astype(bool) & (n >= settings.width)
    covered |= np.repeat(whole, n)
    opens, closes = covered.copy(), covered.copy()
    # Spans end with their text.
    inner = first[(first > 0) & (first < len(covered))]
    opens[1:] &= ~covered[:-1]
    opens[inner] = covered[inner]
    closes[:-1] &= ~covered[1:]
    closes[inner - 1] = covered[inner - 1]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    base = first[np.searchsorted(first, start, "right") - 1]
    spans = pa.ListArray.from_arrays(
        pa.array(np.searchsorted(start, first).astype(np.int32)),
        pa.StructArray.from_arrays([pa.array((x - base).astype(np.int32)) for x in (start, end)], ["from_word", "to_word"]),
    )
    blob, kept = raw.tobytes(), []
    touched = np.add.reduceat(np.append(covered, False), first[:-1]) * (n > 0) if len(n) else n
    for i, (a, b, hit) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist(), touched.tolist(), strict=True)):
        found = blob[a:b].split()
        kept.append(b" ".join(compress(found, (~covered[first[i] : first[i + 1]]).tolist()) if hit else found))
    return pa.StructArray.from_arrays([pa.array(n, pa.int64()), spans, pa.array(kept, pa.string())], _CUT.fieldNames())


def without_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()
) -> tuple[DataFrame, str]:
    """All rows and columns plus a struct (n_words, spans, kept_text), whose name is returned too."""
    rows = _keyed(docs, id_col, text_col)
    copied = materialise(copies(rows), "copies")
    earlier = earlier_windows(rows, copied, settings)

    @F.arrow_udf(_CUT)
    def cutting(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for columns in batches:
            parts = [[c.slice(p.start, p.stop - p.start) for c in columns] for p in in_pieces(columns[0])]
            yield pa.concat_arrays([cut(*part, settings) for part in parts] or [cut(*columns, settings)])

    name = fresh(docs, "cut")
    own = docs.select(F.struct(*map(quoted, docs.columns)).alias("row"), quoted(id_col).alias("id"), quoted(text_col).alias("text"))
    own = own.withColumn("part", F.when(F.col("id").isNull(), F.xxhash64("text")).otherwise(0))
    met = own.alias("d").join(earlier.alias("e"), _same("d", "e"), "left").select("d.*", "e.hashes")
    met = met.alias("d").join(
        copied.withColumn("whole", F.lit(True)).alias("c"),
        [*_same("d", "c"), F.xxhash64("d.text") == F.col("c.text_hash")], "left",
    ).select("row", "d.text", "hashes", F.coalesce("whole", F.lit(False)).alias("whole"))
    done = met.select("row", cutting("text", "hashes", "whole").alias(name))
    return done.select(*[F.col("row").getField(c).alias(c) for c in docs.columns], name), name


# The same in SQL for a table documents(doc_id, text) with unique ids.
ORACLE_SQL = r"""
WITH split AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), places AS (
  SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS i FROM split
), windows AS (
  SELECT doc_id, i, array_to_string(words[i : i + 19], ' ') AS content FROM places WHERE i + 19 <= len(words)
), later AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, row_number() OVER (PARTITION BY content ORDER BY doc_id, i) AS nth FROM windows
  ) WHERE nth > 1
), gone AS (
  SELECT DISTINCT doc_id, i + o AS i FROM later, range(20) AS t(o)
), cut AS (
  SELECT p.doc_id, count(*) AS n_words, count(g.i) AS n_removed,
    coalesce(string_agg(p.words[p.i], ' ' ORDER BY p.i) FILTER (g.i IS NULL), '') AS kept
  FROM places p LEFT JOIN gone g ON p.doc_id = g.doc_id AND p.i = g.i GROUP BY p.doc_id
)
SELECT d.doc_id, coalesce(c.n_words, 0) AS n_words, coalesce(c.n_removed, 0) AS n_removed,
  sha256(coalesce(c.kept, '')) AS kept_sha256
FROM documents d LEFT JOIN cut c ON d.doc_id = c.doc_id
"""
