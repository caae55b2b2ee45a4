"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import wraps

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Words are runs of anything but these six ASCII blanks: [^\x20\x09-\x0D]+.
# bytes.split() without arguments cuts at exactly these.
BLANKS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# So many rows travel to or from a Python worker at once.
_BATCH_ROWS = 500
_BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


def in_short_batches(query: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A query over texts, its first argument the session, which from then on sends short Arrow batches.

    Spark's own 10,000 rows of long texts are held several times over by the executor and each of its
    workers. A smaller limit set by the user stays.
    """

    @wraps(query)
    def run(spark: SparkSession, *args, **options) -> DataFrame:
        if not 0 < int(spark.conf.get(_BATCH_CONF)) <= _BATCH_ROWS:
            spark.conf.set(_BATCH_CONF, str(_BATCH_ROWS))
        return query(spark, *args, **options)

    return run


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have, whatever its case."""
    taken = {name.lower() for name in df.columns}
    name = stem
    while name.lower() in taken:
        name += "_"
    return name


def quoted(name: str) -> Column:
    """Column of exactly this name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def only(docs: DataFrame, **names: str) -> DataFrame:
    """Just the named input columns, under the operator's own names: ``only(docs, id="doc_id")``.

    What else a table holds can then clash with nothing.
    """
    return docs.select(*[quoted(name).alias(own) for own, name in names.items()])


def bounded(rows: DataFrame, most: int, picked_by: list[Column], order: list[str]) -> DataFrame:
    """The ``most`` rows with the smallest hashes of ``picked_by``; ties go by ``order``.

    A threshold read off the number of rows lets few more than that many pass each scan, so what
    is ordered, and what the tasks send on, does not grow with the rows or with the partitions.
    """
    total = rows.count()
    place = F.xxhash64(*picked_by)
    near = rows
    if total > 2 * most:
        # A margin of eight standard deviations and more.
        share = (most + 8 * most**0.5 + 64) / total
        near = rows.filter(place < F.lit(int(share * 2**64) - 2**63))
        if near.limit(most).count() < most:
            near = rows
    return near.orderBy(place, *order).limit(most)


def word_list(text: str | None) -> list[bytes]:
    return text.encode().split() if text else []


def pieces(rows: int, sizes: list[int], limit: int) -> Iterator[slice]:
    """Consecutive slices of at most ``limit`` summed size (or a single larger row)."""
    start, total = 0, 0
    for i in range(rows):
        if i > start and total + sizes[i] > limit:
            yield slice(start, i)
            start, total = i, 0
        total += sizes[i]
    if rows > start:
        yield slice(start, rows)


def small(batches: Iterator[pd.Series], rows: int = 500, chars: int = 2_000_000) -> Iterator[pd.Series]:
    """The same texts in short batches, by rows and by characters: what is made of them leaves the worker sooner."""
    for batch in batches:
        for part in pieces(len(batch), [chars // rows + len(t or "") for t in batch], chars):
            yield batch.iloc[part]


def crc32_sql(number: str) -> str:
    """DuckDB expression of crc32 over a number's decimal digits, bit by bit: DuckDB has no such function."""
    bits = f"flatten([[ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0] for c in string_split(({number})::VARCHAR, '')])"
    step = "xor(xor(x, v) >> 1, (xor(x, v) & 1) * 3988292384::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {bits}), lambda x, v: {step}), 4294967295::BIGINT)"


_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


# Every byte value has a random 64-bit number; a word is the polynomial of its bytes' numbers.
_BYTES = np.random.default_rng(71).integers(0, 2**64, 256, np.uint64)
_BASE = 0x9E3779B97F4A7C15 | 1
_BLANK = np.zeros(256, bool)
_BLANK[[ord(c) for c in BLANKS]] = True
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers_up_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, as many as the longest text so far needed."""
    if len(_powers[0]) < n:
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(2 * n, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


@dataclass(frozen=True)
class Words:
    """The words of texts that lie one after the other: where each starts and ends, its 64-bit hash, and the texts' first words."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray

    @property
    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def words_of(raw: np.ndarray, edges: np.ndarray) -> Words:
    """All words at once of the texts ``raw[edges[i]:edges[i + 1]]``, bytes in UTF-8."""
    word = ~_BLANK[raw]
    cut = edges[(edges > 0) & (edges < len(raw))]
    opens, closes = word.copy(), word.copy()
    opens[1:] &= ~word[:-1]
    opens[cut] = word[cut]
    closes[:-1] &= ~word[1:]
    closes[cut - 1] = word[cut - 1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    up, down = _powers_up_to(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTES[raw] * up[: len(raw)], out=sums[1:])
    # Shifted to the word's own start, so that a word hashes alike wherever it stands.
    hashes = mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    return Words(starts, ends, hashes, np.searchsorted(starts, edges))


def raw_texts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, edges) of an Arrow column of texts, not copied; a null has no bytes."""
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    _, places, data = texts.buffers()
    edges = np.frombuffer(places, np.int64, len(texts) + 1, texts.offset * 8) if places else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[edges[0] : edges[-1]] if data else np.zeros(0, np.uint8)
    return raw, edges - edges[0]


# Texts are hashed together up to so many bytes: what is made of them fits a processor's cache.
_BYTES_AT_ONCE = 1 << 18


def in_pieces(texts: pa.Array) -> Iterator[slice]:
    return pieces(len(texts), pc.fill_null(pc.binary_length(texts), 0).to_pylist(), _BYTES_AT_ONCE)


def _shingles(h: np.ndarray, width: int) -> np.ndarray:
    n = len(h) - width + 1
    joined = np.full(n, width, np.uint64)
    for k in range(width):
        joined = mixed(joined * np.uint64(0x9E3779B97F4A7C15) + h[k : k + n])
    return joined


def shingle_sets(texts: Iterable[str | None], width: int) -> Iterator[np.ndarray]:
    """Of each text the sorted distinct hashes of its shingles; A-Z count as a-z."""
    coded = [t.encode().lower() if t else b"" for t in texts]
    for part in pieces(len(coded), [len(c) for c in coded], _BYTES_AT_ONCE):
        edges = np.cumsum([0, *map(len, coded[part])])
        words = words_of(np.frombuffer(b"".join(coded[part]), np.uint8), edges)
        joined = _shingles(words.hashes, width) if len(words.hashes) >= width else None
        for start, end in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
            if end - start >= width:
                found = joined[start : end - width + 1]
                found.sort()
                # Not a view: a set that is kept shall not keep all of them.
                yield found[np.concatenate([[True], found[1:] != found[:-1]])]
            else:
                yield _shingles(words.hashes[start:end], end - start) if end > start else np.zeros(0, np.uint64)
