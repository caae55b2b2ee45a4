"""Token ids as binary shards in training order.

The documents of each part of the scan make one stream of ids, each document followed by an end
id, cut into sequences of one length. Every sequence has a number: its place in its part, behind
room for all sequences that earlier parts could hold (a text has no more ids than bytes). A keyed
Feistel permutation with cycle walking over all these numbers gives each sequence its place in
training order; equal ranges of places are the shards. So texts are encoded once and every
sequence goes straight to the task that writes its shard, in order, as rows of fixed stride. A
sequence's global slot is its rank: the rows of earlier shards, which one short index lists, and
its row. A trainer reads shards front to back and resumes at any slot with a seek.

Every write goes to an attempt folder of its own and is committed when all its files are there, so
a shorter rewrite leaves no stale shard behind and a reader never sees half of one. A part or shard
lost with its executor is computed again just as it was: numbers depend on the part and the key
alone. Two bounds (parts, bytes of the largest) reach the driver, and one index row per shard.

Fixed cases: a null text adds nothing and an empty one only the end id; ids of documents may be
null or repeated and are only reported; the last sequence of a part is filled up with the end id;
an empty table gives no shards; texts of any length span as many sequences as they need; other
columns, whatever their names, are not looked at.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.llm.common import only
from terrace.llm.feistel import Permutation
from terrace.sources.tables import commit, materialise, new_attempt

# Fixed value: the pattern that parts a text before the merges of the public rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@dataclass(frozen=True)
class RankFile:
    """Byte-level BPE from a file of base64 tokens and ranks; the first free id ends documents."""

    ranks: bytes
    pattern: str = PATTERN

    @property
    def end(self) -> int:
        return _encoding(self)[1]

    def encode(self, text: str) -> np.ndarray:
        return np.asarray(_encoding(self)[0].encode_ordinary(text), np.uint32)


@lru_cache(maxsize=2)
def _encoding(spec: RankFile):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, spec.ranks.splitlines()) if a}
    return tiktoken.Encoding("ranks", pat_str=spec.pattern, mergeable_ranks=ranks, special_tokens={}), max(ranks.values()) + 1


@dataclass(frozen=True)
class Settings:
    """A shard has about ``shard_bytes``: it is a range of places, and how many are taken varies a little."""

    key: str = "training order"
    length: int = 1024
    shard_bytes: int = 16 << 20
    wide: bool = False

    @property
    def dtype(self) -> np.dtype:
        return np.dtype("<u4" if self.wide else "<u2")

    @property
    def stride(self) -> int:
        return self.length * self.dtype.itemsize

    @property
    def rows(self) -> int:
        return max(1, self.shard_bytes // self.stride)


MANIFEST = T.StructType([
    T.StructField("slot", T.LongType()),
    T.StructField("shard", T.IntegerType()),
    T.StructField("byte_offset", T.LongType()),
    T.StructField("sequence", T.LongType()),
    T.StructField("first_doc", T.StringType()),
    T.StructField("n_tokens", T.IntegerType()),
    T.StructField("crc32", T.LongType()),
])

_ROW = pa.schema([
    ("shard", pa.int32()), ("place", pa.int64()), ("sequence", pa.int64()), ("first_doc", pa.string()),
    ("n_tokens", pa.int32()), ("ids", pa.binary()),
])
_WRITTEN = "shard int, row long, sequence long, first_doc string, n_tokens int, crc32 long"
# Sequences cut, and sent on, at once.
_SEQUENCES = 256
# Ids are fewer than bytes; for the number of shards a third is a fair guess.
_BYTES_PER_ID = 3


def shard_name(attempt: str, shard: int) -> str:
    return f"{attempt}/shard-{shard:06d}.bin"


def _place(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def _stream(batches: Iterator[pa.RecordBatch], encoder: RankFile) -> Iterator[tuple[object, np.ndarray]]:
    end = np.array([encoder.end], np.uint32)
    for batch in batches:
        for doc, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            if text is not None:
                yield doc, np.concatenate([encoder.encode(text), end]) if text else end


def _sequences(
    stream: Iterator[tuple[object, np.ndarray]], settings: Settings, end: int
) -> Iterator[tuple[np.ndarray, list[str | None], np.ndarray]]:
    """(rows of ids, the document each begins in, ids that are not filling) of a part's stream."""
    length, held, size = settings.length, [], 0
    starts, docs = [], []

    def cut(last: bool) -> tuple[np.ndarray, list[str | None], np.ndarray]:
        nonlocal held, size, starts, docs
        flat = np.concatenate(held).astype(settings.dtype)
        full = -(-size // length) if last else size // length
        block = np.full(full * length, end, settings.dtype)
        block[: min(size, len(block))] = flat[: len(block)]
        at = np.searchsorted(starts, np.arange(full) * length, side="right") - 1
        firsts = [docs[i] for i in at.tolist()]
        tokens = np.minimum(length, size - np.arange(full) * length)
        # What is left over goes on, and so does the document it lies in.
        held, size = [flat[len(block) :]], max(size - len(block), 0)
        keep = int(np.searchsorted(starts, len(block), side="right")) - 1
        starts, docs = [max(x - len(block), 0) for x in starts[keep:]], docs[keep:]
        return block.reshape(full, length), firsts, tokens

    for doc, ids in stream:
        starts.append(size)
        docs.append(None if doc is None else str(doc))
        held.append(ids)
        size += len(ids)
        if size >= _SEQUENCES * length:
            yield cut(False)
    if size:
        yield cut(True)


def _emitted(encoder: RankFile, settings: Settings, room: int, order: Permutation, shards: int):
    """Every sequence of a part with its shard and its place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack, number = zstandard.ZstdCompressor(level=1), TaskContext.get().partitionId() * room
        last = number + room
        for block, firsts, tokens in _sequences(_stream(batches, encoder), settings, encoder.end):
            numbers = number + np.arange(len(block))
            number += len(block)
            if number > last or number > order.n:
                raise RuntimeError("the scan was parted otherwise than when its parts were measured")
            places = order.forward(numbers)
            shard = [place * shards // order.n for place in places.tolist()]
            yield pa.RecordBatch.from_arrays([
                pa.array(shard, pa.int32()), pa.array(places), pa.array(numbers), pa.array(firsts, pa.string()),
                pa.array(tokens, pa.int32()), pa.array([pack.compress(row.tobytes()) for row in block], pa.binary()),
            ], schema=_ROW)

    return run


def _write(attempt: str):
    """Sequences in order of place, shard by shard, to files; gives what the manifest needs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack, shard, row, out, names = zstandard.ZstdDecompressor(), None, 0, None, None

        def close() -> None:
            # A retried or doubled task writes the same bytes; a reader never sees half a file.
            out.close()
            names[0].move(names[1], names[2])

        for batch in batches:
            rows, sums = [], []
            for number, packed in zip(batch.column("shard").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if number != shard:
                    if shard is not None:
                        close()
                    store, name = _place(shard_name(attempt, number))
                    names = store, f"{name}.{np.random.default_rng().integers(1 << 62):x}", name
                    store.create_dir(name.rpartition("/")[0], recursive=True)
                    shard, row, out = number, 0, store.open_output_stream(names[1])
                raw = unpack.decompress(packed)
                out.write(raw)
                rows.append(row)
                sums.append(zlib.crc32(raw))
                row += 1
            yield pa.RecordBatch.from_arrays([
                batch.column("shard"), pa.array(rows, pa.int64()), batch.column("sequence"), batch.column("first_doc"),
                batch.column("n_tokens"), pa.array(sums, pa.int64()),
            ], names=["shard", "row", "sequence", "first_doc", "n_tokens", "crc32"])
        if shard is not None:
            close()

    return run


def permutation(parts: int, room: int, settings: Settings) -> Permutation:
    """The order of all numbers that ``parts`` parts with ``room`` sequences each can have."""
    return Permutation(max(1, parts * room), settings.key)


def write_shards(
    docs: DataFrame, path: str, encoder: RankFile, id_col: str = "doc_id", text_col: str = "text",
    settings: Settings = Settings(), stored: bool = False,
) -> DataFrame:
    """Write the shards as a new attempt below ``path``, commit it and return its manifest, also kept there.

    ``stored`` says that ``docs`` is read from files as it is; anything else is stored
    first, so that its parts are the same when they are measured and when they are encoded.
    """
    if encoder.end >= np.iinfo(settings.dtype).max:
        raise ValueError("ids do not fit the shards' type")
    rows = only(docs, id=id_col, text=text_col)
    rows = rows if stored else materialise(rows, "ordered")
    spark = rows.sparkSession
    bytes_ = F.coalesce(F.octet_length("text") + 1, F.lit(0)).cast("long")
    per_part = rows.groupBy(F.spark_partition_id().alias("part")).agg(F.sum(bytes_).alias("n"))
    # Two bounds and a sum, whatever the number of parts.
    parts, most, total = per_part.agg(
        F.coalesce(F.max("part") + 1, F.lit(0)), F.coalesce(F.max("n"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))
    ).first()
    room = -(-most // settings.length)
    order = permutation(parts, room, settings)
    shards = max(1, -(-total // (_BYTES_PER_ID * settings.length * settings.rows)))
    attempt = new_attempt(path)
    placed = rows.mapInArrow(_emitted(encoder, settings, room, order, shards), _schema())
    dealt = placed.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "place")
    written = f"{attempt}/rows"
    dealt.mapInArrow(_write(attempt), _WRITTEN).write.parquet(written)
    done = spark.read.schema(_WRITTEN).parquet(written)
    # One row per shard.
    sizes = done.groupBy("shard").agg(F.count(F.lit(1)).alias("rows"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    index = sizes.select("shard", "rows", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("first_slot"))
    index.coalesce(1).write.parquet(f"{attempt}/index")
    starts = spark.read.schema("shard int, rows long, first_slot long").parquet(f"{attempt}/index")
    manifest = done.join(F.broadcast(starts), "shard").select(
        (F.col("first_slot") + F.col("row")).alias("slot"), "shard", (F.col("row") * settings.stride).alias("byte_offset"),
        "sequence", "first_doc", "n_tokens", "crc32",
    )
    manifest.write.parquet(f"{attempt}/manifest")
    commit(spark, attempt)
    return spark.read.schema(MANIFEST).parquet(f"{attempt}/manifest")


def _schema() -> T.StructType:
    return T.StructType([
        T.StructField("shard", T.IntegerType()), T.StructField("place", T.LongType()), T.StructField("sequence", T.LongType()),
        T.StructField("first_doc", T.StringType()), T.StructField("n_tokens", T.IntegerType()), T.StructField("ids", T.BinaryType()),
    ])


def current(path: str) -> str | None:
    """The committed attempt below ``path``, as a trainer without Spark finds it."""
    store, folder = _place(path)
    found = store.get_file_info(fs.FileSelector(f"{folder}/_commits", allow_not_found=True))
    names = sorted(info.base_name for info in found if not info.base_name.startswith("."))
    return f"{path}/attempt={names[-1].partition('-')[2]}" if names else None


def read_slots(path: str, first: int, count: int, settings: Settings = Settings()) -> Iterator[np.ndarray]:
    """Sequences in slot order from any slot on: one seek, then reading straight on."""
    attempt = current(path)
    if attempt is None:
        return
    store, folder = _place(f"{attempt}/index")
    index = pq.read_table(folder, filesystem=store, columns=["shard", "rows", "first_slot"]).sort_by("shard").to_pylist()
    for entry in index:
        skip = first - entry["first_slot"]
        if count <= 0 or skip >= entry["rows"]:
            continue
        store, name = _place(shard_name(attempt, entry["shard"]))
        with store.open_input_file(name) as file:
            rows = min(count, entry["rows"] - skip)
            file.seek(skip * settings.stride)
            for _ in range(rows):
                yield np.frombuffer(file.read(settings.stride), settings.dtype)
        first, count = first + rows, count - rows
