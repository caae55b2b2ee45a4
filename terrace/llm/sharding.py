"""Sharding: a reproducible shuffle whose shard and slot are computed, not drawn.

Rows are numbered 0..n-1 in the order of their id. A keyed Feistel permutation moves
number to place; place p is slot p // shards of shard p % shards. Shards differ by at
most one row, slots have no gaps, and where a row went can be computed from its number
alone, forwards and backwards.

Fixed cases: null ids come last; rows with one id are ordered by a hash of their other
columns, and rows equal in everything are interchangeable; a null text counts as empty;
an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm.common import fresh, only, quoted
from terrace.llm.feistel import Permutation
from terrace.sources.tables import materialise

_POSITION_BITS = 33


def numbered(df: DataFrame, order_by: str, name: str) -> tuple[DataFrame, int]:
    """(rows with a dense number from 0 in the order of a column, number of rows).

    Sorted ranges are stored once; each row's place in its range plus the sizes of the
    ranges before it is its number. No task sees more than one range.
    """
    at, start = fresh(df, "at"), fresh(df, "start")
    ranged = df.sort(quoted(order_by).asc_nulls_last(), F.xxhash64(*map(quoted, df.columns))).withColumn(
        at, F.monotonically_increasing_id()
    )
    placed = materialise(ranged, "numbered")
    part = fresh(placed, "part")
    placed = placed.withColumn(part, F.shiftright(at, _POSITION_BITS))
    # One row per range, i.e. at most one per shuffle partition.
    sizes = placed.groupBy(part).agg(F.count(F.lit(1)).alias(start))
    total = sizes.agg(F.sum(start)).first()[0] or 0
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(part, F.coalesce(F.sum(start).over(before), F.lit(0)).alias(start))
    place = F.col(at) - F.shiftleft(F.col(part), _POSITION_BITS)
    return placed.join(F.broadcast(starts), part).select(
        *map(quoted, df.columns), (F.col(start) + place).alias(name)
    ), total


def shuffle_rows(df: DataFrame, shards: int, key: str, id_col: str = "doc_id") -> DataFrame:
    """All rows and columns of ``df`` plus ``shard`` and ``slot``.

    Pass only the columns wanted: whatever is passed is moved once.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    clash = {"shard", "slot"} & {c.lower() for c in df.columns}
    if clash:
        raise ValueError(f"input already has columns {sorted(clash)}")
    number = fresh(df, "number")
    rows, total = numbered(df, id_col, number)
    place = fresh(df, "place")
    return (
        rows.withColumn(place, Permutation(total, key).of(F.col(number)))
        .withColumn("shard", (F.col(place) % shards).cast("int"))
        .withColumn("slot", F.floor(F.col(place) / shards))
        .drop(number, place)
    )


def write_shards(df: DataFrame, path: str, shards: int, key: str, id_col: str = "doc_id") -> None:
    """Whole rows as Parquet, one folder per shard, each file in slot order.

    A shard is cut into ranges of slots by its size, so no task takes a whole large shard.
    """
    placed = shuffle_rows(df, shards, key, id_col)
    (
        placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard").parquet(path)
    )


def text_sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, size, text_crc32): UTF-8 bytes plus 8 for the id, and the text's checksum."""
    text = F.coalesce("text", F.lit(""))
    return only(docs, id=id_col, text=text_col).select(
        F.col("id").alias(id_col),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
    )
