"""Reconnaissance on any table: column profile, previews, key differences."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace import config
from terrace.operators.union import union_all

# Longer text is compared by its SHA-256, which keeps shuffled keys narrow.
_LONG_TEXT = 64


def profile(df: DataFrame, table: str) -> DataFrame:
    """One row per column: type, table shape, nulls, distinct values.

    One scan and one exchange of values, however many columns there are. A row becomes a pair
    (column number, value as text) per column; pairs are counted within each task before they are
    dealt by both, so a common value travels as one row per task, no column meets in one place
    and no task holds the set of values of a column. Values are told apart as their type does:
    zeros of either sign are one value, and long text is compared by its SHA-256.
    """
    columns = [name for name in df.columns if name != config.POSITION]
    types = dict(df.dtypes)
    if not columns:
        return df.sparkSession.createDataFrame([], _PROFILE)

    def text(name: str) -> Column:
        value = F.col(f"`{name}`")
        if types[name] == "string":
            return F.when(F.length(value) > _LONG_TEXT, F.concat(F.lit("h"), F.sha2(value, 256))).otherwise(F.concat(F.lit("v"), value))
        # Adding zero makes -0.0 positive.
        return (value + F.lit(0).cast(types[name]) if types[name] in ("double", "float") else value).cast("string")

    pairs = df.select(F.posexplode(F.array(*[text(name) for name in columns])).alias("_no", "_value"))
    counted = pairs.groupBy("_no", "_value").agg(F.count(F.lit(1)).alias("_n")).groupBy("_no").agg(
        F.sum("_n").alias("rows"),
        F.coalesce(F.sum(F.when(F.col("_value").isNull(), F.col("_n"))), F.lit(0)).alias("nulls"),
        F.count("_value").alias("distinct_values"),
    )
    # One short row per column, joined so that a table without rows has its columns too.
    named = df.sparkSession.createDataFrame(
        [(i, table, name, types[name], len(columns)) for i, name in enumerate(columns)],
        "_no int, table string, column string, type string, columns int",
    )
    zero = F.lit(0).cast("long")
    return named.join(counted, "_no", "left").select(
        "table", "column", "type", "columns", *[F.coalesce(c, zero).alias(c) for c in ("rows", "nulls", "distinct_values")]
    )


_PROFILE = "table string, column string, type string, columns int, rows long, nulls long, distinct_values long"


def approximate_profile(df: DataFrame, table: str) -> DataFrame:
    """The same profile with sketched distinct counts: one scan and no shuffle of values."""
    columns = [c for c in df.columns if c != config.POSITION]
    types = dict(df.dtypes)
    counted = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"_nulls_{i}") for i, c in enumerate(columns)],
        *[F.approx_count_distinct(c).alias(f"_distinct_{i}") for i, c in enumerate(columns)],
    )
    return counted.select(F.inline(F.array(*[
        F.struct(
            F.lit(table).alias("table"), F.lit(c).alias("column"),
            F.lit(types[c]).alias("type"), F.lit(len(columns)).alias("columns"),
            F.col("_rows").alias("rows"), F.col(f"_nulls_{i}").alias("nulls"),
            F.col(f"_distinct_{i}").alias("distinct_values"),
        )
        for i, c in enumerate(columns)
    ])))


def preview(df: DataFrame, rows: int, order: list[str]) -> DataFrame:
    """First rows in a stated order (a parallel top-n, not a full sort)."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in order]).limit(rows)


class KeyPair(NamedTuple):
    """Two columns whose sets of values should agree."""

    pair: str
    left: DataFrame
    left_key: str | Column
    right: DataFrame
    right_key: str | Column


def key_differences(pairs: list[KeyPair]) -> DataFrame:
    """(pair, only_left, only_right): distinct keys found on one side only.

    Null counts as a key of its own. Both sides of a pair share one shuffle of
    keys in their native type; repeats collapse before it.
    """
    return union_all(_key_difference(pair) for pair in pairs)


def _key_difference(pair: KeyPair) -> DataFrame:
    def side(df: DataFrame, key: str | Column, is_left: bool) -> DataFrame:
        column = F.col(key) if isinstance(key, str) else key
        return df.select(column.alias("_key"), F.lit(is_left).alias("_left"))

    left = side(pair.left, pair.left_key, True)
    right = side(pair.right, pair.right_key, False)
    if left.schema["_key"].dataType != right.schema["_key"].dataType:
        left, right = (df.withColumn("_key", F.col("_key").cast("string")) for df in (left, right))
    seen = left.unionAll(right).groupBy("_key").agg(
        F.max("_left").alias("_in_left"), F.min("_left").alias("_only_left")
    )
    return seen.agg(
        F.lit(pair.pair).alias("pair"),
        F.count_if("_only_left").alias("only_left"),
        F.count_if(~F.col("_in_left")).alias("only_right"),
    )


def missing_members(df: DataFrame, key: str, lookup: DataFrame, lookup_key: str) -> DataFrame:
    """(key, rows) of the values that the lookup does not hold; null may match null.

    Rows are counted per value first, so the join sees every value once.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    known = lookup.select(F.col(lookup_key).alias("_known")).distinct()
    return counts.join(known, F.col(key).eqNullSafe(F.col("_known")), "left_anti")
