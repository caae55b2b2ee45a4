"""Duplicate handling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace import config


def first_per_key(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """Keep the first row of each key.

    Spark recognises the ``= 1`` filter and drops all but one row per key inside
    every task before the shuffle, so a hot key costs one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def keep_first(df: DataFrame, keys: list[str]) -> DataFrame:
    """Drop later rows of a repeated key, in file order."""
    return first_per_key(df, keys, [config.POSITION])


def duplicated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, copies) of every key that occurs more than once; null is a value."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def has_duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: does any key repeat?"""
    return duplicated_keys(df, keys).limit(1).agg((F.count(F.lit(1)) > 0).alias("has_duplicates"))


def duplicated_rows(df: DataFrame, key: str) -> DataFrame:
    """Every row whose key occurs more than once, nulls included."""
    return _rows_of(df, duplicated_keys(df, [key]).select(key), key)


def first_duplicated_rows(df: DataFrame, key: str, rows: int, then: list[str]) -> DataFrame:
    """The first ``rows`` rows, by key, among those whose key repeats.

    A repeated key has two rows at least, so the smallest ``rows`` keys already
    cover the answer; only those few are joined back.
    """
    smallest = duplicated_keys(df, [key]).select(key).orderBy(F.col(key).asc_nulls_last()).limit(rows)
    # At most ``rows`` keys.
    found = df.join(F.broadcast(smallest), df[key].eqNullSafe(smallest[key]), "left_semi")
    return found.orderBy(F.col(key).asc_nulls_last(), *then).limit(rows)


def _rows_of(df: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    from terrace.operators.joins import balanced_join

    # A struct around the key: two empty ones are equal, so the null group needs no flag, and the
    # value keeps its type, with zeros of either sign and all NaNs equal as in the grouping.
    match = F.struct(F.col(key).alias("key")).alias("_match")
    return balanced_join(df.select("*", match), wanted.select(match), "_match", "left_semi").select(*df.columns)
