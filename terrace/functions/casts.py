"""Strict casts: they stop the job instead of passing bad values on."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strict_double(value: Column) -> Column:
    """Number or null; text that is not a number stops the job.

    The guard does not depend on the ANSI setting of the session.
    """
    number = value.try_cast("double")
    problem = F.concat(F.lit("not a number: "), value.cast("string"))
    return F.when(value.isNotNull() & number.isNull(), F.raise_error(problem)).otherwise(number)


def strict_int(value: Column, name: str) -> Column:
    """Whole number, fractions cut off; null and text that is no number stop the job."""
    number = value.try_cast("double").try_cast("int")
    problem = F.concat(
        F.lit(f"{name} must be a number, found: "),
        F.coalesce(value.cast("string"), F.lit("null")),
    )
    return F.when(number.isNull(), F.raise_error(problem)).otherwise(number)


def exact_sum(value: Column) -> Column:
    """Sum of doubles that does not depend on the order of addition, as a double.

    Amounts are added as decimals with twelve places and turned back at the end, so a run with
    other partitions gives the same bytes.
    """
    return F.sum(value.cast("decimal(28,12)")).cast("double")
