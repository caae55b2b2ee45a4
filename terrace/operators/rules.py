"""Declarative checks on a table.

All row-level rules of a table are evaluated in one aggregation over one scan.
Rules about repeated or foreign keys first count each key, with partial counts
before the shuffle, so a hot key travels as one row per task.

Every rule but ``NotNull`` ignores nulls; bounds are inclusive.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.operators.union import union_all

RESULT_COLUMNS = ("rule", "column", "checked", "unexpected", "failures", "unexpected_pct", "success")


@dataclass(frozen=True)
class RowRule:
    """A rule that one row can decide. ``mostly`` is the share that has to pass."""

    column: str
    mostly: float = 1.0
    name = "row_rule"

    def applies(self) -> Column:
        return F.col(self.column).isNotNull()

    def holds(self) -> Column:
        raise NotImplementedError


@dataclass(frozen=True)
class NotNull(RowRule):
    name = "not_null"

    def applies(self) -> Column:
        return F.lit(True)

    def holds(self) -> Column:
        return F.col(self.column).isNotNull()


@dataclass(frozen=True)
class InSet(RowRule):
    values: tuple[Any, ...] = ()
    name = "in_set"

    def holds(self) -> Column:
        return F.col(self.column).isin(*self.values)


@dataclass(frozen=True)
class Between(RowRule):
    low: float | None = None
    high: float | None = None
    name = "between"

    def holds(self) -> Column:
        value = F.col(self.column).try_cast("double")
        ok = F.lit(True)
        if self.low is not None:
            ok = ok & (value >= F.lit(float(self.low)))
        if self.high is not None:
            ok = ok & (value <= F.lit(float(self.high)))
        return ok


@dataclass(frozen=True)
class LengthEquals(RowRule):
    length: int = 0
    name = "length_equals"

    def holds(self) -> Column:
        return F.length(F.col(self.column)) == self.length


@dataclass(frozen=True)
class KeyRule:
    """A rule decided per distinct key; ``failures`` counts the offending keys."""

    columns: tuple[str, ...]

    @property
    def column(self) -> str:
        return ",".join(self.columns)

    def counted(self, df: DataFrame) -> DataFrame:
        """(keys, _rows, _bad) per key, nulls left out."""
        raise NotImplementedError

    def _counts(self, df: DataFrame) -> DataFrame:
        some = F.coalesce(*[F.col(c).cast("string") for c in self.columns]).isNotNull()
        return df.filter(some).groupBy(*self.columns).agg(F.count(F.lit(1)).alias("_rows"))


@dataclass(frozen=True)
class Unique(KeyRule):
    """No key twice; a key of several columns is skipped only when all are null."""

    @property
    def name(self) -> str:
        return "unique" if len(self.columns) == 1 else "compound_unique"

    def counted(self, df: DataFrame) -> DataFrame:
        return self._counts(df).withColumn("_bad", F.col("_rows") > 1)


@dataclass(frozen=True)
class AcceptedValues(KeyRule):
    """Like ``InSet``, but reports how many different values are wrong."""

    values: tuple[Any, ...] = ()
    name = "accepted_values"

    def counted(self, df: DataFrame) -> DataFrame:
        return self._counts(df).withColumn("_bad", ~F.col(self.columns[0]).isin(*self.values))


@dataclass(frozen=True)
class Relationship(KeyRule):
    """Every key exists in the parent; ``failures`` counts the child rows without one."""

    parent: DataFrame | None = None
    parent_column: str = ""
    name = "relationships"

    def counted(self, df: DataFrame) -> DataFrame:
        known = (
            self.parent.select(F.col(self.parent_column).alias(self.columns[0]))
            .distinct().withColumn("_known", F.lit(True))
        )
        return (
            self._counts(df).join(known, self.columns[0], "left")
            .withColumn("_bad", F.col("_known").isNull())
        )


Rule = RowRule | KeyRule


def _verdict(df: DataFrame, mostly: Column) -> DataFrame:
    share = (F.col("checked") - F.col("unexpected")) / F.col("checked")
    passed = F.when(F.col("checked") == 0, F.lit(True)).otherwise(share >= mostly)
    pct = F.when(F.col("checked") == 0, F.lit(0.0)).otherwise(
        F.round(F.col("unexpected") * 100.0 / F.col("checked"), 4)
    )
    return df.withColumn("unexpected_pct", pct).withColumn("success", passed).select(*RESULT_COLUMNS)


def _row_results(df: DataFrame, rules: list[RowRule]) -> DataFrame:
    counts = []
    for i, rule in enumerate(rules):
        counts += [
            F.count_if(rule.applies()).alias(f"_checked_{i}"),
            F.count_if(rule.applies() & ~F.coalesce(rule.holds(), F.lit(False))).alias(f"_bad_{i}"),
        ]
    lines = F.array(*[
        F.struct(
            F.lit(rule.name).alias("rule"),
            F.lit(rule.column).alias("column"),
            F.col(f"_checked_{i}").alias("checked"),
            F.col(f"_bad_{i}").alias("unexpected"),
            F.col(f"_bad_{i}").alias("failures"),
            F.lit(float(rule.mostly)).alias("mostly"),
        )
        for i, rule in enumerate(rules)
    ])
    return _verdict(df.agg(*counts).select(F.inline(lines)), F.col("mostly"))


def _key_result(df: DataFrame, rule: KeyRule) -> DataFrame:
    per_row = isinstance(rule, Relationship)
    bad_rows = F.coalesce(F.sum(F.when(F.col("_bad"), F.col("_rows"))), F.lit(0))
    summed = rule.counted(df).agg(
        F.lit(rule.name).alias("rule"),
        F.lit(rule.column).alias("column"),
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("checked"),
        bad_rows.alias("unexpected"),
        (bad_rows if per_row else F.count_if(F.col("_bad"))).alias("failures"),
    )
    return _verdict(summed, F.lit(1.0))


def evaluate(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """One result row per rule."""
    row_rules = [r for r in rules if isinstance(r, RowRule)]
    parts = [_row_results(df, row_rules)] if row_rules else []
    parts += [_key_result(df, r) for r in rules if isinstance(r, KeyRule)]
    return union_all(parts)
