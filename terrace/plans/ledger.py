"""The steps of a run, recorded as they finish.

Each step's report lines are a small table of their own, written with the commit protocol when the
step has ended. A record names the record it follows, so the records of one run form a chain: when
a step runs again, whatever was recorded after it no longer counts. A run that stopped half-way can
therefore go on after its last good step, on the tables that step left behind.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.sources.tables import current_attempt, load_folder, read_all_loads, write_table

# (step, subject, metric, value, note)
Line = tuple[str, str, str, int, str | None]

LINE_SCHEMA = "step string, subject string, metric string, value long, note string"


class Ledger:
    """Records of one load; with ``resume`` the finished steps of its last run are taken over."""

    def __init__(self, spark: SparkSession, root: str, load_id: str, resume: bool = False):
        self.spark, self.root, self.load_id = spark, root, load_id
        self.lines: list[Line] = []
        self._resume, self._last = resume, ""

    def step(self, name: str, work: Callable[[], list[Line]]) -> list[Line]:
        """The lines of a step: recorded ones if its record still holds, else those of running it now."""
        done = self._recorded(name) if self._resume else None
        if done is None:
            self._resume = False
            done = work()
            self._record(name, done, passed=True)
        self.lines.extend(done)
        return done

    def failed(self, name: str, lines: list[Line]) -> None:
        """Keep the lines of a step that ended badly; it will run again."""
        self._record(name, lines, passed=False)
        self.lines.extend(lines)
        self.close()

    def close(self) -> DataFrame:
        """Store the whole report of the run and return it."""
        frame = self.spark.createDataFrame([line[:4] for line in self.lines], "step string, subject string, metric string, value long")
        write_table(frame.coalesce(1), self.root, "run_log", self.load_id)
        return run_log(self.spark, self.root).filter(F.col("load_id") == self.load_id)

    def _record(self, name: str, lines: list[Line], passed: bool) -> None:
        marks: list[Line] = [(name, "", "_passed", int(passed), None), (name, "", "_follows", 0, self._last)]
        frame = self.spark.createDataFrame([*lines, *marks], LINE_SCHEMA)
        self._last = write_table(frame.coalesce(1), self.root, f"step_{name}", self.load_id).path

    def _recorded(self, name: str) -> list[Line] | None:
        path = current_attempt(self.spark, load_folder(self.root, f"step_{name}", self.load_id))
        if path is None:
            return None
        # A few short rows per table and rule.
        lines = [tuple(row) for row in self.spark.read.schema(LINE_SCHEMA).parquet(path).collect()]
        marks = {metric: (value, note) for _, subject, metric, value, note in lines if not subject}
        if not marks["_passed"][0] or marks["_follows"][1] != self._last:
            return None
        self._last = path
        return [line for line in lines if line[1]]


def run_log(spark: SparkSession, root: str) -> DataFrame:
    """Reports of all runs, one load id per date."""
    return read_all_loads(spark, root, "run_log", "step string, subject string, metric string, value long")
