"""Tables with one folder per load and one commit per write.

A table lives at ``<root>/<table>/load_id=<id>/attempt=<name>/``. Every write goes to an attempt
folder of its own. When all its files are there, an empty marker
``load_id=<id>/_commits/<number>-<name>`` is created, one number above the last: that single
file is the commit. Readers follow the marker with the greatest number, so a load that is being
rebuilt, or whose rebuild failed, stays in service as it was, and a reader that has planned its
scan keeps its files. Of two writers of one load the later commit wins; neither mixes files with
the other. The attempt before the current one is kept for its readers, older ones are deleted.

``publish`` makes a catalog snapshot: a database that holds the tables of one load. Readers find
it through one property of the named database, set in one statement when all tables are there.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from terrace.session import work_folder
from terrace.sources import storage

_COMMITS = "_commits"


@dataclass(frozen=True)
class Written:
    """What one write did; the counts were taken while the rows went by."""

    table: str
    path: str
    rows: int
    metrics: dict[str, int] = field(default_factory=dict)


# Spark's own setting. Without it the exchanges of a query stay on disk until the driver's JVM happens to collect its plan.
_FREE_EXCHANGES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _stored(df: DataFrame, path: str, file_format: str = "parquet") -> None:
    """Write to a path; from then on the session deletes a query's exchanges when it has ended."""
    conf = df.sparkSession.conf
    # Whoever set it before, either way, is followed.
    if conf.get(_FREE_EXCHANGES, None) is None:
        conf.set(_FREE_EXCHANGES, "true")
    writer = df.write.format(file_format)
    (writer.option("compression", "zstd") if file_format == "parquet" else writer).save(path)


def load_folder(root: str, table: str, load_id: str) -> str:
    return f"{root.rstrip('/')}/{table}/load_id={load_id}"


def new_attempt(folder: str) -> str:
    """Where the next write of a load puts its files."""
    return f"{folder}/attempt={uuid.uuid4().hex[:12]}"


def commit(spark: SparkSession, attempt: str) -> str:
    """Put a complete attempt in service; returns its path."""
    folder, _, name = attempt.rpartition("/")
    done = _commits(spark, folder)
    number = int(done[0].partition("-")[0]) + 1 if done else 1
    storage.write_text(spark, f"{folder}/{_COMMITS}/{number:08d}-{name.partition('=')[2]}", "")
    for old in done[1:]:
        # The marker goes first: nothing ever points at a folder half deleted.
        storage.delete(spark, f"{folder}/{_COMMITS}/{old}")
        storage.delete(spark, f"{folder}/attempt={old.partition('-')[2]}")
    return attempt


def _commits(spark: SparkSession, folder: str) -> list[str]:
    """Names of the commit markers of a load, the newest first."""
    found = storage.files_below(spark, f"{folder}/{_COMMITS}")
    return sorted((name.rpartition("/")[2] for name in found), reverse=True)


def current_attempt(spark: SparkSession, folder: str) -> str | None:
    """Path of the attempt that is in service for a load; None if no write of it has ended."""
    done = _commits(spark, folder)
    return f"{folder}/attempt={done[0].partition('-')[2]}" if done else None


def write_table(
    df: DataFrame,
    root: str,
    table: str,
    load_id: str,
    metrics: dict[str, Column] | None = None,
    helpers: tuple[str, ...] = (),
    file_format: str = "parquet",
) -> Written:
    """Write one load and count rows (and ``metrics``) in the same pass, then commit it.

    ``helpers`` names columns that only the metrics need; they are not written.
    """
    path = new_attempt(load_folder(root, table, load_id))
    watch = Observation(f"{table}-{uuid.uuid4().hex[:8]}")
    extra = [expr.alias(name) for name, expr in (metrics or {}).items()]
    observed = df.observe(watch, F.count(F.lit(1)).alias("rows"), *extra).drop(*helpers)
    _stored(observed, path, file_format)
    seen = {name: value or 0 for name, value in watch.get.items()}
    return Written(table, commit(df.sparkSession, path), seen.pop("rows"), seen)


def loads(spark: SparkSession, root: str, table: str) -> list[str]:
    """Load ids with a committed write, the oldest first; ids compare as text."""
    base = f"{root.rstrip('/')}/{table}"
    return [
        name.partition("=")[2] for name in storage.child_folders(spark, base)
        if name.startswith("load_id=") and _commits(spark, f"{base}/{name}")
    ]


def latest_load(spark: SparkSession, root: str, table: str, until: str | None = None) -> str:
    """Path of the newest committed load, or of the newest whose id is not above ``until``."""
    for load_id in reversed(loads(spark, root, table)):
        if until is None or load_id <= until:
            return current_attempt(spark, load_folder(root, table, load_id))
    raise FileNotFoundError(f"no complete load of {table} under {root}" + (f" up to {until}" if until else ""))


def read_table(spark: SparkSession, root: str, table: str, until: str | None = None) -> DataFrame:
    return spark.read.parquet(latest_load(spark, root, table, until))


def read_all_loads(spark: SparkSession, root: str, table: str, schema: str) -> DataFrame:
    """What is in service of every load, with the load's id as ``load_id``."""
    base = f"{root.rstrip('/')}/{table}"
    paths = [current_attempt(spark, load_folder(root, table, load_id)) for load_id in loads(spark, root, table)]
    reader = spark.read.schema(f"{schema}, load_id string, attempt string").option("basePath", base)
    return reader.parquet(*paths).drop("attempt") if paths else spark.createDataFrame([], f"{schema}, load_id string")


_SNAPSHOT = "terrace.snapshot"


def published(spark: SparkSession, database: str) -> str | None:
    """Name of the database that holds the current snapshot; None before the first one."""
    if not spark.catalog.databaseExists(database):
        return None
    lines = spark.sql(f"DESCRIBE DATABASE EXTENDED `{database}`").collect()
    properties = next((row[1] for row in lines if row[0] == "Properties"), "") or ""
    found = re.search(rf"\({re.escape(_SNAPSHOT)},\s*([^)]*)\)", properties)
    return found.group(1) if found else None


def publish(
    spark: SparkSession, database: str, root: str, tables: tuple[str, ...], load_id: str | None = None
) -> str:
    """Register tables over the files in place, all of them switched at once; returns the snapshot's name.

    Readers that must see tables of one load take the name from ``published`` and read from that
    database: it never changes. The plain names (``<database>.<table>``) are views for everyday
    use; they follow one after the other once the snapshot is complete. The snapshot before the
    current one is kept for its readers, older ones are dropped, their files are not touched.
    """
    before = published(spark, database)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    snapshot = f"{database}__{re.sub(r'[^0-9A-Za-z]', '_', load_id or 'latest')}_{uuid.uuid4().hex[:8]}".lower()
    spark.sql(f"CREATE DATABASE `{snapshot}`")
    for table in tables:
        location = storage.qualified(spark, latest_load(spark, root, table, load_id))
        spark.sql(f"CREATE TABLE `{snapshot}`.`{table}` USING parquet LOCATION '{location}'")
    spark.sql(f"ALTER DATABASE `{database}` SET DBPROPERTIES ('{_SNAPSHOT}' = '{snapshot}')")
    for table in tables:
        plain = f"`{database}`.`{table}`"
        if spark.catalog.tableExists(f"{database}.{table}") and spark.catalog.getTable(f"{database}.{table}").tableType != "VIEW":
            spark.sql(f"DROP TABLE {plain}")
        spark.sql(f"CREATE OR REPLACE VIEW {plain} AS SELECT * FROM `{snapshot}`.`{table}`")
    for name in (row[0] for row in spark.sql(f"SHOW DATABASES LIKE '{database}__*'").collect()):
        if name not in (snapshot, before):
            spark.sql(f"DROP DATABASE `{name}` CASCADE")
    return snapshot


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate result to the shared work folder and read it back.

    Cuts lineage at a point that survives lost executors, and gives the planner
    the true size of what follows.
    """
    path = f"{work_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex[:8]}"
    _stored(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_ROWS_PER_FILE = 5_000


def few(df: DataFrame, rows: int) -> DataFrame:
    """``df`` of at most so many rows, in no more tasks than they need.

    A shuffle leaves a result of some thousand rows in as many tasks and files as one of billions
    where Spark does not coalesce it, and the files' footers outweigh the rows. What is computed in
    the last stage runs in these tasks too, so it should follow an exchange or read as few rows.
    """
    return df.coalesce(max(1, -(-rows // _ROWS_PER_FILE)))
