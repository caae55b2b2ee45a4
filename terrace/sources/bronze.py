"""The raw layer: byte-exact copies of the source files, one folder per load date.

``<bronze>/<entity>/ingestion_date=<date>/<file>`` plus one manifest per date. Where a
glob takes files from several folders, ``<file>`` keeps the folders that tell them apart.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace import config
from terrace.functions.text import blank_to_null
from terrace.operators.union import union_all
from terrace.sources import storage
from terrace.sources.cuts import PACKED, cut_between_records
from terrace.sources.tables import current_attempt, load_folder, materialise, write_table

MANIFEST_COLUMNS = (
    "table_name", "source_file", "s3_key", "row_count", "file_size_bytes",
    "uploaded_at", "ingestion_date",
)


@dataclass(frozen=True)
class Landing:
    """Outcome of one load."""

    ingestion_date: str
    manifest: DataFrame | None
    landed: tuple[str, ...]
    missing: tuple[str, ...]


def _file_worker(job: str):
    """The task that copies or deletes files, one per row, or lists folders, wherever Arrow reaches.

    Copied bytes go to a name of their own first and are moved into place at the end, so a task
    that dies half-way leaves no half file under the final name and its retry starts over. What
    such a task left is hidden from readers and deleted by the next load of the date. An inner
    function, so that Spark ships its code and executors need not have this package installed.
    """
    chunk_bytes = 8 << 20

    def place(uri):
        from urllib.parse import quote

        from pyarrow import fs

        return fs.FileSystem.from_uri(quote(uri.replace("s3a://", "s3://", 1), safe=":/@"))

    def copy(batches):
        import uuid
        from datetime import datetime, timezone

        for batch in batches:
            sizes, times = [], []
            for source, target in zip(batch["source"], batch["target"], strict=True):
                from_fs, from_path = place(source)
                to_fs, to_path = place(target)
                folder, _, name = to_path.rpartition("/")
                to_fs.create_dir(folder, recursive=True)
                partial = f"{folder}/_{name}.{uuid.uuid4().hex}"
                size = 0
                # Arrow would unpack what is named like a compressed file.
                with from_fs.open_input_stream(from_path, compression=None) as reader, to_fs.open_output_stream(partial, compression=None) as writer:
                    while chunk := reader.read(chunk_bytes):
                        writer.write(chunk)
                        size += len(chunk)
                to_fs.move(partial, to_path)
                sizes.append(size)
                times.append(datetime.now(timezone.utc).isoformat())
            yield batch[["entity", "source_file", "key"]].assign(file_size_bytes=sizes, uploaded_at=times)

    def delete(batches):
        for batch in batches:
            for target in batch["target"]:
                to_fs, to_path = place(target)
                to_fs.delete_file(to_path)
            yield batch[["target"]]

    def list_below(batches):
        import pandas as pd
        from pyarrow import fs

        for batch in batches:
            for folder in batch["folder"]:
                there, path = place(folder)
                found = there.get_file_info(fs.FileSelector(path, recursive=True, allow_not_found=True))
                names = [f"{folder}{info.path[len(path):]}" for info in found if info.type == fs.FileType.File]
                yield pd.DataFrame({"target": pd.Series(names, dtype=object)})

    return {"copy": copy, "delete": delete, "list": list_below}[job]


# At most so many tasks copy files; each takes its share of the list.
_COPY_TASKS = 10_000


def listed(spark: SparkSession, pattern: str, below: bool = False) -> DataFrame:
    """(uri, bytes) of the files that match a path or glob, or lie ``below`` it; no content is read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", below).load(pattern)
    return found.select(F.col("path").alias("uri"), F.col("length").alias("bytes"))


def land(
    spark: SparkSession,
    raw_dir: str,
    bronze_dir: str,
    ingestion_date: str,
    sources: Mapping[str, config.Source] | None = None,
) -> Landing:
    """Copy the source files of one day, count their records, write the manifest.

    A source without a file is reported, not fatal. Running a date again replaces its files:
    once the new ones are in place, every file of any of the sources that this run did not
    bring is deleted, also where a source brought nothing at all. Another date adds folders.
    The list of files is a table: it is made by a scan of names, copied and deleted by tasks,
    and counted by a CSV scan of the copies. The driver sees one row per source.
    """
    sources = sources or config.sources()
    if not storage.exists(spark, raw_dir):
        raise FileNotFoundError(f"raw folder does not exist: {raw_dir}")
    base = storage.qualified(spark, bronze_dir).rstrip("/")
    feed = storage.qualified(spark, raw_dir).rstrip("/")

    jobs = {
        entity: _jobs(spark, entity, source, feed, base, ingestion_date)
        for entity, source in sources.items()
        if storage.any_file(spark, f"{raw_dir.rstrip('/')}/{source.file_name}")
    }
    missing = tuple(source.file_name for entity, source in sources.items() if entity not in jobs)
    wanted = materialise(union_all(jobs.values()), "wanted-files") if jobs else spark.createDataFrame([], _JOB)
    files = {row["entity"]: row["n"] for row in wanted.groupBy("entity").agg(F.count(F.lit(1)).alias("n")).collect()}
    tasks = max(1, min(sum(files.values()), _COPY_TASKS))
    copied = materialise(
        wanted.repartition(tasks).mapInPandas(
            _file_worker("copy"),
            "entity string, source_file string, key string, file_size_bytes long, uploaded_at string",
        ),
        "landed",
    )
    _drop_left_files(spark, [f"{base}/{entity}/ingestion_date={ingestion_date}" for entity in sources], wanted)

    counts = [_count_records(spark, sources[entity], f"{base}/{entity}/ingestion_date={ingestion_date}") for entity in sorted(files)]
    counts = union_all(counts) if counts else spark.createDataFrame([], "key string, row_count long")
    # A null-safe match keeps Spark from testing the key per record instead of per file.
    manifest = copied.join(counts, copied["key"].eqNullSafe(counts["key"]), "left").select(
        F.col("entity").alias("table_name"), "source_file", copied["key"].alias("s3_key"),
        F.coalesce("row_count", F.lit(0)).alias("row_count"), "file_size_bytes",
        "uploaded_at", F.lit(ingestion_date).alias("ingestion_date"),
    )
    written = write_table(manifest, f"{base}/_manifests", "ingestion_manifest", ingestion_date, file_format="json")
    return Landing(ingestion_date, read_manifest(spark, bronze_dir, ingestion_date, written.path), tuple(sorted(files)), missing)


_JOB = "entity string, source_file string, key string, source string, target string"
_MANIFEST = (
    "table_name string, source_file string, s3_key string, row_count long, file_size_bytes long, "
    "uploaded_at string, ingestion_date string"
)


def read_manifest(spark: SparkSession, bronze_dir: str, ingestion_date: str, path: str | None = None) -> DataFrame:
    """The manifest in service for one date: JSON lines, one per landed file."""
    path = path or current_attempt(spark, load_folder(f"{bronze_dir.rstrip('/')}/_manifests", "ingestion_manifest", ingestion_date))
    if path is None:
        raise FileNotFoundError(f"no manifest of {ingestion_date} under {bronze_dir}")
    return spark.read.schema(_MANIFEST).json(path)


def _jobs(spark: SparkSession, entity: str, source: config.Source, feed: str, base: str, day: str) -> DataFrame:
    """What to copy where. A file keeps its path below the last folder that the source names without a wildcard."""
    fixed, _, _ = re.split(r"[*?\[{]", source.file_name, maxsplit=1)[0].rpartition("/")
    above = "/".join(filter(None, (feed, fixed.strip("/"))))
    files = listed(spark, f"{feed}/{source.file_name}")
    # Schemes are written with one slash or three.
    plain = F.regexp_replace("uri", "^file:/+", "file:/")
    name = F.ltrim(F.substring(plain, len(re.sub("^file:/+", "file:/", above)) + 1, 1 << 20), F.lit("/"))
    key = F.concat(F.lit(f"{entity}/ingestion_date={day}/"), name)
    return files.select(
        F.lit(entity).alias("entity"), name.alias("source_file"), key.alias("key"),
        F.col("uri").alias("source"), F.concat(F.lit(f"{base}/"), key).alias("target"),
    )


def _drop_left_files(spark: SparkSession, folders: list[str], wanted: DataFrame) -> None:
    """Delete, in tasks, all files of the folders that are not among the wanted targets.

    Hidden names are listed too: a lost copy task may have left a part of a file under one.
    """
    asked = spark.createDataFrame([(folder,) for folder in folders], "folder string").repartition(len(folders))
    there = asked.mapInPandas(_file_worker("list"), "target string")
    keep = wanted.select(_key_of(F.col("target")).alias("kept"))
    left = materialise(there.join(keep, _key_of(F.col("target")) == F.col("kept"), "left_anti"), "left-files")
    left.mapInPandas(_file_worker("delete"), "target string").write.format("noop").mode("overwrite").save()


def _csv(spark: SparkSession, source: config.Source):
    return (
        spark.read.schema(source.schema)
        .option("header", True)
        .option("multiLine", source.multi_line)
        .option("quote", '"')
        .option("escape", '"')
        .option("encoding", "UTF-8")
    )


def _key_of(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+/ingestion_date=[^/]+/.+)$", 1)


def _count_records(spark: SparkSession, source: config.Source, folder: str) -> DataFrame:
    """(key, row_count): records per file, header excluded, quoted breaks respected."""
    rows = _csv(spark, source).option("recursiveFileLookup", True).csv(folder)
    per_file = rows.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count(F.lit(1)).alias("row_count"))
    # The scan gives paths in their URL form.
    return per_file.select(_key_of(F.url_decode(F.regexp_replace("path", r"\+", "%2B"))).alias("key"), "row_count")


def load_date(spark: SparkSession, bronze_dir: str, source: config.Source, until: str | None = None) -> str:
    """Greatest load date, not after ``until``, whose folder holds files; dates compare as text."""
    base = f"{bronze_dir.rstrip('/')}/{source.entity}"
    for folder in reversed(storage.child_folders(spark, base)):
        day = folder.partition("=")[2]
        if folder.startswith("ingestion_date=") and (until is None or day <= until) and storage.holds_file(
            spark, f"{base}/{folder}"
        ):
            return day
    raise FileNotFoundError(f"no load of {source.entity} under {base}" + (f" up to {until}" if until else ""))


# A file of quoted records larger than this is cut before it is read.
CUT_BYTES = 256 << 20


def read_load(
    spark: SparkSession,
    bronze_dir: str,
    source: config.Source,
    until: str | None = None,
    cut_bytes: int = CUT_BYTES,
    scratch: str = "",
) -> DataFrame:
    """The newest load (up to a date) as text columns, missing-value tokens turned into null.

    Adds the position of each row in its file. Within one scanned split the
    generated id grows in file order, and splits are ordered by their start. Where records may
    hold line breaks and a file is larger than ``cut_bytes``, the load is cut between records
    first, and its pieces are read by a task each. The pieces lie below ``scratch`` in the work folder.
    A compressed file is not cut; one task reads it.
    """
    day = load_date(spark, bronze_dir, source, until)
    path = f"{bronze_dir.rstrip('/')}/{source.entity}/ingestion_date={day}"
    if source.multi_line:
        files = listed(spark, path, below=True)
        if not files.filter((F.col("bytes") > cut_bytes) & ~F.col("uri").rlike(PACKED)).isEmpty():
            path = cut_between_records(spark, files, cut_bytes, scratch)
    # Compare the header with the schema instead of trusting the order.
    scan = _csv(spark, source).option("enforceSchema", False).option("recursiveFileLookup", True).csv(path)
    position = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("row"),
    )
    return scan.select(
        *[blank_to_null(F.col(c)).alias(c) for c in source.schema.names],
        position.alias(config.POSITION),
    )


def bronze_tables(
    spark: SparkSession,
    bronze_dir: str,
    sources: Mapping[str, config.Source] | None = None,
    until: str | None = None,
    scratch: str = "",
) -> dict[str, DataFrame]:
    sources = sources or config.sources()
    return {entity: read_load(spark, bronze_dir, source, until, scratch=scratch) for entity, source in sources.items()}
