"""The daily run: raw files -> bronze -> gate -> silver -> gold -> model tests.

Each step starts only when the one before succeeded. Within silver the tables do
not depend on each other and are written side by side in one Spark application.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from terrace import config
from terrace.functions.dates import form_of
from terrace.plans import checks, silver
from terrace.plans import ledger as ledgers
from terrace.plans.ledger import Ledger, Line
from terrace.plans.warehouse import Warehouse, silver_table
from terrace.session import work_folder
from terrace.sources import bronze, storage
from terrace.sources.tables import Written, materialise, publish, write_table


@dataclass(frozen=True)
class Places:
    """Root folders of the layers."""

    bronze: str
    silver: str
    gold: str
    runs: str

    @classmethod
    def under(cls, root: str) -> Places:
        root = root.rstrip("/")
        return cls(f"{root}/bronze", f"{root}/silver", f"{root}/gold", f"{root}/runs")


def _nulls(columns: list[str], stem: str) -> dict[str, Column]:
    return {f"{stem}.{c}": F.count_if(F.col(c).isNull()) for c in columns}


def raw_metrics(table: str) -> dict[str, Column]:
    """Counts taken while a raw table streams into its silver job, made from the table's columns.

    Rows, nulls per column and values that cleaning changes per cleaned column; plus what the
    table's own rule leaves out or fills.
    """
    counts = {"rows_in": F.count(F.lit(1))} | _nulls(list(config.RAW_COLUMNS[table]), "nulls_in")
    for column, cleaned in silver.cleaners(table).items():
        counts[f"changed.{column}"] = F.count_if(~cleaned.eqNullSafe(F.col(column)))
    if table == "geolocation":
        place = {c: F.col(c).try_cast("double") for c in ("geolocation_lat", "geolocation_lng")}
        inside = place["geolocation_lat"].between(*config.LATITUDE_RANGE) & place[
            "geolocation_lng"
        ].between(*config.LONGITUDE_RANGE)
        counts["out_of_range"] = F.count_if(~F.coalesce(inside, F.lit(False)))
    if table == "products":
        counts["category_filled"] = F.count_if(F.col("product_category_name").isNull())
    return counts


def _first_value(column: str) -> Column:
    """The first value of a column in file order: a partial minimum per task, nothing is sorted."""
    return F.min_by(column, F.when(F.col(column).isNotNull(), F.col(config.POSITION)))


def parsed_raw(
    spark: SparkSession, places: Places, sources: Mapping[str, config.Source], until: str | None = None, scratch: str = ""
) -> tuple[dict[str, DataFrame], dict[str, str | None]]:
    """The newest raw tables, up to a load date if one is given, and the form of each moment column.

    Gated tables are scanned once per rule group and again by silver, so their text is parsed once
    and kept in columns. The first value of a moment column, seen as the rows go by, decides its
    form. Only customers need to know later where a row stood in its file. Whatever is stored for
    this lies below ``scratch`` in the work folder.
    """
    tables = bronze.bronze_tables(spark, places.bronze, sources, until, scratch)
    forms: dict[str, str | None] = {}
    for entity, df in tables.items():
        dated = config.DATE_COLUMNS.get(entity, ())
        watch = Observation(f"forms-{entity}")
        if dated:
            df = df.observe(watch, *[_first_value(c).alias(c) for c in dated])
        if entity != "customers":
            df = df.drop(config.POSITION)
        tables[entity] = materialise(df, "/".join(filter(None, (scratch, f"raw-{entity}")))) if entity in checks.RAW_SUITES or dated else df
        if dated:
            forms |= {c: form_of(watch.get[c]) for c in dated}
    return tables, forms


def build_silver(
    spark: SparkSession, raw: Mapping[str, DataFrame], root: str, load_id: str, forms: silver.Forms | None = None
) -> list[Written]:
    """Write all silver tables at once; report rows, nulls and changed values before and after."""

    def job(table: str) -> Written:
        watch = Observation(f"raw-{table}")
        watched = raw[table].observe(watch, *[c.alias(n) for n, c in raw_metrics(table).items()])
        metrics, helpers = {}, ()
        if table == "products":
            result = silver.products(watched, raw["category_translation"], flags=True)
            metrics, helpers = {"untranslated": F.count_if(F.col("_untranslated"))}, ("_untranslated",)
        elif table in config.DATE_COLUMNS:
            # Every moment is parsed once, for the table and for the count.
            result = getattr(silver, table)(watched, forms, flags=True)
            metrics, helpers = {"unparsed": F.sum("_unparsed")}, ("_unparsed",)
        else:
            result = silver_table({table: watched}, table)
        metrics |= _nulls([c for c in result.columns if c not in helpers], "nulls")
        written = write_table(result, root, table, load_id, metrics, helpers)
        found = {**{name: value or 0 for name, value in watch.get.items()}, **written.metrics}
        if table == "customers":
            found["duplicates_dropped"] = found["rows_in"] - written.rows
        return Written(table, written.path, written.rows, found)

    with ThreadPoolExecutor(max_workers=len(config.SILVER_TABLES)) as pool:
        runs = [pool.submit(inheritable_thread_target(spark)(job), t) for t in config.SILVER_TABLES]
        return [run.result() for run in runs]


def build_gold(
    spark: SparkSession,
    silver_tables: Mapping[str, DataFrame],
    root: str,
    load_id: str,
    calendar: tuple[str, int] | None = None,
) -> tuple[dict[str, DataFrame], list[Written]]:
    """Write the star schema in dependency order; facts read the stored dimensions.

    Tables that do not need each other are written side by side.
    """
    done: list[Written] = []

    def store(df: DataFrame, table: str) -> DataFrame:
        written = write_table(df, root, table, load_id)
        done.append(written)
        return spark.read.parquet(written.path)

    house = Warehouse(spark, silver_tables, calendar, store)
    for wave in (
        ("dim_date", "dim_customers", "dim_products", "dim_sellers", "fact_payments", "fact_reviews"),
        ("customer_bridge",), ("fact_orders",), ("fact_order_items",),
    ):
        with ThreadPoolExecutor(max_workers=len(wave)) as pool:
            for run_ in [pool.submit(inheritable_thread_target(spark)(house.__getitem__), t) for t in wave]:
                run_.result()
    order = {table: i for i, table in enumerate(config.GOLD_TABLES)}
    return house.gold(), sorted((w for w in done if w.table in order), key=lambda w: order[w.table])


def run(
    spark: SparkSession,
    raw_dir: str,
    places: Places,
    ingestion_date: str,
    sources: Mapping[str, config.Source] | None = None,
    calendar: tuple[str, int] | None = None,
    databases: tuple[str, str] | None = None,
    resume: bool = False,
    consume: bool = False,
) -> DataFrame:
    """Run every step for one date and return its report.

    The date is the load id of every layer, and every layer reads what was loaded
    for it: running it again replaces that load and nothing else, whatever newer
    loads there are. Where a source brought nothing that day, its load before that
    date is used; the report names the load date of each table. A failed gate, model
    test or calendar check raises after its results were added to the report. Every
    step is recorded as it finishes; ``resume`` takes up the date's last run after its
    last good step. ``databases`` names the catalog databases to publish silver and
    gold in. ``consume`` deletes the raw folder once its files are landed. The parsed
    raw text is deleted when silver is written or the gate has refused it.
    """
    sources = sources or config.sources()
    ledger = Ledger(spark, places.runs, ingestion_date, resume)

    def judged(step: str, results: Callable[[], DataFrame]) -> None:
        def work() -> list[Line]:
            # One short row per rule.
            lines: list[Line] = []
            failed = []
            for group, rule, column, failures, success in results().collect():
                subject = f"{group}.{column}:{rule}"
                lines += [(step, subject, "failures", failures, None), (step, subject, "success", int(success), None)]
                if not success:
                    failed.append(f"{group}.{column} {rule} ({failures})")
            if failed:
                ledger.failed(step, lines)
                raise checks.DataQualityError(f"{step} failed: " + ", ".join(failed))
            return lines

        ledger.step(step, work)

    def landed() -> list[Line]:
        landing = bronze.land(spark, raw_dir, places.bronze, ingestion_date, sources)
        lines: list[Line] = [("bronze", name, "missing", 1, None) for name in landing.missing]
        per_table = landing.manifest.groupBy("table_name").agg(
            F.sum("row_count"), F.sum("file_size_bytes"), F.count(F.lit(1))
        )
        for table, rows, size, files in per_table.collect():
            lines += [("bronze", table, n, v, None) for n, v in (("rows", rows), ("bytes", size), ("files", files))]
        for name, source in sources.items():
            day = bronze.load_date(spark, places.bronze, source, until=ingestion_date)
            lines.append(("bronze", name, "load_date", int("".join(filter(str.isdigit, day)) or 0), None))
        return lines

    scratch = f"parsed-{uuid.uuid4().hex[:8]}"
    parsed: list[tuple[dict[str, DataFrame], dict[str, str | None]]] = []

    def raw() -> tuple[dict[str, DataFrame], dict[str, str | None]]:
        if not parsed:
            parsed.append(parsed_raw(spark, places, sources, ingestion_date, scratch))
        return parsed[0]

    def silver_lines() -> list[Line]:
        tables, forms = raw()
        return [
            ("silver", w.table, name, int(value or 0), w.path)
            for w in build_silver(spark, tables, places.silver, ingestion_date, forms)
            for name, value in {"rows": w.rows, **w.metrics}.items()
        ]

    def gold_lines() -> list[Line]:
        stored = build_gold(spark, silver_tables, places.gold, ingestion_date, calendar)[1]
        return [("gold", w.table, "rows", w.rows, w.path) for w in stored]

    def tables_of(lines: list[Line]) -> dict[str, DataFrame]:
        return {subject: spark.read.parquet(path) for _, subject, metric, _, path in lines if metric == "rows"}

    ledger.step("bronze", landed)
    if consume:
        storage.delete(spark, raw_dir)
    try:
        judged("gate", lambda: checks.raw_results(raw()[0]).select("suite", "rule", "column", "failures", "success"))
        silver_tables = tables_of(ledger.step("silver", silver_lines))
    finally:
        # Nothing reads the raw text any more.
        storage.delete(spark, f"{work_folder(spark)}/{scratch}")
    gold = tables_of(ledger.step("gold", gold_lines))
    judged("tests", lambda: checks.model_results(gold).select("model", "test", "column", "failures", "success"))
    judged("calendar", lambda: checks.calendar_coverage(gold).select("model", "test", "column", "failures", "success"))

    if databases:
        publish(spark, databases[0], places.silver, config.SILVER_TABLES, ingestion_date)
        publish(spark, databases[1], places.gold, config.GOLD_TABLES, ingestion_date)
    return ledger.close()


def run_log(spark: SparkSession, places: Places) -> DataFrame:
    """Reports of all runs, one load id per date."""
    return ledgers.run_log(spark, places.runs)
