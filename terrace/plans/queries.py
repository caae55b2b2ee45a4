"""Named queries over a folder of the test tables, one per operator or job."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace import config
from terrace.functions.text import zero_pad
from terrace.operators.dedupe import (
    duplicated_keys, duplicated_rows, first_duplicated_rows, has_duplicates,
)
from terrace.operators.profile import KeyPair, key_differences, missing_members, preview, profile
from terrace.operators.union import union_all
from terrace.plans import business, checks, gold, pipeline, staging
from terrace.plans.warehouse import Warehouse, silver_table
from terrace.session import work_folder
from terrace.sources import bronze, testdata
from terrace.sources.tables import publish, published, read_table, write_table

Query = Callable[[SparkSession, str], DataFrame]

_WAREHOUSES: dict[tuple[str, str], Warehouse] = {}


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The warehouse over one data folder, shared by the queries of a session."""
    key = (work_folder(spark), sf_dir.rstrip("/"))
    if key not in _WAREHOUSES:
        _WAREHOUSES[key] = Warehouse.from_raw(
            spark, testdata.raw_tables(spark, sf_dir)
        )
    return _WAREHOUSES[key]


def _rounded(df: DataFrame) -> DataFrame:
    """Doubles to four places: their sums depend on the order of addition."""
    return df.select(*[
        F.round(name, 4).alias(name) if kind == "double" else F.col(name) for name, kind in df.dtypes
    ])


def _silver(table: str) -> Query:
    return lambda spark, sf_dir: _rounded(silver_table(testdata.raw_tables(spark, sf_dir), table))


def _gold(table: str) -> Query:
    return lambda spark, sf_dir: _rounded(warehouse(spark, sf_dir).build(table))


def _report(question: Callable[[business.Gold], DataFrame]) -> Query:
    return lambda spark, sf_dir: question(warehouse(spark, sf_dir))


def _staging_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.products(silver_table(testdata.raw_tables(spark, sf_dir), "products"))


def _staging_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.orders(silver_table(testdata.raw_tables(spark, sf_dir), "orders"))


# ------------------------------------------------------------------- checks


def _dq_raw_suites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.raw_results(testdata.raw_tables(spark, sf_dir)).select(
        "suite", "rule", "column", "checked", "unexpected", "unexpected_pct", "success"
    )


def _dq_gate_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.gate_status(checks.raw_results(testdata.raw_tables(spark, sf_dir)))


def _dq_gold_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.model_results(warehouse(spark, sf_dir).gold())


def _dq_calendar_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.calendar_coverage(warehouse(spark, sf_dir).gold())


def _dq_grain_violations_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = testdata.table(spark, sf_dir, "lineitem")
    return duplicated_keys(lines, ["l_orderkey", "l_linenumber"])


# ---------------------------------------------------------------- profiling


def _profile_nulls_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return union_all(profile(df, name) for name, df in testdata.raw_tables(spark, sf_dir).items())


def _profile_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first ten orders, in a stated order (here a limit is the feature)."""
    return preview(testdata.orders(spark, sf_dir), 10, ["order_id"])


_KEYS = {
    "geolocation": ["geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng"],
    "order_items": ["order_id", "order_item_id"],
    "order_payments": ["order_id", "payment_sequential"],
    "order_reviews": ["order_id", "review_id"],
}


def _profile_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = testdata.raw_tables(spark, sf_dir)
    return union_all(
        has_duplicates(raw[table], keys).select(
            F.lit(table).alias("table"), F.lit(",".join(keys)).alias("columns"), "has_duplicates"
        )
        for table, keys in _KEYS.items()
    )


def _profile_duplicate_rows_top20(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that share a review_id, the first twenty (here a limit is the feature)."""
    reviews = testdata.order_reviews(spark, sf_dir)
    return first_duplicated_rows(reviews, "review_id", 20, ["order_id"]).select(
        "review_id", "order_id", "review_score"
    )


def _profile_referential_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = testdata.raw_tables(spark, sf_dir)
    declared = [
        ("orders", "order_id", "order_items", "order_id"),
        ("orders", "order_id", "order_payments", "order_id"),
        ("sellers", "seller_id", "order_items", "seller_id"),
        ("order_items", "product_id", "products", "product_id"),
        ("orders", "order_id", "order_reviews", "order_id"),
        ("customers", "customer_id", "orders", "customer_id"),
        ("products", "product_category_name", "category_translation", "product_category_name"),
    ]
    return key_differences([
        KeyPair(f"{a}.{x}-{b}.{y}", raw[a], x, raw[b], y) for a, x, b, y in declared
    ])


def _profile_missing_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = testdata.raw_tables(spark, sf_dir)
    return missing_members(
        raw["products"], "product_category_name",
        raw["category_translation"], "product_category_name",
    )


def _profile_zip_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = testdata.raw_tables(spark, sf_dir)
    places = silver_table(raw, "geolocation")
    found = "geolocation_zip_code_prefix"
    return key_differences([
        KeyPair("customers", raw["customers"], zero_pad(F.col("customer_zip_code_prefix")), places, found),
        KeyPair("sellers", raw["sellers"], zero_pad(F.col("seller_zip_code_prefix")), places, found),
    ]).select("pair", F.col("only_left").alias("missing_zips"))


def _profile_duplicate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    reviews = testdata.order_reviews(spark, sf_dir)
    return duplicated_rows(reviews, "review_id").select("review_id", "order_id", "review_score")


# ----------------------------------------------------- bronze and whole runs


def _as_files(raw: Mapping[str, DataFrame], spark: SparkSession) -> tuple[str, dict[str, config.Source]]:
    """Write raw tables as packed CSV files, the way a feed would deliver them; one task reads a file, so none gets long."""
    folder = f"{work_folder(spark)}/feed-{uuid.uuid4().hex[:8]}"
    for entity, table in raw.items():
        columns = list(config.RAW_COLUMNS[entity])
        table.select(*columns).write.options(maxRecordsPerFile=1_000_000, **{"zlib.compress.level": "BEST_SPEED"}).csv(
            f"{folder}/{entity}", header=True, quote='"', escape='"',
            ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, compression="gzip",
        )
    return folder, config.sources("{entity}/part-*.csv.gz")


def _bronze_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two states of the orders as files, the newer landed first; each date read back, the later one as the newest."""
    raw = testdata.raw_tables(spark, sf_dir)["orders"]
    loads = {"2024-02-01": raw, "2024-01-01": raw.withColumn("order_status", F.lit("created"))}
    bronze_dir = f"{work_folder(spark)}/bronze-{uuid.uuid4().hex[:8]}"
    for day, orders in loads.items():
        folder, sources = _as_files({"orders": orders}, spark)
        bronze.land(spark, folder, bronze_dir, day, {"orders": sources["orders"]})
    return union_all(
        bronze.read_load(spark, bronze_dir, sources["orders"], until).drop(config.POSITION)
        .select(F.lit(day).alias("load"), "*")
        for day, until in (("2024-01-01", "2024-01-31"), ("2024-02-01", None))
    )


def _bronze_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nine tables as files, landed: records per table as the manifest counts them, files and bytes against the feed."""
    raw = testdata.raw_tables(spark, sf_dir)
    folder, sources = _as_files({entity: raw[entity] for entity in config.RAW_COLUMNS}, spark)
    landing = bronze.land(spark, folder, f"{folder}-bronze", "2024-01-01", sources)
    landed = landing.manifest.groupBy("table_name", "ingestion_date").agg(
        F.sum("row_count").alias("row_count"), F.count(F.lit(1)).alias("files"), F.sum("file_size_bytes").alias("bytes")
    )
    fed = union_all(
        bronze.listed(spark, f"{folder}/{source.file_name}").agg(
            F.lit(entity).alias("table_name"), F.count(F.lit(1)).alias("fed_files"), F.sum("bytes").alias("fed_bytes")
        )
        for entity, source in sources.items()
    )
    return landed.join(fed, "table_name", "full").select(
        "table_name", "ingestion_date", "row_count",
        (F.col("files") == F.col("fed_files")).alias("all_files"), (F.col("bytes") == F.col("fed_bytes")).alias("all_bytes"),
    )


def _timestamp_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose moment columns come in forms of their own, each read by the form of its first value."""
    key = F.col("order_id")
    moment = {c: F.col(c).try_cast("timestamp_ntz") for c in config.ORDER_DATE_COLUMNS}
    written = {
        # Every tenth purchase is written in another form than the first one.
        "order_purchase_timestamp": F.when(key % 10 == 3, F.col("order_purchase_timestamp")).otherwise(
            F.date_format(moment["order_purchase_timestamp"], "yyyy-MM-dd'T'HH:mm:ss")),
        "order_approved_at": F.date_format(moment["order_approved_at"], "yyyy-MM-dd HH:mm:ss.SSS"),
        "order_delivered_carrier_date": F.date_format(moment["order_delivered_carrier_date"], "yyyy-MM-dd"),
        "order_delivered_customer_date": F.date_format(moment["order_delivered_customer_date"], "yyyy-MM-dd HH:mm"),
        "order_estimated_delivery_date": F.date_format(moment["order_estimated_delivery_date"], "MM/dd/yyyy HH:mm:ss"),
    }
    folder, sources = _as_files({"orders": testdata.orders(spark, sf_dir).withColumns(written)}, spark)
    places = pipeline.Places.under(f"{folder}-lake")
    only = {"orders": sources["orders"]}
    bronze.land(spark, folder, places.bronze, "2024-01-01", only)
    raw, forms = pipeline.parsed_raw(spark, places, only)
    return silver_table(raw, "orders", forms).select("order_id", *config.ORDER_DATE_COLUMNS)


def _mended(raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The raw tables as a source would send them after the gate refused them."""
    def one_per(table: str, keys: list[str]) -> DataFrame:
        rest = [c for c in config.RAW_COLUMNS[table] if c not in keys]
        return raw[table].groupBy(*keys).agg(*[F.min(c).alias(c) for c in rest])

    return {entity: raw[entity] for entity in config.RAW_COLUMNS} | {
        "customers": raw["customers"].filter(F.col(f"{config.POSITION}._copy") == 0).withColumn("customer_state", F.trim("customer_state")),
        "orders": raw["orders"].withColumn("order_status", F.trim(F.lower("order_status"))),
        "order_items": one_per("order_items", ["order_id", "order_item_id"]),
        "order_reviews": one_per("order_reviews", ["review_id", "order_id"]),
    }


def _pipeline_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two daily runs from files to model tests: the first stops at the gate, the second, on mended files, goes through.

    Bytes and numbers of files are left out of the report: they say how Spark wrote the feed.
    """
    raw = testdata.raw_tables(spark, sf_dir)
    places = pipeline.Places.under(f"{work_folder(spark)}/lake-{uuid.uuid4().hex[:8]}")
    for day, tables in (("2024-01-01", {e: raw[e] for e in config.RAW_COLUMNS}), ("2024-01-02", _mended(raw))):
        folder, sources = _as_files(tables, spark)
        try:
            pipeline.run(spark, folder, places, day, sources, consume=True)
        except checks.DataQualityError as stopped:
            if not str(stopped).startswith("gate failed") or day != "2024-01-01":
                raise
    return pipeline.run_log(spark, places).filter("metric NOT IN ('bytes', 'files')").select(
        F.col("load_id").alias("run"), "step", "subject", "metric", "value"
    )


def _pipeline_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver published in the catalog, twice, and asked there by name: orders, lines and revenue per status."""
    raw = testdata.raw_tables(spark, sf_dir)
    mark = uuid.uuid4().hex[:8]
    root, shelf = f"{work_folder(spark)}/shelf-{mark}", f"shelf_{mark}"
    for day in ("2024-01-01", "2024-01-02"):
        for table in ("orders", "order_items"):
            write_table(silver_table(raw, table), root, table, day)
        publish(spark, shelf, root, ("orders", "order_items"), day)
    name = published(spark, shelf)
    return spark.sql(f"""
        SELECT o.order_status, count(DISTINCT o.order_id) AS orders, count(i.order_id) AS items,
               round(CAST(sum(CAST(i.price AS decimal(28,12))) AS double), 4) AS revenue
        FROM {name}.orders o LEFT JOIN {name}.order_items i ON o.order_id = i.order_id GROUP BY o.order_status
    """)


def _pipeline_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver and gold written from raw, twice under one date: rows per table."""
    raw = testdata.raw_tables(spark, sf_dir)
    root = f"{work_folder(spark)}/run-{uuid.uuid4().hex[:8]}"
    for _ in range(2):
        silver_done = pipeline.build_silver(spark, raw, f"{root}/silver", "2024-01-01")
        stored = {t: read_table(spark, f"{root}/silver", t) for t in config.SILVER_TABLES}
        _, gold_done = pipeline.build_gold(spark, stored, f"{root}/gold", "2024-01-01")
    parts = [("silver", silver_done), ("gold", gold_done)]
    return union_all(
        read_table(spark, f"{root}/{layer}", written.table).agg(
            F.lit(layer).alias("layer"), F.lit(written.table).alias("table"),
            F.lit(written.rows).cast("long").alias("rows_reported"), F.count(F.lit(1)).alias("rows_stored"),
        )
        for layer, done in parts
        for written in done
    )


def _dim_date_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar of fixed length, and the orders placed on each of its days; -1 takes the rest."""
    orders = silver_table(testdata.raw_tables(spark, sf_dir), "orders")
    days = gold.dim_date(gold.fixed_days(spark)).select("date_key", "full_date")
    placed = orders.select(F.to_date("order_purchase_timestamp").alias("full_date")).groupBy("full_date").agg(
        F.count(F.lit(1)).alias("n")
    )
    on_days = placed.join(days, "full_date", "left").groupBy(
        F.coalesce("date_key", F.lit(config.UNKNOWN_KEY)).alias("date_key")
    ).agg(F.sum("n").alias("orders_placed"))
    return days.join(on_days, "date_key", "left").select(
        "date_key", "full_date", F.coalesce("orders_placed", F.lit(0)).alias("orders_placed")
    )


QUERIES: dict[str, Query] = {
    **{f"silver_{t}": _silver(t) for t in config.SILVER_TABLES},
    "staging_products_rename": _staging_products,
    "staging_orders_cast": _staging_orders,
    **{t: _gold(t) for t in config.GOLD_TABLES},
    "dim_date_fixed": _dim_date_fixed,
    "dq_raw_suites": _dq_raw_suites,
    "dq_gate_status": _dq_gate_status,
    "dq_gold_tests": _dq_gold_tests,
    "dq_calendar_coverage": _dq_calendar_coverage,
    "dq_grain_violations_raw": _dq_grain_violations_raw,
    "profile_nulls_distinct": _profile_nulls_distinct,
    "profile_preview": _profile_preview,
    "profile_duplicates": _profile_duplicates,
    "profile_duplicate_rows_top20": _profile_duplicate_rows_top20,
    "profile_duplicate_rows": _profile_duplicate_rows,
    "profile_referential_integrity": _profile_referential_integrity,
    "profile_missing_category": _profile_missing_category,
    "profile_zip_coverage": _profile_zip_coverage,
    "late_rate_by_region": _report(business.late_rate_by_region),
    "late_rate_by_seller": _report(business.late_rate_by_seller),
    "sales_trend": _report(business.sales_trend),
    "review_vs_delay_corr": _report(business.review_vs_delay_corr),
    "review_by_delay_bucket": _report(business.review_by_delay_bucket),
    "seller_performance": _report(business.seller_performance),
    "payment_mix": _report(business.payment_mix),
    "installment_trend": _report(business.installment_trend),
    "avg_order_value": _report(business.avg_order_value),
    "bronze_roundtrip": _bronze_roundtrip,
    "bronze_manifest": _bronze_manifest,
    "bronze_timestamp_forms": _timestamp_forms,
    "pipeline_report": _pipeline_report,
    "pipeline_run": _pipeline_run,
    "pipeline_catalog": _pipeline_catalog,
}
