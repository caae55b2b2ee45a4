"""Raw retail tables derived from the TPC-H-like parquet tables.

Stands in for the raw CSV files, which are not available: same nine entities,
same columns, with padding, accents, missing values, bad dates and repeated
customers worked in. All of it is narrow column arithmetic on whole tables (plus
the 25 nations and 5 regions), see FIXTURES.md.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace import config
from terrace.sources.lazy import LazyTables

# Columns of the test tables. Stating them saves a schema job per read.
_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _text(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd HH:mm:ss")


def _plus(moment: Column, days: Column | int = 0, hours: Column | int = 0) -> Column:
    def whole(n: Column | int) -> Column:
        return (n if isinstance(n, Column) else F.lit(n)).cast("int")

    return moment + F.make_dt_interval(days=whole(days), hours=whole(hours))


def _zip(nation_key: str) -> Column:
    return (F.col(nation_key) * 37 + 100).cast("string")


def _placed(spark: SparkSession, sf_dir: str, df: DataFrame, nation_key: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    ).select(
        F.col("n_nationkey").alias(nation_key),
        F.concat(F.lit("  São "), F.col("n_name"), F.lit(" ")).alias("_city"),
        F.concat(F.lit(" "), F.lower(F.substring("r_name", 1, 2))).alias("_state"),
    )
    return df.join(nations, nation_key)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth customer is listed twice; the second listing has another city."""
    listed = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "_metadata.file_path", "_metadata.row_index"
    )
    copies = F.when(F.col("c_custkey") % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    key = F.col("c_custkey")
    return _placed(spark, sf_dir, listed, "c_nationkey").withColumn("_copy", F.explode(copies)).select(
        key.alias("customer_id"),
        (key - key % 3).alias("customer_unique_id"),
        _zip("c_nationkey").alias("customer_zip_code_prefix"),
        F.when(F.col("_copy") == 1, F.lit("Repetida")).otherwise(F.col("_city")).alias("customer_city"),
        F.col("_state").alias("customer_state"),
        F.struct("file_path", "row_index", "_copy").alias(config.POSITION),
    )


def geolocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, segment = F.col("c_custkey"), F.col("c_mktsegment")
    return table(spark, sf_dir, "customer").filter("c_nationkey <> 24").select(
        _zip("c_nationkey").alias("geolocation_zip_code_prefix"),
        (key % 50 - 40).cast("double").alias("geolocation_lat"),
        (-30 - key % 47).cast("double").alias("geolocation_lng"),
        F.when(key % 4 == 0, F.concat(F.lit("SÃO "), segment)).otherwise(F.lower(segment)).alias("geolocation_city"),
        F.lower(F.substring(segment, 1, 2)).alias("geolocation_state"),
    )


def sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    return _placed(spark, sf_dir, suppliers, "s_nationkey").select(
        F.col("s_suppkey").alias("seller_id"),
        _zip("s_nationkey").alias("seller_zip_code_prefix"),
        F.col("_city").alias("seller_city"),
        F.col("_state").alias("seller_state"),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates are text; a carrier date in five hundred is unreadable."""
    key, bought, state = F.col("o_orderkey"), F.col("o_orderdate"), F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").select(
        key.alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.when(state == "F", "Delivered ").when(state == "O", "shipped").when(state == "P", "processing")
        .alias("order_status"),
        _text(bought).alias("order_purchase_timestamp"),
        F.when(key % 400 != 0, _text(_plus(bought, hours=key % 48))).alias("order_approved_at"),
        F.when(key % 500 == 0, "unreadable")
        .when(state != "P", _text(_plus(bought, days=1 + key % 5)))
        .alias("order_delivered_carrier_date"),
        F.when(state == "F", _text(_plus(bought, days=key % 40, hours=key % 24)))
        .alias("order_delivered_customer_date"),
        _text(_plus(bought, days=20, hours=12)).alias("order_estimated_delivery_date"),
    )


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The item id packs line, part and supplier: (order, line) alone repeats here."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        ((F.col("l_partkey") * 100000000 + F.col("l_suppkey")) * 10 + F.col("l_linenumber")).alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        _text(F.col("l_shipdate")).alias("shipping_limit_date"),
        F.col("l_extendedprice").alias("price"),
        (F.col("l_extendedprice") * F.col("l_tax")).alias("freight_value"),
    )


def order_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to seven consecutive events pay the same order."""
    user, event = F.col("user_id"), F.col("event_id")
    kinds = F.array(*[F.lit(k) for k in ("Credit_Card ", "boleto", "voucher", "debit_card")])
    return table(spark, sf_dir, "events").filter("event_type = 'purchase'").select(
        (event - event % 7).alias("order_id"),
        (event % 7 + 1).cast("int").alias("payment_sequential"),
        F.element_at(kinds, (user % 4 + 1).cast("int")).alias("payment_type"),
        (1 + user % 10).cast("string").alias("payment_installments"),
        F.col("value").alias("payment_value"),
    )


def order_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    event, moment = F.col("event_id"), F.col("ts")
    return table(spark, sf_dir, "events").filter("event_type in ('view', 'click')").select(
        (event - event % 2).alias("review_id"),
        (event - event % 3).alias("order_id"),
        (1 + event % 7 % 5).cast("string").alias("review_score"),
        F.lit(None).cast("string").alias("review_comment_title"),
        F.col("props").alias("review_comment_message"),
        _text(moment).alias("review_creation_date"),
        _text(_plus(moment, hours=event % 72)).alias("review_answer_timestamp"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.when(F.col("p_type") != "SMALL", F.lower("p_type")).alias("product_category_name"),
        F.length("p_name").alias("product_name_lenght"),
        (size * 10).alias("product_description_lenght"),
        (size % 6).alias("product_photos_qty"),
        (size * 100).alias("product_weight_g"),
        (size + 1).alias("product_length_cm"),
        (size + 2).alias("product_height_cm"),
        (size + 3).alias("product_width_cm"),
    )


def category_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Categories found in the parts, but for one that has no English name."""
    name = F.lower("p_type")
    return table(spark, sf_dir, "part").filter("p_type not in ('SMALL', 'MEDIUM')").select(
        name.alias("product_category_name"), F.concat(name, F.lit("_en")).alias("product_category_name_english")
    ).distinct()


_READERS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "customers": customers,
    "geolocation": geolocation,
    "orders": orders,
    "order_items": order_items,
    "order_payments": order_payments,
    "order_reviews": order_reviews,
    "products": products,
    "sellers": sellers,
    "category_translation": category_translation,
}


def raw_tables(spark: SparkSession, sf_dir: str) -> LazyTables:
    return LazyTables(_READERS, lambda entity: _READERS[entity](spark, sf_dir))
