"""Column choice and renames between silver and gold; never stored."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def customers(silver: DataFrame) -> DataFrame:
    return silver.select(
        "customer_id", "customer_unique_id", "customer_zip_code_prefix",
        "customer_city", "customer_state",
    )


def geolocation(silver: DataFrame) -> DataFrame:
    return silver.select(
        F.col("geolocation_zip_code_prefix").alias("zip_code_prefix"),
        F.col("geolocation_lat").alias("latitude"),
        F.col("geolocation_lng").alias("longitude"),
    )


def orders(silver: DataFrame) -> DataFrame:
    return silver.select(
        "order_id", "customer_id", "order_status", "order_purchase_timestamp",
        "order_approved_at", "order_delivered_carrier_date",
        "order_delivered_customer_date", "order_estimated_delivery_date",
        F.round("delivery_delay_days").cast("int").alias("delivery_delay_days"),
    )


def order_items(silver: DataFrame) -> DataFrame:
    return silver.select(
        "order_id", "order_item_id", "product_id", "seller_id",
        "shipping_limit_date", "price", "freight_value",
    )


def order_payments(silver: DataFrame) -> DataFrame:
    return silver.select(
        "order_id", "payment_sequential", "payment_type",
        "payment_installments", "payment_value",
    )


def order_reviews(silver: DataFrame) -> DataFrame:
    return silver.select(
        "review_id", "order_id", "review_score",
        "review_creation_date", "review_answer_timestamp",
    )


def products(silver: DataFrame) -> DataFrame:
    return silver.select(
        "product_id", "product_category_name", "product_category_name_english",
        F.col("product_name_lenght").alias("product_name_length"),
        F.col("product_description_lenght").alias("product_description_length"),
        "product_photos_qty", "product_weight_g", "product_length_cm",
        "product_height_cm", "product_width_cm",
    )


def sellers(silver: DataFrame) -> DataFrame:
    return silver.select("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state")
