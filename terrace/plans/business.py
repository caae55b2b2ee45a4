"""The five business questions, answered from gold tables only.

Order-level measures are needed at seller or payment grain; rows are brought to
one per (order, seller) or per order before two facts meet, so nothing is
counted twice.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.functions.casts import exact_sum
from terrace.operators.joins import balanced_join

Gold = Mapping[str, DataFrame]


def _money(column: str) -> Column:
    """An amount as it is added up: a decimal, so that the order of addition does not matter."""
    return F.col(column).cast("decimal(28,12)")


def _delivered(gold: Gold) -> DataFrame:
    """Delivered orders with a known delay; late means at least one full day."""
    return gold["fact_orders"].filter(
        (F.col("order_status") == "delivered") & F.col("delivery_delay_days").isNotNull()
    ).select("order_id", "customer_key", (F.col("delivery_delay_days") > 0).alias("late"))


def _rates() -> list[Column]:
    return [
        (F.col("delivered_orders") - F.col("late_orders")).alias("on_time_orders"),
        F.round(F.col("late_orders") / F.col("delivered_orders"), 4).alias("late_rate"),
    ]


def late_rate_by_region(gold: Gold) -> DataFrame:
    """Orders are counted per customer first; the join then carries one row each."""
    per_customer = _delivered(gold).groupBy("customer_key").agg(
        F.count(F.lit(1)).alias("delivered"), F.count_if("late").alias("late")
    )
    region = gold["dim_customers"].select("customer_key", "customer_state")
    return (
        per_customer.join(region, "customer_key", "left").groupBy("customer_state")
        .agg(F.sum("delivered").alias("delivered_orders"), F.sum("late").alias("late_orders"))
        .select("customer_state", "delivered_orders", "late_orders", *_rates())
    )


def late_rate_by_seller(gold: Gold) -> DataFrame:
    items = gold["fact_order_items"].select("order_id", "seller_key")
    pairs = items.distinct()
    judged = balanced_join(pairs, _delivered(gold).select("order_id", "late"), "order_id", "inner", keys_from=items)
    per_seller = judged.groupBy("seller_key").agg(
        F.count(F.lit(1)).alias("delivered_orders"), F.count_if("late").alias("late_orders")
    )
    return _named_seller(per_seller, gold).select(
        "seller_key", "seller_id", "delivered_orders", "late_orders", *_rates()
    )


def _named_seller(per_seller: DataFrame, gold: Gold) -> DataFrame:
    names = gold["dim_sellers"].select("seller_key", "seller_id", "seller_state")
    return per_seller.join(names, "seller_key", "left")


def _months(gold: Gold) -> DataFrame:
    """The calendar: a few thousand rows by construction."""
    return gold["dim_date"].select(F.col("date_key").alias("purchase_date_key"), "year", "month")


def sales_trend(gold: Gold) -> DataFrame:
    """Revenue and orders per month, category and customer state."""
    items = gold["fact_order_items"].select(
        "order_id", "product_key", "customer_key", "purchase_date_key", "price"
    )
    category = gold["dim_products"].select(
        "product_key", F.col("product_category_name_english").alias("category")
    )
    region = gold["dim_customers"].select("customer_key", "customer_state")
    placed = items.join(_months(gold), "purchase_date_key", "left")
    placed = balanced_join(placed, category, "product_key", "left", keys_from=items)
    placed = balanced_join(placed, region, "customer_key", "left", keys_from=items)
    # Items of one order in the same group collapse here, before orders are counted.
    groups = ["year", "month", "category", "customer_state"]
    per_order = placed.groupBy(*groups, "order_id").agg(
        F.sum(_money("price")).alias("price"), F.count(F.lit(1)).alias("items")
    )
    return per_order.groupBy(*groups).agg(
        F.round(F.sum("price").cast("double"), 4).alias("revenue"),
        F.count(F.lit(1)).alias("order_count"),
        F.sum("items").alias("item_count"),
    )


def _scored(gold: Gold) -> DataFrame:
    return gold["fact_orders"].filter(
        F.col("delivery_delay_days").isNotNull() & F.col("avg_review_score").isNotNull()
    ).select("delivery_delay_days", F.col("avg_review_score").cast("double").alias("score"))


def review_vs_delay_corr(gold: Gold) -> DataFrame:
    delay = F.col("delivery_delay_days").cast("double")
    return _scored(gold).agg(
        F.count(F.lit(1)).alias("orders"), F.round(F.corr(delay, "score"), 6).alias("correlation")
    )


def review_by_delay_bucket(gold: Gold) -> DataFrame:
    delay = F.col("delivery_delay_days")
    bucket = (
        F.when(delay <= -7, "1: 7+ days early").when(delay <= 0, "2: on time")
        .when(delay <= 3, "3: 1-3 days late").when(delay <= 7, "4: 4-7 days late")
        .otherwise("5: 8+ days late")
    )
    return _scored(gold).groupBy(bucket.alias("delay_bucket")).agg(
        F.count(F.lit(1)).alias("orders"), F.round(F.avg("score"), 4).alias("mean_score")
    )


def _as_date(key: str) -> Column:
    number = F.col(key)
    parts = [(number / 10000).cast("int"), (number / 100).cast("int") % 100, number % 100]
    return F.when(number > 0, F.make_date(*parts))


def seller_performance(gold: Gold) -> DataFrame:
    """Revenue, items, orders and mean days from purchase to delivery, per seller."""
    items = gold["fact_order_items"]
    per_order = items.groupBy("order_id", "seller_key").agg(
        F.sum(_money("price")).alias("price"), F.count(F.lit(1)).alias("items")
    )
    days = gold["fact_orders"].select(
        "order_id",
        F.date_diff(_as_date("delivery_date_key"), _as_date("purchase_date_key")).alias("days"),
    )
    timed = balanced_join(per_order, days, "order_id", "left", keys_from=items)
    per_seller = timed.groupBy("seller_key").agg(
        F.round(F.sum("price").cast("double"), 4).alias("revenue"),
        F.sum("items").alias("item_count"),
        F.count(F.lit(1)).alias("order_count"),
        F.round(F.avg("days"), 4).alias("mean_delivery_days"),
    )
    return _named_seller(per_seller, gold).select(
        "seller_key", "seller_id", "seller_state", "revenue", "item_count", "order_count",
        "mean_delivery_days",
    )


def payment_mix(gold: Gold) -> DataFrame:
    """Payments per type with their share; the shares look at one row per type."""
    per_type = gold["fact_payments"].groupBy("payment_type").agg(
        F.count(F.lit(1)).alias("payments"), exact_sum(F.col("payment_value")).alias("value")
    )
    everything = Window.partitionBy()
    return per_type.select(
        "payment_type", "payments",
        F.round("value", 4).alias("total_value"),
        F.round(F.col("payments") / F.sum("payments").over(everything), 4).alias("payment_share"),
        F.round(F.col("value") / F.sum("value").over(everything), 4).alias("value_share"),
    )


def installment_trend(gold: Gold) -> DataFrame:
    """Mean installments per purchase month; payments are summed per order first."""
    per_order = gold["fact_payments"].groupBy("order_id").agg(
        F.count(F.lit(1)).alias("payments"), F.sum("payment_installments").alias("installments")
    )
    bought = gold["fact_orders"].select("order_id", "purchase_date_key")
    dated = per_order.join(bought, "order_id").join(_months(gold), "purchase_date_key", "left")
    return dated.groupBy("year", "month").agg(
        F.sum("payments").alias("payments"),
        F.round(F.sum("installments") / F.sum("payments"), 4).alias("mean_installments"),
    )


def avg_order_value(gold: Gold) -> DataFrame:
    """Over the orders that have a payment."""
    paid = gold["fact_orders"].filter("payment_method_count > 0")
    return paid.agg(
        F.count(F.lit(1)).alias("paid_orders"),
        F.round(exact_sum(F.col("total_payment_value")), 4).alias("total_value"),
        F.round(exact_sum(F.col("total_payment_value")) / F.count(F.lit(1)), 4).alias("avg_order_value"),
    )
