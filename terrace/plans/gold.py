"""Star schema: four dimensions, four facts, built from staged silver tables.

Arguments are silver tables; dimensions passed to a fact must be stored tables,
because a surrogate key has to be read back, never computed twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace import config
from terrace.functions.casts import exact_sum
from terrace.functions.dates import date_key
from terrace.operators.dedupe import first_per_key
from terrace.operators.joins import balanced_join
from terrace.operators.keys import dense_key
from terrace.operators.union import union_all
from terrace.plans import staging


# ------------------------------------------------------------------ dimensions


def fixed_days(spark: SparkSession, start: str = config.CALENDAR_START, days: int = config.CALENDAR_DAYS) -> DataFrame:
    """``days`` consecutive days from ``start``."""
    return spark.range(days).select(
        F.date_add(F.lit(start).cast("date"), F.col("id").cast("int")).alias("full_date")
    )


def covering_days(orders: DataFrame, order_items: DataFrame, order_reviews: DataFrame) -> DataFrame:
    """Every day from the first to the last date that a fact refers to.

    One row of bounds per table, then one row in all; the calendar that is spread
    from it grows with the period, not with the data.
    """
    dated = (
        (orders, config.ORDER_DATE_COLUMNS),
        (order_items, ("shipping_limit_date",)),
        (order_reviews, ("review_creation_date", "review_answer_timestamp")),
    )
    bounds = []
    for df, columns in dated:
        days = F.array(*[F.col(c).cast("date") for c in columns])
        bounds.append(df.select(
            F.array_min(days).alias("first"), F.array_max(days).alias("last")
        ).agg(F.min("first").alias("first"), F.max("last").alias("last")))
    span = union_all(bounds).agg(F.min("first").alias("first"), F.max("last").alias("last"))
    return span.select(F.explode(F.sequence("first", "last")).alias("full_date"))


def dim_date(days: DataFrame) -> DataFrame:
    """Parts of every calendar day, plus the -1 row that unknown dates point to."""
    full_date = F.col("full_date")
    weekday = F.dayofweek(full_date) - 1
    known = days.select(
        date_key(full_date).alias("date_key"),
        full_date,
        F.dayofmonth(full_date).alias("day"),
        F.date_format(full_date, "EEEE").alias("day_name"),
        weekday.alias("day_of_week"),
        F.dayofyear(full_date).alias("day_of_year"),
        F.weekofyear(full_date).alias("week_of_year"),
        F.month(full_date).alias("month"),
        F.date_format(full_date, "MMMM").alias("month_name"),
        F.quarter(full_date).alias("quarter"),
        F.year(full_date).alias("year"),
        weekday.isin(0, 6).alias("is_weekend"),
    )
    named = {"date_key": config.UNKNOWN_KEY, "day_name": "Unknown", "month_name": "Unknown"}
    unknown = days.sparkSession.range(1).select(*[
        F.lit(named.get(field.name)).cast(field.dataType).alias(field.name) for field in known.schema
    ])
    return known.unionByName(unknown)


def representative_address(customers: DataFrame) -> DataFrame:
    """One address per person: the most frequent, then the one used last.

    Equal addresses collapse in front of the first shuffle and all but one
    candidate per person in front of the second, whatever the person's share.
    """
    address = ["customer_unique_id", "customer_city", "customer_state", "customer_zip_code_prefix"]
    counted = staging.customers(customers).groupBy(*address).agg(
        F.count(F.lit(1)).alias("frequency"), F.max("customer_id").alias("last_id")
    )
    best = [F.col("frequency").desc_nulls_first(), F.col("last_id").desc_nulls_first()]
    return first_per_key(counted, ["customer_unique_id"], best).select(*address)


def _with_coordinates(
    df: DataFrame, zip_code: str, geolocation: DataFrame, keys_from: DataFrame | None = None
) -> DataFrame:
    places = staging.geolocation(geolocation).withColumnRenamed("zip_code_prefix", zip_code)
    joined = balanced_join(df, places, zip_code, "left", keys_from)
    return joined.select(*df.columns, "latitude", "longitude")


def dim_customers(customers: DataFrame, geolocation: DataFrame) -> DataFrame:
    people = _with_coordinates(
        representative_address(customers), "customer_zip_code_prefix", geolocation, keys_from=customers
    )
    return dense_key(people, "customer_unique_id", "customer_key")


def dim_products(products: DataFrame) -> DataFrame:
    return dense_key(staging.products(products), "product_id", "product_key")


def dim_sellers(sellers: DataFrame, geolocation: DataFrame) -> DataFrame:
    placed = _with_coordinates(staging.sellers(sellers), "seller_zip_code_prefix", geolocation).select(
        "seller_id", "seller_city", "seller_state", "seller_zip_code_prefix", "latitude", "longitude"
    )
    return dense_key(placed, "seller_id", "seller_key")


def customer_bridge(customers: DataFrame, dim_customers: DataFrame) -> DataFrame:
    """(customer_id, customer_key): the two hops from an order to a person, done once."""
    known = dim_customers.select("customer_unique_id", "customer_key")
    ids = staging.customers(customers).select("customer_id", "customer_unique_id")
    return balanced_join(ids, known, "customer_unique_id", "left", keys_from=customers).select("customer_id", "customer_key")


# ----------------------------------------------------------------------- facts


def fact_order_items(
    order_items: DataFrame,
    fact_orders: DataFrame,
    dim_products: DataFrame,
    dim_sellers: DataFrame,
) -> DataFrame:
    """One row per order line that belongs to an order; unmatched keys stay null.

    Customer and purchase date were looked up per order already; they are taken
    from the stored order rows instead of being looked up again per line. They come
    last and each id goes when its key is known, so lines move as narrow as they can;
    sellers, the fewest, come first, as lines often need not move to meet them.
    """
    heads = fact_orders.select("order_id", "purchase_date_key", "customer_key")
    lines = staging.order_items(order_items)
    found = balanced_join(
        lines.withColumn("shipping_limit_date_key", date_key(F.col("shipping_limit_date"))).drop("shipping_limit_date"),
        dim_sellers.select("seller_id", "seller_key"), "seller_id", "left", lines,
    ).drop("seller_id")
    found = balanced_join(
        found, dim_products.select("product_id", "product_key"), "product_id", "left", lines
    ).drop("product_id")
    found = balanced_join(found, heads, "order_id", "inner", lines)
    return found.select(
        "order_id", "order_item_id",
        "product_key", "seller_key", "customer_key",
        "purchase_date_key", "shipping_limit_date_key", "price", "freight_value",
    )


def payment_rollup(order_payments: DataFrame) -> DataFrame:
    return staging.order_payments(order_payments).groupBy("order_id").agg(
        exact_sum(F.col("payment_value")).alias("total_payment_value"),
        F.count_distinct("payment_sequential").alias("payment_method_count"),
    )


def review_rollup(order_reviews: DataFrame) -> DataFrame:
    return staging.order_reviews(order_reviews).groupBy("order_id").agg(
        F.avg("review_score").cast("decimal(3,2)").alias("avg_review_score"),
        F.count(F.lit(1)).alias("review_count"),
    )


def fact_orders(
    orders: DataFrame,
    order_payments: DataFrame,
    order_reviews: DataFrame,
    bridge: DataFrame,
) -> DataFrame:
    """One row per order with its life-cycle dates and rolled-up measures.

    Payments and reviews are rolled up to the order before they are joined, so
    no order is repeated. The customer lookup goes first: after it, orders and
    both roll-ups meet on order_id with a single exchange each. These two joins
    need no salting, all three sides have one row per order (the raw gate has
    checked orders for that).
    """
    dates = {
        "purchase_date_key": "order_purchase_timestamp",
        "approval_date_key": "order_approved_at",
        "carrier_date_key": "order_delivered_carrier_date",
        "delivery_date_key": "order_delivered_customer_date",
        "estimated_delivery_date_key": "order_estimated_delivery_date",
    }
    # Date keys are made first: five integers move through the joins, not five moments.
    keyed = staging.orders(orders).select(
        "order_id", "customer_id", *[date_key(F.col(source)).alias(name) for name, source in dates.items()],
        "order_status", "delivery_delay_days",
    )
    heads = balanced_join(keyed, bridge, "customer_id", "left", keys_from=orders).drop("customer_id")
    measured = (
        heads
        .join(payment_rollup(order_payments), "order_id", "left")
        .join(review_rollup(order_reviews), "order_id", "left")
    )
    return measured.select(
        "order_id", "customer_key", *dates, "order_status", "delivery_delay_days",
        F.coalesce("total_payment_value", F.lit(0.0)).alias("total_payment_value"),
        F.coalesce("payment_method_count", F.lit(0)).alias("payment_method_count"),
        "avg_review_score",
        F.coalesce("review_count", F.lit(0)).alias("review_count"),
    )


def fact_payments(order_payments: DataFrame) -> DataFrame:
    return staging.order_payments(order_payments)


def fact_reviews(order_reviews: DataFrame) -> DataFrame:
    return staging.order_reviews(order_reviews).select(
        "review_id", "order_id",
        date_key(F.col("review_creation_date")).alias("review_creation_date_key"),
        date_key(F.col("review_answer_timestamp")).alias("review_answer_date_key"),
        "review_score",
    )
