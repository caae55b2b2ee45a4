"""Names and fixed values of the retail data model."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# ---------------------------------------------------------------- raw entities

# Column names of the raw files, in file order.
RAW_COLUMNS: dict[str, tuple[str, ...]] = {
    "customers": (
        "customer_id", "customer_unique_id", "customer_zip_code_prefix",
        "customer_city", "customer_state",
    ),
    "geolocation": (
        "geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng",
        "geolocation_city", "geolocation_state",
    ),
    "order_items": (
        "order_id", "order_item_id", "product_id", "seller_id",
        "shipping_limit_date", "price", "freight_value",
    ),
    "order_payments": (
        "order_id", "payment_sequential", "payment_type",
        "payment_installments", "payment_value",
    ),
    "order_reviews": (
        "review_id", "order_id", "review_score", "review_comment_title",
        "review_comment_message", "review_creation_date", "review_answer_timestamp",
    ),
    "orders": (
        "order_id", "customer_id", "order_status", "order_purchase_timestamp",
        "order_approved_at", "order_delivered_carrier_date",
        "order_delivered_customer_date", "order_estimated_delivery_date",
    ),
    "products": (
        "product_id", "product_category_name", "product_name_lenght",
        "product_description_lenght", "product_photos_qty", "product_weight_g",
        "product_length_cm", "product_height_cm", "product_width_cm",
    ),
    "sellers": (
        "seller_id", "seller_zip_code_prefix", "seller_city", "seller_state",
    ),
    "category_translation": (
        "product_category_name", "product_category_name_english",
    ),
}

# The tables of the layers.
SILVER_TABLES = (
    "customers", "geolocation", "orders", "order_items",
    "order_payments", "order_reviews", "products", "sellers",
)

GOLD_TABLES = (
    "dim_date", "dim_customers", "dim_products", "dim_sellers",
    "fact_order_items", "fact_orders", "fact_payments", "fact_reviews",
)

# Raw columns that hold moments.
ORDER_DATE_COLUMNS = (
    "order_purchase_timestamp", "order_approved_at",
    "order_delivered_carrier_date", "order_delivered_customer_date",
    "order_estimated_delivery_date",
)

DATE_COLUMNS: dict[str, tuple[str, ...]] = {
    "orders": ORDER_DATE_COLUMNS,
    "order_items": ("shipping_limit_date",),
    "order_reviews": ("review_creation_date", "review_answer_timestamp"),
}

# Numeric raw columns of the products.
PRODUCT_MEASURES = (
    "product_name_lenght", "product_description_lenght", "product_photos_qty",
    "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm",
)

# Column added by the readers: where the row stood in its file. Only
# keep-the-first de-duplication looks at it; every other plan prunes it.
POSITION = "_position"


@dataclass(frozen=True)
class Source:
    """One raw entity and the file (or glob of part files) that carries it.

    ``file_name`` is relative to the raw folder and may name a folder within it.
    ``multi_line`` keeps quoted line breaks inside one record. Large files of that kind are
    cut between records before they are read, which copies them once; switch it off for a
    feed known to hold one record per physical line, whose files Spark splits by itself.
    """

    entity: str
    file_name: str
    multi_line: bool = True

    @property
    def landed_name(self) -> str:
        """The file name (or glob) inside a load folder."""
        return self.file_name.rpartition("/")[2]

    @property
    def schema(self) -> T.StructType:
        return T.StructType(
            [T.StructField(name, T.StringType()) for name in RAW_COLUMNS[self.entity]]
        )


def sources(pattern: str = "{entity}.csv", **file_names: str) -> dict[str, Source]:
    """The nine sources; ``file_names`` overrides the pattern for single entities."""
    return {
        entity: Source(entity, file_names.get(entity, pattern.format(entity=entity)))
        for entity in RAW_COLUMNS
    }


# --------------------------------------------------------------- fixed values

# Text that the raw reader treats as a missing value.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# The order life cycle.
ORDER_STATUSES = (
    "delivered", "shipped", "canceled", "invoiced",
    "processing", "created", "approved", "unavailable",
)

# Bounding box that valid coordinates must fall into (inclusive).
LATITUDE_RANGE = (-34.0, 6.0)
LONGITUDE_RANGE = (-74.0, -32.0)

ZIP_WIDTH = 5
UNKNOWN_CATEGORY = "unknown"
UNKNOWN_KEY = -1

# Default calendar of dim_date.
CALENDAR_START = "2016-01-01"
CALENDAR_DAYS = 1200
