"""Raw text tables -> cleaned, typed tables. Every function is one whole-table job.

Narrow projections except where noted. The functions accept raw columns as text
(the CSV reader) or already typed.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace import config
from terrace.functions.casts import strict_double, strict_int
from terrace.functions.dates import elapsed_days, parse_timestamp
from terrace.functions.text import clean_city, clean_code, clean_label, zero_pad
from terrace.operators.dedupe import keep_first
from terrace.operators.joins import balanced_join


def _address(prefix: str) -> dict[str, Column]:
    return {
        f"{prefix}_zip_code_prefix": zero_pad(F.col(f"{prefix}_zip_code_prefix")),
        f"{prefix}_city": clean_city(F.col(f"{prefix}_city")),
        f"{prefix}_state": clean_code(F.col(f"{prefix}_state")),
    }


def cleaners(table: str) -> dict[str, Column]:
    """The text columns of a table that are cleaned in place, and how."""
    match table:
        case "customers" | "geolocation":
            return _address(table.removesuffix("s"))
        case "sellers":
            return _address("seller")
        case "orders":
            return {"order_status": clean_label(F.col("order_status"))}
        case "order_payments":
            return {"payment_type": clean_label(F.col("payment_type"))}
        case "products":
            return {"product_category_name": F.coalesce("product_category_name", F.lit(config.UNKNOWN_CATEGORY))}
    return {}


# Form of each moment column, by name; a column without one takes any form, value by value.
Forms = Mapping[str, str | None]


def _moments(table: str, forms: Forms | None) -> dict[str, Column]:
    return {c: parse_timestamp(F.col(c), (forms or {}).get(c)) for c in config.DATE_COLUMNS[table]}


def _unparsed(moments: dict[str, Column], flags: bool) -> dict[str, Column]:
    """With ``flags``, ``_unparsed``: how many moments of a row cannot be read. The table writer is told to drop it."""
    lost = [(F.col(c).isNotNull() & moment.isNull()).cast("int") for c, moment in moments.items()]
    return {"_unparsed": sum(lost[1:], lost[0])} if flags else {}


def customers(raw: DataFrame) -> DataFrame:
    """Clean addresses; one row per customer_id, the first in file order (one shuffle).

    Repeats are dropped before the text is cleaned, so no work goes to waste.
    """
    columns = list(config.RAW_COLUMNS["customers"])
    first = keep_first(raw.select(*columns, config.POSITION), ["customer_id"])
    return first.select(*columns).withColumns(cleaners("customers"))


def geolocation_points(raw: DataFrame) -> DataFrame:
    """Clean coordinates inside the bounding box, still one row per point."""
    columns = list(config.RAW_COLUMNS["geolocation"])
    lat = strict_double(F.col("geolocation_lat"))
    lng = strict_double(F.col("geolocation_lng"))
    return (
        raw.select(*columns)
        .withColumns({"geolocation_lat": lat, "geolocation_lng": lng})
        .filter(in_box())
        .withColumns(cleaners("geolocation"))
    )


def in_box() -> Column:
    """Coordinates in range, bounds included; a missing coordinate is outside."""
    inside = F.col("geolocation_lat").between(*config.LATITUDE_RANGE) & F.col(
        "geolocation_lng"
    ).between(*config.LONGITUDE_RANGE)
    return F.coalesce(inside, F.lit(False))


def geolocation(raw: DataFrame) -> DataFrame:
    """One row per zip: mean coordinates, most frequent city and state (ties: lowest).

    Points are first counted per (zip, city) and per (zip, state), with partial
    counts in front of the shuffle, so a zip holding a large share of the points
    arrives as a handful of rows. Means are put together from those sums.
    """
    zip_code = "geolocation_zip_code_prefix"
    names = geolocation_points(raw).select(zip_code, F.inline(F.array(
        _name("city", F.col("geolocation_lat"), F.col("geolocation_lng")),
        _name("state", F.lit(None), F.lit(None)),
    )))
    counted = names.groupBy(zip_code, "kind", "value").agg(
        F.count(F.lit(1)).alias("points"), F.sum("lat").alias("lat"), F.sum("lng").alias("lng")
    )
    points = F.sum(F.when(F.col("kind") == "city", F.col("points")))
    return counted.groupBy(zip_code).agg(
        (F.sum("lat").cast("double") / points).alias("geolocation_lat"),
        (F.sum("lng").cast("double") / points).alias("geolocation_lng"),
        _most_frequent("city").alias("geolocation_city"),
        _most_frequent("state").alias("geolocation_state"),
    )


def _name(kind: str, lat: Column, lng: Column) -> Column:
    return F.struct(
        F.lit(kind).alias("kind"), F.col(f"geolocation_{kind}").alias("value"),
        # Decimals add up to the same sum in any order.
        lat.cast("decimal(28,12)").alias("lat"), lng.cast("decimal(28,12)").alias("lng"),
    )


def _most_frequent(kind: str) -> Column:
    """Name with the most points, the lowest on a tie, nulls left out."""
    named = (F.col("kind") == kind) & F.col("value").isNotNull()
    return F.min(F.when(named, F.struct(-F.col("points"), F.col("value"))))["value"]


def orders(raw: DataFrame, forms: Forms | None = None, flags: bool = False) -> DataFrame:
    moments = _moments("orders", forms)
    typed = raw.select(*config.RAW_COLUMNS["orders"]).withColumns(moments | cleaners("orders") | _unparsed(moments, flags))
    return typed.withColumns({
        "is_delivered": F.coalesce(F.col("order_status") == "delivered", F.lit(False)),
        "delivery_delay_days": elapsed_days(
            F.col("order_estimated_delivery_date"), F.col("order_delivered_customer_date")
        ),
    })


def order_items(raw: DataFrame, forms: Forms | None = None, flags: bool = False) -> DataFrame:
    moments = _moments("order_items", forms)
    return raw.select(*config.RAW_COLUMNS["order_items"]).withColumns(moments | {
        "price": strict_double(F.col("price")),
        "freight_value": strict_double(F.col("freight_value")),
    } | _unparsed(moments, flags))


def order_payments(raw: DataFrame) -> DataFrame:
    return raw.select(*config.RAW_COLUMNS["order_payments"]).withColumns(cleaners("order_payments") | {
        "payment_value": strict_double(F.col("payment_value")),
        "payment_installments": strict_int(F.col("payment_installments"), "payment_installments"),
    })


def order_reviews(raw: DataFrame, forms: Forms | None = None, flags: bool = False) -> DataFrame:
    moments = _moments("order_reviews", forms)
    return raw.select(*config.RAW_COLUMNS["order_reviews"]).withColumns(moments | {
        "review_score": strict_int(F.col("review_score"), "review_score"),
    } | _unparsed(moments, flags))


def products(raw: DataFrame, translation: DataFrame, flags: bool = False) -> DataFrame:
    """Fill the category, look up its English name, fall back to the original.

    ``flags`` adds ``_untranslated`` for the load report; the table writer is told to drop it.
    """
    filled = raw.select(*config.RAW_COLUMNS["products"]).withColumns(
        cleaners("products") | {c: strict_double(F.col(c)) for c in config.PRODUCT_MEASURES}
    )
    english = translation.select(*config.RAW_COLUMNS["category_translation"])
    found = balanced_join(filled, english, "product_category_name", "left")
    translated = F.col("product_category_name_english")
    return found.select(
        *filled.columns,
        F.coalesce(translated, "product_category_name").alias("product_category_name_english"),
        *([translated.isNull().alias("_untranslated")] if flags else []),
    )


def sellers(raw: DataFrame) -> DataFrame:
    return raw.select(*config.RAW_COLUMNS["sellers"]).withColumns(cleaners("sellers"))
