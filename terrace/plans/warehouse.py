"""Wires raw tables to silver and gold."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from terrace import config
from terrace.plans import gold, silver
from terrace.sources.lazy import LazyTables
from terrace.sources.tables import materialise

# Keeps a table and returns it as read back.
Store = Callable[[DataFrame, str], DataFrame]


def silver_table(raw: Mapping[str, DataFrame], table: str, forms: silver.Forms | None = None) -> DataFrame:
    if table == "products":
        return silver.products(raw["products"], raw["category_translation"])
    if table in config.DATE_COLUMNS:
        return getattr(silver, table)(raw[table], forms)
    return getattr(silver, table)(raw[table])


class Warehouse:
    """Silver tables; dimensions, bridge and facts stored when first used.

    Each gold table is written once and read back by whatever needs it next, so
    surrogate keys stay the same and no report repeats the work of a fact.

    ``calendar`` is (first day, number of days); by default it spans the dates in the data.
    """

    def __init__(
        self,
        spark: SparkSession,
        silver_tables: Mapping[str, DataFrame],
        calendar: tuple[str, int] | None = None,
        store: Store = materialise,
    ):
        self.spark = spark
        self.silver = silver_tables
        self.calendar = calendar
        self._store = store
        self._stored: dict[str, DataFrame] = {}

    @classmethod
    def from_raw(cls, spark: SparkSession, raw: Mapping[str, DataFrame], **options) -> Warehouse:
        """Silver is stored when first used, as the daily run stores it: gold plans read the same kind of tables."""
        return cls(spark, LazyTables(
            config.SILVER_TABLES, lambda t: materialise(silver_table(raw, t), f"silver-{t}")
        ), **options)

    def build(self, table: str) -> DataFrame:
        """Plan of one gold table (or of the customer bridge)."""
        s = self.silver
        match table:
            case "dim_date":
                if self.calendar:
                    return gold.dim_date(gold.fixed_days(self.spark, *self.calendar))
                return gold.dim_date(
                    gold.covering_days(s["orders"], s["order_items"], s["order_reviews"])
                )
            case "dim_customers":
                return gold.dim_customers(s["customers"], s["geolocation"])
            case "dim_products":
                return gold.dim_products(s["products"])
            case "dim_sellers":
                return gold.dim_sellers(s["sellers"], s["geolocation"])
            case "customer_bridge":
                return gold.customer_bridge(s["customers"], self["dim_customers"])
            case "fact_order_items":
                return gold.fact_order_items(
                    s["order_items"], self["fact_orders"],
                    self["dim_products"], self["dim_sellers"],
                )
            case "fact_orders":
                return gold.fact_orders(
                    s["orders"], s["order_payments"], s["order_reviews"],
                    self["customer_bridge"],
                )
            case "fact_payments":
                return gold.fact_payments(s["order_payments"])
            case "fact_reviews":
                return gold.fact_reviews(s["order_reviews"])
        raise KeyError(table)

    def __getitem__(self, table: str) -> DataFrame:
        """Stored gold table."""
        if table not in self._stored:
            self._stored[table] = self._store(self.build(table), table)
        return self._stored[table]

    def gold(self) -> dict[str, DataFrame]:
        return {table: self[table] for table in config.GOLD_TABLES}
