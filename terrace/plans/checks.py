"""The raw quality gate (19 rules on 4 tables) and the model tests on gold (25)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace import config
from terrace.operators.rules import (
    AcceptedValues, Between, InSet, LengthEquals, NotNull, Relationship, Rule, Unique, evaluate,
)
from terrace.operators.union import union_all

# The rules every raw load has to pass.
RAW_SUITES: dict[str, list[Rule]] = {
    "customers": [
        NotNull("customer_id"),
        Unique(("customer_id",)),
        NotNull("customer_unique_id"),
        NotNull("customer_state"),
        LengthEquals("customer_state", length=2),
    ],
    "orders": [
        NotNull("order_id"),
        Unique(("order_id",)),
        NotNull("order_purchase_timestamp"),
        InSet("order_status", values=config.ORDER_STATUSES),
        NotNull("order_approved_at", mostly=0.997),
    ],
    "order_items": [
        NotNull("order_id"),
        NotNull("product_id"),
        Between("price", low=0),
        Between("freight_value", low=0),
        Unique(("order_id", "order_item_id")),
    ],
    "order_reviews": [
        NotNull("review_id"),
        NotNull("order_id"),
        Between("review_score", low=1, high=5),
        Unique(("review_id", "order_id")),
    ],
}


class DataQualityError(RuntimeError):
    """A raw load or a built model broke its rules."""


def raw_results(raw: Mapping[str, DataFrame]) -> DataFrame:
    """(suite, rule, column, checked, unexpected, ..., success) for all raw suites."""
    return union_all(
        evaluate(raw[suite], rules).withColumn("suite", F.lit(suite))
        for suite, rules in RAW_SUITES.items()
    )


def gate_status(results: DataFrame) -> DataFrame:
    """PASS or FAIL per suite."""
    return results.groupBy("suite").agg(
        F.count(F.lit(1)).alias("rules"),
        F.count_if(~F.col("success")).alias("failed_rules"),
        F.when(F.every("success"), "PASS").otherwise("FAIL").alias("status"),
    )


def model_rules(gold: Mapping[str, DataFrame]) -> dict[str, list[Rule]]:
    def key(column: str) -> list[Rule]:
        return [Unique((column,)), NotNull(column)]

    # The assertions on the finished models.
    return {
        "dim_date": key("date_key"),
        "dim_customers": key("customer_key") + key("customer_unique_id"),
        "dim_products": key("product_key") + key("product_id"),
        "dim_sellers": key("seller_key") + key("seller_id"),
        "fact_order_items": [
            NotNull("order_id"),
            Relationship(("product_key",), parent=gold["dim_products"], parent_column="product_key"),
            Relationship(("seller_key",), parent=gold["dim_sellers"], parent_column="seller_key"),
            Between("price", low=0),
            Unique(("order_id", "order_item_id")),
        ],
        "fact_orders": key("order_id") + [
            AcceptedValues(("order_status",), values=config.ORDER_STATUSES),
        ],
        "fact_payments": [Between("payment_value", low=0)],
        "fact_reviews": [
            Between("review_score", low=1, high=5),
            Unique(("review_id", "order_id")),
        ],
    }


def model_results(gold: Mapping[str, DataFrame]) -> DataFrame:
    """(model, test, column, failures, success): what each assertion would return."""
    return union_all(
        evaluate(gold[model], rules).select(
            F.lit(model).alias("model"), F.col("rule").alias("test"), "column", "failures", "success"
        )
        for model, rules in model_rules(gold).items()
    )


def calendar_coverage(gold: Mapping[str, DataFrame]) -> DataFrame:
    """Date keys of the facts that dim_date does not hold (reported apart from the tests)."""
    columns = {
        "fact_order_items": ("purchase_date_key", "shipping_limit_date_key"),
        "fact_orders": (
            "purchase_date_key", "approval_date_key", "carrier_date_key",
            "delivery_date_key", "estimated_delivery_date_key",
        ),
        "fact_reviews": ("review_creation_date_key", "review_answer_date_key"),
    }
    return union_all(
        evaluate(gold[model], [
            Relationship((c,), parent=gold["dim_date"], parent_column="date_key") for c in names
        ]).select(F.lit(model).alias("model"), F.col("rule").alias("test"), "column", "failures", "success")
        for model, names in columns.items()
    )
