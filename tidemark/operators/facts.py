"""Fact tables: clean rows with their date and the customer version in force."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators.asof import as_of_customer
from tidemark.operators.joins import left_join

Lookup = Callable[[DataFrame, DataFrame, str, str], DataFrame]


def fact_orders(orders: DataFrame, dim: DataFrame, run_ts: Column, lookup: Lookup = as_of_customer) -> DataFrame:
    rows = lookup(orders, dim, "customer_id", "order_ts").select(
        "*", F.to_date("order_ts").alias("order_date"), F.col("status").alias("order_status")
    )
    return schemas.conform(rows.withColumn("load_ts", run_ts), schemas.FACT_ORDERS)


def fact_payments(
    payments: DataFrame, orders: DataFrame, dim: DataFrame, run_ts: Column, lookup: Lookup = as_of_customer
) -> DataFrame:
    """Payments name no customer; it is found through the clean order."""
    payer = orders.select("order_id", F.col("customer_id").alias("_payer"))
    rows = lookup(left_join(payments, payer, "order_id"), dim, "_payer", "payment_ts")
    return schemas.conform(rows.withColumn("load_ts", run_ts), schemas.FACT_PAYMENTS)


def fact_returns(returns: DataFrame, dim: DataFrame, run_ts: Column, lookup: Lookup = as_of_customer) -> DataFrame:
    rows = lookup(returns, dim, "customer_id", "return_ts").withColumn("return_date", F.to_date("return_ts"))
    return schemas.conform(rows.withColumn("load_ts", run_ts), schemas.FACT_RETURNS)


def fact_events(events: DataFrame, dim: DataFrame, run_ts: Column, lookup: Lookup = as_of_customer) -> DataFrame:
    rows = lookup(events, dim, "user_id", "event_ts").select(
        "*",
        F.to_date("event_ts").alias("event_date"),
        F.try_variant_get("payload", "$.product_id", "string").alias("product_id"),
    )
    return schemas.conform(rows.withColumn("load_ts", run_ts), schemas.FACT_EVENTS)


def rekey(fact: DataFrame, key: str, fresh: DataFrame) -> DataFrame:
    """Fill null customer keys from a rebuilt ``fresh`` fact, for dimension rows that arrived late."""
    found = fresh.filter("customer_sk is not null").select(key, F.col("customer_sk").alias("_found"))
    return fact.join(found, key, "left").select(
        *[F.coalesce("customer_sk", "_found").alias(c) if c == "customer_sk" else F.col(c) for c in fact.columns]
    )
