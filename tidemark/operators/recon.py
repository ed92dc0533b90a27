"""Revenue reconciliation: what each order was worth against what was paid and refunded."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.expressions import rounded_mean
from tidemark.functions.time import day, days_between


def _paid(status: str):
    return F.sum(F.when(F.col("status") == status, F.col("amount")).otherwise(F.lit(0)))


def payment_totals(payments: DataFrame) -> DataFrame:
    """Per order: amounts by payment status, number of payments, last payment."""
    return payments.groupBy("order_id").agg(
        _paid("SETTLED").alias("settled_amount"),
        _paid("PENDING").alias("pending_amount"),
        _paid("REFUNDED").alias("refunded_amount"),
        F.sum("amount").alias("total_payment_amount"),
        F.count("*").alias("payment_count"),
        F.max("payment_ts").alias("last_payment_ts"),
    )


def return_totals(returns: DataFrame) -> DataFrame:
    """Per order: refunds of every status, and number of returns."""
    return returns.groupBy("order_id").agg(
        F.sum("refund_amount").alias("total_refund_amount"), F.count("*").alias("return_count")
    )


def reconcile(orders: DataFrame, payments: DataFrame, returns: DataFrame, as_of: date) -> DataFrame:
    """One row per order with its balance and reconciliation status.

    Payments and returns are summed per order before they are joined, so an order
    with very many payments adds one row per task to the shuffle.
    """
    zero = F.lit(0)
    total, settled = F.col("order_total"), F.col("settled_amount")
    refunds = F.coalesce("total_refund_amount", zero)
    status = (
        F.when(F.col("payment_count").isNull(), "NO_PAYMENT")
        .when((settled == total) & (refunds == 0), "FULLY_PAID")
        .when((settled == total) & (refunds > 0), "PAID_WITH_RETURN")
        .when((settled < total) & (F.col("pending_amount") > 0), "PARTIAL_PENDING")
        .when(settled < total, "UNDERPAID")
        .when(settled > total, "OVERPAID")
        .otherwise("UNKNOWN")
    )
    unsettled = F.coalesce(settled, zero) < total
    base = orders.select("order_id", "order_date", "customer_sk", "order_status", F.col("total").alias("order_total"))
    joined = base.join(payment_totals(payments), "order_id", "left").join(return_totals(returns), "order_id", "left")
    return joined.select(
        "order_id",
        "order_date",
        "customer_sk",
        "order_status",
        "order_total",
        *[
            F.coalesce(c, zero).alias(c)
            for c in ("settled_amount", "pending_amount", "refunded_amount", "total_payment_amount", "payment_count")
        ],
        "last_payment_ts",
        refunds.alias("total_refund_amount"),
        F.coalesce("return_count", zero).alias("return_count"),
        (total - F.coalesce(settled, zero)).alias("outstanding_balance"),
        status.alias("recon_status"),
        F.when(unsettled, days_between("order_date", day(as_of))).alias("days_outstanding"),
    )


def summarise(reconciled: DataFrame) -> DataFrame:
    """Order counts and amounts per reconciliation status. Sort at the consumer."""
    return reconciled.groupBy("recon_status").agg(
        F.count("*").alias("order_count"),
        F.sum("order_total").alias("total_order_value"),
        F.sum("settled_amount").alias("total_settled"),
        F.sum("outstanding_balance").alias("total_outstanding"),
        F.sum("total_refund_amount").alias("total_refunds"),
        rounded_mean(F.sum("days_outstanding"), F.count("days_outstanding"), 6).alias("avg_days_outstanding"),
    )


def by_value(summary: DataFrame) -> DataFrame:
    """Report order: most valuable status first."""
    return summary.orderBy(F.desc_nulls_last("total_order_value"), "recon_status")
