"""Keeping erased people's rows out of every table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.joins import without


def not_in(df: DataFrame, column: str, listed: DataFrame, listed_column: str) -> DataFrame:
    """``column NOT IN (listed)`` with SQL's rule for null.

    A row whose column is null passes only if the list is empty. Written as an anti
    join plus that rule, because Spark runs ``NOT IN`` as a broadcast of the whole
    list however long it has grown. Nulls in the list are ignored.
    """
    blocked = listed.select(F.col(listed_column).alias(column)).filter(F.col(column).isNotNull())
    # Nulls are decided before the join, where they would all meet in one task.
    candidates = df.filter(F.col(column).isNotNull() | ~blocked.exists())
    return without(candidates, column, blocked, column)


def orders_of(orders: DataFrame, people: DataFrame) -> DataFrame:
    """Ids of the orders of listed people. Resolve these before any order is deleted."""
    return orders.join(people.select("customer_id"), "customer_id", "left_semi").select("order_id").distinct()


def purge(df: DataFrame, column: str, listed: DataFrame, listed_column: str) -> DataFrame:
    """Rows whose column is not listed; rows with null stay."""
    return without(df, column, listed, listed_column)


def purge_feeds(raw: dict[str, DataFrame], suppressed: DataFrame, suppressed_orders: DataFrame) -> dict[str, DataFrame]:
    """Raw feeds without suppressed people.

    Payments carry no customer, so they are matched through suppressed order ids:
    those remembered from earlier and those of this very load.
    """
    kept = {}
    known = suppressed_orders.select("order_id")
    if "orders" in raw:
        known = known.unionByName(orders_of(raw["orders"], suppressed))
    for name, df in raw.items():
        if name in ("customers", "orders", "returns"):
            kept[name] = purge(df, "customer_id", suppressed, "customer_id")
        elif name == "events":
            kept[name] = purge(df, "user_id", suppressed, "customer_id")
        elif name == "payments":
            kept[name] = purge(df, "order_id", known, "order_id")
        else:
            kept[name] = df
    return kept


def suppress_clean(name: str, df: DataFrame, suppressed: DataFrame, suppressed_orders: DataFrame) -> DataFrame:
    """The merge-time filter of one feed. Products name no person and pass."""
    if name in ("customers", "orders", "returns"):
        return not_in(df, "customer_id", suppressed, "customer_id")
    if name == "events":
        return not_in(df, "user_id", suppressed, "customer_id")
    if name == "payments":
        return not_in(df, "order_id", suppressed_orders, "order_id")
    return df
