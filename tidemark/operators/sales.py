"""Daily sales, with refunds on the day of return (cash) or of the order (accrual)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.expressions import rounded_mean
from tidemark.functions.time import day
from tidemark.operators.changes import INSERT, UPDATE
from tidemark.schemas import DAILY_SALES, SALES_SUMS, conform

# The refund status that counts as money returned, and the days that are refreshed.
APPROVED = "APPROVED"
REFRESH_DAYS = 30


def _refunds(returns: DataFrame, on: str) -> DataFrame:
    return returns.groupBy(F.col(on).alias("order_date")).agg(
        F.sum("refund_amount").alias("refunds"), F.count("*").alias("returned")
    )


def _refunds_by_order_date(returns: DataFrame, orders: DataFrame) -> DataFrame:
    # Summed per order first: the join then needs no further shuffle of the returns, and an
    # order with very many of them is one row.
    per_order = returns.groupBy("order_id").agg(F.sum("refund_amount").alias("refunds"), F.count("*").alias("returned"))
    dated = per_order.join(orders.select("order_id", "order_date"), "order_id")
    return dated.groupBy("order_date").agg(F.sum("refunds").alias("refunds"), F.sum("returned").alias("returned"))


def _daily(orders: DataFrame, refunds: DataFrame, run_ts: Column, how: str) -> DataFrame:
    sold = orders.groupBy("order_date").agg(
        F.count_distinct("order_id").alias("total_orders"),
        F.sum("total").alias("sold"),
        F.count("total").alias("priced"),
    )
    refund = F.coalesce("refunds", F.lit(0))
    # Without unmatched refund days every row has orders, and a null total stays null.
    gross = F.col("sold") if how == "left" else F.coalesce("sold", F.lit(0))
    rows = sold.join(refunds, "order_date", how).select(
        "order_date",
        F.coalesce("total_orders", F.lit(0)).alias("total_orders"),
        gross.alias("gross_revenue"),
        refund.alias("total_refunds"),
        (gross - refund).alias("net_revenue"),
        F.coalesce("returned", F.lit(0)).alias("total_returns"),
        rounded_mean(F.col("sold"), F.col("priced"), 2).alias("avg_order_value"),
        run_ts.alias("load_ts"),
    )
    return conform(rows, DAILY_SALES)


def _since(df: DataFrame, column: str, as_of: date, days: int | None) -> DataFrame:
    return df if days is None else df.filter(F.col(column) >= F.date_sub(day(as_of), days))


def daily_sales_cash(
    orders: DataFrame,
    returns: DataFrame,
    as_of: date,
    run_ts: Column,
    days: int | None = REFRESH_DAYS,
    include_refund_only_days: bool = False,
) -> DataFrame:
    """Approved refunds count on the day of the return.

    Days without orders are left out, and their refunds with them, unless
    ``include_refund_only_days`` is set. ``days=None`` refreshes every day.
    """
    approved = _since(returns.filter(F.col("status") == APPROVED), "return_date", as_of, days)
    how = "full_outer" if include_refund_only_days else "left"
    return _daily(_since(orders, "order_date", as_of, days), _refunds(approved, "return_date"), run_ts, how)


def daily_sales_accrual(
    orders: DataFrame, returns: DataFrame, as_of: date, run_ts: Column, days: int | None = REFRESH_DAYS
) -> DataFrame:
    """Approved refunds count on the day of the order they undo."""
    recent = _since(orders, "order_date", as_of, days)
    approved = returns.filter(F.col("status") == APPROVED)
    return _daily(recent, _refunds_by_order_date(approved, recent), run_ts, "left")


# --- daily sales kept by signed changes ------------------------------------------------------------

_SUMS = ("orders", "sold", "priced", "refunds", "returned")


def _of_orders(orders: DataFrame, sign: Column) -> DataFrame:
    """What signed orders add to their days."""
    priced = F.col("total").isNotNull().cast("bigint")
    return orders.select(
        "order_date", sign.alias("orders"), (F.coalesce("total", F.lit(0)) * sign).alias("sold"), (priced * sign).alias("priced"),
        F.lit(0).alias("refunds"), F.lit(0).alias("returned"),
    )


def _of_refunds(returns: DataFrame, on: str, sign: Column) -> DataFrame:
    """What signed approved returns add to the days in column ``on``."""
    approved = returns.filter((F.col("status") == APPROVED) & F.col(on).isNotNull())
    return approved.select(
        F.col(on).alias("order_date"), F.lit(0).alias("orders"), F.lit(0).alias("sold"), F.lit(0).alias("priced"),
        (F.coalesce("refund_amount", F.lit(0)) * sign).alias("refunds"), sign.alias("returned"),
    )


def _summed(*parts: DataFrame) -> DataFrame:
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    added = rows.groupBy("order_date").agg(*[F.sum(c).alias(c) for c in _SUMS])
    return conform(added.filter(" or ".join(f"{c} <> 0" for c in _SUMS)), SALES_SUMS)


def _dated(returns: DataFrame, orders: DataFrame) -> DataFrame:
    """Returns with the date of their order as ``ordered_on``."""
    dates = orders.select("order_id", F.col("order_date").alias("ordered_on"))
    return returns.join(dates, "order_id")


def sales_sums(orders: DataFrame, returns: DataFrame, accrual: bool) -> DataFrame:
    """Additive sums per day, of all orders and returns; days with refunds only are kept too."""
    one = F.lit(1).cast("bigint")
    refunds = _of_refunds(_dated(returns, orders), "ordered_on", one) if accrual else _of_refunds(returns, "return_date", one)
    return _summed(_of_orders(orders, one), refunds)


def _sign() -> Column:
    return F.when(F.col("_action").isin(INSERT, UPDATE), 1).otherwise(-1).cast("bigint")


def sales_delta(
    order_images: DataFrame,
    return_images: DataFrame,
    accrual: bool,
    before: tuple[DataFrame, DataFrame] | None = None,
    after: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """What changes of orders and returns (change images, with ``_action``) add to and take from each day.

    Old images count minus and new ones plus, so a day is corrected however long ago it was, and no other day is looked at.
    On accrual basis a refund moves with its order, so the refunds of changed orders count as well: ``before`` and ``after``
    are the orders and returns in either state, of which only those are read that the changes name.
    """
    sold = _of_orders(order_images, _sign())
    if not accrual:
        return _summed(sold, _of_refunds(return_images, "return_date", _sign()))
    named = order_images.select("order_id").unionByName(return_images.select("order_id")).distinct()
    parts = [sold]
    for (orders, returns), sign in ((before, -1), (after, 1)):
        own_orders, own_returns = (t.join(named, "order_id", "left_semi") for t in (orders, returns))
        parts.append(_of_refunds(_dated(own_returns, own_orders), "ordered_on", F.lit(sign).cast("bigint")))
    return _summed(*parts)


def add_sums(sums: DataFrame, delta: DataFrame) -> DataFrame:
    return _summed(sums, delta)


def daily_from_sums(sums: DataFrame, run_ts: Column) -> DataFrame:
    """Daily sales of the days that have orders."""
    gross = F.when(F.col("priced") > 0, F.col("sold"))
    rows = sums.filter("orders > 0").select(
        "order_date",
        F.col("orders").alias("total_orders"),
        gross.alias("gross_revenue"),
        F.col("refunds").alias("total_refunds"),
        (gross - F.col("refunds")).alias("net_revenue"),
        F.col("returned").alias("total_returns"),
        rounded_mean(gross, F.col("priced"), 2).alias("avg_order_value"),
        run_ts.alias("load_ts"),
    )
    return conform(rows, DAILY_SALES)
