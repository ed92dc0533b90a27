"""Where every table lives, and how it is laid out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.operators.session_days import fold_days
from tidemark.sources.id_index import IdIndex
from tidemark.sources.tables import AppendLog, Layout, SnapshotTables, bucket_of, month_of

SESSION_BUCKETS = 256


class Warehouse:
    """Handles to the raw, clean and serving tables below one root folder."""

    def __init__(self, spark: SparkSession, root: str, session_buckets: int = SESSION_BUCKETS):
        self.spark, self.root = spark, root.rstrip("/")
        self.raw = {f.name: self._log(f"raw/{f.name}", f.raw) for f in schemas.FEEDS.values()}
        self.rejects = {f.name: self._log(f"rejects/{f.name}", reject_schema(f)) for f in schemas.FEEDS.values()}
        self.clean = SnapshotTables(
            spark,
            f"{self.root}/clean",
            {f.name: f.clean for f in schemas.BATCH_FEEDS},
            {
                f.name: Layout(part=month_of(f.date_column) if f.date_column else None, sort=(f.key,))
                for f in schemas.BATCH_FEEDS
            },
        )
        self.clean_events = self._log("clean/events", schemas.EVENTS.clean, Layout(bloom=("user_id", "session_id")))
        self.event_ids = IdIndex(spark, f"{self.root}/clean/event_ids", schemas.EVENTS.key)
        self.served = SnapshotTables(
            spark,
            f"{self.root}/served",
            {
                "dim_customer": schemas.DIM_CUSTOMER,
                "dim_product": schemas.DIM_PRODUCT,
                "fact_orders": schemas.FACT_ORDERS,
                "fact_payments": schemas.FACT_PAYMENTS,
                "fact_returns": schemas.FACT_RETURNS,
                "daily_sales_cash": schemas.DAILY_SALES,
                "daily_sales_accrual": schemas.DAILY_SALES,
                "sales_sums_cash": schemas.SALES_SUMS,
                "sales_sums_accrual": schemas.SALES_SUMS,
            },
            {
                "dim_customer": Layout(sort=("customer_id", "is_current", "valid_from")),
                "dim_product": Layout(sort=("product_id",)),
                "fact_orders": Layout(part=month_of("order_date"), sort=("order_date", "order_id")),
                "fact_payments": Layout(part=month_of("payment_ts"), sort=("payment_ts", "payment_id")),
                "fact_returns": Layout(part=month_of("return_date"), sort=("return_date", "return_id")),
            },
        )
        self.fact_events = self._log("served_events/fact_events", schemas.FACT_EVENTS, Layout(sort=("event_date", "event_ts", "event_id")))
        # A batch's people and days decide which of these partitions change.
        bucket = F.concat(bucket_of("line", session_buckets), F.lit("."), month_of("day"))
        self.sessions = SnapshotTables(
            spark,
            f"{self.root}/served_events",
            {"session_days": schemas.SESSION_DAYS},
            {"session_days": Layout(part=bucket, sort=("line", "day_first"))},
        )
        self.check_results = self._log("control/check_results", schemas.CHECK_RESULTS)
        self.audit = self._log("control/audit", schemas.AUDIT_LOG)
        self.suppressed = self._log("control/suppressed", schemas.SUPPRESSION_LIST)
        self.suppressed_orders = self._log("control/suppressed_orders", schemas.SUPPRESSED_ORDERS)
        self.run_log = self._log("control/run_log", schemas.RUN_LOG)

    def fact_sessions(self) -> DataFrame:
        """Sessions folded from their stored parts."""
        return fold_days(self.sessions.read("session_days"))

    def _log(self, path: str, schema: T.StructType, layout: Layout = Layout()) -> AppendLog:
        return AppendLog(self.spark, f"{self.root}/{path}", schema, layout)

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/_streams/{name}"


def reject_schema(feed: schemas.Feed) -> T.StructType:
    """Rejected rows as they were read, with their lineage."""
    if feed.append_only:
        given = [T.StructField("v", schemas.VARIANT)]
    else:
        given = [T.StructField(c, schemas.STRING) for c in [*feed.columns, "rejected_columns"]]
    return T.StructType(given + schemas.RAW_LINEAGE.fields)
