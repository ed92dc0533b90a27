"""Star-schema tables (orders, lineitem, customer, part, events ...) as pipeline feeds.

Each function derives one whole feed or serving table from the stored parquet tables by
fixed rules, so that every operator can run on data of any scale.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.expressions import change_hash
from tidemark.functions.time import timestamp
from tidemark.operators.history import TRACKED
from tidemark.schemas import (
    CHECK_RESULTS,
    CUSTOMERS,
    DIM_CUSTOMER,
    EVENTS,
    FACT_EVENTS,
    FACT_ORDERS,
    FACT_PAYMENTS,
    FACT_RETURNS,
    OPEN_END,
    ORDERS,
    PAYMENTS,
    PRODUCTS,
    RETURNS,
    RUN_LOG,
    conform,
)

# The clocks of the two halves of the data.
ORDERS_AS_OF = date(2001, 8, 2)
EVENTS_AS_OF = date(2024, 1, 30)
RUN_TS = datetime(2024, 2, 1, 0, 0)

FIRST_VERSION = "1995-01-01 00:00:00"
VERSION_DAYS = 730


def _once(derive: Callable[[Star], DataFrame]) -> Callable[[Star], DataFrame]:
    """Plan a derived table once per :class:`Star`, however often a query uses it."""

    @wraps(derive)
    def planned(star: Star) -> DataFrame:
        if derive.__name__ not in star._derived:
            star._derived[derive.__name__] = derive(star)
        return star._derived[derive.__name__]

    return planned


class Star:
    """The parquet tables of one folder, and the feeds derived from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._tables: dict[str, DataFrame] = {}
        self._derived: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        # Kept so that a table's footer is read for its schema once per query.
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    # --- clean feeds -------------------------------------------------------------------------

    @_once
    def orders(self) -> DataFrame:
        total = F.col("o_totalprice").cast("decimal(10,2)")
        shipping = F.when(F.col("o_orderkey") % 2 == 0, 5).otherwise(0).cast("decimal(10,2)")
        changed = F.col("o_orderdate") + _days(F.col("o_orderkey") % 5)
        rows = self.table("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").alias("order_ts"),
            F.col("o_orderstatus").alias("status"),
            (total - shipping).alias("subtotal"),
            F.lit(0).alias("tax"),
            shipping.alias("shipping"),
            total.alias("total"),
            F.col("o_orderpriority").alias("payment_method"),
            changed.alias("updated_at"),
            F.lit("orders").alias("record_source"),
            (changed + F.expr("interval 1 hour")).alias("load_ts"),
        )
        return conform(rows, ORDERS.clean)

    @_once
    def customer_versions(self) -> DataFrame:
        """Clean rows of every version of every customer: one to three, by key."""
        places = self.table("nation").join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        people = self.table("customer").join(
            places.select("n_nationkey", "n_name", "r_name"), F.col("c_nationkey") == F.col("n_nationkey")
        )
        versions = people.withColumn("v", F.explode(F.sequence(F.lit(0), (F.col("c_custkey") % 3).cast("int"))))
        host = F.when(F.col("c_custkey") % 7 == 0, "localhost").otherwise(F.concat(F.lower("n_name"), F.lit(".example")))
        changed = timestamp(FIRST_VERSION) + _days(F.col("v") * VERSION_DAYS)
        rows = versions.select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("first_name"),
            F.col("c_mktsegment").alias("last_name"),
            F.concat(F.lower("c_name"), F.lit("@"), host).alias("email"),
            F.concat(F.lit("555-"), F.col("c_custkey").cast("string"), F.lit("-"), F.col("v").cast("string")).alias("phone"),
            F.col("r_name").alias("region"),
            timestamp("1994-06-01 00:00:00").alias("created_at"),
            changed.alias("updated_at"),
            F.lit("customer").alias("record_source"),
            changed.alias("load_ts"),
            "v",
        )
        return rows.select(*conform(rows, CUSTOMERS.clean).columns, "v").withColumn(
            "customer_id", F.col("customer_id").cast("string")
        )

    @_once
    def customers(self) -> DataFrame:
        """Each customer's last version."""
        last = F.col("v") == F.col("customer_id").cast("bigint") % 3
        return self.customer_versions().filter(last).drop("v")

    @_once
    def products(self) -> DataFrame:
        changed = timestamp("2000-01-01 00:00:00") + _days(F.col("p_size"))
        rows = self.table("part").select(
            F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("product_id"),
            F.col("p_brand").alias("sku"),
            F.col("p_name").alias("name"),
            F.col("p_type").alias("category"),
            F.col("p_retailprice").alias("price"),
            F.lit("USD").alias("currency"),
            timestamp("2000-01-01 00:00:00").alias("created_at"),
            changed.alias("updated_at"),
            F.lit("part").alias("record_source"),
            changed.alias("load_ts"),
        )
        return conform(rows, PRODUCTS.clean)

    @_once
    def payments(self) -> DataFrame:
        """None to two payments per order, by the order key's remainder.

        0: none, 1 and 5: exact, 2: half settled and half pending, 3: half, 4: ten too much.
        """
        kind, total = F.col("o_orderkey") % 6, F.col("o_totalprice").cast("decimal(10,2)")
        half = (total * F.lit(0.5).cast("decimal(2,1)")).cast("decimal(10,2)")
        settled = F.when(kind.isin(1, 5), total).when(kind.isin(2, 3), half).when(kind == 4, total + 10)
        pending = F.when(kind == 2, total - half)
        parts = F.array(
            F.struct(F.lit(1).alias("n"), settled.cast("decimal(10,2)").alias("amount"), F.lit("SETTLED").alias("status")),
            F.struct(F.lit(2).alias("n"), pending.cast("decimal(10,2)").alias("amount"), F.lit("PENDING").alias("status")),
        )
        paid = F.col("o_orderdate") + _days(F.col("o_orderkey") % 400)
        rows = (
            self.table("orders")
            .select("o_orderkey", paid.alias("paid"), F.explode(parts).alias("p"))
            .filter("p.amount is not null")
            .select(
                F.concat(F.lit("PMT"), F.col("o_orderkey").cast("string"), F.lit("-"), F.col("p.n").cast("string"))
                .alias("payment_id"),
                F.col("o_orderkey").alias("order_id"),
                F.col("paid").alias("payment_ts"),
                F.col("p.amount").alias("amount"),
                F.col("p.status").alias("status"),
                F.lit("CARD").alias("provider"),
                F.col("paid").alias("updated_at"),
                F.lit("payments").alias("record_source"),
                F.col("paid").alias("load_ts"),
            )
        )
        return conform(rows, PAYMENTS.clean)

    @_once
    def returns(self) -> DataFrame:
        """One return per order with returned lines, and one of the whole total per sixth order."""
        lines = (
            self.table("lineitem")
            .filter("l_returnflag = 'R'")
            .groupBy("l_orderkey")
            .agg(
                F.max("l_shipdate").alias("return_ts"),
                F.sum(F.col("l_extendedprice").cast("decimal(10,2)")).alias("refund_amount"),
                F.min("l_linestatus").alias("line"),
            )
        )
        owners = self.table("orders").select("o_orderkey", "o_custkey")
        returned = lines.join(owners, F.col("l_orderkey") == F.col("o_orderkey")).select(
            F.concat(F.lit("R"), F.col("l_orderkey").cast("string")).alias("return_id"),
            F.col("l_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            "return_ts",
            F.lit("DEFECTIVE").alias("reason"),
            "refund_amount",
            F.when(F.col("line") == "F", "APPROVED").otherwise("PENDING").alias("status"),
        )
        whole = self.table("orders").filter("o_orderkey % 6 = 5").select(
            F.concat(F.lit("RX"), F.col("o_orderkey").cast("string")).alias("return_id"),
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            (F.col("o_orderdate") + F.expr("interval 30 days")).alias("return_ts"),
            F.lit("CHANGED_MIND").alias("reason"),
            F.col("o_totalprice").cast("decimal(10,2)").alias("refund_amount"),
            F.lit("APPROVED").alias("status"),
        )
        rows = returned.unionByName(whole).withColumns(
            {"updated_at": F.col("return_ts"), "record_source": F.lit("returns"), "load_ts": F.col("return_ts")}
        )
        return conform(rows, RETURNS.clean)

    @_once
    def events(self) -> DataFrame:
        """Clickstream events; one in four has a sourced session, a few are anonymous."""
        key = F.col("event_id")
        name = (
            F.when(F.col("event_type") == "view", "page_view")
            .when(F.col("event_type") == "click", "product_view")
            .when(F.col("event_type") == "signup", "add_to_cart")
            .when(F.col("event_type") == "error", "checkout_start")
            .otherwise("purchase")
        )
        device = F.when(key % 3 == 0, "mobile").when(key % 3 == 1, "desktop").otherwise("tablet")
        session = F.when(
            key % 4 == 0,
            F.concat(F.lit("S"), F.col("user_id").cast("string"), F.lit("-"), F.floor(key / 500).cast("string")),
        )
        product = F.concat(F.lit("P"), F.get_json_object("props", "$.k"))
        rows = self.table("events").select(
            key,
            F.col("ts").alias("event_ts"),
            F.when(key % 97 != 0, F.col("user_id")).alias("user_id"),
            session.alias("session_id"),
            name.alias("event_name"),
            device.alias("device_type"),
            F.parse_json(F.to_json(F.struct(product.alias("product_id")))).alias("payload"),
            F.lit("events").alias("record_source"),
            (F.col("ts") + F.expr("interval 5 minutes")).alias("load_ts"),
        )
        return conform(rows, EVENTS.clean)

    # --- serving tables ----------------------------------------------------------------------

    @_once
    def dim_customer(self) -> DataFrame:
        """Customer history with the key ten times the customer number plus the version."""
        number = F.col("customer_id").cast("bigint")
        last = F.col("v") == number % 3
        ends = F.col("updated_at") + F.expr(f"interval {VERSION_DAYS} days")
        rows = self.customer_versions().select(
            "*",
            (number * 10 + F.col("v")).alias("customer_sk"),
            F.col("updated_at").alias("valid_from"),
            F.when(last, timestamp(OPEN_END)).otherwise(ends).alias("valid_to"),
            last.alias("is_current"),
            change_hash(TRACKED).alias("hash_diff"),
        )
        return conform(rows, DIM_CUSTOMER)

    def _keyed(self, df: DataFrame, person: Column) -> DataFrame:
        # The latest key of a customer follows from the customer number.
        number = person.cast("bigint")
        return df.withColumn("customer_sk", number * 10 + number % 3).withColumn("load_ts", timestamp(RUN_TS))

    @_once
    def fact_orders(self) -> DataFrame:
        rows = self._keyed(self.orders(), F.col("customer_id")).withColumns(
            {"order_date": F.to_date("order_ts"), "order_status": F.col("status")}
        )
        return conform(rows, FACT_ORDERS)

    @_once
    def fact_payments(self) -> DataFrame:
        return conform(self._keyed(self.payments(), F.lit(None)), FACT_PAYMENTS)

    @_once
    def fact_returns(self) -> DataFrame:
        rows = self._keyed(self.returns(), F.col("customer_id")).withColumn("return_date", F.to_date("return_ts"))
        return conform(rows, FACT_RETURNS)

    @_once
    def fact_events(self) -> DataFrame:
        rows = self._keyed(self.events(), F.col("user_id")).withColumns(
            {
                "event_date": F.to_date("event_ts"),
                "product_id": F.try_variant_get("payload", "$.product_id", "string"),
            }
        )
        return conform(rows, FACT_EVENTS)

    # --- change rows -------------------------------------------------------------------------

    @_once
    def raw_orders(self) -> DataFrame:
        """Raw order rows: each order once, and for many of them newer, older and undated copies."""
        base = self.orders().select(*ORDERS.columns, F.col("load_ts").alias("ingestion_ts"))
        number = F.col("order_id").cast("bigint")
        copies = F.array(
            _copy(0, 0, F.col("status"), True),
            F.when(number % 3 == 0, _copy(1, 10, F.lit("SHIPPED"), True)),
            F.when(number % 5 == 0, _copy(2, -10, F.lit("STALE"), True)),
            F.when(number % 7 == 0, _copy(3, 3, F.lit("UNDATED"), False)),
        )
        rows = base.withColumn("c", F.explode(copies)).filter("c is not null").withColumns(
            {
                "status": F.col("c.status"),
                "updated_at": F.when(F.col("c.dated"), F.col("updated_at") + _days(F.col("c.shift"))),
                "ingestion_ts": F.col("ingestion_ts") + _days(F.col("c.n")),
                "source_file": F.concat(F.lit("orders-"), F.col("c.n").cast("string"), F.lit(".csv")),
                "load_id": F.concat(F.lit("orders-"), F.col("c.n").cast("string"), F.lit(".csv:"), F.col("order_id")),
            }
        )
        return conform(rows, ORDERS.raw)

    @_once
    def check_log(self) -> DataFrame:
        """A log of check results: one per day and order priority, from the number of orders."""
        counted = self.table("orders").groupBy("o_orderdate", "o_orderpriority").agg(F.count("*").alias("n"))
        kind, n = F.left("o_orderpriority", F.lit(1)), F.col("n")
        name = (
            F.when(kind == "1", "stream_staleness_bronze_orders")
            .when(kind == "2", "schema_drift_orders_raw")
            .when(kind == "3", "orders_customer_fk")
            .when(kind == "4", "orders_freshness_24h")
            .otherwise("dim_customer_scd2_no_overlap")
        )
        rows = counted.select(
            name.alias("check_name"),
            F.when(n % 3 == 0, "FAIL").when(n % 3 == 1, "PASS").otherwise("WARN").alias("status"),
            n.alias("observed_value"),
            F.lit("1").alias("expected_value"),
            F.concat(F.lit("orders of priority "), "o_orderpriority").alias("details"),
            (F.col("o_orderdate") + F.make_dt_interval(F.lit(0), F.lit(0), n.cast("int"))).alias("check_ts"),
        )
        return conform(rows, CHECK_RESULTS)

    @_once
    def run_log(self) -> DataFrame:
        """A run log with one run per event."""
        prefix = F.when(F.col("event_type") == "error", "job_").otherwise("task_")
        failed = F.col("event_id") % 50 == 0
        rows = self.table("events").select(
            F.concat(prefix, "event_type").alias("name"),
            F.when(failed, "FAILED").otherwise("SUCCEEDED").alias("state"),
            F.col("ts").alias("scheduled_time"),
            (F.col("ts") + F.expr("interval 1 minute")).alias("completed_time"),
            F.col("event_id").alias("run_id"),
            F.lit(None).alias("message"),
            F.when(failed, "failed").alias("error_message"),
        )
        return conform(rows, RUN_LOG)

    @_once
    def suppressed(self) -> DataFrame:
        """A suppression list of every eleventh customer."""
        return self.table("customer").filter("c_custkey % 11 = 3").select(F.col("c_custkey").cast("string").alias("customer_id"))


def _copy(n: int, shift: int, status: Column, dated: bool) -> Column:
    return F.struct(
        F.lit(n).alias("n"), F.lit(shift).alias("shift"), status.alias("status"), F.lit(dated).alias("dated")
    )


def _days(n: Column) -> Column:
    return F.make_dt_interval(n.cast("int"))
