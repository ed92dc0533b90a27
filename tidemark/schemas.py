"""Declared schemas of every table the pipelines read or write."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

STRING = T.StringType()
TS = T.TimestampNTZType()
MONEY = T.DecimalType(10, 2)
TOTAL = T.DecimalType(12, 2)
LONG = T.LongType()
DATE = T.DateType()
BOOL = T.BooleanType()
VARIANT = T.VariantType()

# The spellings of "no value" in landed CSV files, and their timestamp format.
NULL_TOKENS = ("", "NULL", "null")
CSV_TIMESTAMP_PATTERN = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}$"

# Fixed value: the open end of a validity interval.
OPEN_END = "9999-12-31 00:00:00"


def _schema(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in columns])


RAW_LINEAGE = _schema(("ingestion_ts", TS), ("source_file", STRING), ("load_id", STRING))
CLEAN_LINEAGE = _schema(("record_source", STRING), ("load_ts", TS))


@dataclass(frozen=True)
class Feed:
    """One source feed: its business columns, key, and how its files are found."""

    name: str
    key: str
    business: T.StructType
    file_glob: str
    person_column: str | None = None
    date_column: str | None = None
    append_only: bool = False

    @property
    def raw(self) -> T.StructType:
        return T.StructType(self.business.fields + RAW_LINEAGE.fields)

    @property
    def clean(self) -> T.StructType:
        return T.StructType(self.business.fields + CLEAN_LINEAGE.fields)

    @property
    def columns(self) -> list[str]:
        return self.business.fieldNames()


CUSTOMERS = Feed(
    "customers",
    "customer_id",
    _schema(
        ("customer_id", STRING),
        ("first_name", STRING),
        ("last_name", STRING),
        ("email", STRING),
        ("phone", STRING),
        ("region", STRING),
        ("created_at", TS),
        ("updated_at", TS),
    ),
    "*customers*.csv*",
    person_column="customer_id",
)

PRODUCTS = Feed(
    "products",
    "product_id",
    _schema(
        ("product_id", STRING),
        ("sku", STRING),
        ("name", STRING),
        ("category", STRING),
        ("price", MONEY),
        ("currency", STRING),
        ("created_at", TS),
        ("updated_at", TS),
    ),
    "*products*.csv*",
)

ORDERS = Feed(
    "orders",
    "order_id",
    _schema(
        ("order_id", STRING),
        ("customer_id", STRING),
        ("order_ts", TS),
        ("status", STRING),
        ("subtotal", MONEY),
        ("tax", MONEY),
        ("shipping", MONEY),
        ("total", MONEY),
        ("payment_method", STRING),
        ("updated_at", TS),
    ),
    "*orders*.csv*",
    person_column="customer_id",
    date_column="order_ts",
)

PAYMENTS = Feed(
    "payments",
    "payment_id",
    _schema(
        ("payment_id", STRING),
        ("order_id", STRING),
        ("payment_ts", TS),
        ("amount", MONEY),
        ("status", STRING),
        ("provider", STRING),
        ("updated_at", TS),
    ),
    "*payments*.csv*",
    date_column="payment_ts",
)

RETURNS = Feed(
    "returns",
    "return_id",
    _schema(
        ("return_id", STRING),
        ("order_id", STRING),
        ("customer_id", STRING),
        ("return_ts", TS),
        ("reason", STRING),
        ("refund_amount", MONEY),
        ("status", STRING),
        ("updated_at", TS),
    ),
    "*returns*.csv*",
    person_column="customer_id",
    date_column="return_ts",
)

EVENTS = Feed(
    "events",
    "event_id",
    _schema(
        ("event_id", STRING),
        ("event_ts", TS),
        ("user_id", STRING),
        ("session_id", STRING),
        ("event_name", STRING),
        ("device_type", STRING),
        ("payload", VARIANT),
    ),
    "*events*.json*",
    person_column="user_id",
    date_column="event_ts",
    append_only=True,
)

FEEDS = {f.name: f for f in (CUSTOMERS, PRODUCTS, ORDERS, PAYMENTS, RETURNS, EVENTS)}
BATCH_FEEDS = tuple(f for f in FEEDS.values() if not f.append_only)

DIM_CUSTOMER = _schema(
    ("customer_sk", LONG),
    ("customer_id", STRING),
    ("first_name", STRING),
    ("last_name", STRING),
    ("email", STRING),
    ("phone", STRING),
    ("region", STRING),
    ("valid_from", TS),
    ("valid_to", TS),
    ("is_current", BOOL),
    ("hash_diff", STRING),
    ("record_source", STRING),
    ("load_ts", TS),
)

DIM_PRODUCT = _schema(
    ("product_sk", LONG),
    ("product_id", STRING),
    ("sku", STRING),
    ("name", STRING),
    ("category", STRING),
    ("price", MONEY),
    ("currency", STRING),
    ("record_source", STRING),
    ("load_ts", TS),
)

FACT_ORDERS = _schema(
    ("order_id", STRING),
    ("order_ts", TS),
    ("order_date", DATE),
    ("customer_sk", LONG),
    ("order_status", STRING),
    ("subtotal", MONEY),
    ("tax", MONEY),
    ("shipping", MONEY),
    ("total", MONEY),
    ("payment_method", STRING),
    ("load_ts", TS),
)

FACT_PAYMENTS = _schema(
    ("payment_id", STRING),
    ("order_id", STRING),
    ("payment_ts", TS),
    ("customer_sk", LONG),
    ("amount", MONEY),
    ("status", STRING),
    ("provider", STRING),
    ("load_ts", TS),
)

FACT_RETURNS = _schema(
    ("return_id", STRING),
    ("order_id", STRING),
    ("customer_sk", LONG),
    ("return_ts", TS),
    ("return_date", DATE),
    ("reason", STRING),
    ("refund_amount", MONEY),
    ("status", STRING),
    ("load_ts", TS),
)

FACT_EVENTS = _schema(
    ("event_id", STRING),
    ("event_ts", TS),
    ("event_date", DATE),
    ("customer_sk", LONG),
    ("session_id", STRING),
    ("event_name", STRING),
    ("device_type", STRING),
    ("product_id", STRING),
    ("load_ts", TS),
)

FACT_SESSIONS = _schema(
    ("session_id", STRING),
    ("customer_sk", LONG),
    ("device_type", STRING),
    ("session_start", TS),
    ("session_end", TS),
    ("session_duration_sec", LONG),
    ("page_views", LONG),
    ("product_views", LONG),
    ("add_to_carts", LONG),
    ("checkouts_started", LONG),
    ("purchases", LONG),
    ("is_bounce", BOOL),
    ("is_conversion", BOOL),
    ("is_computed_session", BOOL),
    ("products_viewed", T.ArrayType(STRING)),
    ("load_ts", TS),
)

#: What a session had of one day; see ``operators.session_days``.
SESSION_DAYS = _schema(
    ("line", STRING),
    ("customer_sk", LONG),
    ("day", DATE),
    ("local", LONG),
    ("session_id", STRING),
    ("device_type", STRING),
    ("session_start", TS),
    ("session_end", TS),
    ("page_views", LONG),
    ("product_views", LONG),
    ("add_to_carts", LONG),
    ("checkouts_started", LONG),
    ("purchases", LONG),
    ("events", LONG),
    ("products", T.ArrayType(STRING)),
    ("day_first", LONG),
    ("day_last", LONG),
    ("day_free", BOOL),
    ("day_opened", LONG),
    ("load_ts", TS),
)

DAILY_SALES = _schema(
    ("order_date", DATE),
    ("total_orders", LONG),
    ("gross_revenue", TOTAL),
    ("total_refunds", TOTAL),
    ("net_revenue", TOTAL),
    ("total_returns", LONG),
    ("avg_order_value", TOTAL),
    ("load_ts", TS),
)

#: What daily sales add up from.
SALES_SUMS = _schema(
    ("order_date", DATE),
    ("orders", LONG),
    ("sold", TOTAL),
    ("priced", LONG),
    ("refunds", TOTAL),
    ("returned", LONG),
)

CHECK_RESULTS = _schema(
    ("check_name", STRING),
    ("status", STRING),
    ("observed_value", STRING),
    ("expected_value", STRING),
    ("details", STRING),
    ("check_ts", TS),
)

AUDIT_LOG = _schema(
    ("request_id", STRING),
    ("customer_id", STRING),
    ("action", STRING),
    ("layer", STRING),
    ("table_name", STRING),
    ("rows_affected", LONG),
    ("requested_by", STRING),
    ("executed_at", TS),
)

SUPPRESSION_LIST = _schema(
    ("customer_id", STRING),
    ("suppressed_at", TS),
    ("requested_by", STRING),
)

SUPPRESSED_ORDERS = _schema(("order_id", STRING))

RUN_LOG = _schema(
    ("name", STRING),
    ("state", STRING),
    ("scheduled_time", TS),
    ("completed_time", TS),
    ("run_id", STRING),
    ("message", STRING),
    ("error_message", STRING),
)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` onto ``schema``: its columns, order and types."""
    given = {f.name: f.dataType for f in df.schema.fields}
    return df.select(
        *[f.name if given[f.name] == f.dataType else F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]
    )
