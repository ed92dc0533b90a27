"""Slowly changing dimensions: one row per version of an entity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.expressions import change_hash
from tidemark.functions.time import timestamp
from tidemark.operators.keys import assign_keys
from tidemark.operators.upsert import insert_new, update_by_key
from tidemark.schemas import DIM_CUSTOMER, DIM_PRODUCT, OPEN_END, conform

# The columns whose change opens a new version, in hash order.
TRACKED = ("first_name", "last_name", "email", "phone", "region")
REDACTED = "REDACTED"


def stage_versions(customers: DataFrame, first_version_from: str | None = None) -> DataFrame:
    """Candidate versions of clean customer rows.

    A version takes effect when the source changed the row, else when it was loaded.
    ``first_version_from`` names a column to use instead for customers not seen before;
    it is kept as ``first_ts`` for :func:`open_versions`.
    """
    effective = F.coalesce("updated_at", "load_ts")
    first = F.coalesce(F.col(first_version_from), effective) if first_version_from else effective
    return customers.select(
        "customer_id",
        *TRACKED,
        effective.alias("effective_ts"),
        first.alias("first_ts"),
        "record_source",
        change_hash(TRACKED).alias("hash_diff"),
    )


def close_versions(dim: DataFrame, staged: DataFrame, run_ts: Column) -> DataFrame:
    """The dimension with each current version ended that ``staged`` contradicts."""
    news = staged.select(
        "customer_id", F.col("hash_diff").alias("_hash"), F.col("effective_ts").alias("_from"), F.lit(True).alias("_seen")
    )
    current = dim.filter("is_current").join(news, "customer_id", "left")
    changed = F.col("_seen").isNotNull() & (F.col("hash_diff") != F.col("_hash"))
    closed = current.select(
        *[
            F.when(changed, new).otherwise(F.col(c)).alias(c) if (new := _closing(c, run_ts)) is not None else F.col(c)
            for c in dim.columns
        ]
    )
    return dim.filter(~F.col("is_current")).unionByName(closed)


def _closing(column: str, run_ts: Column) -> Column | None:
    return {"valid_to": F.col("_from"), "is_current": F.lit(False), "load_ts": run_ts}.get(column)


def open_versions(dim: DataFrame, staged: DataFrame, run_ts: Column) -> DataFrame:
    """Versions to add, still without key: entities that are new or differ from their current version."""
    current = dim.filter("is_current").select("customer_id", "hash_diff")
    fresh = insert_new(current, staged, ["customer_id", "hash_diff"])
    known = dim.select("customer_id").join(staged.select("customer_id"), "customer_id", "left_semi").distinct()
    return fresh.join(known.withColumn("_known", F.lit(True)), "customer_id", "left").select(
        "customer_id",
        *TRACKED,
        F.when(F.col("_known"), F.col("effective_ts")).otherwise(F.col("first_ts")).alias("valid_from"),
        timestamp(OPEN_END).alias("valid_to"),
        F.lit(True).alias("is_current"),
        "hash_diff",
        "record_source",
        run_ts.alias("load_ts"),
    )


def apply_versions(dim: DataFrame, staged: DataFrame, run_ts: Column) -> DataFrame:
    """The dimension after one batch with at most one row per customer."""
    opened = assign_keys(open_versions(dim, staged, run_ts), ["customer_id"], "customer_sk", taken=dim)
    return conform(close_versions(dim, staged, run_ts).unionByName(opened), DIM_CUSTOMER)


def build_history(staged: DataFrame, run_ts: Column) -> DataFrame:
    """All versions of a whole change log at once, several per customer allowed.

    A row equal to its predecessor opens no version. Rows are first reduced to one
    per customer and effective time, and ordered within a month, so a customer with very
    many versions is spread over the months; only a row per month is ordered across them.
    """
    key = ["customer_id", "_month"]
    one = staged.groupBy("customer_id", "effective_ts").agg(
        F.max_by(F.struct("record_source", *TRACKED, "hash_diff"), "hash_diff").alias("_v")
    )
    month = F.coalesce(F.trunc("effective_ts", "month"), F.lit("0001-01-01").cast("date"))
    in_month = Window.partitionBy(*key).orderBy("effective_ts")
    rows = one.select("customer_id", "effective_ts", "_v.*", month.alias("_month")).select(
        "*", F.lag("hash_diff").over(in_month).alias("_before"), (F.row_number().over(in_month) == 1).alias("_first")
    )
    # Whether a month's first row is a change, and when the next change comes, follows from one summary row per month.
    inner = F.when(~F.col("_first") & (F.col("_before") != F.col("hash_diff")), F.col("effective_ts"))
    months = rows.groupBy(*key).agg(
        F.min("effective_ts").alias("_start"), F.min(inner).alias("_inner"),
        F.min_by("hash_diff", F.struct("effective_ts")).alias("_opening"), F.max_by("hash_diff", F.struct("effective_ts")).alias("_closing"),
    )
    line = Window.partitionBy("customer_id").orderBy("_month")
    earlier = F.lag("_closing").over(line)
    months = months.withColumn("_opens", earlier.isNull() | (earlier != F.col("_opening")))
    months = months.withColumn("_begins", F.when(F.col("_opens"), F.col("_start")).otherwise(F.col("_inner")))
    later = F.first("_begins", ignorenulls=True).over(line.rowsBetween(1, Window.unboundedFollowing))
    edges = months.select(*key, "_opens", later.alias("_after"))
    joined = rows.join(edges, key, "left")
    changes = joined.filter(F.when(F.col("_first"), F.coalesce("_opens", F.lit(True))).otherwise(F.col("_before") != F.col("hash_diff")))
    changes = changes.withColumn("_next", F.coalesce(F.lead("effective_ts").over(in_month), "_after"))
    return changes.select(
        "customer_id",
        *TRACKED,
        F.col("effective_ts").alias("valid_from"),
        F.coalesce("_next", timestamp(OPEN_END)).alias("valid_to"),
        F.col("_next").isNull().alias("is_current"),
        "hash_diff",
        "record_source",
        run_ts.alias("load_ts"),
    )


def rehash(dim: DataFrame) -> DataFrame:
    """Recompute every version's change hash, except of redacted people."""
    kept = F.col("first_name") != REDACTED
    return dim.withColumn("hash_diff", F.when(kept, change_hash(TRACKED)).otherwise(F.col("hash_diff")))


def overwrite_products(dim: DataFrame, products: DataFrame, run_ts: Column) -> DataFrame:
    """Product dimension after a batch: attributes overwritten, keys kept, new products numbered."""
    values = [f for f in DIM_PRODUCT.fieldNames() if f not in ("product_sk", "product_id")]
    batch = products.withColumn("load_ts", run_ts).select("product_id", *values)
    updated = update_by_key(dim, batch, ["product_id"], values)
    added = assign_keys(insert_new(dim, batch, ["product_id"]), ["product_id"], "product_sk", taken=dim)
    return conform(updated.unionByName(added), DIM_PRODUCT)
