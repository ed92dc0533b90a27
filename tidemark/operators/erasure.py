"""Right to delete: remove people from raw and clean tables, anonymise the dimension, keep an audit."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.history import REDACTED
from tidemark.operators.joins import without
from tidemark.operators.suppression import orders_of
from tidemark.schemas import AUDIT_LOG, SUPPRESSION_LIST, conform

PERSONAL = ("first_name", "last_name", "email", "phone")
OWNER = {"customers": "customer_id", "orders": "customer_id", "returns": "customer_id", "events": "user_id"}

# The audit trail's actions and names, in the order they are written.
HARD_DELETE, ANONYMIZE, SUPPRESS, WARNING = "HARD_DELETE", "ANONYMIZE", "SUPPRESS", "TIME_TRAVEL_WARNING"
AUDITED_FEEDS = ("customers", "orders", "payments", "returns", "events")
RAW_NAMES = {f: f"{f.upper()}_RAW" for f in AUDITED_FEEDS}
CLEAN_NAMES = {f: f.upper() for f in AUDITED_FEEDS}


def requests(people: DataFrame) -> DataFrame:
    """Distinct ids asked for, blank ones removed."""
    return people.filter(F.col("customer_id").isNotNull() & (F.trim("customer_id") != "")).select("customer_id").distinct()


def found_in(people: DataFrame, *layers: DataFrame) -> DataFrame:
    """Requested people who occur in at least one layer's customer table."""
    marks = [
        layer.select("customer_id").join(people, "customer_id", "left_semi").distinct() for layer in layers
    ]
    return reduce(DataFrame.unionByName, marks).distinct()


def _doomed_orders(tables: dict[str, DataFrame], people: DataFrame) -> DataFrame:
    """(order_id, customer_id) of the people's orders."""
    return tables["orders"].join(people, "customer_id", "left_semi").select("order_id", "customer_id").distinct()


def erase(tables: dict[str, DataFrame], people: DataFrame) -> dict[str, DataFrame]:
    """One layer's tables without the people's rows; payments go with their orders."""
    doomed = orders_of(tables["orders"], people)
    kept = {}
    for name, df in tables.items():
        if name in OWNER:
            kept[name] = without(df, OWNER[name], people, "customer_id")
        elif name == "payments":
            kept[name] = without(df, "order_id", doomed, "order_id")
        else:
            kept[name] = df
    return kept


def _owned(tables: dict[str, DataFrame], people: DataFrame, layer: str) -> list[DataFrame]:
    """(customer_id, slot) of the rows of one layer that name somebody; payments through the people's orders."""
    found = []
    for name in AUDITED_FEEDS:
        if name == "payments":
            rows = tables[name].select("order_id").join(_doomed_orders(tables, people), "order_id").select("customer_id")
        else:
            rows = tables[name].select(F.col(OWNER[name]).alias("customer_id"))
        found.append(rows.withColumn("slot", F.lit(f"{layer}.{name}")))
    return found


def erased_counts(tables: dict[str, DataFrame], people: DataFrame) -> DataFrame:
    """Rows :func:`erase` removes, as (customer_id, feed, rows), for people who lose any."""
    named = reduce(DataFrame.unionByName, _owned(tables, people, "layer"))
    met = named.join(people.select("customer_id"), "customer_id", "left_semi")
    feed = F.substring_index("slot", ".", -1).alias("feed")
    return met.groupBy("customer_id", feed).agg(F.count("*").alias("rows"))


def anonymise(dim: DataFrame, people: DataFrame, run_ts: Column) -> DataFrame:
    """Dimension with the people's personal columns redacted; keys, region and validity stay."""
    marked = dim.join(people.select("customer_id").withColumn("_hit", F.lit(True)), "customer_id", "left")
    new = {c: F.lit(REDACTED) for c in PERSONAL}
    new["hash_diff"] = F.sha2(F.lit(REDACTED), 256)
    new["load_ts"] = run_ts
    return marked.select(
        *[F.when(F.col("_hit"), new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in dim.columns]
    )


def suppression_rows(listed: DataFrame, people: DataFrame, requested_by: str, run_ts: Column) -> DataFrame:
    """Entries to append to the suppression list: people not on it yet."""
    fresh = people.join(listed.select("customer_id"), "customer_id", "left_anti")
    rows = fresh.select("customer_id", run_ts.alias("suppressed_at"), F.lit(requested_by).alias("requested_by"))
    return conform(rows, SUPPRESSION_LIST)


def not_audited(people: DataFrame, audit: DataFrame, request_id: str) -> DataFrame:
    """People whom a request's audit does not name yet: all of them, unless its id is used again."""
    named = audit.filter(F.col("request_id") == request_id).select("customer_id")
    return people.join(named, "customer_id", "left_anti")


def audit_rows(
    raw: dict[str, DataFrame],
    clean: dict[str, DataFrame],
    dim: DataFrame,
    listed: DataFrame,
    people: DataFrame,
    requested_by: str,
    run_ts: Column,
    request_id: str | None = None,
) -> DataFrame:
    """Thirteen entries per person: what was deleted, anonymised and suppressed, and a retention warning."""
    request_id = request_id or str(uuid.uuid4())
    in_dim = dim.select("customer_id", F.lit("GOLD.dim").alias("slot"))
    new_entries = suppression_rows(listed, people, requested_by, run_ts).select("customer_id", F.lit("UTIL.list").alias("slot"))
    # All tables meet the people once, and are counted in one aggregation. A semi join would be pushed into each table.
    named = reduce(DataFrame.unionByName, [*_owned(raw, people, "BRONZE"), *_owned(clean, people, "SILVER"), in_dim, new_entries])
    met = named.join(people.select("customer_id").distinct(), "customer_id")
    # One column per (layer, feed): a fixed set, so the trail needs a single aggregation.
    slots = (
        [("BRONZE", f, HARD_DELETE, RAW_NAMES[f]) for f in AUDITED_FEEDS]
        + [("SILVER", f, HARD_DELETE, CLEAN_NAMES[f]) for f in AUDITED_FEEDS]
        + [("GOLD", "dim", ANONYMIZE, "DIM_CUSTOMER"), ("UTIL", "list", SUPPRESS, "GDPR_SUPPRESSION_LIST")]
        + [("ALL", None, WARNING, "ALL_TABLES")]
    )
    asked = people.select("customer_id", F.lit("none").alias("slot"))
    wide = met.unionByName(asked).groupBy("customer_id").agg(
        *[F.count_if(F.col("slot") == f"{layer}.{feed}").alias(f"n{i}") for i, (layer, feed, _, _) in enumerate(slots) if feed is not None]
    )
    entries = F.array(
        *[
            F.struct(
                F.lit(action).alias("action"),
                F.lit(layer).alias("layer"),
                F.lit(table).alias("table_name"),
                (F.col(f"n{i}") if feed is not None else F.lit(0)).cast("bigint").alias("rows_affected"),
            )
            for i, (layer, feed, action, table) in enumerate(slots)
        ]
    )
    rows = wide.select("customer_id", F.explode(entries).alias("e")).select(
        F.lit(request_id).alias("request_id"),
        "customer_id",
        "e.*",
        F.lit(requested_by).alias("requested_by"),
        run_ts.alias("executed_at"),
    )
    return conform(rows, AUDIT_LOG)
