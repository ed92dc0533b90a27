"""Clean to serving: dimensions, facts, daily sales and sessions."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import facts, history, sales, session_days
from tidemark.operators.asof import lookup_for
from tidemark.operators.changes import change_images
from tidemark.operators.upsert import insert_new, overwrite_by_key
from tidemark.plans.warehouse import Warehouse
from tidemark.sources.scratch import cut_lineage
from tidemark.sources.tables import BATCH, Snapshot, batch_of


@dataclass
class BuildResult:
    """What a build changed, as shown in the run log."""

    job: str
    updated: list[str] = field(default_factory=list)

    @property
    def message(self) -> str:
        if not self.updated:
            return f"{self.job} completed: No streams had data. No-op."
        return f"{self.job} completed: " + " ".join(f"{t.upper()} updated." for t in self.updated)


def _stamp(df: DataFrame, batch: int) -> DataFrame:
    return df.withColumn(BATCH, F.lit(batch).cast("bigint"))


def _newest_batch(snap: Snapshot, name: str) -> int | None:
    return max((batch_of(f) for f in snap.folders.get(name, {}).values()), default=None)


#: The tables of a build as its message lists them.
BUILD_ORDER = (
    "dim_product", "dim_customer", "fact_orders", "fact_payments", "fact_returns",
    "sales_sums_cash", "daily_sales_cash", "sales_sums_accrual", "daily_sales_accrual",
)
#: Keys of a batch that may be sent whole to every task.
SMALL_BATCH = 500_000


def named_by(batch: DataFrame, column: str, table: DataFrame, key: str | None = None) -> DataFrame:
    """The rows of a large table that a batch names, kept in the shared folder.

    The batch's keys are counted; up to ``SMALL_BATCH`` of them are broadcast, so the table is streamed past them and not
    shuffled. More of them meet the table by a shuffle.
    """
    key = key or column
    keys = cut_lineage(batch.select(F.col(column).alias(key)).filter(F.col(key).isNotNull()).distinct())
    few = keys.limit(SMALL_BATCH + 1).count() <= SMALL_BATCH
    return cut_lineage(table.join(F.broadcast(keys) if few else keys, key, "left_semi").select(table.columns))


def side_by_side(*steps: Callable[[], None]) -> None:
    """Run steps that do not build on each other at one time, so that the last tasks of one leave no core idle."""
    with ThreadPoolExecutor(max(len(steps), 1)) as pool:
        for done in [pool.submit(step) for step in steps]:
            done.result()


def looked_up_by(batch: DataFrame, column: str, table: DataFrame, key: str | None = None) -> DataFrame:
    """The rows of a large table that a lookup from a batch may need: those it names, or all of them.

    A batch of more than ``SMALL_BATCH`` rows meets the table by a shuffle in any case. Its share of the table is then not
    looked for and stored first, and a lookup finds nothing else in the whole.
    """
    return table if batch.count() > SMALL_BATCH else named_by(batch, column, table, key)


def build_batch(
    wh: Warehouse,
    batch: int,
    run_ts: Column,
    as_of: date,
    days: int | None = sales.REFRESH_DAYS,
    first_version_from: str | None = None,
) -> BuildResult:
    """Build what changed: dimensions first, then the facts that look them up, then aggregates.

    A table whose source has no changes is left alone, and daily sales are refreshed only
    if orders or returns changed: those of the last ``days``, or if that is None of every
    day that the changes bear on. Everything publishes in one step.
    """
    clean, snap = wh.clean.snapshot(), wh.served.snapshot()
    result, folders, consumed = BuildResult("build_batch"), {}, {}

    def changed(name: str) -> DataFrame | None:
        newest, done = _newest_batch(clean, name), snap.consumed.get(name)
        if newest is None or (done is not None and newest <= done):
            return None
        rows = wh.clean.changes(name, clean, done)
        consumed[name] = newest
        return None if rows.isEmpty() else rows

    def table(name: str, since: str | None = None) -> DataFrame:
        return wh.served.read(name, Snapshot(snap.version, {**snap.folders, **folders}), since)

    number = snap.next

    def replace(name: str, df: DataFrame) -> None:
        folders[name] = wh.served.write(name, _stamp(df, number), number)
        result.updated.append(name)

    def upsert(name: str, rows: DataFrame, key: str) -> None:
        folders[name] = wh.served.rewrite(
            name, _stamp(rows, number), [key], snap, number, lambda stored, source: overwrite_by_key(stored, source, [key])
        )
        result.updated.append(name)

    if (products := changed("products")) is not None:
        replace("dim_product", history.overwrite_products(table("dim_product"), products, run_ts))
    if (customers := changed("customers")) is not None:
        staged = history.stage_versions(customers, first_version_from)
        replace("dim_customer", history.apply_versions(table("dim_customer"), staged, run_ts))
    dim = table("dim_customer")
    lookup = lookup_for(dim)
    orders, payments, returns = changed("orders"), changed("payments"), changed("returns")

    def build_orders() -> None:
        upsert("fact_orders", facts.fact_orders(orders, looked_up_by(orders, "customer_id", dim), run_ts, lookup), "order_id")

    def build_payments() -> None:
        paid = looked_up_by(payments, "order_id", wh.clean.read("orders", clean).select("order_id", "customer_id"))
        payers = looked_up_by(paid, "customer_id", dim)
        upsert("fact_payments", facts.fact_payments(payments, paid, payers, run_ts, lookup), "payment_id")

    def build_returns() -> None:
        upsert("fact_returns", facts.fact_returns(returns, looked_up_by(returns, "customer_id", dim), run_ts, lookup), "return_id")

    news = ((build_orders, orders), (build_payments, payments), (build_returns, returns))
    side_by_side(*[build for build, rows in news if rows is not None])
    if (orders is not None or returns is not None) and days is None:
        _add_changes(wh, snap, table, replace, run_ts, folders)
    elif orders is not None or returns is not None:
        _refresh_sales(wh, table, replace, run_ts, as_of, days)
    if consumed:
        wh.served.publish(snap, folders, consumed)
    result.updated.sort(key=BUILD_ORDER.index)  # steps that ran at one time end in any order
    return result


def _add_changes(wh, snap, table, replace, run_ts, folders) -> None:
    """All days kept right by what the batch changed: old images of its rows count minus, new ones plus.

    Sums that are not there yet are made of all rows, and need no images.
    """
    old = {name: wh.served.read(name, snap) for name in ("fact_orders", "fact_returns")}
    kept = [basis for basis in ("cash", "accrual") if f"sales_sums_{basis}" in snap.folders]
    images = {}
    for name, key in (("fact_orders", "order_id"), ("fact_returns", "return_id")) if kept else ():
        if name in folders:  # only rows that this publication stamped have changed
            now = wh.served.read_stored(name, Snapshot(snap.version, folders)).filter(F.col(BATCH) == snap.next).drop(BATCH)
            images[name] = cut_lineage(change_images(named_by(now, key, old[name]), now, [key]))
        else:
            images[name] = old[name].limit(0).withColumn("_action", F.lit(""))
    states = ((old["fact_orders"], old["fact_returns"]), (table("fact_orders"), table("fact_returns")))

    def keep(basis: str) -> None:
        name, accrual = f"sales_sums_{basis}", basis == "accrual"
        if basis in kept:
            delta = sales.sales_delta(images["fact_orders"], images["fact_returns"], accrual, *states)
            sums = sales.add_sums(table(name), delta)
        else:
            sums = sales.sales_sums(*states[1], accrual)
        replace(name, sums)
        replace(f"daily_sales_{basis}", sales.daily_from_sums(table(name), run_ts))

    side_by_side(lambda: keep("cash"), lambda: keep("accrual"))


def _refresh_sales(wh, table, replace, run_ts, as_of, days) -> None:
    # Months before the refreshed days are not opened. A return may undo an order of any
    # earlier date, so the accrual view looks through all returns.
    since = None if days is None else (as_of - timedelta(days=days)).strftime("%Y-%m")
    recent = table("fact_orders", since)
    fresh = {
        "daily_sales_cash": sales.daily_sales_cash(recent, table("fact_returns", since), as_of, run_ts, days),
        "daily_sales_accrual": sales.daily_sales_accrual(recent, table("fact_returns"), as_of, run_ts, days),
    }
    for name, rows in fresh.items():
        replace(name, overwrite_by_key(table(name), rows, ["order_date"]))


def build_events(wh: Warehouse, events: DataFrame, batch: int, run_ts: Column) -> BuildResult:
    """Append a batch of clean events to the fact, then redo the days of its people that it touches."""
    result = BuildResult("build_events")
    dim = wh.served.read("dim_customer")
    unserved = cut_lineage(_unserved(wh, events, batch))
    people = named_by(unserved, "user_id", dim, "customer_id")
    rows = facts.fact_events(unserved, people, run_ts, lookup_for(people))
    wh.fact_events.append(rows, batch)
    result.updated.append("fact_events")
    every = wh.fact_events.read()
    touched = cut_lineage(session_days.touched_days(every.filter(F.col(BATCH) == batch)))
    if touched.isEmpty():
        return result
    # Only the days that this batch has events of are read, and only their partitions are written.
    days = [r[0] for r in touched.select("day").distinct().collect()]
    events = every.drop(BATCH).filter(F.col("event_date").isin(days) | F.col("event_date").isNull())
    snap = wh.sessions.snapshot()
    part = wh.sessions.layouts["session_days"].part
    parts = {r[0] for r in touched.select(part).distinct().collect()}
    kept = session_days.without_days(wh.sessions.read_stored("session_days", snap, parts), touched)
    fresh = _stamp(session_days.fresh_days(events, touched, run_ts), snap.next)
    listed = {p: f for p, f in snap.folders.get("session_days", {}).items() if p not in parts}
    written = wh.sessions.write("session_days", kept.unionByName(fresh), snap.next)
    wh.sessions.publish(snap, {"session_days": {**listed, **written}}, {"fact_events": batch})
    result.updated.append("fact_sessions")
    return result


def _unserved(wh: Warehouse, events: DataFrame, batch: int) -> DataFrame:
    """Events no earlier batch served. An event never changes, so only its own dates are searched."""
    first, last = events.agg(F.min(F.to_date("event_ts")), F.max(F.to_date("event_ts"))).first()
    earlier = wh.fact_events.read().filter(F.col(BATCH) < batch)
    if first is None:
        searched = earlier.filter("event_date is null")
    else:
        searched = earlier.filter(F.col("event_date").between(first, last) | F.col("event_date").isNull())
    return insert_new(searched, events, ["event_id"])


def rekey_facts(wh: Warehouse, batch: int, run_ts: Column) -> None:
    """Fill customer keys that were missing because the customer arrived after the fact."""
    clean, snap = wh.clean.snapshot(), wh.served.snapshot()
    dim = wh.served.read("dim_customer", snap)
    orders = wh.clean.read("orders", clean)
    fresh = {
        "fact_orders": ("order_id", facts.fact_orders(orders, dim, run_ts)),
        "fact_payments": ("payment_id", facts.fact_payments(wh.clean.read("payments", clean), orders, dim, run_ts)),
        "fact_returns": ("return_id", facts.fact_returns(wh.clean.read("returns", clean), dim, run_ts)),
    }
    folders = {}
    for name, (key, rows) in fresh.items():
        folders[name] = wh.served.write(name, facts.rekey(wh.served.read_stored(name, snap), key, rows), snap.next)
    wh.served.publish(snap, folders, {})
