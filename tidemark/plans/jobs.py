"""The two pipelines end to end, with a run log."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.time import timestamp
from tidemark.operators import quality
from tidemark.plans.clean import merge_batch
from tidemark.plans.ingest import ingest_batch, ingest_events
from tidemark.plans.serving import build_batch
from tidemark.plans.warehouse import Warehouse
from tidemark.schemas import BATCH_FEEDS, RUN_LOG, conform
from tidemark.sources.tables import BATCH, number_of
from tidemark.streaming.events import clean_events_query, serve_events_query


_ENTRY = (
    "name string, state string, scheduled_time timestamp_ntz, completed_time timestamp_ntz, "
    "run_id string, message string, error_message string"
)


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def logged(wh: Warehouse, name: str, batch: int, stage: Callable[[], object], now: Callable[[], datetime] = utc_now):
    """Run a stage and append its outcome to the run log; errors are logged and raised."""
    started, state, message, error = now(), "SUCCEEDED", None, None
    try:
        outcome = stage()
        message = str(getattr(outcome, "message", outcome))
        return outcome
    except Exception as failure:
        state, error = "FAILED", str(failure)
        raise
    finally:
        rows = wh.spark.createDataFrame([(name, state, started, now(), f"{name}-{batch}", message, error)], _ENTRY)
        wh.run_log.append(conform(rows, RUN_LOG), number_of(str(uuid.uuid4())))  # jobs may end together


def logged_stream(
    wh: Warehouse, name: str, batch: int, start: Callable[[], StreamingQuery], now: Callable[[], datetime] = utc_now
) -> None:
    """:func:`logged` for a query that stops by itself, with an entry per micro-batch: its rows and how long it took."""

    def run() -> str:
        query = start()
        query.awaitTermination()
        done = [p for p in query.recentProgress if p.numInputRows]
        entries = [
            (f"{name}_MICRO_BATCH", "SUCCEEDED", _zoneless(p.timestamp), _zoneless(p.timestamp, p.batchDuration),
             f"{name}-{batch}-{p.batchId}", f"{p.numInputRows} rows", None)
            for p in done
        ]
        if entries:
            wh.run_log.append(conform(wh.spark.createDataFrame(entries, _ENTRY), RUN_LOG), number_of(str(uuid.uuid4())))
        return f"{sum(p.numInputRows for p in done)} rows in {len(done)} micro-batches"

    logged(wh, name, batch, run, now)


def _zoneless(instant: str, later_ms: int = 0) -> datetime:
    return datetime.fromisoformat(instant.replace("Z", "+00:00")).replace(tzinfo=None) + timedelta(milliseconds=later_ms)


def clean_tables(wh: Warehouse) -> dict[str, DataFrame]:
    snap = wh.clean.snapshot()
    return {**{f.name: wh.clean.read(f.name, snap) for f in BATCH_FEEDS}, "events": wh.clean_events.rows()}


def served_tables(wh: Warehouse) -> dict[str, DataFrame]:
    snap = wh.served.snapshot()
    tables = {name: wh.served.read(name, snap) for name in wh.served.schemas}
    return {**tables, "fact_events": wh.fact_events.rows(), "fact_sessions": wh.fact_sessions()}


def pending_feeds(wh: Warehouse) -> dict[str, DataFrame]:
    """Per layer and feed, the load time of the oldest row not yet consumed.

    The batch feeds record what they consumed; events count as consumed up to the newest load time of the next layer.
    """
    clean, served = wh.clean.snapshot(), wh.served.snapshot()
    events_done, facts_done = (log.rows().agg(F.max("load_ts")).first()[0] for log in (wh.clean_events, wh.fact_events))
    later = lambda df, column, done: df if done is None else df.filter(F.col(column) > F.lit(done))
    waiting = later(wh.raw["events"].rows(), "ingestion_ts", events_done)
    unserved = later(wh.clean_events.rows(), "load_ts", facts_done)
    raw_parts = [waiting.agg(F.min("ingestion_ts").alias("oldest")).withColumn("feed", F.lit("events_raw_stream"))]
    clean_parts = [unserved.agg(F.min("load_ts").alias("oldest")).withColumn("feed", F.lit("events_stream"))]
    for feed in BATCH_FEEDS:
        waiting = wh.raw[feed.name].read(after=clean.consumed.get(feed.name))
        raw_parts.append(waiting.agg(F.min("ingestion_ts").alias("oldest")).withColumn("feed", F.lit(f"{feed.name}_raw_stream")))
        changed = wh.clean.changes(feed.name, clean, served.consumed.get(feed.name))
        clean_parts.append(changed.agg(F.min("load_ts").alias("oldest")).withColumn("feed", F.lit(f"{feed.name}_stream")))
    union = lambda parts: parts[0] if len(parts) == 1 else parts[0].unionByName(union(parts[1:]))
    return {"bronze": union(raw_parts), "silver": union(clean_parts)}


def run_checks(wh: Warehouse, batch: int, clock: Column) -> DataFrame:
    """Run every check and append the results in one write."""
    raw, snap = {name: log.stored() for name, log in wh.raw.items()}, wh.clean.snapshot()
    stored = {**{f.name: wh.clean.stored(f.name, snap) for f in BATCH_FEEDS}, "events": wh.clean_events.stored()}
    results = quality.run_all(
        clean_tables(wh), served_tables(wh), clock, raw=raw, pending=pending_feeds(wh), stored=stored
    )
    wh.check_results.append(results, batch)
    return wh.check_results.read().filter(F.col(BATCH) == batch).drop(BATCH)


def run_batch(
    wh: Warehouse, landing: str, batch: int, as_of: date | None = None, now: Callable[[], datetime] = utc_now, **options
) -> DataFrame:
    """Ingest, merge, build and check the batch feeds. Returns the check results."""
    clock = timestamp(now())
    today = as_of or now().date()
    logged(wh, "TASK_INGEST_BATCH", batch, lambda: ingest_batch(wh, landing, lambda: clock), now)
    logged(wh, "TASK_MERGE_SILVER_BATCH", batch, lambda: merge_batch(wh, batch, clock), now)
    logged(wh, "TASK_BUILD_GOLD_BATCH", batch, lambda: build_batch(wh, batch, clock, today, **options), now)
    return logged(wh, "TASK_DQ_CHECKS", batch, lambda: run_checks(wh, batch, clock), now)


def run_events(wh: Warehouse, landing: str, batch: int, now: Callable[[], datetime] = utc_now) -> None:
    """Ingest, deduplicate and serve what clickstream files there are."""
    clock = timestamp(now())
    if logged(wh, "TASK_INGEST_EVENTS", batch, lambda: ingest_events(wh, landing, lambda: clock), now) is None:
        return  # no event has ever landed
    logged_stream(wh, "TASK_MERGE_SILVER_EVENTS", batch, lambda: clean_events_query(wh, lambda: clock), now)
    logged_stream(wh, "TASK_BUILD_GOLD_EVENTS", batch, lambda: serve_events_query(wh, lambda: clock), now)


def merge_all(wh: Warehouse, batch: int, now: Callable[[], datetime] = utc_now) -> None:
    """Both merges by one call, for runs by hand: the batch feeds, then the events."""
    clock = timestamp(now())
    logged(wh, "MERGE_SILVER_BATCH", batch, lambda: merge_batch(wh, batch, clock), now)
    if wh.raw["events"].last_batch() is not None:
        logged_stream(wh, "MERGE_SILVER_EVENTS", batch, lambda: clean_events_query(wh, lambda: clock), now)


def build_all(wh: Warehouse, batch: int, as_of: date | None = None, now: Callable[[], datetime] = utc_now, **options) -> None:
    """Both builds by one call, for runs by hand."""
    clock = timestamp(now())
    logged(wh, "BUILD_GOLD_BATCH", batch, lambda: build_batch(wh, batch, clock, as_of or now().date(), **options), now)
    if wh.clean_events.last_batch() is not None:
        logged_stream(wh, "BUILD_GOLD_EVENTS", batch, lambda: serve_events_query(wh, lambda: clock), now)
