"""Raw to clean: newest version per key, late data never overwriting newer."""

from __future__ import annotations

import uuid
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.cleaning import clean_rows
from tidemark.operators.quality import failure_row
from tidemark.operators.upsert import guarded_merge, updated_or_loaded
from tidemark.plans.warehouse import Warehouse
from tidemark.schemas import BATCH_FEEDS, EVENTS, conform
from tidemark.sources.scratch import cut_lineage
from tidemark.sources.tables import BATCH


def merge_changes(stored: DataFrame, rows: DataFrame, key: str, batch: int) -> DataFrame:
    """Guarded upsert of ``rows`` into stored rows; those it takes are stamped with ``batch``."""
    source = rows.withColumn(BATCH, F.lit(batch).cast("bigint"))
    return guarded_merge(stored, source, [key], updated_or_loaded).drop("_changed")


def merge_batch(wh: Warehouse, batch: int, run_ts: Column) -> list[str]:
    """Merge new raw rows of the five batch feeds; all five publish together or none does.

    Returns the tables that had changes. A failure leaves a result row and is raised.
    """
    try:
        snap = wh.clean.snapshot()
        folders, consumed = {}, {}
        suppressed, suppressed_orders = wh.suppressed.rows(), wh.suppressed_orders.rows()
        for feed in BATCH_FEEDS:
            log = wh.raw[feed.name]
            last, done = log.last_batch(), snap.consumed.get(feed.name)
            if last is None or (done is not None and last <= done):
                continue
            changes = log.read(after=done).filter(F.col(BATCH) <= last)
            rows = clean_rows(changes, feed, suppressed, suppressed_orders)
            folders[feed.name] = wh.clean.rewrite(
                feed.name, rows, [feed.key], snap, snap.next,
                lambda stored, source, key=feed.key: merge_changes(stored, source, key, snap.next),
            )
            consumed[feed.name] = last
        if consumed:
            wh.clean.publish(snap, folders, consumed)
        return sorted(consumed)
    except Exception as error:
        wh.check_results.append_once(failure_row(wh.spark, "merge_silver_batch", str(error), run_ts), str(uuid.uuid4()))
        raise


def merge_events(
    wh: Warehouse, changes: DataFrame, batch: int, run_ts: Column, horizon_days: int | None = None
) -> None:
    """Append a batch of raw events, each event id once across all batches.

    Repeats are looked for in the index of event ids, opened only at the prefixes that the batch has. A replayed batch must
    not see its own earlier rows, so only earlier batches count. ``horizon_days`` bounds how far back a repeated id is
    looked for; None is exact.
    """
    try:
        rows = clean_rows(changes, EVENTS, wh.suppressed.rows(), wh.suppressed_orders.rows())
        rows = cut_lineage(conform(rows, EVENTS.clean))
        since = None if horizon_days is None else run_ts - F.lit(timedelta(days=horizon_days))
        wh.clean_events.append(wh.event_ids.unseen(rows, batch, since), batch)
        # Ids follow their rows: a run that stops in between is replayed and adds them then.
        wh.event_ids.add(wh.clean_events.read().filter(F.col(BATCH) == batch), batch)
    except Exception as error:
        wh.check_results.append_once(failure_row(wh.spark, "merge_silver_events", str(error), run_ts), str(uuid.uuid4()))
        raise
