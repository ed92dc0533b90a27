"""Landing to raw: each file once, rejects aside, suppressed people left out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.suppression import orders_of, purge, purge_feeds
from tidemark.plans.warehouse import Warehouse
from tidemark.schemas import BATCH_FEEDS, EVENTS, FEEDS, Feed
from tidemark.sources import landing
from tidemark.sources.scratch import cut_lineage


def _store(wh: Warehouse, feed: Feed, run_ts: Callable[[], Column]) -> Callable[[DataFrame, int], None]:
    load = landing.load_json if feed.append_only else landing.load_csv

    def store(batch: DataFrame, batch_id: int) -> None:
        # Rows and rejects both come from the parsed files, which are parsed once and numbered for good.
        parsed = cut_lineage(landing.with_sequence(batch))
        rows, rejects = load(parsed, feed, run_ts())
        suppressed = wh.suppressed.rows()
        if feed.name == "orders":
            # Remember whose orders these were before dropping them: their payments
            # name only the order.
            wh.suppressed_orders.append(orders_of(rows, suppressed), batch_id)
        kept = purge_feeds({feed.name: rows}, suppressed, wh.suppressed_orders.rows())[feed.name]
        wh.raw[feed.name].append(kept, batch_id)
        wh.rejects[feed.name].append(_without_suppressed(wh, feed, rejects, suppressed), batch_id)

    return store


def _without_suppressed(wh: Warehouse, feed: Feed, rejects: DataFrame, suppressed: DataFrame) -> DataFrame:
    """Rejected rows, without those that name a suppressed person or one of their orders."""
    if feed.append_only:
        named = rejects.withColumn("user_id", F.try_variant_get("v", "$.user_id", "string"))
        return purge(named, "user_id", suppressed, "customer_id").drop("user_id")
    return purge_feeds({feed.name: rejects}, suppressed, wh.suppressed_orders.rows())[feed.name]


def ingest_feed(
    wh: Warehouse,
    folder: str,
    feed: Feed,
    run_ts: Callable[[], Column],
    interval: str | None = None,
    files_per_batch: int | None = None,
    bytes_per_batch: str | None = None,
) -> StreamingQuery:
    """Start loading a feed's files. Spark's checkpoint remembers which were loaded.

    Without ``interval`` the query loads what is there and stops. A backfill is loaded in as many micro-batches as the
    limits ask for: ``files_per_batch``, or ``bytes_per_batch`` as in ``10g``; a file larger than that is loaded alone.
    """
    if files_per_batch is not None and bytes_per_batch is not None:
        raise ValueError("a micro-batch is limited by files or by bytes, not by both")
    limits = {"maxFilesPerTrigger": files_per_batch, "maxBytesPerTrigger": bytes_per_batch}
    limits = {name: str(value) for name, value in limits.items() if value is not None}
    if feed.append_only:
        stream = landing.stream_json_variant(wh.spark, folder, feed, limits)
    else:
        stream = landing.stream_csv_text(wh.spark, folder, feed, limits)
    writer = stream.writeStream.foreachBatch(_store(wh, feed, run_ts)).option(
        "checkpointLocation", wh.checkpoint(f"ingest_{feed.name}")
    )
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**trigger).start()


def ingest_batch(wh: Warehouse, folder: str, run_ts: Callable[[], Column], **limits) -> dict[str, int | None]:
    """Load new files of the five CSV feeds; returns each feed's last batch number.

    Orders are loaded before payments, which depend on the suppressed orders found. ``limits`` are those of
    :func:`ingest_feed`.
    """
    for feed in BATCH_FEEDS:
        ingest_feed(wh, folder, feed, run_ts, **limits).awaitTermination()
    return {feed.name: wh.raw[feed.name].last_batch() for feed in BATCH_FEEDS}


def ingest_events(wh: Warehouse, folder: str, run_ts: Callable[[], Column], **limits) -> int | None:
    ingest_feed(wh, folder, FEEDS[EVENTS.name], run_ts, **limits).awaitTermination()
    return wh.raw["events"].last_batch()
