"""The clickstream path as streaming queries: raw to clean, clean to serving.

Offsets are committed after a micro-batch has been written, and every write is keyed
by the batch number, so a batch that is run again replaces what it wrote before.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.plans.clean import merge_events
from tidemark.plans.serving import build_events
from tidemark.plans.warehouse import Warehouse
from tidemark.sources.landing import ANY_AGE
from tidemark.sources.tables import BATCH, AppendLog


def read_appends(log: AppendLog) -> DataFrame:
    """A stream of the rows later appended to a log."""
    schema = T.StructType([*log.schema.fields, T.StructField(BATCH, T.LongType())])
    return log.spark.readStream.schema(schema).option("maxFileAge", ANY_AGE).parquet(log.path).drop(BATCH)


def _start(
    stream: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str, interval: str | None
) -> StreamingQuery:
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    writer = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger).start()


def clean_events_query(
    wh: Warehouse, run_ts: Callable[[], Column], interval: str | None = None, horizon_days: int | None = None
) -> StreamingQuery:
    """Deduplicate raw events into the clean log, exactly unless ``horizon_days`` is given."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        merge_events(wh, batch, batch_id, run_ts(), horizon_days)

    return _start(read_appends(wh.raw["events"]), apply, wh.checkpoint("clean_events"), interval)


def serve_events_query(wh: Warehouse, run_ts: Callable[[], Column], interval: str | None = None) -> StreamingQuery:
    """Serve clean events as facts and refresh the sessions they belong to."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        build_events(wh, batch, batch_id, run_ts())

    return _start(read_appends(wh.clean_events), apply, wh.checkpoint("serve_events"), interval)
