"""Raw change rows to the clean rows a merge takes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.latest import latest_by_key, post_images, recency
from tidemark.operators.suppression import suppress_clean
from tidemark.schemas import Feed, conform


def clean_rows(
    changes: DataFrame, feed: Feed, suppressed: DataFrame, suppressed_orders: DataFrame
) -> DataFrame:
    """Newest raw row per key, with suppressed people's rows removed and lineage renamed."""
    allowed = suppress_clean(feed.name, post_images(changes, feed.key), suppressed, suppressed_orders)
    newest = latest_by_key(allowed, [feed.key], recency(feed))
    renamed = newest.withColumns(
        {"record_source": F.col("source_file"), "load_ts": F.col("ingestion_ts")}
    )
    return conform(renamed, feed.clean)
