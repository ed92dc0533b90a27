"""Readers for landed CSV and JSON files: typed rows, rejects and lineage."""

from __future__ import annotations

import re
from functools import reduce
from operator import or_
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.expressions import blank_to_null, parse_text
from tidemark.schemas import Feed
from tidemark.sources.scratch import cut_lineage

_CELL = "_cell_"
_PLACE = ["_file", "_row"]

#: A file is loaded however old it is: without this, streams pass over files a week older than the newest seen.
ANY_AGE = "36500d"


def _file_in(folder: str) -> Column:
    """A file's path below the landing folder, which tells files of one name in different folders apart."""
    root = re.sub(r"^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?", "", folder).rstrip("/")
    below = F.regexp_replace("_metadata.file_path", f"^.*?{re.escape(quote(root))}/+", "")
    return below.alias("_file")


def _file_position(folder: str) -> list[Column]:
    return [
        _file_in(folder),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_seq"),
    ]


def _text_schema(feed: Feed) -> T.StructType:
    # Columns are taken by position; the header's names are not consulted.
    return T.StructType([T.StructField(c, T.StringType()) for c in feed.columns])


def _csv_options(reader):
    # Rows with too few cells are padded with null and rows with too many are
    # cut, which is what "column count may differ" asks for.
    return (
        reader.option("header", True)
        .option("enforceSchema", True)
        .option("sep", ",")
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
    )


def read_csv_text(spark: SparkSession, path: str, feed: Feed) -> DataFrame:
    """Cells of the feed's CSV files as text, with each row's place in its file."""
    reader = _csv_options(spark.read.schema(_text_schema(feed)))
    return reader.option("pathGlobFilter", feed.file_glob).csv(path).select(*feed.columns, *_file_position(path))


def stream_csv_text(spark: SparkSession, path: str, feed: Feed, limits: dict[str, str] | None = None) -> DataFrame:
    """Streaming form of :func:`read_csv_text`: each file is delivered once."""
    reader = _csv_options(spark.readStream.schema(_text_schema(feed))).option("maxFileAge", ANY_AGE).options(**(limits or {}))
    stream = reader.option("pathGlobFilter", feed.file_glob).csv(path)
    return stream.select(*feed.columns, _file_in(path), F.col("_metadata.file_block_start").alias("_block"))


def read_json_variant(spark: SparkSession, path: str, feed: Feed) -> DataFrame:
    """One variant per line of the feed's JSON files, with the line's place in its file."""
    reader = spark.read.option("singleVariantColumn", "v").option("pathGlobFilter", feed.file_glob)
    return reader.json(path).select("v", *_file_position(path))


def stream_json_variant(spark: SparkSession, path: str, feed: Feed, limits: dict[str, str] | None = None) -> DataFrame:
    """Streaming form of :func:`read_json_variant`: each file is delivered once."""
    reader = spark.readStream.option("singleVariantColumn", "v").option("maxFileAge", ANY_AGE).options(**(limits or {}))
    lines = reader.option("pathGlobFilter", feed.file_glob).json(path)
    return lines.select("v", _file_in(path), F.col("_metadata.file_block_start").alias("_block"))


def with_sequence(batch: DataFrame) -> DataFrame:
    """Add the row sequence that a streaming query may only compute inside a micro-batch."""
    return batch.withColumn("_seq", F.monotonically_increasing_id())


def type_csv(text: DataFrame, feed: Feed) -> tuple[DataFrame, DataFrame]:
    """Split text rows into typed rows and rejects.

    A row is rejected if a cell that held a value lost it in the cast.
    """
    cells = {f.name: blank_to_null(F.col(f.name)) for f in feed.business.fields}
    wide = text.select(
        *[c.alias(_CELL + name) for name, c in cells.items()],
        *[parse_text(cells[f.name], f.dataType).alias(f.name) for f in feed.business.fields],
        *_PLACE,
    )
    typed = [f.name for f in feed.business.fields if not isinstance(f.dataType, T.StringType)]
    lost = reduce(or_, [F.col(_CELL + c).isNotNull() & F.col(c).isNull() for c in typed])
    good = wide.filter(~lost).select(*feed.columns, *_PLACE)
    bad = wide.filter(lost).select(
        *[F.col(_CELL + c).alias(c) for c in feed.columns],
        F.concat_ws(",", *[F.when(F.col(_CELL + c).isNotNull() & F.col(c).isNull(), F.lit(c)) for c in typed])
        .alias("rejected_columns"),
        *_PLACE,
    )
    return good, bad


def type_json(lines: DataFrame, feed: Feed) -> tuple[DataFrame, DataFrame]:
    """Typed rows by key path, and the lines whose timestamp did not parse."""
    paths = []
    for f in feed.business.fields:
        if isinstance(f.dataType, T.VariantType):
            paths.append(F.try_variant_get("v", f"$.{f.name}", "variant").alias(f.name))
        elif isinstance(f.dataType, T.TimestampNTZType):
            text = F.try_variant_get("v", f"$.{f.name}", "string")
            paths.append(text.try_cast("timestamp_ntz").alias(f.name))
        else:
            paths.append(F.try_variant_get("v", f"$.{f.name}", f.dataType.simpleString()).alias(f.name))
    stamps = [f.name for f in feed.business.fields if isinstance(f.dataType, T.TimestampNTZType)]
    given = {c: blank_to_null(F.try_variant_get("v", f"$.{c}", "string")) for c in stamps}
    lost = reduce(or_, [given[c].isNotNull() & F.col(c).isNull() for c in stamps])
    wide = lines.select("v", *paths, *_PLACE).withColumn("_lost", F.col("v").isNull() | lost)
    good = wide.filter(~F.col("_lost")).select(*feed.columns, *_PLACE)
    bad = wide.filter("_lost").select("v", *_PLACE)
    return good, bad


def file_row_numbers(text: DataFrame) -> DataFrame:
    """Number rows within their file from 1, without gathering a file in one task.

    Rows of one file block are read consecutively by one task, so a row's place in
    its block is its distance from the block's first row. Only one row per block is
    then ordered within its file to turn block sizes into starting positions. How these
    few rows meet the others is left to Spark, which knows their size once they are stored.
    """
    blocks = cut_lineage(
        text.groupBy("_file", "_block").agg(F.min("_seq").alias("_first"), F.count("*").alias("_rows"))
    )
    before = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select(
        "_file", "_block", "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")
    )
    return (
        text.join(starts, ["_file", "_block"])
        .withColumn("_row", F.col("_start") + F.col("_seq") - F.col("_first") + 1)
        .drop("_first", "_start", "_block", "_seq")
    )


def add_lineage(rows: DataFrame, columns: list[str], run_ts: Column) -> DataFrame:
    """Attach when, from which file, and from which row of it each record came."""
    return rows.select(
        *columns,
        run_ts.cast("timestamp_ntz").alias("ingestion_ts"),
        F.col("_file").alias("source_file"),
        F.concat(F.col("_file"), F.lit(":"), F.col("_row").cast("string")).alias("load_id"),
    )


def load_csv(text: DataFrame, feed: Feed, run_ts: Column) -> tuple[DataFrame, DataFrame]:
    """Raw-table rows and rejects of CSV text."""
    good, bad = type_csv(file_row_numbers(text), feed)
    return add_lineage(good, feed.columns, run_ts), add_lineage(bad, feed.columns + ["rejected_columns"], run_ts)


def load_json(lines: DataFrame, feed: Feed, run_ts: Column) -> tuple[DataFrame, DataFrame]:
    """Raw-table rows and rejects of JSON lines."""
    good, bad = type_json(file_row_numbers(lines), feed)
    return add_lineage(good, feed.columns, run_ts), add_lineage(bad, ["v"], run_ts)
