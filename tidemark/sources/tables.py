"""Stored tables: parquet folders that are written once and then listed as current.

No folder is rewritten while it may be read. A run writes the partitions it changed
into folders of its own and lists them in a small control table as its last step, so
a run that fails leaves the published tables as they were, and several tables change
together or not at all.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.joins import without
from tidemark.sources.scratch import cut_lineage

BATCH = "_batch"
PART = "_part"
WHOLE = "all"
UNDATED = "undated"


def month_of(date_column: str) -> Column:
    """Partition of a dated row: the month, as in ``2026-02``."""
    return F.coalesce(F.date_format(date_column, "yyyy-MM"), F.lit(UNDATED))


def bucket_of(key: str | Column, buckets: int) -> Column:
    """Partition of a row that has no date to go by: a bucket of its key's hash."""
    return F.format_string("b%05d", F.pmod(F.xxhash64(key), F.lit(buckets)))


@dataclass(frozen=True)
class Layout:
    """How a table is partitioned on disk, and what its rows are sorted or looked up by."""

    part: Column | None = None
    sort: Sequence[str] = ()
    bloom: Sequence[str] = ()


def write_parquet(df: DataFrame, folder: str, layout: Layout = Layout(), partition_by: Sequence[str] = ()) -> None:
    """Write ``df`` to a folder of its own in the table's layout."""
    if layout.sort:
        # Neighbouring keys share row groups, so readers skip the others by their min and max. Ranges cost a second run of
        # the last stage, to draw their bounds from; partitions of their own need none, and large ones are cut by size.
        dealt = df.hint("rebalance", *partition_by) if layout.part is not None else df.repartitionByRange(*partition_by, *layout.sort)
        df = dealt.sortWithinPartitions(*partition_by, *layout.sort)
    writer = df.write.mode("overwrite")
    for column in layout.bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(folder)


class AppendLog:
    """An append-only table with one folder per batch.

    Writing a batch again replaces it, so a replayed batch leaves no duplicates. Rows that no later run may replace are
    appended under a key instead.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, layout: Layout = Layout()):
        self.spark, self.path, self.schema, self.layout = spark, path.rstrip("/"), schema, layout

    def append(self, df: DataFrame, batch: int) -> None:
        write_parquet(df.select(self.schema.fieldNames()), f"{self.path}/{BATCH}={batch}", self.layout)

    def append_once(self, df: DataFrame, key: str) -> None:
        """Append rows under a key of their own; what was appended under it before stays as it is.

        For logs that must keep what they hold: a request that is repeated finds less to record than the first time.
        """
        batch = number_of(key)
        if self.read().filter(F.col(BATCH) == batch).isEmpty():
            self.append(df, batch)

    def read(self, after: int | None = None) -> DataFrame:
        """Rows with their batch number; ``after`` prunes to later batches."""
        schema = T.StructType([*self.schema.fields, T.StructField(BATCH, T.LongType())])
        try:
            rows = self.spark.read.schema(schema).parquet(self.path)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)
        return rows if after is None else rows.filter(F.col(BATCH) > after)

    def rows(self) -> DataFrame:
        return self.read().drop(BATCH)

    def stored(self) -> DataFrame:
        """The table with the columns its files have, whatever the declared schema says."""
        try:
            return self.spark.read.option("mergeSchema", True).parquet(self.path).drop(BATCH)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], self.schema)

    def last_batch(self) -> int | None:
        """Highest batch number, from the folder names alone."""
        return self.read().agg(F.max(BATCH)).first()[0]

    def batches_with(self, values: DataFrame, column: str, of: Column | None = None) -> list[int]:
        """Batches that hold a row whose column, or ``of``, is among ``values``. At most one number per batch."""
        owned = self.read().select((F.col(column) if of is None else of).alias(column), BATCH)
        hit = owned.join(values, column, "left_semi").select(BATCH).distinct()
        return sorted(r[BATCH] for r in hit.collect())

    def remove(self, values: DataFrame, column: str, spare: str, of: Column | None = None) -> list[int]:
        """Delete the rows whose column is among ``values``, rewriting only the batches that hold any.

        ``of`` is what to compare where the value is not a column of its own.

        The surviving rows are written to ``spare`` and from there over the batches, all
        in one job, so a failure in between loses nothing.
        """
        batches = self.batches_with(values, column, of)
        if not batches:
            return batches
        affected = self.read().filter(F.col(BATCH).isin(batches))
        columns = [*self.schema.fieldNames(), BATCH]
        owned = affected.withColumn("_owner", F.col(column) if of is None else of)
        without(owned, "_owner", values, column).select(columns).write.mode("overwrite").parquet(spare)
        schema = T.StructType([*self.schema.fields, T.StructField(BATCH, T.LongType())])
        staged = self.spark.read.schema(schema).parquet(spare)
        staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BATCH).parquet(self.path)
        left = {r[BATCH] for r in staged.select(BATCH).distinct().collect()}
        for emptied in sorted(set(batches) - left):
            self.append(self.spark.createDataFrame([], self.schema), emptied)
        return batches


@dataclass
class Snapshot:
    """What a control table lists: folders by table and partition, and consumed positions."""

    version: int = 0
    folders: dict[str, dict[str, str]] = field(default_factory=dict)
    consumed: dict[str, int] = field(default_factory=dict)

    @property
    def next(self) -> int:
        """The number of the publication after this one."""
        return self.version + 1


_CONTROL = T.StructType(
    [
        T.StructField("version", T.LongType()),
        T.StructField("kind", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("part", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)


class SnapshotTables:
    """A group of tables that are published together.

    Each stored row carries the publication that last changed it, so readers of changes
    need only the partitions written since, and no second copy of the changed rows.
    Publications are numbered by the store, always upwards: ``snapshot().next`` is the
    number a run stamps its rows with.
    """

    def __init__(self, spark: SparkSession, root: str, schemas: dict[str, T.StructType], layouts: dict[str, Layout]):
        self.spark, self.root = spark, root.rstrip("/")
        self.schemas, self.layouts = schemas, layouts
        self._control = f"{self.root}/control"

    def snapshot(self) -> Snapshot:
        """The latest publication. It has one row per table partition, never per data row."""
        try:
            listed = self.spark.read.schema(_CONTROL).parquet(self._control)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return Snapshot()
        newest = listed.agg(F.max("version")).first()[0]
        if newest is None:
            return Snapshot()
        found = Snapshot(version=newest)
        for row in listed.filter(F.col("version") == newest).collect():
            if row.kind == "folder":
                found.folders.setdefault(row.name, {})[row.part] = row.value
            elif row.kind == "consumed":
                found.consumed[row.name] = int(row.value)
        return found

    def _stored_schema(self, name: str) -> T.StructType:
        return T.StructType([*self.schemas[name].fields, T.StructField(BATCH, T.LongType())])

    def _read_folders(self, name: str, folders: Sequence[str]) -> DataFrame:
        schema = self._stored_schema(name)
        if not folders:
            return self.spark.createDataFrame([], schema).limit(0)  # known to be empty: a first load meets no join
        return self.spark.read.schema(schema).parquet(*folders)

    def read_stored(self, name: str, snap: Snapshot, parts: set[str] | None = None) -> DataFrame:
        """Rows with their batch column, of all partitions or of some."""
        listed = snap.folders.get(name, {})
        return self._read_folders(name, [f for p, f in sorted(listed.items()) if parts is None or p in parts])

    def stored(self, name: str, snap: Snapshot) -> DataFrame:
        """The table with the columns its files have, whatever the declared schema says."""
        folders = sorted(snap.folders.get(name, {}).values())
        if not folders:
            return self.spark.createDataFrame([], self.schemas[name])
        return self.spark.read.option("mergeSchema", True).parquet(*folders).drop(BATCH)

    def read(self, name: str, snap: Snapshot | None = None, since: str | None = None) -> DataFrame:
        """The table; ``since`` leaves out partitions of earlier months."""
        snap = snap or self.snapshot()
        listed = snap.folders.get(name, {})
        parts = None if since is None else {p for p in listed if p == UNDATED or p == WHOLE or p >= since}
        return self.read_stored(name, snap, parts).drop(BATCH)

    def changes(self, name: str, snap: Snapshot, after: int | None) -> DataFrame:
        """Rows that batches later than ``after`` added or changed, in their present state."""
        listed = snap.folders.get(name, {})
        if after is None:
            return self.read_stored(name, snap).drop(BATCH)
        recent = {p for p, folder in listed.items() if batch_of(folder) > after}
        return self.read_stored(name, snap, recent).filter(F.col(BATCH) > after).drop(BATCH)

    def _part(self, name: str) -> Column:
        part = self.layouts.get(name, Layout()).part
        return F.lit(WHOLE) if part is None else part

    def write(self, name: str, df: DataFrame, batch: int) -> dict[str, str]:
        """Write rows to a folder that nothing else uses, and say where each partition went."""
        folder = f"{self.root}/{name}/run={batch}.{uuid.uuid4().hex}"
        stored = df.select(*self._stored_schema(name).fieldNames(), self._part(name).alias(PART))
        write_parquet(stored, folder, self.layouts.get(name, Layout()), [PART])
        # Reading only the partition column costs a listing of the folder.
        schema = T.StructType([*self._stored_schema(name).fields, T.StructField(PART, T.StringType())])
        parts = self.spark.read.schema(schema).parquet(folder).select(PART).distinct().collect()
        return {r[PART]: f"{folder}/{PART}={r[PART]}" for r in parts}

    def touched_parts(self, name: str, source: DataFrame, keys: Sequence[str], snap: Snapshot) -> set[str]:
        """Partitions a batch changes: those its rows go to and those they are in now."""
        part = self._part(name)
        going = source.select(part.alias(PART))
        inside = self.read_stored(name, snap).join(source.select(*keys), list(keys), "left_semi").select(part.alias(PART))
        return {r[PART] for r in going.unionAll(inside).distinct().collect()}

    def rewrite(
        self,
        name: str,
        source: DataFrame,
        keys: Sequence[str],
        snap: Snapshot,
        batch: int,
        merge: Callable[[DataFrame, DataFrame], DataFrame],
    ) -> dict[str, str]:
        """``merge(stored, source)`` for the partitions ``source`` touches; returns the table's new listing.

        The batch is needed several times, so it is computed once and kept in the shared folder. A table that has nothing
        yet is written at once.
        """
        if not snap.folders.get(name):
            return self.write(name, merge(self.read_stored(name, snap), source), batch)
        source = cut_lineage(source)
        touched = self.touched_parts(name, source, keys, snap)
        kept = {p: f for p, f in snap.folders.get(name, {}).items() if p not in touched}
        return {**kept, **self.write(name, merge(self.read_stored(name, snap, touched), source), batch)}

    def publish(self, snap: Snapshot, folders: dict[str, dict[str, str]], consumed: dict[str, int]) -> Snapshot:
        """Make new listings current. This is a run's last step, and a single small file."""
        new = Snapshot(snap.version + 1, {**snap.folders, **folders}, {**snap.consumed, **consumed})
        rows = [(new.version, "folder", n, p, f) for n, parts in new.folders.items() for p, f in parts.items()]
        rows += [(new.version, "consumed", n, None, str(v)) for n, v in new.consumed.items()]
        rows.append((new.version, "published", None, None, None))
        listed = self.spark.createDataFrame(rows, _CONTROL).coalesce(1)
        listed.write.mode("overwrite").parquet(f"{self._control}/publication={new.version}")
        return new


def batch_of(folder: str) -> int:
    """The batch that wrote a listed folder."""
    return int(folder.split("/run=")[1].split(".")[0])


def number_of(key: str) -> int:
    """A batch number that stands for a key; negative, so apart from numbered batches."""
    return -1 - (uuid.uuid5(uuid.NAMESPACE_OID, key).int >> 66)
