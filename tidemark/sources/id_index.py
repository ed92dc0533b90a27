"""Which ids a table has ever held: an index that is opened only where a batch needs it."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.upsert import insert_new
from tidemark.sources.tables import BATCH

PREFIX = "_prefix"
PREFIXES = 256


class IdIndex:
    """Ids with the time they were loaded, foldered by a prefix of their hash and by batch.

    A batch opens the folders of the prefixes that its ids have, and reads ids alone. Within a file ids are sorted and have
    a Bloom filter, so row groups that cannot hold an id are passed over. Dates are no help: a repeat may state another
    time. Writing a batch again replaces it.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, kind: T.DataType = T.StringType(), prefixes: int = PREFIXES):
        self.spark, self.path, self.key, self.prefixes = spark, path.rstrip("/"), key, prefixes
        fields = [T.StructField(key, kind), T.StructField("load_ts", T.TimestampNTZType())]
        self.schema = T.StructType([*fields, T.StructField(PREFIX, T.IntegerType()), T.StructField(BATCH, T.LongType())])

    def _prefix(self):
        return F.pmod(F.xxhash64(self.key), F.lit(self.prefixes)).cast("int")

    def add(self, rows: DataFrame, batch: int) -> None:
        """Add the ids of a batch's rows (with ``load_ts``)."""
        ids = rows.select(self.key, "load_ts", self._prefix().alias(PREFIX), F.lit(batch).cast("bigint").alias(BATCH))
        dealt = ids.repartition(PREFIX).sortWithinPartitions(PREFIX, self.key)
        writer = dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.option(f"parquet.bloom.filter.enabled#{self.key}", "true").partitionBy(PREFIX, BATCH).parquet(self.path)

    def read(self, prefixes: list[int] | None = None) -> DataFrame:
        """Ids with load time, prefix and batch, of all prefixes or of some."""
        try:
            rows = self.spark.read.schema(self.schema).parquet(self.path)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], self.schema)
        return rows if prefixes is None else rows.filter(F.col(PREFIX).isin(prefixes))

    def met_by(self, rows: DataFrame) -> DataFrame:
        """The part of the index where ids of ``rows`` may be; runs a job that brings prefixes, at most all, to the driver."""
        found = rows.select(self._prefix().alias(PREFIX)).distinct().collect()
        return self.read(sorted(r[0] for r in found))

    def unseen(self, rows: DataFrame, batch: int | None = None, since=None) -> DataFrame:
        """Rows whose id no batch (before ``batch``) has, loaded at or after ``since`` if that is given."""
        seen = self.met_by(rows)
        if batch is not None:
            seen = seen.filter(F.col(BATCH) < batch)
        if since is not None:
            seen = seen.filter(F.col("load_ts") >= since)
        return insert_new(seen, rows, [self.key])
