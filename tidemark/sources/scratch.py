"""The shared folder for checkpoints and intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    A session that runs in one process, such as a local test, gets a folder of its own if it names none. On a cluster a
    folder of one machine would be lost with it, so there the setting is required.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise ValueError(f"spark.checkpoint.dir must name a folder that all machines of {master} share")
    local = tempfile.mkdtemp(prefix="tidemark-")
    spark.sparkContext.setCheckpointDir(local)
    return local


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A path below the shared folder that nothing else uses."""
    return f"{checkpoint_root(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder, so it outlives lost executors."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)
