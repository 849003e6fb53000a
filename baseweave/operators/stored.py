"""Intermediate results that several steps read: computed once, written to the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Rows that a task sorts or sums at once.
TASK_ROWS = 1 << 19
#: Partitions up to which Spark writes a shuffle without sorting it in memory (``spark.shuffle.sort.bypassMergeThreshold``); tasks take up to MORE times the rows before there are more.
UNSORTED, MORE = 200, 8


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where it is unset a folder of our own, which only a local master may have."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="baseweave-checkpoint-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet and read again: its plan runs once, and what follows survives lost executors without it."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dealt(rows: DataFrame, n: int, *keys: str) -> DataFrame:
    """``rows``, of which there are ``n``, for a step by ``keys``: so many that Spark's own partitions may outgrow a task are dealt to more of them."""
    parts = max(min(-(-n // TASK_ROWS), UNSORTED), -(-n // (MORE * TASK_ROWS)))
    return rows.repartition(parts, *keys) if parts > rows.sparkSession.sparkContext.defaultParallelism else rows
