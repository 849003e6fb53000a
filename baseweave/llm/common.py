"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space of every contract here, as a regular-expression class body.
SPACE = r"\x20\x09-\x0D"
SPACE_CHARS = (" ", "\t", "\n", "\x0b", "\x0c", "\r")
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; where it is unset one of our own, on a local master only."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="baseweave-checkpoint-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def written(df: DataFrame, name: str, compact: bool = False) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    ``compact`` is for results much smaller than what they are made of: Spark
    gathers them into files of its advisory size instead of one for each task.

    It cuts the lineage: what follows survives lost executors without running
    the work before it again, and is not computed twice by two readers.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    (df.hint("rebalance") if compact else df).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def without_space(text: Column) -> Column:
    """``text`` without any character of SPACE."""
    for c in SPACE_CHARS:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def row_key(id_col: str, text_col: str) -> Column:
    """A digest of id and text, by which a row is found again where ids are null or repeated."""
    of_id, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (id_col, text_col))
    return F.unhex(F.sha2(F.concat(of_id, F.lit("\x00"), text), 256))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
