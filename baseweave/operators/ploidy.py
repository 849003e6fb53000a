"""Ploidy by the number of sequences in alignment blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def file_ploidy(blocks: DataFrame, max_blocks: int | None = None) -> DataFrame:
    """(file, ploidy): the most sequences besides the reference among a file's blocks, 1 at least.

    ``blocks`` has a row (file, block_id) for each sequence. With ``max_blocks``
    only so many blocks of each file count, those with the smallest ids.
    """
    per_block = blocks.groupBy("file", "block_id").agg(F.count(F.lit(1)).alias("n"))
    if max_blocks is not None:
        nth = F.row_number().over(Window.partitionBy("file").orderBy("block_id"))
        per_block = per_block.withColumn("nth", nth).filter(F.col("nth") <= max_blocks)
    return per_block.groupBy("file").agg(F.greatest(F.max("n") - 1, F.lit(1)).cast("bigint").alias("ploidy"))


def resolve_ploidy(ploidies: DataFrame, configured: int | None = None) -> tuple[int, str]:
    """One ploidy for all, and where it is from: ``config``, ``maf``, ``maf_max`` (they differ) or ``default``."""
    if configured is not None:
        return configured, "config"
    row = ploidies.agg(F.max("ploidy").alias("most"), F.count_distinct("ploidy").alias("n")).first()
    if row["most"] is None:
        return 1, "default"
    return row["most"], "maf" if row["n"] == 1 else "maf_max"
