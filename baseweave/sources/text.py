"""Lines of text files with their file and order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from baseweave.operators.stored import stored

from .blocked import is_blocked, read_blocked


#: Lines of a file that are numbered together.
RUN = 1 << 18


def has_blocked(paths: str | list[str]) -> bool:
    """Whether all these files are blocked ones."""
    every = [paths] if isinstance(paths, str) else list(paths)
    return bool(every) and all(is_blocked(p) for p in every)


def read_lines(spark: SparkSession, paths: str | list[str], recursive: bool = False) -> DataFrame:
    """(file, ordinal, line); compressed files are read as such, blocked ones in ranges side by side.

    ``ordinal`` orders the lines of a file: by the part of the file that a task
    read, then within the task.
    """
    if not recursive and has_blocked(paths):
        return read_blocked(spark, [paths] if isinstance(paths, str) else list(paths))
    reader = spark.read.option("recursiveFileLookup", "true") if recursive else spark.read
    raw = reader.text(paths)
    where = F.struct(F.col("_metadata.file_block_start").alias("part"), F.monotonically_increasing_id().alias("row"))
    return raw.select(F.col("_metadata.file_path").alias("file"), where.alias("ordinal"), F.col("value").alias("line"))


def in_file_order(lines: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """``lines`` with running sums over the lines of each file up to and with this one: name -> expression.

    A file larger than a task is cut into parts by the order of its lines, the
    parts' totals are summed along the file, and a window runs within a part
    only. ``lines`` are stored first, as both steps read them.
    """
    rows = stored(lines, "lines").withColumns({f"__v_{n}": v for n, v in sums.items()})
    # Lines that one task read from one part of a file have numbers that follow each other.
    rows = rows.withColumn("__run", F.struct(F.col("ordinal.part").alias("part"), F.floor(F.col("ordinal.row") / RUN).alias("run")))
    totals = rows.groupBy("file", "__run").agg(*[F.sum(f"__v_{n}").alias(n) for n in sums])
    earlier = Window.partitionBy("file").orderBy("__run").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select("file", "__run", *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"__c_{n}") for n in sums])
    within = Window.partitionBy("file", "__run").orderBy("ordinal").rowsBetween(Window.unboundedPreceding, 0)
    out = rows.join(carried, ["file", "__run"]).withColumns({n: (F.col(f"__c_{n}") + F.sum(f"__v_{n}").over(within)).cast("bigint") for n in sums})
    return out.select(*lines.columns, *sums)


def field(cols: str, k: int) -> Column:
    """Field ``k`` from 0, or null where the line is shorter."""
    return F.get(F.col(cols), F.lit(k))


def split_fields(lines: DataFrame) -> DataFrame:
    return lines.withColumn("cols", F.split("line", "\t", -1)).withColumn("n_cols", F.size("cols"))


def base_name(file: Column) -> Column:
    return F.regexp_extract(file, r"([^/]+?)(?:\.g?vcf)?(?:\.gz)?$", 1)
