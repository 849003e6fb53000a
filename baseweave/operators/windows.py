"""Densities in windows of fixed width."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from baseweave.functions.names import window_index

WIDTH = 100_000


def window_spine(lengths: DataFrame, width: int = WIDTH) -> DataFrame:
    """(contig, bin, start, end, mid) of all windows; the last ends with the contig."""
    last = F.floor((F.col("length") - 1) / width).cast("bigint")
    bins = lengths.filter("length > 0").select("contig", "length", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("bin"))
    start, end = F.col("bin") * width, F.least(F.col("bin") * width + width, F.col("length"))
    return bins.select("contig", "bin", start.alias("start"), end.alias("end"), (start + F.floor((end - start) / 2)).cast("bigint").alias("mid"))


def bin_points(points: DataFrame, width: int = WIDTH) -> DataFrame:
    """(contig, bin, n): rows, not positions, in each window."""
    return points.groupBy("contig", window_index(F.col("pos"), width).alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def bin_intervals(intervals: DataFrame, lengths: DataFrame, width: int = WIDTH) -> DataFrame:
    """(contig, bin, bp): base pairs in each window of intervals, clipped to the contig."""
    clipped = intervals.join(lengths, "contig").withColumn("e", F.least("e", "length")).filter("e > s")
    bins = F.sequence(F.floor(F.col("s") / width).cast("bigint"), F.floor((F.col("e") - 1) / width).cast("bigint"))
    each = clipped.select("contig", "s", "e", F.explode(bins).alias("bin"))
    inside = F.least(F.col("e"), (F.col("bin") + 1) * width) - F.greatest(F.col("s"), F.col("bin") * width)
    return each.groupBy("contig", "bin").agg(F.sum(inside).cast("bigint").alias("bp"))


def with_empty_windows(binned: DataFrame, lengths: DataFrame, value: str, width: int = WIDTH) -> DataFrame:
    """All windows with their value, 0 where there is none."""
    return window_spine(lengths, width).join(binned, ["contig", "bin"], "left").withColumn(value, F.coalesce(value, F.lit(0).cast("bigint")))
