"""Removal of very large insertions and deletions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from baseweave.functions import vcf

from .intervals import merge

DEFAULT_CUTOFF = 9_101_264


def large_indels(records: DataFrame, cutoff: int = DEFAULT_CUTOFF) -> DataFrame:
    return records.filter(vcf.indel_size(F.col("ref"), F.col("alt")) > cutoff)


def dropped_spans(large: DataFrame) -> DataFrame:
    """(contig, s, e) of what each large indel takes: the reference where it is the longer, else one position."""
    start = F.col("pos") - 1
    end = F.when(F.length("ref") > F.length("alt"), start + F.length("ref")).otherwise(F.col("pos"))
    return large.filter("pos is not null").select("contig", start.alias("s"), end.alias("e"))


def dropped_intervals(large: DataFrame) -> DataFrame:
    """The same, merged."""
    return merge(dropped_spans(large))


def drop_sites(records: DataFrame, large: DataFrame) -> DataFrame:
    """``records`` without any at a position where the same file has a large indel."""
    return records.join(large.select("file", "contig", "pos").distinct(), ["file", "contig", "pos"], "left_anti")


def drop_counts(records: DataFrame, cutoff: int = DEFAULT_CUTOFF) -> DataFrame:
    """(file, before, after, removed): records of each file before and after the removal."""
    left = drop_sites(records, large_indels(records, cutoff)).groupBy("file").agg(F.count(F.lit(1)).alias("after"))
    both = records.groupBy("file").agg(F.count(F.lit(1)).alias("before")).join(left, "file", "left")
    after = F.coalesce("after", F.lit(0))
    return both.select("file", "before", after.alias("after"), (F.col("before") - after).alias("removed"))
