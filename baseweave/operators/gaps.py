"""Positions that no record covers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from baseweave.functions import vcf

from .running import running


def record_spans(records: DataFrame) -> DataFrame:
    """(contig, s, e) of what each record covers; records without a position cover nothing."""
    end = vcf.covered_end(F.col("pos"), F.col("ref"), F.col("info"))
    return records.filter("pos is not null").select("contig", (F.col("pos") - 1).alias("s"), end.alias("e"))


def missing(spans: DataFrame, lengths: DataFrame | None = None) -> DataFrame:
    """Gaps before and between the spans of each contig, and after them where (contig, length) is given.

    A contig without spans has no gaps.
    """
    reach = running(spans.select("contig", "s", "e"), "s", {"reach": ("max", F.col("e"))}, inclusive=False, ties=("e",))
    before = F.coalesce("reach", F.lit(0).cast("bigint"))
    found = reach.filter(F.col("s") > before).select("contig", before.alias("s"), F.col("s").alias("e"))
    if lengths is None:
        return found
    tail = spans.groupBy("contig").agg(F.max("e").alias("s")).join(lengths, "contig")
    return found.unionByName(tail.filter("s < length").select("contig", "s", F.col("length").alias("e")))
