"""Positions that can be called: invariant or clean."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .intervals import merge


def accessible_positions(clean: DataFrame, invariant: DataFrame, lengths: DataFrame) -> DataFrame:
    """(contig, pos) of distinct positions of clean and invariant records within the contig."""
    both = clean.select("contig", "pos").unionByName(invariant.select("contig", "pos"))
    return both.join(lengths, "contig").filter(F.col("pos").between(1, F.col("length"))).select("contig", "pos").distinct()


def accessible_runs(positions: DataFrame) -> DataFrame:
    """The same as merged intervals."""
    return merge(positions.select("contig", (F.col("pos") - 1).alias("s"), F.col("pos").alias("e")))


def accessible_intervals(clean: DataFrame, invariant: DataFrame, lengths: DataFrame) -> DataFrame:
    """The same from runs of positions (contig, s, e) of clean and invariant records, without a row for each position."""
    both = clean.select("contig", "s", "e").unionByName(invariant.select("contig", "s", "e")).join(lengths, "contig")
    return merge(both.select("contig", F.greatest("s", F.lit(0)).alias("s"), F.least("e", "length").alias("e")))
