"""The filtered mask: everything that is neither invariant nor clean."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from baseweave.functions import vcf

from .classify import FILTERED
from .intervals import subtract, together, without


def mask_spans(records: DataFrame) -> DataFrame:
    """(contig, s, e) of records as masks see them: END wherever there is one."""
    end = vcf.masked_end(F.col("pos"), F.col("ref"), F.col("info"))
    return records.filter("pos is not null").select("contig", (F.col("pos") - 1).alias("s"), end.alias("e")).filter("e > s")


def class_spans(classified: DataFrame, classes: list[str]) -> DataFrame:
    """(contig, s, e, tag) of records of the named classes, read once; the tag is the class's number."""
    end = vcf.masked_end(F.col("pos"), F.col("ref"), F.col("info"))
    tag = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col("class")) - 1
    rows = classified.filter(F.col("pos").isNotNull() & F.col("class").isin(classes))
    return rows.select("contig", (F.col("pos") - 1).alias("s"), end.alias("e"), tag.cast("int").alias("tag")).filter("e > s")


def filtered_mask(filtered: DataFrame, missing: DataFrame, dropped: DataFrame, invariant: DataFrame, clean: DataFrame) -> DataFrame:
    """(filtered, missing and dropped) without (invariant and clean); records are given as such, the others as intervals."""
    return subtract(together(mask_spans(filtered), missing, dropped), together(mask_spans(invariant), mask_spans(clean)))


def class_mask(classified: DataFrame, *lost: DataFrame) -> DataFrame:
    """The same mask from records with their ``class``, read once, and the lost intervals (missing, dropped)."""
    end = vcf.masked_end(F.col("pos"), F.col("ref"), F.col("info"))
    tag = F.when(F.col("class") == FILTERED, 0).otherwise(1)
    # A filtered record is masked if it has the four columns that tell its reference.
    whole = (F.col("class") != FILTERED) | (F.col("n_cols") >= 4) if "n_cols" in classified.columns else F.lit(True)
    spans = classified.filter(F.col("pos").isNotNull() & whole).select("contig", (F.col("pos") - 1).alias("s"), end.alias("e"), tag.alias("tag"))
    return without(reduce(DataFrame.unionByName, [spans, *[df.select("contig", "s", "e").withColumn("tag", F.lit(0)) for df in lost]]))


def target_contig(filtered: DataFrame, invariant: DataFrame, clean: DataFrame, missing: DataFrame) -> str | None:
    """The contig that a set of files is about: of the filtered records, else the first of the others that has any.

    More than one contig among the filtered records is an error.
    """
    found = [r["contig"] for r in filtered.select("contig").distinct().limit(2).collect()]
    if len(found) > 1:
        raise ValueError("filtered records are of more than one contig")
    for other in (invariant, clean, missing):
        if found:
            break
        first = F.min_by("contig", "ordinal") if "ordinal" in other.columns else F.min("contig")
        found = [r["contig"] for r in other.agg(first.alias("contig")).collect() if r["contig"] is not None]
    return found[0] if found else None
