"""Routing of records to invariant, filtered or clean.

Records have the columns of ``sources.vcf``: contig, pos, ref, alt, info,
samples, n_cols and an order within the contig. A record with an END block is
invariant by itself. All others of one position that follow each other without
an END block between them are one group, and the group goes one way: invariant
if any of its records is, else filtered if any is filtered or lacks a genotype,
else clean. Records with fewer than eight columns are filtered by themselves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from baseweave.functions import vcf

from .stored import dealt

INVARIANT, FILTERED, CLEAN = "inv", "filtered", "clean"


def flag_records(records: DataFrame, filter_multiallelic: bool = False) -> DataFrame:
    """``records`` with end, is_inv, is_filtered and has_missing_gt."""
    return records.withColumns(
        {
            "end": vcf.extract_end(F.col("info")),
            "is_inv": vcf.is_invariant(F.col("alt")),
            "is_filtered": vcf.is_filtered(F.col("ref"), F.col("alt"), filter_multiallelic),
            "has_missing_gt": vcf.has_missing_genotype(F.col("samples")),
        }
    )


def classify(records: DataFrame, order: tuple[str, ...] = ("ordinal",), filter_multiallelic: bool = False) -> DataFrame:
    """``flag_records`` with the class of each record in ``class``.

    Windows run within a position, so any number of positions of a contig may be
    worked on at once. A position that is no number needs an END block; without
    one the query fails when it runs, as no interval can hold the record.
    """
    flagged = flag_records(records, filter_multiallelic)
    bad = (F.col("n_cols") >= 8) & F.col("end").isNull() & F.col("pos").isNull()
    message = F.concat(F.lit("position is not a number: "), F.coalesce("contig", F.lit("")))
    flagged = flagged.withColumn("__bad", F.when(bad, F.raise_error(message)).cast("int"))
    short, block = F.col("n_cols") < 8, F.col("end").isNotNull()
    apart = F.when(short, 0).when(block, 1).otherwise(2)
    flagged = dealt(flagged, records.count(), "contig", "pos")
    at = Window.partitionBy("contig", "pos").orderBy(*order)
    flagged = flagged.withColumn("__apart", apart).withColumn("__group", F.sum((F.col("__apart") == 1).cast("int")).over(at))
    group = Window.partitionBy("contig", "pos", "__group", "__apart")
    inv = F.bool_or("is_inv").over(group)
    filtered = F.bool_or(F.col("is_filtered") | F.col("has_missing_gt")).over(group)
    grouped = F.when(inv, INVARIANT).when(filtered, FILTERED).otherwise(CLEAN)
    routed = F.when(F.col("__apart") == 0, FILTERED).when(F.col("__apart") == 1, INVARIANT).otherwise(grouped)
    return flagged.withColumn("class", routed).filter(F.col("__bad").isNull()).drop("__apart", "__group", "__bad")


def expanded_positions(classified: DataFrame) -> DataFrame:
    """Invariant records with a row for each position of their block; only ``pos`` changes."""
    inv = classified.filter(F.col("class") == INVARIANT)
    span = F.when(F.col("end") > F.col("pos"), F.sequence("pos", "end")).otherwise(F.array("pos"))
    return inv.withColumn("pos", F.explode(span))


def class_counts(classified: DataFrame) -> DataFrame:
    """(contig, class, bp): positions of invariant blocks, records of the others; nothing is expanded."""
    size = F.when((F.col("class") == INVARIANT) & (F.col("end") > F.col("pos")), F.col("end") - F.col("pos") + 1).otherwise(1)
    return classified.groupBy("contig", "class").agg(F.sum(size).cast("bigint").alias("bp"))


def reformatted(classified: DataFrame, order: tuple[str, ...] = ("contig", "pos", "ordinal"), by: tuple[str, ...] = ()) -> DataFrame:
    """Clean records, without the symbol for any other allele if the first of them calls for that.

    The first clean record decides for all (``by``: for all of its file).
    """
    clean = classified.filter(F.col("class") == CLEAN)
    need = vcf.needs_reformat(F.col("format"), F.col("samples"))
    keys = [*by] if by else ["__all"]
    clean = clean.withColumn("__all", F.lit(1))
    first = clean.groupBy(*keys).agg(F.min_by(need, F.struct(*order)).alias("__strip"))
    out = clean.join(F.broadcast(first) if not by else first, keys)
    return out.withColumn("alt", F.when(F.col("__strip"), vcf.strip_non_ref(F.col("alt"))).otherwise(F.col("alt"))).drop("__all", "__strip")
