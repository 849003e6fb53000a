"""Contig names of different sources, resolved against each other."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from baseweave.functions.names import normalized_contig


def contig_map(fasta: DataFrame, gvcf: DataFrame) -> DataFrame:
    """(key, fasta_name, gvcf_name, ambiguous) of names that are alike once normalised.

    ``ambiguous`` tells keys with several names on a side; they cannot be used.
    """
    sides = []
    for names, out in ((fasta, "fasta"), (gvcf, "gvcf")):
        keyed = names.select("contig", normalized_contig(F.col("contig")).alias("key")).distinct()
        sides.append(keyed.groupBy("key").agg(F.min("contig").alias(f"{out}_name"), F.count(F.lit(1)).alias(f"n_{out}")))
    both = sides[0].join(sides[1], "key")
    return both.select("key", "fasta_name", "gvcf_name", ((F.col("n_fasta") > 1) | (F.col("n_gvcf") > 1)).alias("ambiguous"))


def checked_contig_map(fasta: DataFrame, gvcf: DataFrame) -> dict[str, str]:
    """FASTA name to gVCF name; an error if no name is shared or a shared one is ambiguous."""
    rows = contig_map(fasta, gvcf).orderBy("key").collect()
    if not rows:
        raise ValueError("reference and gVCF share no contig")
    if bad := [r["key"] for r in rows if r["ambiguous"]]:
        raise ValueError(f"several contigs are alike once normalised: {', '.join(bad)}")
    return {r["fasta_name"]: r["gvcf_name"] for r in rows}


def renamed(names: DataFrame, mapping: DataFrame) -> DataFrame:
    """(contig, renamed): names by the map where they are in it, else their own."""
    to = mapping.select(F.col("fasta_name").alias("contig"), "gvcf_name")
    return names.join(to, "contig", "left").select("contig", F.coalesce("gvcf_name", "contig").alias("renamed"))


def resolve_contigs(requested: DataFrame, available: DataFrame) -> DataFrame:
    """(contig, resolved, how, ordinal) for the requested (contig, ordinal): ``exact``, ``remapped`` or ``skipped``.

    A name that is not available itself is remapped if exactly one available
    name is alike once normalised. Of requests resolved alike the first stays.
    """
    names = available.select(F.col("contig").alias("name")).distinct().withColumn("key", normalized_contig(F.col("name")))
    only = names.groupBy("key").agg(F.min("name").alias("alike"), F.count(F.lit(1)).alias("n")).filter("n = 1").drop("n")
    asked = requested.select("contig", "ordinal").withColumn("key", normalized_contig(F.col("contig")))
    found = asked.join(names.select(F.col("name").alias("exact"), F.col("name").alias("contig")), "contig", "left").join(only, "key", "left")
    resolved = F.coalesce("exact", "alike")
    how = F.when(F.col("exact").isNotNull(), "exact").when(F.col("alike").isNotNull(), "remapped").otherwise("skipped")
    found = found.select("contig", resolved.alias("resolved"), how.alias("how"), "ordinal")
    first = F.row_number().over(Window.partitionBy(F.coalesce("resolved", F.concat(F.lit("\0"), "contig"))).orderBy("ordinal"))
    return found.withColumn("__first", first).filter("__first = 1 or how = 'skipped'").drop("__first")


def contig_differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """(side, contig) of names that only one side has."""
    a, b = left.select("contig").distinct(), right.select("contig").distinct()
    only = [x.join(y, "contig", "left_anti").select(F.lit(side).alias("side"), "contig") for x, y, side in ((a, b, "left"), (b, a, "right"))]
    return only[0].unionByName(only[1])


def presence(samples: DataFrame, contigs: DataFrame, records: DataFrame) -> DataFrame:
    """(base, contig, status): present or missing for each sample and contig."""
    have = records.select(F.col("file").alias("base"), "contig").distinct().withColumn("__has", F.lit(True))
    spine = samples.select("base").distinct().crossJoin(contigs.select("contig").distinct())
    return spine.join(have, ["base", "contig"], "left").select("base", "contig", F.when(F.col("__has"), "present").otherwise("missing").alias("status"))


def missing_contigs(status: DataFrame, preview: int = 10) -> DataFrame:
    """(base, n_missing, preview): contigs that a sample lacks, in order, the first of them as text."""
    lacking = status.filter(F.lower("status") == "missing").groupBy("base").agg(F.sort_array(F.collect_set("contig")).alias("c"))
    shown = F.array_join(F.slice("c", 1, preview), ", ")
    more = F.when(F.size("c") > preview, F.concat(F.lit(" (+"), F.size("c") - preview, F.lit(" more)"))).otherwise("")
    return lacking.select("base", F.size("c").cast("bigint").alias("n_missing"), F.concat(shown, more).alias("preview"))


def present_only(records: DataFrame, status: DataFrame) -> DataFrame:
    """Records of samples that have the contig."""
    have = status.filter(F.lower("status") == "present").select(F.col("base").alias("file"), "contig")
    return records.join(have, ["file", "contig"], "left_semi")
