"""Contig and file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalized_contig(name: Column) -> Column:
    """A name without case, white space around it, leading ``chr`` and leading zeros of its number."""
    bare = F.regexp_replace(F.lower(F.regexp_replace(name, r"^\s+|\s+$", "")), "^chr", "")
    numbered = F.regexp_replace(bare, "^(.*?)0*([0-9]+)$", "$1$2")
    short = F.when(bare.rlike("[0-9]$"), numbered).otherwise(F.regexp_replace(bare, "^0+", ""))
    return F.when(short == "", F.lit("0")).otherwise(short)


def window_index(pos: Column, width: int) -> Column:
    """Window of a 1-based position."""
    return F.greatest(F.floor((pos - 1) / width).cast("bigint"), F.lit(0).cast("bigint"))


def contig_from_prefix(prefix: Column) -> Column:
    """What follows the first ``combined.`` of a file prefix."""
    return F.nullif(F.regexp_extract(prefix, r"combined\.(.+)$", 1), F.lit(""))


def reference_base(path: str) -> str:
    """A reference's name without folders and the endings of FASTA files."""
    name = path.rstrip("/").rsplit("/", 1)[-1]
    for ending in (".gz", ".fa", ".fasta"):
        name = name.removesuffix(ending)
    return name


def gvcf_name(sample: str, reference: str) -> str:
    return f"{sample}To{reference_base(reference)}.gvcf.gz"


def combined_prefix(contig: str) -> str:
    return f"combined.{contig}"
