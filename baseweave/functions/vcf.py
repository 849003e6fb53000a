"""Column expressions over the fields of variant records.

Coordinates of records are 1-based; intervals are 0-based and half-open.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NON_REF = "<NON_REF>"
BASES = ("A", "C", "G", "T")


def as_bigint(text: Column) -> Column:
    """The number that a text spells, or null."""
    return F.nullif(F.trim(text), F.lit("")).try_cast("bigint")


def info_value(info: Column, key: str) -> Column:
    """The text after the first ``key=`` of an INFO field, or null."""
    return F.nullif(F.regexp_extract(info, f"(?:^|;){key}=([^;]*)", 1), F.lit(""))


def extract_end(info: Column) -> Column:
    """END of a block; null where the first END is absent or no number, even if a later one is."""
    return as_bigint(info_value(info, "END"))


def extract_dp(info: Column) -> Column:
    return as_bigint(info_value(info, "DP"))


def with_dp(info: Column, dp: Column) -> Column:
    """INFO with its depth replaced, or appended where it has none."""
    entry = F.concat(F.lit("DP="), dp.cast("string"))
    return (
        F.when(info.isin(".", ""), entry)
        .when(info.rlike("(^|;)DP="), F.regexp_replace(info, "(^|;)DP=[^;]*", F.concat(F.lit("$1"), entry)))
        .otherwise(F.concat(info, F.lit(";"), entry))
    )


def alleles(alt: Column) -> Column:
    """Alternative alleles, trimmed of all white space; none where ALT is ``.``."""
    split = F.transform(F.split(alt, ","), lambda a: F.regexp_replace(a, r"^\s+|\s+$", ""))
    return F.when(alt == ".", F.array().cast("array<string>")).otherwise(split)


def called_alleles(alt: Column) -> Column:
    """Alternative alleles without the symbol for any other allele."""
    return F.filter(alleles(alt), lambda a: a != NON_REF)


def has_star(alt: Column) -> Column:
    return F.array_contains(called_alleles(alt), "*")


def is_long_ref(ref: Column) -> Column:
    return F.length(ref) > 1


def is_multiallelic(alt: Column) -> Column:
    """More than one distinct single base."""
    return F.size(F.array_distinct(F.filter(called_alleles(alt), lambda a: a.isin(*BASES)))) > 1


def has_other_allele(alt: Column) -> Column:
    """Some allele that is neither a single upper-case base nor a star."""
    return F.exists(called_alleles(alt), lambda a: ~a.isin(*BASES, "*"))


def is_filtered(ref: Column, alt: Column, filter_multiallelic: bool = False) -> Column:
    found = has_star(alt) | is_long_ref(ref) | has_other_allele(alt)
    return found | is_multiallelic(alt) if filter_multiallelic else found


def is_invariant(alt: Column) -> Column:
    return F.size(called_alleles(alt)) == 0


def is_variant_alt(alt: Column) -> Column:
    """Whether ALT names an allele at all: for densities of variants."""
    named = F.filter(alleles(alt), lambda a: ~a.isin(NON_REF, ".", ""))
    return F.size(named) > 0


def genotype(sample: Column) -> Column:
    return F.substring_index(sample, ":", 1)


def has_missing_genotype(samples: Column) -> Column:
    """A sample whose genotype is exactly ``.``, or no samples at all; ``./.`` counts as called."""
    return (F.size(samples) == 0) | F.exists(samples, lambda s: genotype(s) == ".")


def needs_reformat(fmt: Column, samples: Column) -> Column:
    """Allele depths are declared and some sample carries more than a plain haploid call."""

    def rich(s: Column) -> Column:
        ploid = s.rlike("^[0-9]+$") & (F.coalesce(s.try_cast("bigint"), F.lit(9)) > 1)
        return ~s.isin(".", "./.", ".|.") & (s.rlike("[:/|]") | ploid)

    return F.coalesce(F.array_contains(F.split(fmt, ":"), "AD") & F.exists(samples, rich), F.lit(False))


def strip_non_ref(alt: Column) -> Column:
    """ALT without the symbol for any other allele; unchanged where nothing would be left."""
    kept = F.array_join(F.filter(F.split(alt, ","), lambda a: (a != "") & (a != NON_REF)), ",")
    return F.coalesce(F.nullif(kept, F.lit("")), alt)


def indel_size(ref: Column, alt: Column) -> Column:
    """Difference in length of REF and the whole ALT text."""
    return F.abs(F.length(ref) - F.length(alt))


def covered_end(pos: Column, ref: Column, info: Column) -> Column:
    """End of what a record covers when gaps are looked for: END from POS on, else the length of REF."""
    end = extract_end(info)
    return F.when(end >= pos, end).otherwise(pos - 1 + F.greatest(F.length(ref), F.lit(1)))


def masked_end(pos: Column, ref: Column, info: Column) -> Column:
    """End of what a record covers when masks are made: END wherever there is one."""
    return F.coalesce(extract_end(info), pos - 1 + F.greatest(F.length(ref), F.lit(1)))
