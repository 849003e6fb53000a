"""Proof that invariant, clean and masked positions partition a contig."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .intervals import intersect, length, merge, overlap_bp, segments, union
from .runs import position_runs
from .stored import stored

#: Intervals shown for each pair of sets that overlap.
SHOWN = 20
EMPTY = "no clean, invariant or masked positions"


class CoverageError(ValueError):
    """The sets overlap or do not add up to the contig."""


@dataclass
class Coverage:
    """Figures of one contig. ``lines`` is the text of the report."""

    chrom: str
    clean_bp: int
    inv_bp: int
    filtered_bed_bp: int
    total_bp: int
    chrom_len: int
    warning: str | None = None
    overlaps: list[str] = field(default_factory=list)

    def lines(self) -> list[str]:
        names = ("chrom", "clean_bp", "inv_bp", "filtered_bed_bp", "total_bp", "chrom_len")
        return [f"{n}={getattr(self, n)}" for n in names] + ([f"warning={self.warning}"] if self.warning else [])


def positions(records: DataFrame) -> DataFrame:
    """One base pair for each record, whatever its block or reference."""
    return records.filter("pos is not null").select("contig", (F.col("pos") - 1).alias("s"), F.col("pos").alias("e"))


def _shown(**sets: DataFrame) -> list[str]:
    names, out = list(sets), []
    for i in range(len(names)):
        for k in range(i + 1, len(names)):
            met = intersect(sets[names[i]], sets[names[k]]).orderBy("contig", "s")
            n = met.count()
            if n:
                out += [f"{names[i]} and {names[k]}: {r.contig} {r.s} {r.e}" for r in met.limit(SHOWN).collect()]
                out += [f"... {n - SHOWN} more"] if n > SHOWN else []
    return out


def coverage_by_contig(lengths: DataFrame, clean: DataFrame, invariant: DataFrame, mask: DataFrame) -> DataFrame:
    """(contig, clean_bp, inv_bp, filtered_bed_bp, total_bp, overlap_bp, chrom_len) of all contigs, by one sweep.

    ``clean`` and ``invariant`` are records, or runs of their positions as intervals;
    ``mask`` is intervals. Contigs without any of these have zeros.
    """
    runs = [position_runs(df) if "pos" in df.columns else df.select("contig", "s", "e") for df in (clean, invariant)]
    parts = segments(*runs, mask.select("contig", "s", "e"))
    size = F.col("e") - F.col("s")
    over = sum(((F.col(f"n{k}") > 0).cast("int") for k in range(3)), F.lit(0))
    held = {"clean_bp": F.col("n0") > 0, "inv_bp": F.col("n1") > 0, "filtered_bed_bp": F.col("n2") > 0, "total_bp": over > 0, "overlap_bp": over > 1}
    sums = parts.groupBy("contig").agg(*[F.sum(F.when(c, size).otherwise(0)).cast("bigint").alias(n) for n, c in held.items()])
    counted = lengths.join(sums, "contig", "left")
    return counted.select("contig", *[F.coalesce(n, F.lit(0).cast("bigint")).alias(n) for n in held], F.col("length").alias("chrom_len"))


def report_lines(figures: DataFrame) -> DataFrame:
    """(contig, nth, line): the report's ``key=value`` lines of each contig."""
    names = {"chrom": "contig", "clean_bp": "clean_bp", "inv_bp": "inv_bp", "filtered_bed_bp": "filtered_bed_bp", "total_bp": "total_bp", "chrom_len": "chrom_len"}
    lines = [F.concat(F.lit(f"{k}="), F.col(c).cast("string")) for k, c in names.items()]
    warning = F.when(F.col("total_bp") == 0, F.array(F.lit(f"warning={EMPTY}"))).otherwise(F.array().cast("array<string>"))
    return figures.select("contig", F.posexplode(F.concat(F.array(*lines), warning)).alias("nth", "line"))


def check_all(lengths: DataFrame, clean: DataFrame, invariant: DataFrame, mask: DataFrame) -> DataFrame:
    """``coverage_by_contig``; raises CoverageError if some contig with any positions is no exact partition."""
    figures = stored(coverage_by_contig(lengths, clean, invariant, mask), "coverage")
    wrong = figures.filter("overlap_bp > 0 or (total_bp > 0 and total_bp <> chrom_len)")
    if found := wrong.orderBy("contig").limit(SHOWN).collect():
        raise CoverageError("\n".join(f"{r['contig']}: {r['total_bp']} of {r['chrom_len']} positions, sets overlap at {r['overlap_bp']}" for r in found))
    return figures


def check_coverage(contig: str, lengths: DataFrame, clean: DataFrame, invariant: DataFrame, mask: DataFrame) -> Coverage:
    """Figures of ``contig``; raises CoverageError if the three sets are no exact partition.

    ``clean`` and ``invariant`` are records, ``mask`` intervals. Where all three
    are empty the figures carry a warning instead.
    """
    row = lengths.filter(F.col("contig") == contig).agg(F.min("length").alias("n")).first()
    if row["n"] is None:
        raise ValueError(f"no length is known for contig {contig}")
    sets = {"clean": positions(clean), "inv": positions(invariant), "mask": mask.select("contig", "s", "e")}
    sets = {name: merge(df.filter(F.col("contig") == contig)) for name, df in sets.items()}
    bp = {name: length(df).agg(F.sum("bp")).first()[0] or 0 for name, df in sets.items()}
    total = length(union(*sets.values())).agg(F.sum("bp")).first()[0] or 0
    found = Coverage(contig, bp["clean"], bp["inv"], bp["mask"], total, row["n"])
    if not any(bp.values()):
        found.warning = EMPTY
        return found
    if not overlap_bp(**sets).isEmpty():
        found.overlaps = _shown(**sets)
        raise CoverageError("sets overlap:\n" + "\n".join(found.overlaps))
    if total != found.chrom_len:
        raise CoverageError(f"{contig}: sets cover {total} of {found.chrom_len} positions")
    return found
