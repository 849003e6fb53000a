"""Interval algebra on DataFrames (contig, s, e), 0-based and half-open.

Everything is one sweep: each set's ends become +1 and -1 at positions, running
sums tell how many intervals of each set cover a stretch, and the result is
where a predicate of these numbers holds. No interval is compared with another.
Intervals with a null or with ``e <= s`` hold nothing and are left out.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .running import paired, running


CONTIG = ("contig",)


def proper(df: DataFrame, keys: tuple[str, ...] = CONTIG) -> DataFrame:
    return df.select(*keys, "s", "e").filter("e > s")


def tagged(*sets: DataFrame, keys: tuple[str, ...] = CONTIG) -> DataFrame:
    """(keys, s, e, tag): the intervals of all sets, tagged by the set's number."""
    return reduce(DataFrame.unionByName, [proper(df, keys).withColumn("tag", F.lit(k)) for k, df in enumerate(sets)])


def _events(spans: DataFrame, n: int, keys: tuple[str, ...] = CONTIG) -> DataFrame:
    """(keys, x, d0, d1, ...): by how much an end changes the number of intervals of each tag at a position."""
    sides = F.array(F.struct(F.col("s").alias("x"), F.lit(1).alias("d")), F.struct(F.col("e").alias("x"), F.lit(-1).alias("d")))
    side = spans.filter("e > s").select(*keys, "tag", F.explode(sides).alias("side"))
    changes = [F.when(F.col("tag") == k, F.col("side.d")).otherwise(0).cast("bigint").alias(f"d{k}") for k in range(n)]
    return side.select(*keys, F.col("side.x").alias("x"), *changes)


def swept(spans: DataFrame, n: int) -> DataFrame:
    """(contig, s, e, n0, n1, ...): stretches between neighbouring ends, and how many intervals of each tag cover them."""
    names = [f"n{k}" for k in range(n)]
    found = running(_events(spans, n), "x", {c: ("sum", F.col(f"d{k}")) for k, c in enumerate(names)}, following="e", summed=tuple(f"d{k}" for k in range(n)))
    return found.filter("e is not null").select("contig", F.col("x").alias("s"), "e", *names)


def segments(*sets: DataFrame) -> DataFrame:
    """The same of sets, each with its own tag."""
    return swept(tagged(*sets), len(sets))


def sweep(predicate: Callable[..., Column], spans: DataFrame, n: int, keys: tuple[str, ...] = CONTIG) -> DataFrame:
    """Merged stretches where ``predicate`` of the numbers of covering intervals holds, one number for each of ``n`` tags.

    At each position the numbers before and after are known, so stretches begin
    and end where the predicate changes; each beginning is paired with the next
    end. The predicate is false where nothing covers.
    """
    found = running(_events(spans, n, keys), "x", {f"n{k}": ("sum", F.col(f"d{k}")) for k in range(n)}, keys=keys, bin_name="bin", summed=tuple(f"d{k}" for k in range(n)))
    after = predicate(*[F.col(f"n{k}") for k in range(n)])
    before = predicate(*[F.col(f"n{k}") - F.col(f"d{k}") for k in range(n)])
    changes = found.select(*keys, "x", "bin", after.alias("begins"), before.alias("holds")).filter("begins <> holds")
    return paired(changes, "x", "begins", "e", "bin", keys).select(*keys, F.col("x").alias("s"), "e")


def merge(intervals: DataFrame, keys: tuple[str, ...] = CONTIG) -> DataFrame:
    """Overlapping and adjacent intervals of the same ``keys`` as one."""
    return sweep(lambda n: n > 0, tagged(intervals, keys=keys), 1, keys)


def without(spans: DataFrame) -> DataFrame:
    """What intervals of tag 0 cover and those of tag 1 do not."""
    return sweep(lambda n, m: (n > 0) & (m == 0), spans, 2)


def subtract(a: DataFrame, b: DataFrame) -> DataFrame:
    return without(tagged(a, b))


def intersect(a: DataFrame, b: DataFrame) -> DataFrame:
    return sweep(lambda n, m: (n > 0) & (m > 0), tagged(a, b), 2)


def together(*sets: DataFrame) -> DataFrame:
    """All intervals, not merged."""
    return reduce(DataFrame.unionByName, [s.select("contig", "s", "e") for s in sets])


def union(*sets: DataFrame) -> DataFrame:
    return merge(together(*sets))


def complement(intervals: DataFrame, lengths: DataFrame) -> DataFrame:
    """What (contig, length) has beyond the intervals; contigs without any are whole."""
    whole = lengths.select("contig", F.lit(0).cast("bigint").alias("s"), F.col("length").alias("e"))
    return subtract(whole, intervals)


def length(intervals: DataFrame, name: str = "bp") -> DataFrame:
    """(contig, bp) of intervals that do not overlap."""
    return intervals.groupBy("contig").agg(F.sum(F.col("e") - F.col("s")).cast("bigint").alias(name))


def overlap_bp(**sets: DataFrame) -> DataFrame:
    """(contig, left, right, bp) for each two of the named sets that overlap."""
    return tagged_overlap_bp(tagged(*sets.values()), list(sets))


def tagged_overlap_bp(spans: DataFrame, names: list[str]) -> DataFrame:
    """The same of intervals (contig, s, e, tag), whose tag is the number of their set in ``names``."""
    pairs = [(i, k) for i in range(len(names)) for k in range(i + 1, len(names))]
    both = F.array(*[F.struct(F.lit(names[i]).alias("left"), F.lit(names[k]).alias("right"), ((F.col(f"n{i}") > 0) & (F.col(f"n{k}") > 0)).alias("met")) for i, k in pairs])
    found = swept(spans, len(names)).select("contig", "s", "e", F.explode(both).alias("p")).filter("p.met")
    return found.groupBy("contig", "p.left", "p.right").agg(F.sum(F.col("e") - F.col("s")).cast("bigint").alias("bp"))


def partition_check(lengths: DataFrame, **sets: DataFrame) -> DataFrame:
    """For each contig whether the sets are disjoint and cover it exactly.

    (contig, covered_bp, overlap_bp, length, exact): intervals of one set may
    overlap each other; those of different sets may not.
    """
    cover = sum(((F.col(f"n{k}") > 0).cast("int") for k in range(len(sets))), F.lit(0))
    parts = segments(*sets.values()).withColumn("cover", cover).filter("cover > 0")
    size = F.col("e") - F.col("s")
    sums = parts.groupBy("contig").agg(
        F.sum(size).cast("bigint").alias("covered_bp"),
        F.sum(F.when(F.col("cover") > 1, size).otherwise(0)).cast("bigint").alias("overlap_bp"),
        F.min("s").alias("first"),
        F.max("e").alias("last"),
    )
    out = lengths.join(sums, "contig", "left")
    covered, overlap = F.coalesce("covered_bp", F.lit(0)), F.coalesce("overlap_bp", F.lit(0))
    inside = F.coalesce((F.col("first") >= 0) & (F.col("last") <= F.col("length")), F.lit(True))
    exact = (covered == F.col("length")) & (overlap == 0) & inside
    return out.select("contig", covered.alias("covered_bp"), overlap.alias("overlap_bp"), "length", exact.alias("exact"))


def points_within(points: DataFrame, intervals: DataFrame, pos: str = "pos", keys: tuple[str, ...] = CONTIG) -> DataFrame:
    """The rows of ``points`` (keys, 1-based ``pos``) that lie in an interval of the same ``keys``.

    Intervals and points go along the contig together: a point is inside if some
    interval that starts at or before it ends after it.
    """
    cols = points.columns
    x = F.col(pos) - 1
    marked = points.select(*keys, F.struct(*cols).alias("row"), x.alias("x"), F.lit(None).cast("bigint").alias("end"), F.lit(1).alias("kind"))
    spans = proper(intervals, keys).select(*keys, F.lit(None).cast(marked.schema["row"].dataType).alias("row"), F.col("s").alias("x"), F.col("e").alias("end"), F.lit(0).alias("kind"))
    both = running(marked.unionByName(spans), "x", {"reach": ("max", F.col("end"))}, ties=("kind",), keys=keys)
    return both.filter("kind = 1 and reach > x").select("row.*")
