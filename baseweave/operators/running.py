"""Running sums and maxima along contigs that are larger than a task.

A contig's rows are cut into bins of positions. Totals of earlier bins are
carried into each bin, and a window runs within a bin only. So neither a
contig nor the whole genome has to pass through one task.

Both the totals and the windows need the rows, so these are stored first: what
they are made of is planned and computed once, however deep such steps are nested.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .stored import dealt, stored

#: Positions in a bin.
BIN = 1 << 20


def running(
    df: DataFrame,
    at: str,
    values: dict[str, tuple[str, Column]],
    inclusive: bool = True,
    ties: tuple[str, ...] = (),
    following: str | None = None,
    keys: tuple[str, ...] = ("contig",),
    bin_name: str | None = None,
    summed: tuple[str, ...] = (),
) -> DataFrame:
    """``df`` with a column for each of ``values``: name -> ("sum" or "max", expression).

    Rows go by ``at`` within ``keys``. A value runs over the rows up to this one,
    or before it if not ``inclusive``. Sums without rows are 0, maxima null.
    ``following`` names a column for the next row's ``at``, null for the last,
    ``bin_name`` one for the row's bin, by which the result is partitioned.
    Rows with the same ``at`` become one if ``summed`` names the other columns, which are added up.
    """
    totals = {"sum": F.sum, "max": F.max}
    combine = {"sum": lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)), "max": lambda a, b: F.greatest(a, b)}
    rows, added = stored(df, "running"), {f"__v_{n}": v for n, (_, v) in values.items()}
    size = rows.count()
    rows = rows.withColumns({"__bin": F.floor(F.greatest(F.col(at), F.lit(0)) / BIN), **added})
    per_bin = rows.groupBy(*keys, "__bin").agg(F.min(at).alias("__first"), *[totals[kind](f"__v_{n}").alias(n) for n, (kind, _) in values.items()])
    bins = Window.partitionBy(*keys).orderBy("__bin")
    earlier, later = bins.rowsBetween(Window.unboundedPreceding, -1), bins.rowsBetween(1, Window.unboundedFollowing)
    carried = per_bin.select(*keys, "__bin", F.min("__first").over(later).alias("__later"), *[totals[kind](n).over(earlier).alias(f"__c_{n}") for n, (kind, _) in values.items()])
    if summed:
        rows = dealt(rows, size, *keys, at).groupBy(*keys, at, "__bin").agg(*[F.sum(c).alias(c) for c in summed]).withColumns(added)
    rows = dealt(rows, size, *keys, "__bin")
    in_order = Window.partitionBy(*keys, "__bin").orderBy(at, *ties)
    within = in_order.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    out = rows.join(carried, [*keys, "__bin"]).withColumns({n: combine[kind](F.col(f"__c_{n}"), totals[kind](f"__v_{n}").over(within)) for n, (kind, _) in values.items()})
    if following:
        out = out.withColumn(following, F.coalesce(F.lead(at).over(in_order), F.col("__later")))
    named = [F.col("__bin").alias(bin_name)] if bin_name else []
    return out.select(*df.columns, *values, *([following] if following else []), *named)


def paired(changes: DataFrame, at: str, begins: str, name: str, bin_name: str, keys: tuple[str, ...] = ("contig",)) -> DataFrame:
    """The rows of ``changes`` that begin a stretch, with the ``at`` of the next change in ``name``.

    Changes within ``keys`` begin and end stretches by turns. Most meet their end
    in their own bin. What is left, the last beginning of a bin and the first end
    of a later one, are two rows a bin at most, and these go along the contig.
    """
    in_bin = Window.partitionBy(*keys, bin_name).orderBy(at)
    seen = changes.withColumns({"__next": F.lead(at).over(in_bin), "__first": F.lag(at).over(in_bin).isNull()})
    border = F.when(F.col(begins), F.col("__next").isNull()).otherwise(F.col("__first"))
    seen = seen.withColumn("__group", F.when(border, -1).otherwise(F.col(bin_name))).filter(F.col(begins) | border)
    along = Window.partitionBy(*keys, "__group").orderBy(at)
    met = seen.withColumn(name, F.coalesce("__next", F.lead(at).over(along)))
    return met.filter(begins).drop("__next", "__first", "__group", bin_name)
