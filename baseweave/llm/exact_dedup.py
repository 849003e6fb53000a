"""Exact deduplication by skew-safe combining, in DataFrame operations only.

Texts are equal when they are identical after white space is deleted. Groups
are combined three times, each time by digest and full content: within the
partition that read the rows (Spark's partial aggregate), within a salt of the
digest, and over the salts. A group that holds a third of all rows so arrives
as one row per map task and salt, and finally as one row per salt. Rows then
meet the group's winner by digest and, where a group is hot, by a salt too.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import without_space, written

#: A group of one in so many rows, or larger, is dealt over salts where its rows meet their winner.
SHARES = 1000
#: Copies of one row that are made from one array.
BLOCK = 1 << 16


def _sha256(content: Column) -> Column:
    return F.sha2(content, 256)


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    salts: int = 16,
    digest: Callable[[Column], Column] = _sha256,
) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the most code points stays, then the one with
    the smallest id (a null id counts as the largest). Null text equals empty
    text, and texts of white space only equal both. Rows repeated with the same
    id and text form one group of which exactly one is kept. Columns other than
    id and text are not read. An empty table gives no rows.

    ``digest`` exists for tests: with a digest that collides, rows are matched
    by content, so results do not depend on it.
    """
    return _marked(docs, id_col, text_col, salts, digest).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def _marked(docs: DataFrame, id_col: str, text_col: str, salts: int = 16, digest: Callable[[Column], Column] = _sha256) -> DataFrame:
    """The columns of ``exact_dedup``, the text's code points, and whether the row repeats one that is kept."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    content = without_space(text)
    base = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.length(text).alias("points"), content.alias("content")
    ).withColumn("digest", digest(F.col("content")))
    best = F.struct((-F.col("points")).alias("less"), F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"))
    salted = (
        base.withColumn("salt", F.pmod(F.xxhash64("doc_id", "points"), F.lit(salts)).cast("int"))
        .groupBy("salt", "digest", "content")
        .agg(F.min(best).alias("best"), F.count(F.lit(1)).alias("n"))
    )
    groups = salted.groupBy("digest", "content").agg(F.min("best").alias("best"), F.sum("n").alias("n"))
    of_group = [F.col("best.id").alias("keep_id"), (-F.col("best.less")).alias("keep_points"), F.col("n").alias("group_size")]
    # The content itself is compared above; it is not needed again unless two contents share a digest.
    winners = written(groups.select("digest", *of_group), "exact-winners", compact=True)
    clash = winners.groupBy("digest").agg(F.count(F.lit(1)).alias("contents")).filter("contents > 1")
    hot = _hot(winners)
    keys = ["digest"]
    if not clash.isEmpty():
        keys, winners = ["digest", "content"], groups.select("digest", "content", *of_group)
    # Equal rows meet their winner as one row with a count.
    rows = base.groupBy("doc_id", "points", *keys).agg(F.count(F.lit(1)).alias("copies"))
    # Rows of a hot digest are dealt over its salts, and its winner goes to each of them.
    rows = rows.join(F.broadcast(hot), "digest", "left")
    rows = rows.withColumn("part", F.coalesce(F.pmod(F.xxhash64("doc_id", "points"), F.col("parts")), F.lit(0)).cast("int"))
    winners = winners.join(F.broadcast(hot), "digest", "left")
    winners = winners.withColumn("part", F.explode(F.sequence(F.lit(0), (F.coalesce("parts", F.lit(1)) - 1).cast("int"))))
    met = rows.drop("parts").join(winners.drop("parts"), [*keys, "part"])
    best = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("points") == F.col("keep_points"))
    # Copies come back in blocks, so that no row holds an array as long as the number of them.
    met = met.withColumn("best", best).withColumn("before", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(BLOCK).cast("long"))))
    upto = F.least(F.col("copies"), F.col("before") + BLOCK)
    met = met.withColumn("nth", F.explode(F.sequence(F.col("before") + 1, upto)))
    kept, again = (F.col("best") & (F.col("nth") == 1)).alias("kept"), (F.col("best") & (F.col("nth") > 1)).alias("again")
    return met.select("doc_id", "keep_id", "group_size", kept, F.col("digest").alias("text_sha256"), "points", again)


def _hot(winners: DataFrame) -> DataFrame:
    """(digest, parts): digests with a share of 1 / ``SHARES`` of all rows or more, and over how many salts their rows go.

    There are ``SHARES`` of them at most, with twice as many salts in all, whatever the input's size.
    """
    total = winners.agg(F.sum("group_size")).first()[0] or 0
    share = F.ceil(F.col("group_size") * SHARES / F.lit(max(total, 1)))
    return winners.filter(F.col("group_size") * SHARES >= total).groupBy("digest").agg(F.max(share).cast("long").alias("parts"))


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Rows repeated with one id and text are one document: one of them stays.
    Rows are told apart by id, text without white space and code points, so a
    null or repeated id keeps no copies of other documents.
    """
    marks = _marked(docs, id_col, text_col).filter("kept or again")
    marks = written(marks.select("doc_id", "points", F.unhex("text_sha256").alias("sha256"), "again"), "exact-marks", compact=True)
    stay = marks.filter("not again").select(*[F.col(c).alias(f"__kept_{c}") for c in ("doc_id", "points", "sha256")])
    text = F.coalesce(F.col(text_col), F.lit(""))
    own = {"__id": F.col(id_col).cast("long"), "__points": F.length(text), "__sha256": F.unhex(_sha256(without_space(text)))}
    same = F.col("__id").eqNullSafe(F.col("__kept_doc_id")) & (F.col("__points") == F.col("__kept_points")) & (F.col("__sha256") == F.col("__kept_sha256"))
    left = docs.withColumns(own).join(stay, same, "left_semi")
    if not marks.filter("again").isEmpty():
        left = left.dropDuplicates(list(own))
    return left.drop(*own)
