"""Minimax contiguous sharding, in DataFrame operations only.

Documents of equal text are one atomic group. Groups stand in a fixed order;
the smallest capacity at which a greedy scan needs no more than the wanted
number of shards is found by search, and the order is cut there.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: Capacities tried in one round of the search; each round divides the range by one more.
PROBES = 31
#: Bits of a digest that may part a size class into blocks.
BITS = 32
#: Blocks up to which their prefix sums are broadcast.
BROADCAST_BLOCKS = 200_000


def _furthest(groups: DataFrame, limits: list[tuple[int, int]]) -> list[int]:
    """For each (from, to), the largest group end in (from, to], or ``from`` when there is none."""
    near = groups.filter(f"end_bytes > {min(a for a, _ in limits)} and end_bytes <= {max(b for _, b in limits)}")
    ends = near.agg(*[F.max(F.when(F.col("end_bytes") <= b, F.col("end_bytes"))).alias(f"c{i}") for i, (_, b) in enumerate(limits)]).first()
    return [max(a, end if end is not None else a) for (a, _), end in zip(limits, ends, strict=True)]


def _greedy(groups: DataFrame, capacities: list[int], shards: int) -> list[list[int]]:
    """For each capacity the ends of its shards, each shard filled as far as it goes."""
    at = [0] * len(capacities)
    ends: list[list[int]] = [[] for _ in capacities]
    for _ in range(shards):
        at = _furthest(groups, [(a, a + c) for a, c in zip(at, capacities, strict=True)])
        for own, a in zip(ends, at, strict=True):
            own.append(a)
    return ends


def minimax_cuts(groups: DataFrame, shards: int) -> tuple[int, list[int]]:
    """The smallest feasible capacity and the shards' ends in bytes.

    ``groups`` has start_bytes and end_bytes, running sums in the fixed order.
    A search over capacities takes ``PROBES`` at once, so a round costs as many
    small aggregates as there are shards, whatever the number of groups.
    """
    total, largest = groups.agg(F.max("end_bytes"), F.max(F.col("end_bytes") - F.col("start_bytes"))).first()
    if total is None:
        return 0, [0] * shards
    low = max(largest, math.ceil(total / shards))
    high = math.ceil(total / shards) + largest  # always enough: each shard but the last takes its even share at least
    best: list[int] = []
    while low < high or not best:
        step = max(1, (high - low) // (PROBES + 1))
        tried = sorted({min(high, low + i * step) for i in range(PROBES + 1)})
        ends = _greedy(groups, tried, shards)
        fits = [i for i, e in enumerate(ends) if e[-1] == total]
        if fits:
            high, best = tried[fits[0]], ends[fits[0]]
        if not fits or fits[0] > 0:
            low = tried[fits[0] - 1 if fits else -1] + 1
        else:
            low = high
    return high, best


def _block(groups: DataFrame, block_rows: int) -> Column:
    """The block of a group, in the order of size classes and within these of digests."""
    number = F.conv(F.substring("key", 1, BITS // 4), 16, 10).cast("long")
    counted = groups.groupBy("size_class").count().collect()  # a number for each power of two
    bits = {r["size_class"]: min(BITS, math.ceil(math.log2(max(1, r["count"] / block_rows)))) for r in counted}
    place = F.coalesce(*[F.when(F.col("size_class") == k, F.shiftright(number, BITS - n)) for k, n in bits.items()], F.lit(0))
    return F.shiftleft("size_class", BITS) + place


def shard_documents(
    docs: DataFrame,
    shards: int = 8,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_rows: int = 100_000,
) -> DataFrame:
    """One row per input row: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    The law is ``bytes``. A document's size is its UTF-8 bytes plus one; null
    text counts as empty and equals it. Groups of equal texts are never parted.
    They stand by size class (powers of two), larger ones first, so that fine
    grains come last, then by digest. ``slot`` counts from 0 within the shard
    without gaps, in that order, then by a hash of id and row and by the id. Null
    ids are no special case and repeated rows get slots of their own. An empty table gives no
    rows; with fewer groups than shards some shards are empty.

    Prefix sums are made in blocks: a size class and, by the counted groups of
    that class, as many bits of the digest that blocks hold about ``block_rows``
    groups. A group's rows are numbered in parts of about as many rows too, so no
    window holds a whole hot group, and windows do not grow with the data. There
    are at most two blocks for each ``block_rows`` groups, and one for each class
    (a text of 2 ** 31 bytes and 10 ** 10 copies leave 64 of these).
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.sha2(text, 256).alias("key"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = written(rows, "shard-rows")
    n_rows = rows.count()
    pieces = 64
    while pieces * block_rows < n_rows:
        pieces *= 2
    rows = rows.withColumn("piece", F.pmod(F.xxhash64("doc_id", "row"), F.lit(pieces)).cast("int"))
    cells = rows.groupBy("key", "piece").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("key").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select("key", "piece", "bytes", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    groups = cells.groupBy("key").agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n"))
    size_class = (F.lit(63) - F.floor(F.log2(F.col("bytes")))).cast("long")
    groups = written(groups.withColumn("size_class", size_class), "shard-sums")
    groups = groups.withColumn("block", _block(groups, block_rows))
    # In the order of blocks, so that the search for cuts reads few row groups of the written result.
    groups = groups.repartitionByRange("block")
    running = Window.partitionBy("block").orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    groups = groups.select("block", "key", "bytes", "n", F.sum("bytes").over(running).alias("b"), F.sum("n").over(running).alias("r"))
    # One window, over blocks only: 10 ** 10 groups have at most 200,064.
    so_far = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = groups.groupBy("block").agg(F.sum("bytes").alias("block_bytes"), F.sum("n").alias("block_rows"))
    blocks = blocks.select(
        "block",
        F.coalesce(F.sum("block_bytes").over(so_far), F.lit(0)).alias("block_b"),
        F.coalesce(F.sum("block_rows").over(so_far), F.lit(0)).alias("block_r"),
    )
    blocks = written(blocks, "shard-blocks", compact=True)
    if blocks.count() <= BROADCAST_BLOCKS:
        blocks = F.broadcast(blocks)
    end = F.col("b") + F.col("block_b")
    placed = groups.join(blocks, "block").select(
        "key",
        (end - F.col("bytes")).alias("start_bytes"),
        end.alias("end_bytes"),
        (F.col("r") + F.col("block_r") - F.col("n")).alias("start_row"),
    )
    placed = written(placed, "shard-groups")
    _, ends = minimax_cuts(placed, shards)
    shard = sum((F.when(F.col("start_bytes") >= e, 1).otherwise(0) for e in ends[:-1]), F.lit(0)).cast("int")
    placed = placed.withColumn("shard", shard)
    starts = placed.groupBy("shard").agg(F.min("start_row").alias("shard_row"))
    placed = placed.join(F.broadcast(starts), "shard")
    cells = cells.join(placed, "key").select(
        "key", "piece", "shard", (F.col("start_row") - F.col("shard_row") + F.col("before")).alias("first_slot")
    )
    in_cell = Window.partitionBy("key", "piece").orderBy("doc_id", "size")
    numbered = rows.withColumn("nth", F.row_number().over(in_cell) - 1)
    return numbered.join(cells, ["key", "piece"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("first_slot") + F.col("nth")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
