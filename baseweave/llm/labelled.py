"""Which labelled documents a classifier may learn from, and a bounded sample of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: Column) -> Column:
    """A third of all documents by their id, never learned from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def learnable(docs: DataFrame, labels: DataFrame, label: str, bound: int) -> DataFrame:
    """(doc_id, text, label) of at most ``bound`` labelled documents that are not held out.

    The sample is by a hash of the id, so it is the same whenever it is taken.
    Rows without a label are left out. Of several texts under one id one stands
    for it; only rows repeated with the same id and text may come repeatedly, so
    what is made of them has to be made distinct by ``doc_id``.
    """
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    usable = usable.filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    usable = usable.groupBy("doc_id").agg(F.max("label").alias("label"))
    chosen = F.broadcast(usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound))
    # Only hashes of texts are grouped, so a hot id is combined where it is read; no more than ``bound`` rows are left.
    hashed = docs.withColumn("hash", F.xxhash64("text"))
    one = hashed.select("doc_id", "hash").join(chosen, "doc_id").groupBy("doc_id").agg(F.min("hash").alias("hash"), F.max("label").alias("label"))
    return hashed.join(F.broadcast(one), ["doc_id", "hash"]).drop("hash")
