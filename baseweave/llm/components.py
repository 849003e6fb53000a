"""Connected components of a table of links by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every id of ``links`` (a, b) but the smallest of its component.

    Each round points every node at the smallest node it knows of, in sums and
    joins on keys; rounds grow with the logarithm of a component's length. Links
    with a null and links of a node to itself say nothing and are left out.
    """
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()
    while True:
        seen = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = seen.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = seen.join(least, "u").filter("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        lowest = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(lowest, "hi").select(F.explode(F.array("hi", "lo")).alias("hi"), F.col("m").alias("lo"))
        edges = written(small.filter("hi > lo").distinct(), "links", compact=True)
        many = edges.groupBy("hi").count().filter("count > 1")
        deep = edges.join(edges.select(F.col("hi").alias("lo")), "lo", "left_semi")
        if many.isEmpty() and deep.isEmpty():
            return edges.select(F.col("hi").alias("id"), F.col("lo").alias("component"))
