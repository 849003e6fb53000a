"""The highest-ranked documents of each item, by a threshold algorithm in three phases over postings by term.

A term's list has the part that a document gets from it. An item's score is the
sum over its m terms.

1. Heads: the k first entries of every list. Their sums for each item are lower
   bounds, and the k-th largest, t, is one of the item's k-th score.
2. A document of at least t has a part of at least t / m from some term. So every
   list gives all entries from that threshold on. What a document may still get
   from lists that did not give it is below the threshold each. The documents of
   the largest sums of heads are looked up; what so cannot reach the k-th largest
   of these exact scores, or of the sums of entries given, is left out.
3. The exact scores of those left are looked up by document and term.

Whole lists are read, but only what a threshold lets through is moved. Lists are
never sorted in one task: Spark keeps the first of each part of a list before it
brings them together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written
from .terms import terms_of

#: Documents of an item whose exact scores are looked up after the first phase, for each that is wanted.
TRIED = 4
#: Rows (under 64 bytes each) of items' terms or of pairs that are broadcast to meet the postings; beyond that they meet by a shuffle.
BROADCAST_ROWS = 500_000
#: A row without a term tells the number of terms of a document that has any.
POSTINGS = "id long, nth long, n long, term long, tf long"


def _posted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, nth, n, term, tf): ``nth`` tells rows apart, whatever their ids."""
    number = TaskContext.get().partitionId() << 33
    for batch in batches:
        ids = batch.column(0)
        for found in terms_of(batch.column(1), digits=True):
            if not len(found.hashes):
                continue
            order = np.lexsort((found.hashes, found.text))
            text, hashes = found.text[order], found.hashes[order]
            new = np.flatnonzero(np.append(True, (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])))
            tf = np.diff(np.append(new, len(text)))
            rows, sizes = np.unique(text, return_counts=True)
            n = np.zeros(rows[-1] + 1, np.int64)
            n[rows] = sizes
            every = np.concatenate([text[new], rows])
            term = np.concatenate([hashes[new].view(np.int64), np.zeros(len(rows), np.int64)])
            none = np.arange(len(every)) >= len(new)
            columns = [ids.take(pa.array(every)), pa.array(every + number), pa.array(n[every]), pa.array(term, mask=none), pa.array(np.concatenate([tf, sizes]))]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in POSTINGS.split(", ")])
        number += batch.num_rows


def _first(by: list, order: list, k: int, rows: DataFrame, name: str = "place") -> DataFrame:
    """The first ``k`` rows of each group, with their ``place``."""
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col(name) <= k)


def _kth(sums: DataFrame, k: int, name: str) -> DataFrame:
    """(item, name): the k-th largest sum of each item, 0 where it has fewer."""
    best = _first(["item"], [F.desc("total")], k, sums.select("item", "total"))
    return best.groupBy("item").agg(F.when(F.count("*") == k, F.min("total")).otherwise(0).cast("long").alias(name))


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` documents of the highest scores above 0 for each item, equal scores by id.

    Terms are runs of ASCII letters, digits and other than ASCII characters, A-Z
    lower-cased. A term that df of N documents hold weighs w = floor(1000 * ln((2 N + 2) / (2 df + 1)));
    a document of n terms, of L in all documents, has m = 25 + 75 n N div L and gets
    w * (10 ** 9 tf div (1000 tf + 8 m)) for each time the item has the term.

    Null texts have no terms; documents without terms count nowhere, and items
    without a known term get no row. Each row of either table is one of its own:
    rows repeated with the same id come repeatedly, null ids last among equal
    scores. Other columns are not read; empty tables give no rows.
    """
    asked = items.select(F.col(item_col).cast("long").alias("id"), F.col(item_text_col).alias("text")).mapInArrow(_posted, POSTINGS).filter("term is not null")
    asked = written(asked.select(F.col("nth").alias("item"), F.col("id").alias("item_id"), "term", F.col("tf").alias("times")), "item-terms")
    vocabulary = asked.select("term").distinct().withColumn("known", F.lit(True))
    every = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(_posted, POSTINGS)
    postings = every.join(vocabulary, "term", "left").filter("known or term is null").select(F.col("id").alias("doc_id"), F.col("nth").alias("doc"), "n", "term", "tf")
    postings = written(postings, "postings")
    n_docs, n_terms = postings.filter("term is null").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(1))).first()
    held = postings.filter("term is not null").groupBy("term").agg(F.count("*").alias("df"))
    weight = F.floor(1000 * F.log((F.lit(2 * n_docs + 2).cast("double")) / (2 * F.col("df") + 1).cast("double"))).cast("long")
    weights = held.select("term", weight.alias("w")).filter("w > 0")
    asked = written(asked.join(weights, "term").withColumn("m", F.count("*").over(Window.partitionBy("item"))), "weighed-terms")
    part = F.expr(f"w * ((1000000000L * tf) div (1000 * tf + 8 * (25 + (75 * n * {n_docs}L) div {n_terms}L)))")

    def small(rows: DataFrame) -> DataFrame:
        """Rows that every task gets, if there are few; a document's postings then stay together, and its sums are made where they are."""
        return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows

    def lists(terms: DataFrame) -> DataFrame:
        """(doc, doc_id, term, part) of the lists of ``terms`` (term, w, least) from ``least`` on."""
        found = postings.filter("term is not null").join(small(terms), "term").withColumn("part", part)
        return found.filter("part >= least").select("doc", "doc_id", "term", "part")

    def summed(entries: DataFrame) -> DataFrame:
        return entries.groupBy("item", "doc").agg(F.sum(F.col("times") * F.col("part")).alias("total"), F.count("*").alias("seen"))

    def looked_up(pairs: DataFrame) -> DataFrame:
        """The exact sums of (item, doc) from the postings of these documents."""
        own = postings.filter("term is not null").select("doc", "n", "term", "tf").join(small(pairs), "doc")
        return summed(own.join(small(asked.select("item", "term", "times", "w")), ["item", "term"]).withColumn("part", part))

    by_part = [F.desc("part"), F.asc_nulls_last("doc_id"), "doc"]
    heads = _first(["term"], by_part, k, lists(asked.select("term", "w", F.lit(1).alias("least")).distinct())).drop("place")
    sums = written(summed(asked.join(heads, "term")), "head-sums")
    tried = _first(["item"], [F.desc("total"), "doc"], TRIED * k, sums)
    floor = _kth(looked_up(written(tried.select("item", "doc"), "tried")), k, "floor")
    limits = asked.join(_kth(sums, k, "bound"), "item").join(floor, "item")
    limits = written(limits.withColumn("least", F.greatest(F.expr("(bound + m * times - 1) div (m * times)"), F.lit(1))), "thresholds", compact=True)
    lowest = limits.groupBy("term", "w").agg(F.min("least").alias("least"))
    asking = limits.select("item", "term", "times", F.col("least").alias("own_least"))
    given = lists(lowest).join(small(asking), "term").filter("part >= own_least")
    known = limits.select("item", "m", "bound", "floor").distinct()
    reach = F.col("total") + (F.col("m") - F.col("seen")) * F.greatest(F.expr("(bound - 1) div m"), F.lit(0))
    seen = written(summed(given).join(known, "item").withColumn("reach", reach).filter("reach >= floor").drop("bound", "floor"), "seen")
    candidates = written(seen.join(_kth(seen, k, "floor"), "item").filter("reach >= floor"), "candidates", compact=True)
    partly = written(candidates.filter("seen < m").select("item", "doc"), "partly", compact=True)
    exact = candidates.filter("seen = m").select("item", "doc", "total").unionByName(looked_up(partly).select("item", "doc", "total"))
    exact = exact.join(postings.filter("term is null").select("doc", "doc_id"), "doc")
    by_score = [F.desc("total"), F.asc_nulls_last("doc_id"), "doc"]
    best = _first(["item"], by_score, k, exact, "rank")
    names = asked.select("item", "item_id").distinct()
    return best.join(names, "item").select("item_id", "rank", "doc_id", F.col("total").alias("score"))
