"""Benchmark decontamination by size-partitioned MinHash containment search, in DataFrame operations only.

Test items are short and documents long, so resemblance says little; what counts
is the share of an item's shingles that a document contains. Items are parted by
size class. Each class has its own length of sketch: the ``2 * missing + 1``
smallest hashes of an item's shingles, where ``missing`` is what a document that
contains an item of the class may lack. Documents are searched for sketch hashes
by an equi-join, matched hashes are counted for each document and item, and where
so many match that the threshold can be reached, the candidate is verified on
exact shingles.

Shingles that more than ``SHARED`` items have stand behind all others, so that a
phrase of a third of all items is in the sketches only of items that have nothing
rarer. No item is missed by that: the bound holds for any choice of an item's
shingles.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, SPACE_CHARS, ascii_lower, row_key, written

WORDS = 5
#: Items that may share a shingle of a sketch, where an item has others.
SHARED = 32
#: Hashes up to which the items' side of a join is broadcast.
BROADCAST_ENTRIES = 200_000


def _words(table: DataFrame, name: str) -> DataFrame:
    """(name, w): the words of each text that has any."""
    text = F.btrim(ascii_lower(F.col("text")), F.lit("".join(SPACE_CHARS)))
    return table.select(name, text.alias("t")).filter("t <> ''").select(name, F.split("t", f"[{SPACE}]+").alias("w"))


def _each(words: int, make: Callable[[Column], Column]) -> Column:
    """What ``make`` gives for each place in the word array ``w`` where a shingle begins; a text with fewer words has one, its whole sequence."""
    return F.explode(F.transform(F.sequence(F.lit(0), F.greatest(F.size("w") - words, F.lit(0))), make))


def _hash(words: int) -> Callable[[Column], Column]:
    return lambda i: F.xxhash64(*[F.get("w", i + k) for k in range(words)])


def _gram(words: int) -> Callable[[Column], Column]:
    return lambda i: F.array_join(F.slice("w", i + 1, words), " ")


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    percent: int = 75,
    words: int = WORDS,
) -> DataFrame:
    """(doc_id, item_id, n_shared, n_item, containment) for each document that contains an item.

    Words are runs of non-spaces with A-Z lower-cased. A text's set are its
    distinct shingles of five words, or its whole sequence if it has fewer. An
    item is contained where a document has ``percent`` or more of its shingles;
    so an item of fewer than five words is contained only in a document of just
    these words. Null texts count as empty and neither contain nor are contained.
    Rows of one document id, or one item id, count as one set each; null ids are
    left out. Columns other than ids and texts are not read. Empty tables give no
    rows.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).filter("doc_id is not null")
    items = items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text")).filter("item_id is not null")
    both = _each(words, lambda i: F.struct(_hash(words)(i).alias("hash"), _gram(words)(i).alias("gram"))).alias("g")
    grams = written(_words(items, "item_id").select("item_id", both).select("item_id", "g.*").distinct(), "items", compact=True)

    # Items with equal sets are searched for once, by the smallest id.
    content = F.sha2(F.array_join(F.sort_array(F.collect_list("gram")), "\n"), 256)
    sized = grams.groupBy("item_id").agg(F.count(F.lit(1)).alias("n_item"), content.alias("content"))
    sized = written(sized, "item-sizes", compact=True)
    first = sized.groupBy("content").agg(F.min("item_id").alias("item_id"))
    # Items of 2 ** k up to 2 ** (k + 1) - 1 shingles are one class, with the sketch that its largest needs.
    size_class = F.floor(F.log2("n_item"))
    missing = F.floor((F.pow(F.lit(2.0), size_class + 1) - 1) * (100 - percent) / 100)
    sized = sized.select("item_id", "n_item", "content", size_class.cast("int").alias("size_class"), (2 * missing + 1).cast("int").alias("entries"))
    searched = grams.join(sized.join(first, ["content", "item_id"]), "item_id")
    shared_by = grams.groupBy("hash").agg(F.count(F.lit(1)).alias("shared_by"))
    place = F.row_number().over(Window.partitionBy("item_id").orderBy(F.col("shared_by") > SHARED, "hash", "gram"))
    lacking = F.floor(F.col("n_item") * (100 - percent) / 100)
    sketch = searched.join(shared_by, "hash").withColumn("place", place).filter("place <= entries")
    sketch = sketch.select("size_class", "item_id", "hash", (F.least("entries", "n_item") - lacking).cast("int").alias("needed"))
    sketch = written(sketch, "sketches", compact=True)

    # How many of a sketch's hashes a document has, class by class; a hash may stand for two shingles of an item.
    found = _words(docs, "doc_id").select("doc_id", _each(words, _hash(words)).alias("hash"))
    found = found.join(_small(sketch.select("hash").distinct()), "hash").select("doc_id", "hash").distinct()
    matched = found.join(sketch, "hash").groupBy("size_class", "doc_id", "item_id").agg(F.count(F.lit(1)).alias("matched"), F.first("needed").alias("needed"))
    hits = written(matched.filter("matched >= needed").select("doc_id", "item_id"), "candidates", compact=True)

    # Verification on the shingles themselves: each candidate asks its document for the item's.
    asked = hits.join(grams.select("item_id", "hash", "gram"), "item_id")
    texts = docs.join(hits.select("doc_id").distinct(), "doc_id", "left_semi")
    own = _words(texts, "doc_id").select("doc_id", both).select("doc_id", "g.*")
    own = own.join(_small(asked.select("hash").distinct()), "hash", "left_semi").select("doc_id", "gram").distinct()
    shared = asked.join(own, ["doc_id", "gram"]).groupBy("doc_id", "item_id").agg(F.count(F.lit(1)).alias("n_shared"))
    verified = shared.join(sized.select("item_id", "n_item", "content"), "item_id").filter(F.col("n_shared") * 100 >= F.col("n_item") * percent)
    every = verified.drop("item_id").join(sized.select("item_id", "content"), "content")
    return every.select("doc_id", "item_id", "n_shared", "n_item", (F.col("n_shared") / F.col("n_item")).alias("containment"))


def _small(hashes: DataFrame) -> DataFrame:
    """The hashes, broadcast where they are few."""
    hashes = written(hashes, "hashes", compact=True)
    return F.broadcast(hashes) if hashes.count() <= BROADCAST_ENTRIES else hashes


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that contain no item, with all their columns.

    Each row is judged by its own text, whether or not its id is null or
    repeated; repeated rows stay or go together. Null and empty texts stay.
    Columns may have any names. An empty table stays empty, and without items
    every row stays.
    """
    rows = docs.select(row_key(id_col, text_col).alias("row"), F.col(text_col).alias("text"))
    bad = contaminated(rows, items, "row", "text").select(F.col("doc_id").alias("__bad_row")).distinct()
    return docs.join(bad, row_key(id_col, text_col) == F.col("__bad_row"), "left_anti")
