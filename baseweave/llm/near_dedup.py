"""Near-duplicate groups by min-max hashing, confirmed on full shingle sets.

Every hash function gives two entries of a signature, the smallest and the
largest value over a document's shingles, so a signature costs half the hash
evaluations. Bands of four entries (two minima, two maxima) bring candidates
together; each link is then confirmed on the full sets.

Copies and near copies come in large groups, so pairs within a bucket are never
all formed. Documents with equal sets are one node. A bucket's members are
compared with the bucket's smallest node; confirmed links make components. A
bucket whose members are then of several components may hide links that these
stars have not tried. In small buckets (a bounded number of pairs each) the
pairs between components are formed; in large ones an exact prefix filter takes
over: documents at or over the threshold share one of their rarest shingles.

Before sets are compared, sketches of one bit of each signature entry rule out
pairs that are far apart.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .components import components
from .words import hashed_words, mixed, shingle_sets

WORDS = 5
#: Bands and hash functions in each. Of two sets at a similarity of 0.75 the smallest and the largest value agree with a
#: probability of 0.75 * 0.75 where sets are large, so all bands miss with (1 - 0.316) ** 40 = 3e-7. In small sets the two
#: are never one shingle, and they agree less often (0.5 for three of four shingles): sets of up to ``FEW`` shingles have
#: ``FURTHER`` bands besides, and all miss with (1 - 0.25) ** 72 = 1e-9 at most. Of two sets that could be linked the
#: larger decides which bands they share, so where it has more than ``FEW`` shingles the first figure holds.
BANDS, FURTHER, FUNCTIONS = 40, 32, 2
FEW = 40
_RANDOM = np.random.default_rng(9_090)
_TIMES = _RANDOM.integers(0, 2**63, (BANDS + FURTHER) * FUNCTIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLUS = _RANDOM.integers(0, 2**64, (BANDS + FURTHER) * FUNCTIONS, dtype=np.uint64)
ENTRIES = 2 * BANDS * FUNCTIONS
SIGNATURE = "doc_id long, hash long, n_shingles long, sum1 long, sum2 long, bits0 long, bits1 long, bits2 long, bands array<long>"
BITS = ["bits0", "bits1", "bits2"]
#: Of two sets at 0.75 or more, each of the 160 bits agrees with a probability of 0.875; pairs below this number are not
#: compared. By Chernoff's bound such a pair is lost with 2.5e-12 at most.
ALIKE = 104
#: Slots of shingle counts: a constant, so they fit the driver and a broadcast.
SLOTS = 1 << 18
#: Members of a bucket up to which pairs between its components are formed.
SMALL = 32


def min_max_bands(hashes: np.ndarray, begins: np.ndarray, bands: range = range(BANDS)) -> tuple[np.ndarray, np.ndarray]:
    """A row of band keys and one of signature entries for each text; every text has a shingle."""
    keys = np.zeros((len(begins), len(bands)), np.uint64)
    entries = np.zeros((2 * FUNCTIONS * len(bands), len(begins)), np.uint64)
    for nth, band in enumerate(bands):
        key = np.full(len(begins), band, np.uint64)
        for k in range(FUNCTIONS):
            function = band * FUNCTIONS + k
            values = (hashes ^ _PLUS[function]) * _TIMES[function]
            at = 2 * (nth * FUNCTIONS + k)
            entries[at], entries[at + 1] = np.minimum.reduceat(values, begins), np.maximum.reduceat(values, begins)
            key = mixed(mixed(key ^ entries[at]) ^ entries[at + 1])
        keys[:, nth] = key
    return keys, entries


def _sketch(entries: np.ndarray) -> np.ndarray:
    """A bit of each signature entry."""
    bits = np.zeros((3, entries.shape[1]), np.uint64)
    for k, entry in enumerate(entries):
        bits[k // 64] |= (mixed(entry) & np.uint64(1)) << np.uint64(k % 64)
    return bits


def _band_lists(hashes: np.ndarray, begins: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """The band keys of each text, more of them for small sets, and its sketch."""
    keys, entries = min_max_bands(hashes, begins)
    n = np.diff(np.append(begins, len(hashes)))
    few = n <= FEW
    lists = list(keys)
    if few.any():
        own = np.cumsum(n[few]) - n[few]
        more, _ = min_max_bands(hashes[np.repeat(few, n)], own, range(BANDS, BANDS + FURTHER))
        for k, row in zip(np.flatnonzero(few), more, strict=True):
            lists[k] = np.concatenate([lists[k], row])
    return lists, _sketch(entries)


def _sums(hashes: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Two sums over each set (with a shingle each), by which sets are told apart: 128 bits."""
    return np.stack([np.add.reduceat(mixed(hashes, salt), begins) for salt in (1, 2)])


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at, to, words in hashed_words(batch.column(2), lower=True):
            hashes, begins = shingle_sets(words, WORDS)
            n = np.diff(begins)
            full = n > 0
            sums = np.zeros((2, len(n)), np.uint64)
            keys, bits, counts = [np.zeros(0, np.uint64)], np.zeros((3, len(n)), np.uint64), np.zeros(len(n), np.int64)
            if full.any():
                own = begins[:-1][full]
                sums[:, full] = _sums(hashes, own)
                keys, bits[:, full] = _band_lists(hashes, own)
                counts[full] = [len(k) for k in keys]
            lists = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32), pa.array(np.concatenate(keys).view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k).slice(at, to - at) for k in (0, 1)), pa.array(n), *(pa.array(x.view(np.int64)) for x in (*sums, *bits)), lists],
                ["doc_id", "hash", "n_shingles", "sum1", "sum2", *BITS, "bands"],
            )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at, to, words in hashed_words(batch.column(1), lower=True):
            hashes, begins = shingle_sets(words, WORDS)
            sets = [hashes[a:b].tobytes() for a, b in zip(begins[:-1], begins[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, to - at), pa.array(sets, pa.binary())], ["id", "shingles"])


def _slot(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(46)).astype(np.int64)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many shingles of a task's sets fall into each slot."""
    total = np.zeros(SLOTS, np.int64)
    for batch in batches:
        for s in batch.column(0):
            np.add.at(total, _slot(np.frombuffer(s.as_buffer(), np.uint64)), 1)
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["slot", "n"])


def _prefixes(counts):
    """Of each set its rarest shingles, with their place and whether they are enough for the smaller set of a pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sizes, parts, places = [], [], [], []
            for one, s in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                tokens = np.frombuffer(s.as_buffer(), np.uint64)
                n = len(tokens)
                seen = counts.value[_slot(tokens)]
                place = np.lexsort([tokens, seen])[: n - -(-3 * n // 4) + 1]
                shared = np.flatnonzero(seen[place] > 1)
                ids.append(np.full(len(shared), one))
                sizes.append(np.full(len(shared), n))
                parts.append(tokens[place[shared]])
                places.append(shared + 1)
            ids, sizes, parts, places = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (ids, sizes, parts, places))
            first = places <= sizes + (-6 * sizes // 7) + 1
            columns = [pa.array(ids), pa.array(sizes), pa.array(parts.view(np.int64)), pa.array(places), pa.array(first)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n", "shingle", "place", "first"])

    return run


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b, left, right = (batch.column(k) for k in range(4))
        linked = []
        for x, y in zip(left, right, strict=True):
            x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (x, y))
            both = np.concatenate([x, y])
            both.sort()
            common = int((both[1:] == both[:-1]).sum())
            linked.append(100 * common >= 75 * (len(both) - common))
        yield pa.RecordBatch.from_arrays([a, b, pa.array(linked, pa.bool_())], ["a", "b", "linked"])


def _plausible(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sizes and sketches allow for a link."""
    left = nodes.select(F.col("id").alias("a"), F.col("n_shingles").alias("n"), *[F.col(c).alias(f"{c}_a") for c in BITS])
    right = nodes.select(F.col("id").alias("b"), F.col("n_shingles").alias("m"), *[F.col(c).alias(f"{c}_b") for c in BITS])
    differ = sum((F.bit_count(F.col(f"{c}_a").bitwiseXOR(F.col(f"{c}_b"))) for c in BITS), F.lit(0))
    sizes = 4 * F.least("n", "m") >= 3 * F.greatest("n", "m")
    return pairs.join(left, "a").join(right, "b").filter(sizes & (differ <= ENTRIES - ALIKE)).select(*pairs.columns)


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` (a, b) with whether their sets are at or over the threshold."""
    left = pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("left")), "a")
    both = left.join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("right")), "b")
    return written(both.select("a", "b", "left", "right").mapInArrow(_confirm, "a long, b long, linked boolean"), "near-pairs", compact=True)


def _labelled(nodes: DataFrame, found: DataFrame, col: str, label: str) -> DataFrame:
    own = found.select(F.col("id").alias(col), F.col("component").alias(label))
    return nodes.join(own, col, "left").withColumn(label, F.coalesce(label, col))


def _rare_pairs(ids: DataFrame, sets: DataFrame, found: DataFrame) -> DataFrame:
    """Pairs from different components that share one of their rarest shingles.

    Two sets at or over 0.75 overlap in at least 3/4 of the larger and 6/7 of
    the smaller. The rarest shingles of each, as many as it may lack and one
    more, so cannot be free of the other's. The order is the same for all: by
    how often a shingle occurs, then by the shingle. What two sets
    have after their first common shingle bounds their overlap, and a pair is
    formed only where that is enough.

    Rarity is by counts of shingles in a fixed number of slots. Slots shared by
    different shingles only make the order less sharp; it stays one order.
    """
    own = sets.join(ids, "id", "left_semi").select("id", "shingles")
    got = own.select("shingles").mapInArrow(_counts, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(SLOTS, np.int64)
    counts[got["slot"].to_numpy(np.int64)] = got["n"].to_numpy(np.int64)
    rare = own.mapInArrow(_prefixes(ids.sparkSession.sparkContext.broadcast(counts)), "id long, n long, shingle long, place long, first boolean")
    rare = written(_labelled(rare, found, "id", "component"), "near-rare", compact=True)
    # Shingles within one component need no pairs.
    mixed_up = rare.groupBy("shingle").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x < y").select("shingle")
    rare = rare.join(mixed_up, "shingle")
    other = rare.filter("first").select("shingle", F.col("id").alias("b"), F.col("n").alias("m"), F.col("place").alias("place_b"), F.col("component").alias("other"))
    enough = 7 * (1 + F.least(F.col("n") - F.col("place"), F.col("m") - F.col("place_b"))) >= 3 * (F.col("n") + F.col("m"))
    smaller = (F.col("m") < F.col("n")) | ((F.col("m") == F.col("n")) & (F.col("b") < F.col("id")))
    met = rare.join(other, "shingle").filter(smaller & (4 * F.col("m") >= 3 * F.col("n")) & enough & (F.col("component") != F.col("other")))
    return met.select(F.col("id").alias("a"), "b").distinct()


def _of_one_id(real: DataFrame, nodes: DataFrame, same: list[str]) -> DataFrame | None:
    """Links (a, b) between the nodes of an id that stands on rows with different sets; none where no id does."""
    node = F.struct(*same)
    several = real.groupBy("doc_id").agg(F.min(node).alias("x"), F.max(node).alias("y")).filter("x <> y").select("doc_id")
    several = written(several, "near-repeated-ids", compact=True)
    if several.isEmpty():
        return None
    of = written(real.join(several, "doc_id", "left_semi").join(nodes, same).select("doc_id", "id").distinct(), "near-of-ids", compact=True)
    first = of.groupBy("doc_id").agg(F.min("id").alias("b"))
    return of.join(first, "doc_id").filter("id <> b").select(F.col("id").alias("a"), "b")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    Words are runs of non-spaces with A-Z lower-cased; a document's set are its
    distinct shingles of five words, or its whole sequence if it has fewer.
    Documents are linked at a Jaccard similarity of 0.75 or more. A component's
    id is its smallest document id, and that document is kept. Null text counts
    as empty; documents without words have an empty set and are linked with
    nothing. Repeated rows have the same component. Rows of one id are one
    document: each text has its own set and links, and all texts with words of
    one id are of one component. Null ids are linked to nothing and kept. Columns
    other than id and text are not read. An empty table gives no rows.

    Shingles are told apart by 64-bit hashes (see ``words``), sets by the number
    and two 64-bit sums of these.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("hash"), text.alias("text"))
    signed = written(source.mapInArrow(_signatures, SIGNATURE), "near-signatures")
    same = ["n_shingles", "sum1", "sum2"]
    real = signed.filter("n_shingles > 0 and doc_id is not null")
    # A node is a set; its text is that of its first row by id and the text's hash.
    nodes = real.groupBy(*same).agg(F.min(F.struct("doc_id", "hash")).alias("row"), *[F.first(c).alias(c) for c in (*BITS, "bands")])
    nodes = nodes.select(F.monotonically_increasing_id().alias("id"), "row.doc_id", "row.hash", *same, *BITS, "bands")
    nodes = written(nodes, "near-nodes")
    given = _of_one_id(real, nodes.select("id", *same), same)

    member = nodes.select("id", "doc_id", F.explode("bands").alias("key"))
    # The smallest document is the pivot: what is copied is mostly there before its copies.
    bucket = member.groupBy("key").agg(F.min(F.struct("doc_id", "id"))["id"].alias("pivot"), F.count(F.lit(1)).alias("members")).filter("members > 1")
    member = written(member.drop("doc_id").join(bucket, "key"), "near-members", compact=True)
    asked = nodes.select("id", "doc_id", "hash").join(member.select("id").distinct(), "id", "left_semi")
    texts = source.join(asked, ["doc_id", "hash"]).select("id", "text")
    sets = written(texts.mapInArrow(_sets, "id long, shingles binary"), "near-sets")
    # Rows repeated with one id and text give one set again.
    sets = sets.dropDuplicates(["id"]) if _repeats(sets) else sets

    stars = member.filter("id <> pivot").groupBy(F.col("id").alias("a"), F.col("pivot").alias("b")).agg(F.count(F.lit(1)).alias("shared"))
    pairs = written(_plausible(stars, nodes), "near-candidates", compact=True)
    best = pairs.groupBy("a").agg(F.max(F.struct("shared", (-F.col("b")).alias("less"))).alias("best")).select("a", (-F.col("best.less")).alias("b"))
    links = confirmed(best, sets)
    sure = links.filter("linked").select("a", "b")
    found = components(sure if given is None else sure.unionByName(given))

    rest = pairs.select("a", "b").join(links, ["a", "b"], "left_anti")
    rest = _labelled(_labelled(rest, found, "a", "of_a"), found, "b", "of_b").filter("of_a <> of_b").select("a", "b")
    more = confirmed(rest, sets)
    found = _extended(found, more)

    # What is left: members of one bucket that are in different components and were compared with its pivot only.
    named = _labelled(member, found, "id", "of")
    several = named.groupBy("key").agg(F.min("of").alias("x"), F.max("of").alias("y")).filter("x < y").select("key")
    named = written(named.join(several, "key"), "near-open", compact=True)
    small, large = named.filter(F.col("members") <= SMALL), named.filter(F.col("members") > SMALL)
    other = small.select("key", F.col("id").alias("b"), F.col("of").alias("of_b"))
    last = small.join(other, "key").filter("id > b and of <> of_b and b <> pivot").select(F.col("id").alias("a"), "b").distinct()
    last = last.unionByName(_rare_pairs(large.select("id").distinct(), sets, found)).distinct()
    tried = links.select("a", "b").unionByName(more.select("a", "b"))
    tried = tried.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    last = last.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).join(tried, ["a", "b"], "left_anti")
    found = _extended(found, confirmed(_plausible(last, nodes), sets))

    # Every row meets its node by its set, and its component's smallest document by its node.
    of = _labelled(nodes.select(*same, "id", F.col("doc_id").alias("doc")), found, "id", "component")
    grown = found.select(F.explode(F.array("id", "component")).alias("id"), "component").distinct()
    least = nodes.select("id", "doc_id").join(grown, "id").groupBy("component").agg(F.min("doc_id").alias("least"))
    of = of.join(least, "component", "left").select(*same, F.coalesce("least", "doc").alias("component"))
    out = signed.select("doc_id", *same).join(of, same, "left")
    whole = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("component")).otherwise(F.col("doc_id"))
    out = out.withColumn("component_id", whole)
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def _repeats(sets: DataFrame) -> bool:
    return not sets.groupBy("id").count().filter("count > 1").isEmpty()


def _extended(found: DataFrame, pairs: DataFrame) -> DataFrame:
    old = found.select(F.col("id").alias("a"), F.col("component").alias("b"))
    return components(old.unionByName(pairs.filter("linked").select("a", "b")))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` of which each component keeps its smallest id, with all their columns.

    Rows of one id are one document and stay or go together, those without words
    too. Rows with null ids stay, as do documents without words. An empty table
    stays empty.
    """
    found = near_duplicates(docs, id_col, text_col).filter("not kept").select(F.col("doc_id").alias("__near_copy")).distinct()
    return docs.join(found, F.col(id_col).cast("long") == F.col("__near_copy"), "left_anti")
