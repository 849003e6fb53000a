"""How far the sources of a language are from each other, and which terms set a source apart.

Integer-dictionary encoding of terms:

1. Texts become counts of terms by (lang, source), combined in the task and again by Spark.
2. A language keeps the terms that enough of its documents hold. Kept terms are dealt into chunks by
   a hash; a chunk's terms are sorted by their UTF-8 bytes, and a term's id is its place there.
3. In a chunk each source is a dense vector over these ids, filled by one bincount. Distances of sources
   are sums over chunks, and the first terms of a source are chosen from the first of each chunk. As ids
   go by UTF-8 order, equal values are ordered by id.

All arithmetic is of whole numbers, exact for totals up to 9 * 10 ** 15.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written
from .terms import terms_of

COUNTS = "lang string, source string, term string, n long, docs long"
SCORES = "lang string, source string, part string, item string, value long"
#: Rows that a task gathers before it hands them on.
HELD = 200_000
#: Entries of a chunk's matrix of sources by terms; more where there are many sources, so that a chunk's pairs stay fewer than its entries.
ENTRIES, MOST_ENTRIES = 1 << 13, 1 << 24


class _Gathered:
    """Counts of a task's (group, term), combined as they come."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.groups: dict[tuple, int] = {}
        self.parts: list[tuple] = []
        self.rows = 0

    def add(self, group: np.ndarray, hashes: np.ndarray, n: np.ndarray, docs: np.ndarray, terms: pa.Array) -> None:
        self.parts.append((group, hashes, n, docs, terms))
        self.rows += len(group)

    def combine(self) -> None:
        group, hashes, n, docs = (np.concatenate([p[k] for p in self.parts]) for k in range(4))
        terms = pa.concat_arrays([p[4] for p in self.parts])
        order = np.lexsort((hashes, group))
        group, hashes = group[order], hashes[order]
        new = np.flatnonzero(np.append(True, (group[1:] != group[:-1]) | (hashes[1:] != hashes[:-1])))
        added = [np.add.reduceat(c[order], new) for c in (n, docs)]
        self.parts = [(group[new], hashes[new], *added, terms.take(pa.array(order[new])))]
        self.rows = len(new)

    def batch(self) -> pa.RecordBatch:
        group, _, n, docs, terms = self.parts[0]
        lang, source = (pa.array([g[k] for g in self.groups], pa.string()).take(pa.array(group)) for k in (0, 1))
        return pa.RecordBatch.from_arrays([lang, source, terms, pa.array(n), pa.array(docs)], ["lang", "source", "term", "n", "docs"])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = _Gathered()
    for batch in batches:
        pairs = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
        for found in terms_of(batch.column(2), digits=False):
            if not len(found.hashes):
                continue
            of_row = np.array([held.groups.setdefault(p, len(held.groups)) for p in pairs], np.int64)
            group = of_row[found.text]
            order = np.lexsort((found.text, found.hashes, group))
            group, hashes, text = group[order], found.hashes[order], found.text[order]
            other = (group[1:] != group[:-1]) | (hashes[1:] != hashes[:-1])
            new = np.flatnonzero(np.append(True, other))
            n = np.diff(np.append(new, len(group)))
            docs = np.add.reduceat(np.append(True, other | (text[1:] != text[:-1])).astype(np.int64), new)
            held.add(group[new], hashes[new], n, docs, found.strings(order[new]))
            if held.rows > HELD:
                held.combine()
                if held.rows > HELD // 2:
                    yield held.batch()
                    held.clear()
    if held.parts:
        held.combine()
        yield held.batch()


def _share(counts: np.ndarray, total: np.ndarray, smooth: int) -> np.ndarray:
    """1 + floor(10 ** 9 * (counts + smooth) / total), three digits at a time, so that no product overflows."""
    left, found = counts + smooth, np.zeros(np.broadcast(counts, total).shape, np.int64)
    for _ in range(3):
        whole, left = np.divmod(left * 1000, total)
        found = found * 1000 + whole
    return found + 1


def _chunk(smooth: int, top: int):
    """Scores of one chunk: part sums for pairs of sources, and each source's first terms."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        lang = key[0].as_py()
        is_group = np.array(rows["term"].is_null())
        groups, counted = rows.filter(pa.array(is_group)), rows.filter(pa.array(~is_group))
        sources = sorted(zip(groups["source"].to_pylist(), groups["total"].to_pylist(), strict=True))
        place = {s: k for k, (s, _) in enumerate(sources)}
        every, of_all = groups["kept"][0].as_py(), groups["lang_total"][0].as_py()
        names = np.array([t.encode() for t in counted["term"].to_pylist()], object)
        terms = np.unique(names)
        width = len(terms)
        at = np.array([place[s] for s in counted["source"].to_pylist()], np.int64) * width + np.searchsorted(terms, names)
        n = np.array(counted["n"], np.int64)
        # bincount adds doubles, which are exact for halves of a number.
        high, low = (np.bincount(at, weights=w, minlength=len(sources) * width).astype(np.int64) for w in (n >> 31, n & (2**31 - 1)))
        dense = ((high << 31) + low).reshape(len(sources), width)
        totals = np.array([[t] for _, t in sources], np.int64) + smooth * every
        own = _share(dense, totals, smooth)
        whole = _share(dense.sum(0), np.int64(of_all + smooth * every), smooth)
        source, part, item, value = [], [], [], []
        for k, (name, _) in enumerate(sources):
            apart = np.abs(own - own[k]).sum(1).tolist()
            others = [j for j in range(len(sources)) if j != k]
            above = own[k] - whole
            better = np.flatnonzero((dense[k] > 0) & (above > 0))
            first = better[np.argsort(-above[better], kind="stable")[:top]]
            source += [name] * (len(others) + len(first))
            part += ["pair"] * len(others) + ["term"] * len(first)
            item += [sources[j][0] for j in others] + [terms[t].decode() for t in first]
            value += [apart[j] for j in others] + above[first].tolist()
        text = [pa.array(c, pa.string()) for c in ([lang] * len(source), source, part, item)]
        return pa.table([*text, pa.array(value, pa.int64())], names=["lang", "source", "part", "item", "value"])

    return run


def source_divergence(docs: DataFrame, min_docs: int = 30, top: int = 50, smooth: int = 5, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """lang, source, part, item, value, rank: by each group's ``rank``, how far it is from the others and what sets it apart.

    Each (lang, source) gives a term kept by its language the share p, 10 ** 9
    times its smoothed relative frequency, plus 1. Part ``pair`` has every other
    source of the language with the sum of differences of shares, all ranks;
    part ``term`` the ``top`` terms that the group has and whose share is above
    the language's. Ranks go by value, the largest first, then by item.

    Null text, lang and source are empty strings. Every row counts, repeated
    rows repeatedly. A group without terms has its pairs, and pairs are 0 apart
    where a language keeps no term; a language's only source has no pair. Other
    columns are not read; an empty table gives no rows.
    """
    text = {n: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for n, c in (("lang", lang_col), ("source", source_col), ("text", text_col))}
    rows = docs.select(*text.values())
    counts = rows.mapInArrow(_counted, COUNTS).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    counts = written(counts, "term-counts")
    enough = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs")).filter(F.col("docs") >= min_docs).select("lang", "term")
    kept = written(counts.join(enough, ["lang", "term"]).select("lang", "source", "term", "n"), "kept-counts")
    of_lang = kept.groupBy("lang", "term").agg(F.sum("n").alias("n")).groupBy("lang").agg(F.count("*").alias("kept"), F.sum("n").alias("lang_total"))
    groups = rows.select("lang", "source").distinct()
    entries = F.least(F.greatest(F.lit(ENTRIES), 4 * F.col("sources") * F.col("sources")), F.lit(MOST_ENTRIES))
    langs = groups.groupBy("lang").agg(F.count("*").alias("sources")).join(of_lang, "lang", "left").na.fill(0, ["kept", "lang_total"])
    langs = langs.withColumn("chunks", F.greatest(F.ceil(F.col("kept") * F.col("sources") / entries), F.lit(1)).cast("long"))
    langs = written(langs.select("lang", "kept", "lang_total", "chunks"), "langs")
    totals = groups.join(kept.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left").na.fill(0, ["total"])
    each = totals.join(langs, "lang").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    each = each.select("lang", "chunk", "source", F.lit(None).cast("string").alias("term"), F.lit(0).cast("long").alias("n"), "total", "kept", "lang_total")
    none = F.lit(None).cast("long")
    dealt = kept.join(langs.select("lang", "chunks"), "lang").withColumn("chunk", F.pmod(F.xxhash64("term"), F.col("chunks")))
    dealt = dealt.select("lang", "chunk", "source", "term", "n", none.alias("total"), none.alias("kept"), none.alias("lang_total"))
    scores = written(each.unionByName(dealt).groupBy("lang", "chunk").applyInArrow(_chunk(smooth, top), SCORES), "chunk-scores")
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = scores.filter("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value")).withColumn("rank", F.row_number().over(by_value))
    terms = scores.filter("part = 'term'").withColumn("rank", F.row_number().over(by_value)).filter(F.col("rank") <= top)
    return pairs.unionByName(terms).select("lang", "source", "part", "item", "value", "rank")
