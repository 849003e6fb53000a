"""Main text of web pages by wrappers that are induced from the pages of each host.

1. Each page becomes a skeleton (its tree with equal siblings as one slot) and the hashes of its blocks.
   The commonest skeleton of a host is its reference.
2. Every page is aligned with its host's reference by simple tree matching. Texts that come at the same slot of
   most of a host's pages are the constant nodes of its template; what varies is content.
3. Pages are read again with their host's wrapper: of the article (else the main part, else the element that holds most
   of the text outside menus, forms and the like) all blocks but those of the template are the text.

Pages whose main text is the same count once for a template, so copies do not make a template of their text. What is
counted is skeletons and hashes of blocks; a host's pages are never brought together.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, written
from .dom import parse
from .wrappers import Skeleton, align, main_text, region

OUTLINES = "host string, skeleton string, main long, slots array<int>, hashes array<long>"
#: Pages with different main texts that a text of a template is on at least, and the share of the host's pages.
LEAST_PAGES, LEAST_SHARE = 3, 0.6
#: Wrappers are broadcast up to so many bytes; beyond that pages meet them by a shuffle.
BROADCAST = 32 << 20
#: Skeletons and alignments that a worker remembers.
REMEMBERED = 10_000


def host_of(url: Column) -> Column:
    """The host of a url, lower-cased; empty where there is none."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")))


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - 2**63


def _outlined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The outline of each page of a host."""
    for batch in batches:
        found: list[tuple] = []
        for host, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            page = parse(html)
            skeleton, slots = Skeleton.of(page)
            main = _hash("\n".join(page.blocks[k].text for k in region(page)))
            found.append((host, skeleton.line(), main, [slots[b.node] for b in page.blocks], [_hash(b.text) for b in page.blocks]))
        kinds = [pa.string(), pa.string(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64())]
        columns = [pa.array([r[k] for r in found], kind) for k, kind in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in OUTLINES.split(", ")])


def _met(rows: DataFrame, by_host: DataFrame, how: str) -> DataFrame:
    """``rows`` with what is known of their host: broadcast if it is small, so that no host is brought together."""
    of = [F.octet_length(f.name) if f.dataType.typeName() == "string" else 12 * F.size(f.name) if f.dataType.typeName() == "array" else F.lit(8) for f in by_host.schema]
    size = by_host.agg(F.sum(sum(of, F.lit(64)))).first()[0] or 0
    return rows.join(F.broadcast(by_host) if size <= BROADCAST else by_host, "host", how)


class _Aligned:
    """Slots of pages in their references, remembered by both skeletons."""

    def __init__(self) -> None:
        self.known: dict[tuple[str, str], list[int]] = {}

    def __call__(self, page: str, reference: str) -> list[int]:
        key = (page, reference)
        if key not in self.known:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[key] = align(Skeleton.read(page), Skeleton.read(reference))
        return self.known[key]


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, slot, hash): what a page has at the slots of its host's reference, once for each page."""
    aligned = _Aligned()
    for batch in batches:
        hosts, slots, hashes = [], [], []
        for host, skeleton, own, texts, reference in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
            places = aligned(skeleton, reference)
            here = {(places[s], h) for s, h in zip(own, texts, strict=True) if places[s] >= 0}
            hosts += [host] * len(here)
            slots += [s for s, _ in here]
            hashes += [h for _, h in here]
        yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(slots, pa.int32()), pa.array(hashes, pa.int64())], ["host", "slot", "hash"])


def induce_wrappers(pages: DataFrame) -> DataFrame:
    """(host, reference, constants) of pages (host, html): each host's reference skeleton and its template's (slot, hash)."""
    outlines = written(pages.filter("host <> ''").mapInArrow(_outlined, OUTLINES), "outlines")
    counted = outlines.groupBy("host", "skeleton").agg(F.count("*").alias("n"))
    references = counted.groupBy("host").agg(F.max_by("skeleton", F.struct("n", F.xxhash64("skeleton"), "skeleton")).alias("reference"))
    # One page stands for all of a host with the same main text.
    distinct = outlines.groupBy("host", "main").agg(F.min(F.struct("skeleton", "slots", "hashes")).alias("page"))
    distinct = written(distinct.select("host", "page.*"), "distinct-outlines", compact=True)
    sizes = distinct.groupBy("host").agg(F.count("*").alias("pages")).filter(F.col("pages") >= LEAST_PAGES)
    references = written(references.join(sizes, "host", "left"), "references", compact=True)
    placed = _met(distinct, references.filter("pages is not null"), "inner").select("host", "skeleton", "slots", "hashes", "reference").mapInArrow(_placed, "host string, slot int, hash long")
    times = placed.groupBy("host", "slot", "hash").agg(F.count("*").alias("n")).filter(F.col("n") >= LEAST_PAGES)
    constant = times.join(sizes, "host").filter(F.col("n") >= LEAST_SHARE * F.col("pages"))
    constants = constant.groupBy("host").agg(F.sort_array(F.collect_list(F.struct("slot", "hash"))).alias("constants"))
    return references.select("host", "reference").join(constants, "host")


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    aligned = _Aligned()
    for batch in batches:
        texts = []
        for html, reference, constants in zip(*(batch.column(k).to_pylist() for k in range(2, 5)), strict=True):
            page = parse(html)
            template = [False] * len(page.blocks)
            if reference is not None:
                skeleton, slots = Skeleton.of(page)
                places = aligned(skeleton.line(), reference)
                fixed = {(c["slot"], c["hash"]) for c in constants}
                template = [(places[slots[b.node]], _hash(b.text)) in fixed for b in page.blocks]
            texts.append(main_text(page, template))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars: the main text of each page, blocks joined by line feeds, and its code points.

    White space inside a block is one space; character references are decoded.
    Null html is empty, a page without main text gives an empty text. A page
    without a url or host is read by itself, as is one of a host with fewer than
    LEAST_PAGES different pages. Repeated rows give repeated results, null ids
    stay; other columns are not read, an empty table gives no rows. Whole pages
    are read, however long; elements nested deeper than ``dom.DEPTH`` count as siblings.
    """
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), host_of(F.col(url_col)).alias("host"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    wrappers = written(induce_wrappers(rows.select("host", "html")), "wrappers", compact=True)
    met = _met(rows, wrappers, "left").select("page_id", "url", "html", "reference", "constants")
    schema = f"page_id {rows.schema['page_id'].dataType.simpleString()}, url string, text string"
    return met.mapInArrow(_extracted, schema).withColumn("n_chars", F.length("text").cast("long"))
