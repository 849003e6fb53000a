"""Variant records and reference blocks of pairwise alignment blocks.

The reference is the first sequence of a block. Each other sequence is compared
with it column by column: runs of equal bases become reference blocks with END,
single differing bases become variants, and gaps become insertions or deletions
anchored at the base before them. Where blocks of a file overlap on the
reference, one is chosen for each stretch; blocks are then independent and are
walked side by side, one block at a time.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from baseweave.functions import vcf
from baseweave.sources import maf
from baseweave.sources.tables import as_records

from .intervals import sweep, tagged
from .stored import stored

SCHEMA = "file string, contig string, pos bigint, ref string, alt string, info string"
#: Records handed on at once; columns of pairs compared at once, but for a pair that has more.
RECORDS, COLUMNS = 50_000, 1 << 20
GAP, SAME, DIFFERENT, GAPPED = ord("-"), 0, 1, 2
#: Positions of a bin within which overlapping blocks are chosen from.
CHOICE_BIN = 1 << 20
BASES, PAIRED = "ACGTacgt", "TGCAtgca"
TURNED = str.maketrans(BASES, PAIRED)
UPPER = np.frombuffer(bytes(range(256)).upper(), np.uint8)
LETTERS = pa.array([chr(c) for c in range(128)])
#: What a base differs to, by its letter, and the symbol where it does not.
ALTS = pa.array([f"{chr(c)},{vcf.NON_REF}" for c in range(128)] + [vcf.NON_REF])


def walk(reference: str, other: str, start: int, kept: list[tuple[int, int]] | None = None) -> Iterator[tuple[int, str, str, str]]:
    """(pos, ref, alt, info) of one aligned sequence against the reference from 0-based ``start``; see ``walked``."""
    _, *columns = walked([reference], [other], [start], [kept])
    yield from zip(*columns, strict=True)


def walked(references: list[str], others: list[str], starts: list[int], kept: list[list[tuple[int, int]] | None]) -> tuple[list, ...]:
    """(which pair, pos, ref, alt, info) of aligned pairs of one length each, as columns; see ``_walked``."""
    own, pos, *texts = _walked(pa.array(references, pa.string()), pa.array(others, pa.string()), np.array(starts, np.int64), kept)
    return own.tolist(), pos.tolist(), *[t.to_pylist() for t in texts]


def _columns(texts: pa.Array) -> np.ndarray:
    """The letters of texts in one row, in upper case."""
    _, at, text = texts.buffers()
    at = np.frombuffer(at, np.int32)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else [0]
    letters = np.frombuffer(text or b"", np.uint8)[at[0] : at[-1]]
    if (letters > 127).any():
        letters = np.frombuffer("".join(texts.to_pylist()).encode("ascii", "replace"), np.uint8)
    return UPPER[letters]


def _texts(first: np.ndarray, sizes: np.ndarray, rest: np.ndarray) -> pa.Array:
    """Texts of a letter of ``first`` and ``sizes`` letters of ``rest``, which are in one row."""
    at = np.append(0, np.cumsum(sizes + 1)).astype(np.int32)
    letters, after = np.empty(at[-1], np.uint8), np.ones(at[-1], bool)
    after[at[:-1]] = False
    letters[at[:-1]], letters[after] = first, rest
    return pa.StringArray.from_buffers(len(first), pa.py_buffer(at), pa.py_buffer(letters))


def _walked(references: pa.Array, others: pa.Array, starts: np.ndarray, kept: list[list[tuple[int, int]] | None] | None = None) -> tuple:
    """(which pair, pos, ref, alt, info) of aligned pairs of one length each, as columns.

    ``kept`` are stretches of the reference, in order, to which a pair's records
    are confined; an insertion belongs to the base before it. All pairs are
    compared as one array, and records are made as columns.
    """
    r, o = _columns(references), _columns(others)
    none = (np.array([], np.int64), np.array([], np.int64), *[pa.array([], pa.string())] * 3)
    if not len(r):
        return none
    sizes = np.array(pc.utf8_length(references), np.int64)
    first = np.cumsum(sizes) - sizes
    based = r != GAP
    bases, base_at = np.append(0, np.cumsum(based)), np.flatnonzero(based)
    pair = np.repeat(np.arange(len(sizes)), sizes)
    at = (starts - bases[first] - 1)[pair] + bases[1:]  # where each column's base, or the last one before it, stands
    kind = np.full(len(r), DIFFERENT, np.int8)
    kind[r == o] = SAME
    kind[~based | (o == GAP)] = GAPPED

    # Columns of all stretches, which begin and end where their positions do.
    n_bases = bases[first + sizes] - bases[first]
    if kept is None or all(own is None for own in kept):
        some = n_bases > 0
        k0, k1 = base_at[bases[first[some]]], (first + sizes)[some]
    else:
        spans = [(k, s, e) for k, own in enumerate(kept) for s, e in (own if own is not None else [(int(starts[k]), int(starts[k] + n_bases[k]))])]
        if not spans:
            return none
        of, s, e = (np.array(c, np.int64) for c in zip(*spans, strict=True))
        # Positions by pair in one order: those of a pair begin where the pair before ends.
        shift = np.append(0, np.cumsum(n_bases + 2)[:-1])
        key = at - starts[pair] + 1 + shift[pair]
        bound = lambda x: np.searchsorted(key, np.clip(x - starts[of] + 1, 0, n_bases[of] + 1) + shift[of], "left")
        k0, k1 = bound(s), bound(e)
    k0, k1 = k0[k1 > k0], k1[k1 > k0]
    if not len(k0):
        return none
    edge = np.append(True, kind[1:] != kind[:-1]) | (kind == DIFFERENT)
    edge[k0] = True
    a = np.flatnonzero(edge)
    within = np.searchsorted(k0, a, "right") - 1
    inside = (within >= 0) & (a < k1[within])
    a, within = a[inside], within[inside]
    b = np.minimum(np.append(a[1:], len(r)), k1[within])

    same, own, pos = kind[a] == SAME, pair[a], at[a] + 1
    ref, alt = LETTERS.take(pa.array(r[a])), ALTS.take(pa.array(np.where(same, len(LETTERS), o[a])))
    ends = pc.cast(pa.array(at[a] + b - a, mask=~same), pa.string())
    info = pc.fill_null(pc.binary_join_element_wise("END=", ends, ""), ".")
    gapped = np.flatnonzero(kind[a] == GAPPED)
    if len(gapped):
        put = o != GAP
        puts = np.append(0, np.cumsum(put))
        x, y = a[gapped], b[gapped]
        before_at = at[x] + ~based[x]
        n_held, n_new = bases[y] - bases[x], puts[y] - puts[x]
        good = (before_at > starts[own[gapped]]) & (n_held + n_new > 0)
        lost, gapped, x, y, n_held, n_new = gapped[~good], gapped[good], x[good], y[good], n_held[good], n_new[good]
        pos[gapped] = before_at[good]
        within = np.zeros(len(r) + 1, np.int8)
        np.add.at(within, x, 1)
        np.subtract.at(within, y, 1)
        within = np.cumsum(within[:-1], dtype=np.int8) > 0
        mask = np.zeros(len(a), bool)
        mask[gapped] = True
        before = r[base_at[bases[x] - 1]]
        new = pc.binary_join_element_wise(_texts(before, n_new, o[within & put]), vcf.NON_REF, ",")
        ref, alt = pc.replace_with_mask(ref, pa.array(mask), _texts(before, n_held, r[within & based])), pc.replace_with_mask(alt, pa.array(mask), new)
        if len(lost):
            left = np.delete(np.arange(len(a)), lost)
            own, pos, (ref, alt, info) = own[left], pos[left], [c.take(pa.array(left)) for c in (ref, alt, info)]
    return own, pos, ref, alt, info


def _forward(blocks: DataFrame) -> DataFrame:
    """Blocks (file, block_id, score, rows) with the reference on its forward strand, as (file, block_id, contig, at, size, src_size, reference, texts, score).

    Where the reference is on the other strand all texts of the block are turned.
    """
    first = F.get("rows", F.lit(0))
    turned = F.coalesce(first["strand"] == "-", F.lit(False))
    forward = lambda t: F.when(turned, F.reverse(F.translate(t, BASES, PAIRED))).otherwise(t)
    start = F.when(turned, first["src_size"] - first["start"] - first["size"]).otherwise(first["start"])
    texts = F.transform(F.slice("rows", F.lit(2), F.greatest(F.size("rows") - 1, F.lit(0))), lambda r: forward(r["text"]))
    return blocks.select("file", "block_id", first["src"].alias("contig"), start.alias("at"), first["size"].alias("size"), first["src_size"].alias("src_size"), forward(first["text"]).alias("reference"), texts.alias("texts"), "score")


def _choose(key: tuple, rows: pa.Table) -> pa.Table:
    """Of the blocks over a bin, for each stretch the one of the highest score, of equal ones the first in the file."""
    s, e, score, block = (rows[c].to_pylist() for c in ("s", "e", "score", "block_id"))
    order = sorted(range(len(s)), key=lambda i: s[i])
    places = sorted({*s, *e})
    live: list[tuple] = []
    out: list[list] = []
    nth = 0
    for x, y in zip(places, places[1:], strict=False):
        while nth < len(order) and s[order[nth]] == x:
            i = order[nth]
            heapq.heappush(live, (-score[i] if score[i] is not None else float("inf"), block[i], e[i]))
            nth += 1
        while live and live[0][2] <= x:
            heapq.heappop(live)
        if live:
            if out and out[-1][0] == live[0][1] and out[-1][2] == x:
                out[-1][2] = y
            else:
                out.append([live[0][1], x, y])
    file, contig = (pa.array([k.as_py()] * len(out), pa.string()) for k in key[:2])
    return pa.table([file, contig, *[pa.array([o[k] for o in out], pa.int64()) for k in range(3)]], names=["file", "contig", "block_id", "s", "e"])


def chosen_stretches(first: DataFrame) -> DataFrame:
    """(file, contig, block_id, s, e): which block of a file each stretch of the reference is taken from.

    ``first`` has (file, contig, block_id, score, at, size) of each block's
    reference. Where blocks overlap, the one of the highest score is taken, of
    equal scores the first in the file; a block without a score is the last
    choice. Contigs are worked on in bins, so none passes through one task;
    stretches end at bins' borders.
    """
    spans = first.select("file", "contig", "block_id", "score", F.col("at").alias("s"), (F.col("at") + F.col("size")).alias("e")).filter("e > s")
    bins = F.sequence(F.floor(F.col("s") / CHOICE_BIN).cast("bigint"), F.floor((F.col("e") - 1) / CHOICE_BIN).cast("bigint"))
    parts = spans.withColumn("bin", F.explode(bins))
    parts = parts.withColumns({"s": F.greatest(F.col("s"), F.col("bin") * CHOICE_BIN), "e": F.least(F.col("e"), (F.col("bin") + 1) * CHOICE_BIN)})
    return parts.groupBy("file", "contig", "bin").applyInArrow(_choose, "file string, contig string, block_id bigint, s bigint, e bigint")


def _uncovered(first: DataFrame) -> DataFrame:
    """Records of reference blocks where no block of a file is, on contigs that the file has: base ``N``."""
    spans = first.select("file", "contig", F.col("at").alias("s"), (F.col("at") + F.col("size")).alias("e"))
    whole = first.groupBy("file", "contig").agg(F.max("src_size").alias("e")).select("file", "contig", F.lit(0).cast("bigint").alias("s"), "e")
    left = sweep(lambda n, m: (n > 0) & (m == 0), tagged(whole, spans, keys=("file", "contig")), 2, ("file", "contig"))
    info = F.concat(F.lit("END="), F.col("e").cast("string"))
    return left.select("file", "contig", (F.col("s") + 1).alias("pos"), F.lit("N").alias("ref"), F.lit(vcf.NON_REF).alias("alt"), info.alias("info"))


def maf_to_gvcf(blocks: DataFrame, one_block: bool = False, fill_gaps: bool = False) -> DataFrame:
    """Records (file, contig, pos, ref, alt, info) of alignment blocks as ``sources.maf.parse_blocks`` has them, or rows as ``parse_maf`` has.

    ``one_block`` takes each stretch of the reference from one block of a file
    (``chosen_stretches``); else blocks that overlap all give their records.
    ``fill_gaps`` makes reference blocks of what no block of the file is on.
    """
    if "seq_idx" in blocks.columns:
        blocks = maf.gathered(blocks)
        blocks = stored(blocks, "gathered") if one_block or fill_gaps else blocks
    first = _forward(blocks)
    pairs = first.filter("at is not null").select("file", "block_id", "contig", "at", "reference", F.explode("texts").alias("text"))
    pairs = pairs.filter(F.length("text") == F.length("reference"))
    if one_block:
        kept = chosen_stretches(first).groupBy("file", "block_id").agg(F.sort_array(F.collect_list(F.struct("s", "e"))).alias("kept"))
        pairs = pairs.join(kept, ["file", "block_id"])
    else:
        pairs = pairs.withColumn("kept", F.lit(None).cast("array<struct<s: bigint, e: bigint>>"))
    records = pairs.select("file", "contig", "at", "reference", "text", "kept").mapInArrow(_records, SCHEMA)
    return records.unionByName(_uncovered(first)) if fill_gaps else records


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        files, contigs, references, others = (batch.column(k) for k in (0, 1, 3, 4))
        kept: list[list[tuple[int, int]] | None] = []
        for pieces in batch.column(5).to_pylist() if batch.column(5).null_count < batch.num_rows else ():
            stretches: list[tuple[int, int]] = []
            for piece in pieces or ():  # stretches that go on beyond a bin are one again
                s, e = piece["s"], piece["e"]
                if stretches and stretches[-1][1] == s:
                    s = stretches.pop()[0]
                stretches.append((s, e))
            kept.append(None if pieces is None else stretches)
        starts = np.array(batch.column(2), np.int64)
        for low, high in _portions(np.array(pc.utf8_length(references), np.int64)):
            some = slice(low, high)
            found = _walked(references[some], others[some], starts[some], kept[some] if kept else None)
            yield from _handed_on(files[some], contigs[some], *found)


def _portions(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of pairs of so many columns, of which COLUMNS are compared at once, but for a pair that has more."""
    upto, low = np.cumsum(sizes), 0
    while low < len(sizes):
        high = max(low + 1, int(np.searchsorted(upto, upto[low] - sizes[low] + COLUMNS, "right")))
        yield low, high
        low = high


def _handed_on(files: pa.Array, contigs: pa.Array, own: np.ndarray, pos: np.ndarray, *texts: pa.Array) -> Iterator[pa.RecordBatch]:
    for k in range(0, len(own), RECORDS):
        which = pa.array(own[k : k + RECORDS])
        columns = [files.take(which), contigs.take(which), pa.array(pos[k : k + RECORDS]), *[t.slice(k, RECORDS) for t in texts]]
        yield pa.RecordBatch.from_arrays(columns, ["file", "contig", "pos", "ref", "alt", "info"])


def _of_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same of batches of blocks (file, rows) as they are; see ``_forward``."""
    for batch in batches:
        files, rows = batch.column(0), batch.column(1)
        sizes = np.array(pc.list_value_length(rows), np.int64)
        row = dict(zip([f.name for f in maf.ROW_TYPE], rows.flatten().flatten(), strict=True))
        first = np.cumsum(sizes) - sizes
        start, size, src_size = (row[c].take(pa.array(first)) for c in ("start", "size", "src_size"))
        turned = np.array(pc.fill_null(pc.equal(row["strand"].take(pa.array(first)), "-"), False), dtype=bool)
        at, text = pc.if_else(pa.array(turned), pc.subtract(pc.subtract(src_size, start), size), start), row["text"]
        if turned.any():
            of_turned = pa.array(np.repeat(turned, sizes))
            back = [None if t is None else t.translate(TURNED)[::-1] for t in text.filter(of_turned).to_pylist()]
            text = pc.replace_with_mask(text, of_turned, pa.array(back, pa.string()))
        # Pairs of a block's first sequence and each other, of one length.
        block = np.repeat(np.arange(len(sizes)), sizes)
        other = np.delete(np.arange(len(block)), first)
        length = np.array(pc.fill_null(pc.utf8_length(text), -1), np.int64)
        fits = (length[other] == length[first[block[other]]]) & (length[other] >= 0) & np.array(at.is_valid(), dtype=bool)[block[other]]
        other = other[fits]
        block = block[other]
        starts, contigs = np.array(pc.fill_null(at, 0), np.int64)[block], row["src"]
        for low, high in _portions(length[other]):
            own, to = block[low:high], pa.array(first[block[low:high]])
            found = _walked(text.take(to), text.take(pa.array(other[low:high])), starts[low:high])
            yield from _handed_on(files.take(pa.array(own)), contigs.take(to), *found)


def records_where_read(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``maf_to_gvcf`` of alignment files, without overlaps chosen or gaps filled: a block is walked by the task that reads it."""
    return maf.mapped_blocks(spark, paths, _of_blocks, SCHEMA)


def sample_records(blocks: DataFrame, one_block: bool = False, fill_gaps: bool = False) -> DataFrame:
    """The same as records of VCF_SCHEMA, one sample for each alignment file: ``0`` in blocks, ``1`` at variants.

    ``file`` is the alignment's name without its endings, which is the sample's.
    """
    return called(maf_to_gvcf(blocks, one_block, fill_gaps))


def called(records: DataFrame) -> DataFrame:
    """Records of ``maf_to_gvcf`` as ``sample_records`` has them."""
    rows = records.withColumn("file", F.regexp_extract("file", r"([^/]+?)(?:\.maf)?(?:\.gz)?$", 1))
    call = F.when(F.col("alt") == vcf.NON_REF, "0").otherwise("1")
    return as_records(rows.withColumns({"format": F.lit("GT"), "samples": F.array(call)}))


def trimmed(records: DataFrame) -> DataFrame:
    """Biallelic records without bases that REF and ALT share at the end, then at the beginning, one base kept."""
    both = F.least(F.length("ref"), F.length("alt")) - 1
    same_end = F.aggregate(
        F.sequence(F.lit(1), F.greatest(both, F.lit(1))),
        F.lit(0),
        lambda n, k: F.when((n == k - 1) & (k <= both) & (F.col("ref").substr(-k, F.lit(1)) == F.col("alt").substr(-k, F.lit(1))), k).otherwise(n),
    )
    cut = records.withColumn("__n", same_end)
    cut = cut.withColumns({c: F.col(c).substr(F.lit(1), F.length(c) - F.col("__n")) for c in ("ref", "alt")})
    both = F.least(F.length("ref"), F.length("alt")) - 1
    same_start = F.aggregate(
        F.sequence(F.lit(1), F.greatest(both, F.lit(1))),
        F.lit(0),
        lambda n, k: F.when((n == k - 1) & (k <= both) & (F.col("ref").substr(k, F.lit(1)) == F.col("alt").substr(k, F.lit(1))), k).otherwise(n),
    )
    cut = cut.withColumn("__n", same_start)
    cut = cut.withColumns({c: F.col(c).substr(F.col("__n") + 1, F.length(c)) for c in ("ref", "alt")} | {"pos": F.col("pos") + F.col("__n")})
    return cut.drop("__n")


def shifted(pos: int, alleles: list[str], before: str) -> tuple[int, list[str]]:
    """A record's sequence alleles, the reference first, as far left as ``before``, the reference up to it, allows, without shared bases.

    All alleles roll together: as long as they end with the same base that base
    goes, and where one would be empty all take the base before them.
    """
    if any(a == alleles[0] for a in alleles[1:]):
        return pos, alleles
    while len({a[-1] for a in alleles}) == 1 and (min(map(len, alleles)) > 1 or before):
        alleles = [a[:-1] for a in alleles]
        if not all(alleles):
            pos, base, before = pos - 1, before[-1], before[:-1]
            alleles = [base + a for a in alleles]
    while min(map(len, alleles)) > 1 and len({a[0] for a in alleles}) == 1:
        pos, alleles = pos + 1, [a[1:] for a in alleles]
    return pos, alleles


def _moved(pos: int, ref: str, alt: str, before: str) -> tuple[int, str, str, bool]:
    """``shifted`` for a record's fields, symbols of ALT carried along, and whether it came to the beginning of ``before``."""
    alts = alt.split(",")
    plain = [k for k, a in enumerate(alts) if a != "*" and not a.startswith("<")]
    at, alleles = shifted(pos, [ref.upper(), *[alts[k].upper() for k in plain]], before)
    for k, a in zip(plain, alleles[1:], strict=True):
        alts[k] = a
    return at, alleles[0], ",".join(alts), 0 < len(before) == pos - at and at > 1


def left_aligned(records: DataFrame, reference: DataFrame, chunk: int = 10_000) -> DataFrame:
    """``records`` with indels shifted left against the reference and trimmed.

    ``reference`` has (contig, start, sequence) in pieces of ``chunk`` bases.
    All sequence alleles of a record move together; symbols (``*``, ``<...>``)
    are carried along. Records without a sequence allele, with END, or with other
    letters than bases stay as they are. Records of the same position and
    alleles move alike, so these are worked on once. A round shifts them
    within their piece and the one before; those that reached its beginning go
    on in the next round, until none does.
    """
    pieces = stored(reference.select("contig", (F.col("start") / chunk).cast("bigint").alias("piece"), "sequence"), "reference")
    rows = stored(records.withColumn("__moves", _movable(records)), "records")
    site, own = ("contig", "pos", "ref", "alt"), [F.col(c).alias(f"__{c}") for c in ("pos", "ref", "alt")]
    left, done = rows.filter("__moves").select(*site).distinct().select(*site, *own), None
    while True:
        moved = stored(_shifted_once(left, pieces, chunk), "shifted")
        settled = moved.filter("not __border").drop("__border")
        done = settled if done is None else done.unionByName(settled)
        left = moved.filter("__border").drop("__border")
        if left.isEmpty():
            break
    to = done.select("contig", *[F.col(f"__{c}").alias(c) for c in ("pos", "ref", "alt")], *[F.col(c).alias(f"__{c}") for c in ("pos", "ref", "alt")])
    shifted_rows = rows.filter("__moves").join(to, list(site)).withColumns({c: F.col(f"__{c}") for c in ("pos", "ref", "alt")})
    return rows.filter("not __moves").select(*records.columns).unionByName(shifted_rows.select(*records.columns))


def _movable(records: DataFrame) -> Column:
    """Whether a record has sequence alleles that may move or lose shared bases; single bases have none to lose."""
    alts = F.split("alt", ",")
    sequence = lambda a: a.rlike("^[ACGTNacgtn]+$")
    symbol = lambda a: (a == "*") | a.rlike("^<.*>$")
    plain = sequence(F.col("ref")) & F.exists(alts, sequence) & F.forall(alts, lambda a: sequence(a) | symbol(a)) & F.col("pos").isNotNull()
    if "info" in records.columns:
        plain = plain & vcf.extract_end(F.coalesce("info", F.lit("."))).isNull()
    single = F.col("ref").rlike("^[ACGTN]$") & F.forall(alts, lambda a: a.rlike("^[ACGTN]$") | symbol(a))
    return F.coalesce(plain & ~single, F.lit(False))


def _shifted_once(sites: DataFrame, pieces: DataFrame, chunk: int) -> DataFrame:
    """One round, with ``__border`` for sites that moved as far as the reference at hand went."""
    earlier = pieces.select("contig", (F.col("piece") + 1).alias("piece"), F.col("sequence").alias("earlier"))
    rows = sites.withColumn("piece", F.floor((F.col("pos") - 1) / chunk).cast("bigint"))
    rows = rows.join(pieces, ["contig", "piece"], "left").join(earlier, ["contig", "piece"], "left")
    inside = F.substring("sequence", F.lit(1), ((F.col("pos") - 1) % chunk).cast("int"))
    before = F.upper(F.concat(F.coalesce("earlier", F.lit("")), F.coalesce(inside, F.lit(""))))
    rows = rows.select(*sites.columns, before.alias("before"))
    schema = StructType([*sites.schema.fields, StructField("__border", BooleanType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [_moved(int(pos), ref, alt, before) for pos, ref, alt, before in zip(batch["pos"], batch["ref"], batch["alt"], batch["before"], strict=True)]
            moved = pd.DataFrame(found, columns=["pos", "ref", "alt", "__border"], index=batch.index)
            yield batch.drop(columns="before").assign(**{c: moved[c] for c in moved})

    return rows.mapInPandas(run, schema)
