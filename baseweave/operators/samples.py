"""Outer merge of samples at a locus.

Samples come as records with ``file`` naming the sample. Where any sample of a
contig has a variant there is one row: the longest reference text, all called
alleles in order with the symbol for any other one last, and each sample's
call: its own genotype, ``0`` where one of its reference blocks covers the
position, else ``.``. Between these loci, stretches of reference blocks are
blocks again. A contig has columns for the samples that have records on it.

A contig is cut into bins of positions, and blocks with it. A block is an event
of its sample where it begins and one where it ends. Within a bin events go by
position, and the calls over a stretch are those of the stretch before
with the samples changed that have an event there. Calls are summed up as arrays
over many stretches at once, so the work goes with the calls that are written, and
no sample is a column of its own before its call is.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from baseweave.functions import vcf
from baseweave.sources.tables import as_records

from .intervals import segments
from .mask import mask_spans
from .stored import dealt, stored

CALLS = "contig string, pos bigint, end bigint, ref string, alt string, calls string"
LOCUS_CALLS = pa.schema([("contig", pa.string()), ("pos", pa.int64()), ("ref", pa.string()), ("alt", pa.string()), ("calls", pa.string())])
#: Positions in a bin, fewer where there are many samples, so that a bin's events fit a task.
BIN, LEAST_BIN, BIN_CELLS = 1 << 16, 1 << 10, 1 << 26
COVERED, ABSENT = "0", "."
#: Calls that are worked out at once.
CELLS = 1 << 20


def variants(records: DataFrame) -> DataFrame:
    return records.filter(vcf.extract_end(F.col("info")).isNull() & ~vcf.is_invariant(F.col("alt")))


def reference_blocks(records: DataFrame) -> DataFrame:
    return records.filter(vcf.extract_end(F.col("info")).isNotNull() | vcf.is_invariant(F.col("alt")))


def contig_samples(records: DataFrame) -> DataFrame:
    """(contig, names, size): the samples with records on each contig, in order, and how many records these are; a merged row has their calls in this order."""
    seen = records.groupBy("contig", "file").agg(F.count(F.lit(1)).alias("size"))
    return seen.groupBy("contig").agg(F.sort_array(F.collect_list("file")).alias("names"), F.sum("size").alias("size"))


def sample_names(records: DataFrame) -> list[str]:
    """All samples in order."""
    return sorted(r["file"] for r in records.select("file").distinct().collect())


def _numbered(records: DataFrame, members: DataFrame) -> DataFrame:
    """``records`` with the number ``k`` of their sample among the ``n`` of their contig."""
    return records.join(members.select("contig", F.size("names").alias("n"), F.posexplode("names").alias("k", "file")), ["contig", "file"])


def _width(most: int) -> int:
    """Positions in a bin where a contig has up to ``most`` samples."""
    return max(LEAST_BIN, min(BIN, BIN_CELLS // most))


def _sizes(members: DataFrame) -> tuple[int, int]:
    """How many samples a contig has at most, and how many records all have."""
    most, size = members.agg(F.max(F.size("names")), F.sum("size")).first()
    return most or 1, size or 0


def _bin_of(x: Column, width: int) -> Column:
    return F.floor(x / width).cast("bigint")


def _kinds(numbered: DataFrame) -> DataFrame:
    """``numbered`` records with ``own`` for variants and ``block`` for blocks, which are from ``s`` to ``end``; what a record is, its END and its alleles tell, which are read once."""
    pos = F.col("pos")
    end, alleles = vcf.extract_end(F.col("info")), vcf.called_alleles(F.col("alt"))
    rows = numbered.select("contig", "k", "n", "pos", "ref", "samples", end.alias("fin"), vcf.masked_end(pos, F.col("ref"), F.col("info")).alias("end"), alleles.alias("alleles"))
    none, s = F.size("alleles") == 0, F.greatest(pos - 1, F.lit(0))
    own, block = pos.isNotNull() & F.col("fin").isNull() & ~none, pos.isNotNull() & (F.col("fin").isNotNull() | none) & (F.col("end") > s)
    return rows.select("contig", "k", "n", "pos", "ref", "samples", "end", "alleles", s.alias("s"), own.alias("own"), block.alias("block"))


def _bins_of_block(width: int) -> Column:
    return F.sequence(_bin_of(F.col("s"), width), _bin_of(F.col("end") - 1, width))


def _parts(records: DataFrame, width: int) -> DataFrame:
    """(contig, bin, x, e, k): where in a bin each of a sample's blocks begins and ends."""
    parts = _kinds(records).select("contig", "k", "s", F.col("end").alias("e"), F.explode(F.when(F.col("block"), _bins_of_block(width))).alias("bin"))
    return parts.select("contig", "bin", F.greatest(F.col("s"), F.col("bin") * width).alias("x"), F.least(F.col("e"), (F.col("bin") + 1) * width).alias("e"), "k")


def _swept_blocks(width: int):
    """The calls of ``_sweep`` from rows that have each block once, from ``x`` to ``e``."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        is_block = rows["k"].is_valid()
        blocks, loci = rows.filter(is_block), rows.filter(pc.invert(is_block))
        x, e = rows.schema.get_field_index("x"), rows.schema.get_field_index("e")
        change = lambda part, d: part.set_column(e, "d", pa.array([d] * len(part), pa.int32()))
        ends = blocks.set_column(x, "x", blocks["e"])
        return _sweep(width)(key, pa.concat_tables([change(blocks, 1), change(ends, -1), change(loci, None)]))

    return run


def _sweep(width: int):
    """Calls of one bin: a row for each locus, and for each stretch between loci over which some sample has a block.

    Rows with ``k`` tell by how much (``d``) the number of a sample's blocks changes at ``x``, those without are loci.
    """

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        contig, start = key[0].as_py(), key[1].as_py() * width
        n = rows["n"][0].as_py()
        is_event = np.array(rows["k"].is_valid())
        events, loci = rows.filter(pa.array(is_event)), rows.filter(pa.array(~is_event)).sort_by("x")
        at, k, d = (np.array(events[c].cast(pa.int64())) for c in ("x", "k", "d"))
        order = np.argsort(at, kind="stable")
        at, k, d = at[order], k[order], d[order]
        locus_at = np.array(loci["x"].cast(pa.int64()))
        # Own genotypes of all loci one after another: whose locus and sample each is. Calls are taken from these and the two others.
        ks, gts = (loci[c].combine_chunks() for c in ("ks", "gts"))
        first = np.append(0, np.cumsum(np.array(pc.list_value_length(ks), np.int64)))
        own_locus, own_k, gts = np.repeat(np.arange(len(ks)), np.diff(first)), np.array(ks.flatten(), np.int64), gts.flatten()
        is_own = np.array(gts.is_valid(), bool)
        choices = pa.concat_arrays([pa.array([COVERED, ABSENT]), gts.cast(pa.string())])
        cuts = np.unique(np.concatenate([at, locus_at, locus_at + 1]))
        cuts = cuts[cuts <= start + width]
        begins, ends = np.searchsorted(at, cuts, "left"), np.searchsorted(at, cuts, "right")
        locus = np.searchsorted(locus_at, cuts)
        is_locus = np.append(locus_at, -1)[locus] == cuts
        m, of = len(cuts), np.searchsorted(cuts, at)
        last = np.arange(m) + 1 == m
        block, goes_on = np.zeros(m, bool), np.zeros(m, bool)
        rows_of, texts = [np.zeros(0, np.int64)], [pa.array([], pa.string())]
        counts, held, step = np.zeros(n, np.int32), np.zeros(n, bool), max(1, CELLS // n)
        for low in range(0, m, step):
            high = min(m, low + step)
            change, seen = np.zeros((high - low, n), np.int32), slice(begins[low], ends[high - 1])
            np.add.at(change, (of[seen] - low, k[seen]), d[seen])
            change[0] += counts
            running = np.cumsum(change, axis=0)
            over, counts = running > 0, running[-1]
            here = slice(low, high)
            block[here] = over.any(axis=1) & ~is_locus[here] & ~last[here]
            same = (over == np.vstack([held[None], over[:-1]])).all(axis=1)
            before = np.append(block[low - 1] if low else False, block[low : high - 1])
            goes_on[here], held = block[here] & before & same, over[-1]
            wanted = np.flatnonzero(is_locus[here] | (block[here] & ~goes_on[here]))
            call = np.where(over[wanted], 0, 1)
            at_locus = np.flatnonzero(is_locus[here][wanted])
            if len(at_locus):
                j = locus[low + wanted[at_locus]]  # one after another
                own = slice(first[j[0]], first[j[-1] + 1])
                own = np.flatnonzero(is_own[own]) + own.start
                call[at_locus[own_locus[own] - j[0]], own_k[own]] = 2 + own
            offsets = pa.array(np.arange(len(wanted) + 1) * n, pa.int32())
            texts.append(pc.binary_join(pa.ListArray.from_arrays(offsets, choices.take(pa.array(call.ravel()))), "\t"))
            rows_of.append(low + wanted)
        stays = np.append(np.flatnonzero(~goes_on), m)
        stops = np.minimum(stays[np.searchsorted(stays, np.arange(m), "right")], m - 1)
        out = np.concatenate(rows_of)
        is_call = is_locus[out]
        which = pa.array(locus[out], mask=~is_call)
        end = pa.array(cuts[stops[out]], pa.int64(), mask=is_call)
        refs, alts = (loci[c].combine_chunks().cast(pa.string()).take(which) for c in ("ref", "alt"))
        columns = [pa.array(cuts[out] + 1, pa.int64()), end, refs, alts, pa.concat_arrays(texts)]
        return pa.table([pa.array([contig] * len(out), pa.string()), *columns], names=["contig", "pos", "end", "ref", "alt", "calls"])

    return run


def _joined(calls: DataFrame, width: int) -> DataFrame:
    """``calls`` with blocks that go on beyond their bin as one; of a bin these are two at most."""
    border = F.col("end").isNotNull() & (((F.col("pos") - 1) % width == 0) | (F.col("end") % width == 0))
    along = Window.partitionBy("contig").orderBy("pos")
    cut = calls.filter(border)
    goes_on = (F.lag("end").over(along) == F.col("pos") - 1) & (F.lag("calls").over(along) == F.col("calls"))
    cut = cut.withColumn("chain", F.sum(F.when(F.coalesce(goes_on, F.lit(False)), 0).otherwise(1)).over(along))
    whole = cut.groupBy("contig", "chain").agg(F.min("pos").alias("pos"), F.max("end").alias("end"), F.first("calls").alias("calls"))
    none = F.lit(None).cast("string")
    return calls.filter(~border).unionByName(whole.select("contig", "pos", "end", none.alias("ref"), none.alias("alt"), "calls"))


def _first_of_each(found: str) -> Column:
    """Of an array of structs in order of their sample ``k``, the first of each sample."""
    return F.filter(found, lambda s, i: (i == 0) | (F.get(F.col(found), i - 1)["k"] != s["k"]))


def _called(records: DataFrame, loci: DataFrame, members: DataFrame) -> DataFrame:
    """Rows of CALLS, calls parted by tabs: loci (without ``end``), and blocks between them from ``pos`` to ``end``.

    ``records`` are numbered, ``loci`` have (contig, pos, ref, alt, ks, gts): the numbers of samples and their own genotypes.
    """
    most, size = _sizes(members)
    width = _width(most)
    blocks = _parts(records, width)
    absent = {"ref": "string", "alt": "string", "ks": "array<int>", "gts": "array<string>"}
    blocks = blocks.select("*", *[F.lit(None).cast(t).alias(c) for c, t in absent.items()])
    x = F.col("pos") - 1
    at = loci.select("contig", _bin_of(x, width).alias("bin"), x.alias("x"), F.lit(None).cast("bigint").alias("e"), F.lit(None).cast("int").alias("k"), *absent)
    sizes = members.select("contig", F.size("names").alias("n"))
    found = dealt(blocks.unionByName(at).join(sizes, "contig"), size, "contig", "bin").groupBy("contig", "bin").applyInArrow(_swept_blocks(width), CALLS)
    return _joined(stored(found, "calls"), width)


def _in_bins(numbered: DataFrame, width: int) -> DataFrame:
    """(contig, bin, x, e, k, n, ref, alt, gt): variants with their called alleles and genotype, and blocks, which have ``e``, as parts of bins.

    Records that are neither have no bin.
    """
    x = F.col("pos") - 1
    bins = F.when(F.col("own"), F.array(_bin_of(x, width))).when(F.col("block"), _bins_of_block(width))
    parts = _kinds(numbered).select("contig", "k", "n", "pos", "ref", "samples", "s", "end", "alleles", "own", F.explode(bins).alias("bin"))
    of = lambda c: F.when(F.col("own"), c)
    at = of(x).otherwise(F.greatest("s", F.col("bin") * width)).alias("x")
    stop = F.when(~F.col("own"), F.least("end", (F.col("bin") + 1) * width)).alias("e")
    gt = of(vcf.genotype(F.element_at("samples", 1))).alias("gt")
    return parts.select("contig", "bin", at, stop, "k", "n", of(F.col("ref")).alias("ref"), of(F.array_join("alleles", ",")).alias("alt"), gt)


def _ranked(texts: pa.ChunkedArray, key) -> tuple[np.ndarray, list]:
    """The number of each text among the different ones in the order of ``key``, and these; null is one of them."""
    found = texts.combine_chunks().dictionary_encode("encode")
    values = found.dictionary.to_pylist()
    order = sorted(range(len(values)), key=lambda i: key(values[i]))
    rank = np.empty(len(values), np.int64)
    rank[order] = np.arange(len(values))
    return rank[np.array(found.indices, np.int64)], [values[i] for i in order]


def _spread(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers of each stretch that has ``size`` numbers from ``first`` on, one stretch after another."""
    return np.arange(size.sum()) + np.repeat(first - np.cumsum(size) + size, size)


def _all_alleles(of: np.ndarray, m: int, alts: pa.ChunkedArray) -> pa.Array:
    """For each of ``m`` loci the alleles of its records (``of``: whose) in order, and the symbol for any other one."""
    code, texts = _ranked(alts, lambda t: t or "")
    each = [[] if t is None else t.split(",") for t in texts]
    names = sorted({a for own in each for a in own})
    number = {a: i for i, a in enumerate(names)}
    size = np.array([len(own) for own in each], np.int64)
    flat = np.array([number[a] for own in each for a in own], np.int64)
    seen = np.unique(of * len(texts) + code)
    locus, code = seen // len(texts), seen % len(texts)
    first, width = np.cumsum(size) - size, len(names) + 1
    pairs = np.repeat(locus, size[code]) * width + flat[_spread(first[code], size[code])]
    pairs = np.unique(np.concatenate([pairs, np.arange(m) * width + len(names)]))
    offsets = pa.array(np.searchsorted(pairs, np.arange(m + 1) * width), pa.int32())
    return pc.binary_join(pa.ListArray.from_arrays(offsets, pa.array([*names, vcf.NON_REF]).take(pa.array(pairs % width))), ",")


def _locus_calls(key: tuple, rows: pa.Table) -> pa.Table:
    """Loci of one bin with the call of each sample: its own, or whether a block of its is over the locus."""
    n = rows["n"][0].as_py()
    is_block = rows["e"].is_valid()
    blocks, own = rows.filter(is_block), rows.filter(pc.invert(is_block))
    if not len(own):
        return pa.Table.from_pylist([], schema=LOCUS_CALLS)
    at, of = np.unique(np.array(own["x"], np.int64), return_inverse=True)
    m = len(at)
    rank, refs = _ranked(own["ref"], lambda r: (r is not None, len(r or ""), r or ""))
    longest = np.zeros(m, np.int64)
    np.maximum.at(longest, of, rank)
    # Of a sample's genotypes at a locus the first by text.
    rank, gts = _ranked(own["gt"], lambda t: (t is None, t or ""))
    cell = of * n + np.array(own["k"], np.int64)
    called = np.flatnonzero(np.array(own["gt"].is_valid()))
    called = called[np.lexsort((rank[called], cell[called]))]
    cells, nth = np.unique(cell[called], return_index=True)
    choice = 2 + rank[called[nth]]
    choices = pa.array([COVERED, ABSENT, *gts], pa.string())
    # Blocks that begin up to a position less those that end there; samples stand one after another, so other samples' cancel out.
    begin, end, k = (np.array(blocks[c], np.int64) for c in ("x", "e", "k"))
    low = min(at[0], begin.min(initial=at[0]))
    span = max(at[-1], end.max(initial=at[-1])) - low + 1
    begins, ends = np.sort(k * span + begin - low), np.sort(k * span + end - low)
    texts, step = [], max(1, CELLS // n)
    for a in range(0, m, step):
        b = min(m, a + step)
        points = (np.arange(n) * span + (at[a:b] - low)[:, None]).ravel()
        call = np.where(np.searchsorted(begins, points, "right") > np.searchsorted(ends, points, "right"), 0, 1)
        here = slice(*np.searchsorted(cells, [a * n, b * n]))
        call[cells[here] - a * n] = choice[here]
        offsets = pa.array(np.arange(b - a + 1) * n, pa.int32())
        texts.append(pc.binary_join(pa.ListArray.from_arrays(offsets, choices.take(pa.array(call))), "\t"))
    columns = [pa.array([key[0].as_py()] * m, pa.string()), pa.array(at + 1), pa.array(refs, pa.string()).take(pa.array(longest)), _all_alleles(of, m, own["alt"]), pa.concat_arrays(texts)]
    return pa.Table.from_arrays(columns, schema=LOCUS_CALLS)


def merge_samples(records: DataFrame) -> DataFrame:
    """(contig, pos, ref, alt, calls): each sample's own genotype as it stands, by sample of the contig.

    Blocks between loci are not asked for, so records meet in their bin as they are, and in one shuffle.
    """
    members = stored(contig_samples(records), "members")
    most, size = _sizes(members)
    parts = _in_bins(_numbered(records, members), _width(most))
    found = dealt(parts, size, "contig", "bin").groupBy("contig", "bin").applyInArrow(_locus_calls, from_arrow_schema(LOCUS_CALLS)).join(members, "contig")
    return found.select("contig", "pos", "ref", "alt", F.map_from_arrays("names", F.split("calls", "\t", -1)).alias("calls"))


def _longer(allele: Column, ref: Column, longest: Column) -> Column:
    """An allele of ``ref`` as one of the locus's longest reference; symbols stay."""
    return F.when(allele.rlike("^[ACGTNacgtn]+$"), F.concat(allele, F.substr(longest, F.length(ref) + 1))).otherwise(allele)


def _renumbered(gt: Column, own: Column, every: Column) -> Column:
    """A genotype by the locus's alleles instead of the sample's own; an allele that is not called there is ``.``."""
    number = lambda t: F.array_position(every, F.get(own, t.try_cast("int") - 1)).cast("string")
    parts = F.transform(F.split(gt, "(?<=[/|])|(?=[/|])"), lambda t: F.when(t.rlike("^[1-9][0-9]*$"), F.coalesce(number(t), F.lit("."))).otherwise(t))
    return F.array_join(parts, "")


def merged_records(records: DataFrame, file: str = "merged", members: DataFrame | None = None) -> DataFrame:
    """One gVCF of all samples, as records like any others: loci with variants, and blocks with END between them.

    Alleles are those of the longest reference of a locus, and genotypes are
    numbered by them. A contig's rows have the samples of ``contig_samples`` in
    order (``members`` saves looking for them again); a sample without the
    contig has no column there. A block is one stretch over which the same
    samples have blocks; its base is not known here and is ``N``. Of several
    variant records of a sample at one position the first by reference,
    alternatives and genotype gives the call. Without records there are no rows.
    """
    members = members if members is not None else stored(contig_samples(records), "members")
    numbered = _numbered(records, members)
    gt = vcf.genotype(F.element_at("samples", 1)).alias("gt")
    called = variants(numbered).filter("pos is not null").select("k", "contig", "pos", "ref", vcf.called_alleles(F.col("alt")).alias("alleles"), gt)
    _, size = _sizes(members)
    called = dealt(called.repartition("contig", "pos"), size, "contig", "pos")
    loci = called.groupBy("contig", "pos").agg(F.sort_array(F.collect_set(F.struct("k", F.struct("ref", "alleles", "gt").alias("call")))).alias("each"))
    seen = F.array_distinct(F.transform("each", lambda s: s["call"].dropFields("gt")))
    loci = loci.select("contig", "pos", seen.alias("seen"), _first_of_each("each").alias("each"))
    longest = F.array_max(F.transform("seen", lambda r: F.struct(F.length(r["ref"]).alias("n"), r["ref"].alias("ref"))))["ref"]
    loci = loci.select("contig", "pos", longest.alias("ref"), "seen", "each")
    every = F.flatten(F.transform("seen", lambda r: F.transform(r["alleles"], lambda a: _longer(a, r["ref"], F.col("ref")))))
    loci = loci.withColumn("every", F.sort_array(F.array_distinct(every)))
    own = lambda c: F.transform(c["alleles"], lambda a: _longer(a, c["ref"], F.col("ref")))
    gts = F.transform("each", lambda s: _renumbered(s["call"]["gt"], own(s["call"]), F.col("every")))
    alt = F.array_join(F.concat("every", F.array(F.lit(vcf.NON_REF))), ",")
    found = _called(numbered, loci.select("contig", "pos", "ref", alt.alias("alt"), F.col("each.k").alias("ks"), gts.alias("gts")), members)
    info = F.when(F.col("end").isNull(), ".").otherwise(F.concat(F.lit("END="), F.col("end").cast("string")))
    rows = found.select("contig", "pos", F.coalesce("ref", F.lit("N")).alias("ref"), F.coalesce("alt", F.lit(vcf.NON_REF)).alias("alt"), info.alias("info"), F.split("calls", "\t", -1).alias("samples"))
    return as_records(rows.withColumns({"file": F.lit(file), "format": F.lit("GT")}))


def joint_blocks(records: DataFrame) -> DataFrame:
    """(contig, s, e, n_samples): stretches of reference blocks by the number of blocks over them."""
    return segments(mask_spans(reference_blocks(records))).filter("n0 > 0").withColumnRenamed("n0", "n_samples")
