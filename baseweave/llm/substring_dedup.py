"""Removal of passages that an earlier document has, by FM-indexes of shards.

A window is 13 words. Its anchor is the smallest hash among its runs of five
words, so equal windows have equal anchors wherever they stand. Neighbouring
windows of one anchor form a segment, and segments are dealt to shards by their
anchor: equal windows meet in one shard, and work grows with the input only.

1. Segments' anchors (not their words) are dealt out. An anchor of one document
   only cannot belong to a repeated window, and goes no further. Of segments
   with the same words, the smallest document's stands for all, first within a
   task's batch, then within the shard; the others wait for what is found of it.
2. The words of the segments that stand for all are dealt to their shards. A shard
   builds a compressed FM-index of them and streams each of them through it.
   Backward search gives for each place the longest match, up to 13 words (matching
   statistics are followed to the threshold and no further), and the interval of
   suffixes that begin with it; the smallest owner there tells whether an earlier
   document has these words. Stretches of such places are reported.
3. A segment that waited loses the stretches in which the one that stands for it
   was matched: those have an earlier owner. Reports go back to the shard's copies
   and, batch by batch, to those that never left their batch, so no number of
   copies meets in one task.
4. Reports meet their documents, where they are checked against the text.

Segments travel packed, many to a row; a shard holds about ``shard_bytes`` of
text, so the number of shards grows with the input. A passage that very many
documents have in different surroundings would crowd the shards of its anchors.
Anchors are therefore counted first, in a fixed number of slots; windows of a
crowded slot go by the hash of all their words instead, wherever they stand.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .fm_index import FMIndex
from .words import Words, hashed_words, mixed, runs_of

WIDTH, ANCHOR = 13, 5
#: Slots of anchor counts: a constant, so they fit the driver and a broadcast.
SLOTS = 1 << 18
#: Records of a task that are combined at once.
COMBINED = 200_000
#: Windows in a segment at most; longer runs, as of one word repeated, are cut into several segments.
LONGEST = 64
#: Set in the length of a segment that others of its batch wait for.
WAITED = 1 << 15
#: Two segments count as equal by 96 bits of two hashes: among 10 ** 12 segments not one false pair is to be expected (6e-6).
SEEN = np.dtype([("anchor", "<u4"), ("length", "<u2"), ("start", "<i4"), ("doc", "<i8"), ("content", "<u8"), ("check", "<u4")])
_ODD = np.array([0xD1342543DE82EF95, 0xAF251AF3B0F025B5], np.uint64)
_PART = [("doc", "<i8"), ("start", "<i4"), ("length", "<i4"), ("content", "<u8")]
#: A segment: its document, first word there, number of words and hash.
PLACED = np.dtype(_PART)
#: A segment to index in a shard.
SEGMENT = np.dtype([*_PART, ("shard", "<i4")])
#: A segment that waits in its batch for the one at ``place`` of what the batch sent to ``shard``.
CLAIM = np.dtype([*_PART, ("shard", "<i4"), ("place", "<i4")])
#: A segment that waits in its shard, or (``own``) one that stands for others; ``place`` tells who waits for it in its batch, -1 nobody.
COPY = np.dtype([*_PART, ("batch", "<i8"), ("place", "<i4"), ("own", "u1")])
#: Words ``begin`` to ``end`` of the segment at ``place`` of a batch's records of ``shard`` were matched.
FOUND = np.dtype([("shard", "<i4"), ("place", "<i4"), ("begin", "<i4"), ("end", "<i4")])
#: Words ``begin`` to ``end`` of a document go, provided that the segment there is the one meant.
REMOVAL = np.dtype([*_PART, ("begin", "<i4"), ("end", "<i4")])


def _contents(words: Words, begin: np.ndarray, length: np.ndarray, salt: int = 0) -> np.ndarray:
    """A hash of each run of eight words or more, made of hashes of eight words that follow each other."""
    eight = words.hashes
    for step in (1, 2, 4):
        eight = mixed(eight[:-step] * _ODD[salt] + eight[step:], salt)
    state = mixed(length.astype(np.uint64), salt)
    live = np.arange(len(begin))
    for k in range(0, int(length.max(initial=0)), 8):
        live = live[length[live] > k]
        state[live] = mixed(state[live] ^ eight[begin[live] + np.minimum(k, length[live] - 8)])
    return state


def _slot(anchor: np.ndarray) -> np.ndarray:
    return (anchor >> np.uint64(46)).astype(np.int64)


def segments(words: Words, crowded: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, first word in the chunk, number of words and anchor of each segment.

    Where an anchor's slot is ``crowded``, each window is a segment of its own
    and its anchor is the hash of all its words.
    """
    none = np.zeros(0, np.int64)
    anchors = runs_of(words.hashes, ANCHOR)
    if len(words.hashes) < WIDTH:
        return none, none, none, none.astype(np.uint64)
    two = np.minimum(anchors[:-1], anchors[1:])
    four = np.minimum(two[:-2], two[2:])
    eight = np.minimum(four[:-4], four[4:])
    least = np.minimum(eight[:-1], anchors[8:])
    text = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
    at = np.flatnonzero(text[: len(least)] == text[WIDTH - 1 :])
    if not len(at):
        return none, none, none, none.astype(np.uint64)
    anchor = mixed(least[at])
    new = np.ones(len(at), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1)
    run = np.flatnonzero(new)
    new |= (np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))) % LONGEST == 0
    if crowded is not None and crowded.any():
        alone = crowded[_slot(anchor)]
        new |= alone
        anchor[alone] = runs_of(words.hashes, WIDTH)[at[alone]]
    run = np.flatnonzero(new)
    length = np.diff(np.append(run, len(at))) + WIDTH - 1
    return text[at[run]], at[run], length, anchor[run]


def _crowds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many segments of a task's texts have their anchor in each slot; slot -1 has the bytes of text."""
    total, n_bytes = np.zeros(SLOTS, np.int64), 0
    for batch in batches:
        for _, _, words in hashed_words(batch.column(0), lower=False):
            n_bytes += len(words.data)
            total += np.bincount(_slot(segments(words)[3]), minlength=SLOTS)
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1)), pa.array(np.append(total[some], n_bytes))], ["slot", "n"])


def _packed(key: np.ndarray, *columns: np.ndarray) -> list[pa.Array]:
    """A row for each key: the key and its records of each column, which follow each other in ``key``'s order."""
    every, row = np.unique(key, return_inverse=True)
    parts, at = [], 0
    for records in columns:
        own = row[at : at + len(records)]
        order = np.argsort(own, kind="stable")
        cuts = np.searchsorted(own[order], np.arange(len(every) + 1))
        records, at = records[order], at + len(records)
        parts.append(pa.array([records[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary()))
    return [pa.array(every), *parts]


def _records(parts: pa.ChunkedArray | pa.Array, dtype: np.dtype) -> np.ndarray:
    return np.frombuffer(b"".join(p for p in parts.to_pylist() if p), dtype)


def _table(schema: str, **columns: pa.Array) -> pa.RecordBatch:
    """Rows of ``schema`` ("name type, ..."), null in the columns that are not given."""
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    n = len(next(iter(columns.values())))
    found = [(name, columns[name].cast(kinds[kind]) if name in columns else pa.nulls(n, kinds[kind])) for name, kind in (c.split() for c in schema.split(", "))]
    return pa.RecordBatch.from_arrays([c for _, c in found], [name for name, _ in found])


SENT = "shard int, batch long, seen binary, claims binary"


def _seen(shards: int, crowded):
    """Segments' anchors, packed by shard. Of equal segments of a batch the smallest document's stands for all.

    The others wait in their batch, as rows under a key below 0, so copies do not
    pile up in a shard.
    """

    def combined(batch: int, shard: list[np.ndarray], records: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        key, found = np.concatenate(shard), np.concatenate(records)
        order, copy, first = _copies(found)
        key, found = key[order], found[order]
        ahead = np.cumsum(~copy) - 1
        stands = np.unique(ahead[first[copy]])
        sent, sent_key, waiting = found[~copy], key[~copy], found[copy]
        sent["length"][stands] |= WAITED
        by_key = np.argsort(sent_key, kind="stable")
        begin = _runs(sent_key[by_key])
        place = np.empty(len(sent), np.int64)
        place[by_key] = np.arange(len(sent)) - np.repeat(begin, np.diff(np.append(begin, len(sent))))
        shards_sent, seen = _packed(sent_key, sent)
        yield _table(SENT, shard=shards_sent, batch=pa.array([batch] * len(seen), pa.int64()), seen=seen)
        if len(waiting):
            claims = _as(CLAIM, waiting)
            of = ahead[first[copy]]
            claims["shard"], claims["place"] = sent_key[of], place[of]
            yield _table(SENT, shard=pa.array([-1 - batch % shards]), batch=pa.array([batch], pa.int64()), claims=pa.array([claims.tobytes()], pa.binary()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, records, n, number = [], [], 0, TaskContext.get().partitionId() << 32
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for at, to, words in hashed_words(batch.column(1), lower=False):
                text, begin, length, anchor = segments(words, crowded.value)
                own = np.empty(len(text), SEEN)
                own["anchor"], own["length"], own["doc"] = anchor >> np.uint64(32), length, ids[at:to][text]
                own["start"] = begin - words.first[text]
                own["content"], own["check"] = _contents(words, begin, length), _contents(words, begin, length, 1) >> np.uint64(32)
                shard.append(((anchor & np.uint64(0xFFFFFFFF)) % np.uint64(shards)).astype(np.int64))
                records.append(own)
                n += len(own)
                if n >= COMBINED:
                    yield from combined(number, shard, records)
                    shard, records, n, number = [], [], 0, number + 1
        if n:
            yield from combined(number, shard, records)

    return run


def _copies(seen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order by content and document, and in it which segments a smaller document has too, and where the first equal one is."""
    order = np.lexsort([seen["doc"], seen["check"], seen["content"]])
    begin = _runs(seen["content"][order], seen["check"][order])
    doc = seen["doc"][order]
    first = np.repeat(begin, np.diff(np.append(begin, len(doc))))
    return order, doc > doc[first], first


def _as(dtype: np.dtype, records: np.ndarray) -> np.ndarray:
    """Records of another kind with the same segments."""
    out = np.zeros(len(records), dtype)
    for name, _ in _PART:
        out[name] = records[name]
    if records.dtype == SEEN:
        out["length"] &= WAITED - 1
    return out


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Where each run of rows with equal values begins."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for values in columns:
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


MARKS = "bucket int, segments binary, shard int, copies binary, batch long, claims binary"


def _shared(buckets: int):
    """Of a shard's anchors those of several documents: segments to index, and those that wait for them; what waits in batches goes through."""

    def run(rows: pa.Table) -> pa.Table:
        shard = rows["shard"][0].as_py()
        if shard < 0:
            return pa.Table.from_batches([_table(MARKS, batch=rows["batch"].combine_chunks(), claims=rows["claims"].combine_chunks())])
        parts = [np.frombuffer(x, SEEN) for x in rows["seen"].to_pylist()]
        seen, batch = np.concatenate(parts), np.repeat(np.array(rows["batch"]), [len(x) for x in parts])
        place = np.concatenate([np.arange(len(x)) for x in parts])
        by_anchor = np.argsort(seen["anchor"], kind="stable")
        seen, batch, place = seen[by_anchor], batch[by_anchor], place[by_anchor]
        begin = _runs(seen["anchor"])
        several = np.minimum.reduceat(seen["doc"], begin) < np.maximum.reduceat(seen["doc"], begin) if len(begin) else np.zeros(0, bool)
        several = np.repeat(several, np.diff(np.append(begin, len(seen))))
        # What waits in a batch is of another document, though the shard may have seen one only.
        several |= seen["length"] >= WAITED
        seen, batch, place = seen[several], batch[several], place[several]
        order, copy, _ = _copies(seen)
        seen, batch, place = seen[order], batch[order], place[order]
        own = _as(SEGMENT, seen[~copy])
        own["shard"] = shard
        waited = seen["length"] >= WAITED
        some = copy | waited
        copies = _as(COPY, seen[some])
        copies["batch"], copies["place"], copies["own"] = batch[some], np.where(waited, place, -1)[some], ~copy[some]
        keys, packed = _packed(own["doc"] % buckets, own)
        out = [_table(MARKS, bucket=keys, segments=packed)]
        if len(copies):
            out.append(_table(MARKS, shard=pa.array([shard]), copies=pa.array([copies.tobytes()], pa.binary())))
        return pa.Table.from_batches(out)

    return run


def _there(words: Words, ids: np.ndarray, records: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text and record for the records, sorted by document, whose segment is really there; rows of one id may differ."""
    low, high = np.searchsorted(records["doc"], ids, "left"), np.searchsorted(records["doc"], ids, "right")
    n = high - low
    text = np.repeat(np.arange(len(ids)), n)
    records = records[np.repeat(low - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())]
    begin, length = words.first[text] + records["start"], records["length"].astype(np.int64)
    inside = begin + length <= words.first[text + 1]
    text, records, begin, length = text[inside], records[inside], begin[inside], length[inside]
    same = _contents(words, begin, length) == records["content"]
    return text[same], records[same]


def _texts(rows: pa.Table, records: np.ndarray) -> Iterator[tuple[int, int, Words, np.ndarray, np.ndarray]]:
    """Runs of a bucket's texts with their words and the records that are theirs."""
    ids = rows["doc_id"].combine_chunks()
    known, ids = ids.is_valid().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()
    records = records[np.argsort(records["doc"], kind="stable")]
    for at, to, words in hashed_words(rows["text"].combine_chunks(), lower=False):
        text, own = _there(words, ids[at:to], records)
        has_id = known[at:to][text]
        yield at, to, words, text[has_id], own[has_id]


def _words_out(rows: pa.Table, marks: pa.Table) -> pa.Table:
    """The words of a bucket's segments to index, packed by shard: segments' records, and their words."""
    shard, placed, hashes, lengths = [np.zeros(0, np.int32)], [np.zeros(0, PLACED)], [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for _, _, words, text, own in _texts(rows, _records(marks["segments"], SEGMENT)):
        begin, length = words.first[text] + own["start"], own["length"].astype(np.int64)
        hashes.append(words.hashes[np.repeat(begin - np.concatenate([[0], np.cumsum(length)[:-1]]), length) + np.arange(length.sum())])
        lengths.append(length)
        shard.append(own["shard"])
        part = np.empty(len(own), PLACED)
        for name, _ in _PART:
            part[name] = own[name]
        placed.append(part)
    shard, placed, hashes, lengths = (np.concatenate(x) for x in (shard, placed, hashes, lengths))
    keys = np.concatenate([shard, np.repeat(shard, lengths)])
    shards, placed, hashes = _packed(keys, placed, hashes)
    return pa.Table.from_batches([_table("shard int, placed binary, words binary", shard=shards, placed=placed, words=hashes)])


REPORTS = "bucket int, removals binary, batch long, found binary"


def _searched(buckets: int):
    """Index a shard's segments, stream them through the index, report the stretches that smaller documents have."""

    def run(rows: pa.Table, waiting: pa.Table) -> pa.Table:
        placed = _records(rows["placed"], PLACED)
        words, length = _records(rows["words"], np.dtype("<u8")), placed["length"].astype(np.int64)
        _, number = np.unique(placed["doc"], return_inverse=True)
        index = FMIndex(words, length, number.ravel(), WIDTH)
        longest, owner = index.matches(words, length)
        of = np.repeat(np.arange(len(placed)), length)
        begins = np.cumsum(length) - length

        def stretches(at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            """Segment, first word in it and end of each run of places from which 13 words match."""
            run = _runs(at - np.arange(len(at)), of[at])
            last = at[np.append(run[1:], len(at))[: len(run)] - 1] if len(run) else at
            segment = of[at[run]]
            return segment, at[run] - begins[segment], last - begins[segment] + WIDTH

        # From these places on 13 words match, and some match is a smaller document's.
        segment, begin, end = stretches(np.flatnonzero((longest >= WIDTH) & (owner < number.ravel()[of])))
        gone = _as(REMOVAL, placed[segment])
        gone["begin"], gone["end"] = gone["start"] + begin, gone["start"] + end
        # What waits for a segment is of a larger document than that, so wherever it is matched an earlier document has it.
        copies = _records(waiting["copies"], COPY)
        segment, begin, end = stretches(np.flatnonzero(longest >= WIDTH))
        content = np.argsort(placed["content"], kind="stable")
        at = np.searchsorted(placed["content"][content], copies["content"])
        known = at < len(content)
        known[known] = placed["content"][content[at[known]]] == copies["content"][known]
        copies, stands = copies[known], content[at[known]]
        low, high = np.searchsorted(segment, stands, "left"), np.searchsorted(segment, stands, "right")
        which, nth = _expanded(low, high)
        copies, begin, end = copies[which], begin[nth], end[nth]
        late = (copies["own"] == 0) & (copies["doc"] > placed["doc"][stands[which]])
        lost = _as(REMOVAL, copies[late])
        lost["begin"], lost["end"] = lost["start"] + begin[late], lost["start"] + end[late]
        gone = np.concatenate([gone, lost])
        keys, removals = _packed(gone["doc"] % buckets, gone)
        waits = copies["place"] >= 0
        found = np.zeros(int(waits.sum()), FOUND)
        found["shard"] = rows["shard"][0].as_py() if len(rows) else 0
        found["place"], found["begin"], found["end"] = copies["place"][waits], begin[waits], end[waits]
        batches, packed = _packed(copies["batch"][waits], found)
        return pa.Table.from_batches([_table(REPORTS, bucket=keys, removals=removals), _table(REPORTS, batch=batches, found=packed)])

    return run


def _expanded(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each number from each ``low`` to its ``high``, and which of them it is of."""
    n = high - low
    which = np.repeat(np.arange(len(n)), n)
    return which, np.repeat(low - np.concatenate([[0], np.cumsum(n)[:-1]]).astype(np.int64), n) + np.arange(n.sum())


def _answered(buckets: int):
    """Removals of what waits in a batch, from what was found of the segments it waits for."""

    def run(rows: pa.Table, reports: pa.Table) -> pa.Table:
        claims, found = _records(rows["claims"], CLAIM), _records(reports["found"], FOUND)
        key = lambda x: (x["shard"].astype(np.int64) << 32) + x["place"]
        found = found[np.argsort(key(found), kind="stable")]
        which, nth = _expanded(np.searchsorted(key(found), key(claims), "left"), np.searchsorted(key(found), key(claims), "right"))
        gone = _as(REMOVAL, claims[which])
        gone["begin"], gone["end"] = gone["start"] + found["begin"][nth], gone["start"] + found["end"][nth]
        keys, removals = _packed(gone["doc"] % buckets, gone)
        return pa.Table.from_batches([_table("bucket int, removals binary", bucket=keys, removals=removals)])

    return run


def _untouched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows that keep all their words."""
    none = pa.table({"removals": pa.array([], pa.binary())})
    for batch in batches:
        yield from _kept(pa.Table.from_batches([batch]), none).to_batches()


def _kept(rows: pa.Table, removals: pa.Table) -> pa.Table:
    n_words, n_removed, digest, kept_text = [], [], [], []
    for _, _, words, text, gone in _texts(rows, _records(removals["removals"], REMOVAL)):
        edges = np.zeros(len(words.hashes) + 1, np.int64)
        np.add.at(edges, words.first[text] + gone["begin"], 1)
        np.add.at(edges, words.first[text] + gone["end"], -1)
        stays = (np.cumsum(edges) == 0).tolist()
        raw = words.data.tobytes()
        for k in range(len(words.first) - 1):
            split = raw[words.offsets[k] : words.offsets[k + 1]].split()
            kept = list(compress(split, stays[words.first[k] : words.first[k + 1]]))
            whole = b" ".join(kept)
            n_words.append(len(split))
            n_removed.append(len(split) - len(kept))
            digest.append(hashlib.sha256(whole).hexdigest())
            kept_text.append(whole)
    columns = [rows["doc_id"], pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digest, pa.string()), pa.array(kept_text, pa.binary()).cast(pa.string())]
    return pa.Table.from_arrays(columns, ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])


def _prime(least: int) -> int:
    """The smallest prime from ``least`` on: ids in steps of any kind then spread over so many buckets."""
    while least < 2 or any(least % k == 0 for k in range(2, math.isqrt(least) + 1)):
        least += 1
    return least


def substring_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = 8 << 20, crowd: int = 100_000, keep_text: bool = True
) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept_sha256, kept_text.

    Words are runs of non-spaces, unchanged. A word goes if a window of 13 words
    over it also starts in a document with a smaller id; windows are judged on
    the input. Words are told apart by 64-bit hashes (``words``): with a billion
    distinct words 0.03 pairs of them have one hash, and such a pair makes a false
    window only where the 12 words about it are alike. ``kept_text`` has the words that stay, joined by one space, and
    ``kept_sha256`` is its digest; ``keep_text=False`` leaves the text out.

    Null text has no words, as has empty text; documents of fewer than 13 words
    keep them all. Rows of one id do not make each other lose words, and repeated
    rows have the same result. Rows with a null id neither lose words nor make
    others lose any. Columns other than id and text are not read. An empty table
    gives no rows.

    ``crowd`` is the number of segments from which on a slot of anchors counts as
    crowded; results do not depend on it.

    The texts are shuffled once, into buckets of about ``shard_bytes`` by id;
    both times that records meet their texts use that shuffle.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    got = source.filter("doc_id is not null").select("text").mapInArrow(_crowds, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toPandas()
    counts = dict(zip(got["slot"], got["n"], strict=True))
    n_bytes = int(counts.pop(-1, 0))
    crowded = np.zeros(SLOTS, bool)
    crowded[[k for k, n in counts.items() if n > crowd]] = True
    crowded = source.sparkSession.sparkContext.broadcast(crowded)
    shards = max(1, -(-n_bytes // shard_bytes))
    buckets = _prime(shards)
    seen = source.filter("doc_id is not null").mapInArrow(_seen(shards, crowded), SENT).repartition(shards, "shard")
    marks = written(seen.groupBy("shard").applyInArrow(_shared(buckets), MARKS), "substring-marks")
    texts = source.filter("doc_id is not null").withColumn("bucket", F.pmod("doc_id", F.lit(buckets)).cast("int")).repartition(buckets, "bucket")
    dealt = texts.groupBy("bucket").cogroup(marks.filter("segments is not null").select("bucket", "segments").groupBy("bucket"))
    dealt = dealt.applyInArrow(_words_out, "shard int, placed binary, words binary").repartition(shards, "shard")
    waiting = marks.filter("copies is not null").select("shard", "copies")
    found = written(dealt.groupBy("shard").cogroup(waiting.groupBy("shard")).applyInArrow(_searched(buckets), REPORTS), "substring-reports")
    claims = marks.filter("claims is not null").select("batch", "claims")
    answers = claims.groupBy("batch").cogroup(found.filter("found is not null").select("batch", "found").groupBy("batch")).applyInArrow(_answered(buckets), "bucket int, removals binary")
    gone = found.filter("removals is not null").select("bucket", "removals").unionByName(answers)
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * keep_text
    last = _kept if keep_text else _counted
    kept = texts.groupBy("bucket").cogroup(gone.groupBy("bucket")).applyInArrow(last, schema)
    # Rows without an id meet no report, and so no bucket.
    apart = source.filter("doc_id is null").mapInArrow(_untouched, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string")
    return kept.unionByName(apart.select(*kept.columns))


def _counted(rows: pa.Table, removals: pa.Table) -> pa.Table:
    return _kept(rows, removals).drop_columns(["kept_text"])
