"""Alignment blocks, put together where their lines are read.

A task goes through the lines of its range of a file and hands on the blocks
that lie in it as one row each. What is before a range's first end of a block
and after its last one is handed on as such: two rows a range, and only these
are brought together and numbered along the file. Lines are taken apart as
columns; none is gone through by itself.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from baseweave.operators.stored import stored

from .text import has_blocked, read_lines

#: A sequence of a block.
ROW_TYPE = pa.struct([("src", pa.string()), ("start", pa.int64()), ("size", pa.int64()), ("strand", pa.string()), ("src_size", pa.int64()), ("text", pa.string())])
#: edge: 0 for a whole block, 1 for what a range has before its first end of a block, 2 for what it has after its last.
PIECES = "file string, name string, part bigint, row bigint, edge int, block bigint, head string, rows array<struct<src: string, start: bigint, size: bigint, strand: string, src_size: bigint, text: string>>"
WHOLE, BEFORE, AFTER = 0, 1, 2
TEXT = pa.large_string()
#: What a line is: none of a block, a sequence, or an end of a block: the head of the next or a blank one.
OTHER, SEQUENCE, HEAD, BLANK = 0, 1, 2, 3
#: Lines, or bytes of lines, that are taken apart at once.
LINES, BYTES = 1 << 16, 8 << 20
#: Bytes of a range, and of a line, up to which blocks are told apart by their heads.
RANGE_BYTES, LINE_BYTES = 256 << 20, 1 << 20
Batches = Iterator[pa.RecordBatch]


def _byte(texts: pa.Array, k: int) -> np.ndarray:
    """Byte ``k`` of each text, a blank where it is shorter."""
    found = np.full(len(texts), ord(" "), np.uint8)
    if len(texts):
        _, at, letters = texts.buffers()
        at = np.frombuffer(at, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        long = np.diff(at) > k
        found[long] = np.frombuffer(letters or b"", np.uint8)[at[:-1][long] + k]
    return found


def _kinds(lines: pa.Array) -> np.ndarray:
    """What each line is."""
    kinds = np.full(len(lines), OTHER, np.int8)
    size, space = np.array(pc.binary_length(lines), np.int64), ord(" ")
    byte = [_byte(lines, k) for k in range(2)]
    kinds[(byte[0] == ord("s")) & (byte[1] == space) & (size > 1)] = SEQUENCE
    kinds[(byte[0] == ord("a")) & (byte[1] == space)] = HEAD
    blank = np.flatnonzero(byte[0] == space)
    blank = blank[np.array(pc.equal(pc.utf8_trim(lines.take(pa.array(blank)), " "), ""), dtype=bool)]
    kinds[blank] = BLANK
    return kinds


def _number(word: str | None) -> int | None:
    """``as_bigint`` of a word."""
    found = re.fullmatch(r"[\x00-\x20\x7f]*([+-]?)0*([0-9]+)[\x00-\x20\x7f]*", word or "")
    if not found or len(found[2]) > 19:
        return None
    value = int(found[1] + found[2])
    return value if -(1 << 63) <= value < 1 << 63 else None


def _numbers(words: pa.Array) -> pa.Array:
    """``as_bigint`` of words."""
    text = words.buffers()[2]
    if text is None or not (np.frombuffer(text, np.uint8) > ord("9")).any():
        try:
            return pc.cast(words, pa.int64())
        except pa.ArrowInvalid:  # a sign, a blank or too many digits
            pass
    return pa.array([_number(w) for w in words.to_pylist()], pa.int64())


def _sequences(lines: pa.Array) -> pa.StructArray:
    """The sequences that lines tell; what a line lacks is null."""
    words = pc.ascii_split_whitespace(pc.utf8_trim(lines, " "))
    at = np.array(words.offsets, np.int64)
    n = np.diff(at)
    word = lambda k: words.values.take(pa.array(at[:-1] + k, mask=n <= k))
    columns = [_numbers(word(k)) if pa.types.is_integer(field.type) else word(k).cast(pa.string()) for k, field in enumerate(ROW_TYPE, 1)]
    return pa.StructArray.from_arrays(columns, fields=list(ROW_TYPE))


class _Range:
    """The lines of one range of a file, given piece by piece."""

    def __init__(self, file: str, name: str, part: int, row: int, whole: bool) -> None:
        self.at, self.whole = (file, name, part, row), whole
        self.blocks, self.ended = 0, False
        self.held = self.before = pa.array([], TEXT)

    def add(self, lines: list[pa.Array]) -> pa.RecordBatch | None:
        lines = pa.concat_arrays([self.held, *lines])
        kinds = _kinds(lines)
        ends = np.flatnonzero(kinds >= HEAD)
        if not len(ends):
            self.held = lines.filter(pa.array(kinds == SEQUENCE))
            return None
        if not self.ended:
            first = int(ends[0])
            self.before, self.ended = lines.slice(0, first).filter(pa.array(kinds[:first] == SEQUENCE)), True
            lines, kinds, ends = lines.slice(first), kinds[first:], ends - first
        # What follows the last end waits for its own end.
        last = int(ends[-1])
        waits = kinds[last:] == SEQUENCE
        waits[0] = True
        self.held = lines.slice(last).filter(pa.array(waits))
        rows = np.flatnonzero(kinds[:last] == SEQUENCE) if self.whole else ends[:0]
        of = np.searchsorted(ends, rows, "right") - 1
        begins = np.flatnonzero(np.append(True, of[1:] != of[:-1])) if len(of) else of
        if not len(begins):
            return None
        heads = lines.take(pa.array(ends[of[begins]], mask=kinds[ends[of[begins]]] != HEAD))
        own = pa.ListArray.from_arrays(pa.array(np.append(begins, len(rows)), pa.int32()), _sequences(lines.take(pa.array(rows))))
        numbers = self.blocks + np.arange(len(begins))
        self.blocks += len(begins)
        return self._batch(WHOLE, pa.array(numbers, pa.int64()), heads, own)

    def close(self) -> Batches:
        before, after = (self.before, self.held) if self.ended else (self.held, None)
        yield self._edge(BEFORE, None, before)
        if after is not None:
            kinds = _kinds(after)
            yield self._edge(AFTER, after[0].as_py() if kinds[0] == HEAD else None, after.filter(pa.array(kinds == SEQUENCE)))

    def _edge(self, edge: int, head: str | None, lines: pa.Array) -> pa.RecordBatch:
        rows = pa.ListArray.from_arrays(pa.array([0, len(lines)], pa.int32()), _sequences(lines))
        return self._batch(edge, pa.array([self.blocks], pa.int64()), pa.array([head], pa.string()), rows)

    def _batch(self, edge: int, block: pa.Array, head: pa.Array, rows: pa.Array) -> pa.RecordBatch:
        kinds = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int32())
        fixed = [pa.repeat(pa.scalar(v, kind), len(block)) for v, kind in zip((*self.at, edge), kinds, strict=True)]
        columns = [*fixed, block, head.cast(pa.string()), rows]
        return pa.RecordBatch.from_arrays(columns, ["file", "name", "part", "row", "edge", "block", "head", "rows"])


def _pieces(batches: Batches, folder: bool = False, whole: bool = True, edges: bool = True) -> Batches:
    """Pieces of lines (name, part, row, line): whole blocks, the edges of ranges, or both."""
    current: _Range | None = None
    waiting: list[pa.Array] = []
    n = size = 0

    def flush() -> Batches:
        if current and waiting and (found := current.add(waiting)) is not None:
            yield found
        waiting.clear()

    for batch in batches:
        if not batch.num_rows:
            continue
        name, part, row = (batch.column(k) for k in range(3))
        code, at = np.array(name.dictionary_encode().indices), np.array(part)
        cuts = np.flatnonzero(np.append(True, (code[1:] != code[:-1]) | (at[1:] != at[:-1]))).tolist()
        lines = batch.column(3).cast(TEXT)
        for a, b in zip(cuts, [*cuts[1:], batch.num_rows], strict=True):
            if current is None or current.at[1:3] != (name[a].as_py(), part[a].as_py()):
                yield from flush()
                yield from current.close() if current and edges else ()
                file = name[a].as_py()
                current, n, size = _Range(re.sub("/[^/]*$", "", file) if folder else file, file, part[a].as_py(), row[a].as_py(), whole), 0, 0
            waiting.append(lines.slice(a, b - a))
            n, size = n + b - a, size + waiting[-1].nbytes
            if n >= LINES or size >= BYTES:
                yield from flush()
                n = size = 0
    yield from flush()
    yield from current.close() if current and edges else ()


def _placed(lines: DataFrame) -> DataFrame:
    return lines.select(F.col("file").alias("name"), F.col("ordinal.part").alias("part"), F.col("ordinal.row").alias("row"), "line")


def _score() -> Column:
    return F.regexp_extract("head", r"\bscore=(\S+)", 1).try_cast("double").alias("score")


def _chains(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges (file, name, part, row, edge, block, score, rows) with the block they belong to in ``chain``, and these blocks: (file, chain, rows, whole, score).

    What is open after a range goes on until the next end, in this file.
    """
    along = Window.partitionBy("file").orderBy("name", "part", "row", "edge")
    new = (F.col("edge") == AFTER) | F.coalesce(F.lag("name").over(along) != F.col("name"), F.lit(True))
    edges = edges.withColumn("new", new.cast("int")).withColumn("chain", F.sum("new").over(along))
    place = F.struct("name", "part", "row", "edge")
    rows = F.flatten(F.transform(F.sort_array(F.collect_list(F.struct(place.alias("at"), "rows"))), lambda p: p["rows"]))
    whole = F.sum(F.when(F.col("edge") == BEFORE, F.col("block")).otherwise(0))
    return edges, edges.groupBy("file", "chain").agg(rows.alias("rows"), whole.alias("whole"), F.max(F.when(F.col("edge") == AFTER, F.col("score"))).alias("score"))


def parse_blocks(lines: DataFrame, folder: bool = False) -> DataFrame:
    """(file, block_id, score, rows) of an alignment's blocks; ``rows`` has src, start, size, strand, src_size and text of each sequence.

    ``lines`` are as ``read_lines`` has them: those of a range of a file in one
    task, in order. An ``a`` line, a blank one or the end of a file ends a
    block; blocks without sequences do not count. The first sequence of a block
    is the reference's. The score is that of the block's ``a`` line, null where
    it has none. With ``folder`` the files of a folder are parts of one
    alignment, in the order of their names, and ``file`` is the folder.
    """
    pieces = _placed(lines).mapInArrow(lambda batches: _pieces(batches, folder), PIECES)
    pieces = stored(pieces.select("file", "name", "part", "row", "edge", "block", _score(), "rows"), "blocks")

    edges, chains = _chains(pieces.filter(F.col("edge") != WHOLE))
    some = (F.size("rows") > 0).cast("bigint")
    earlier = Window.partitionBy("file").orderBy("chain").rowsBetween(Window.unboundedPreceding, -1)
    chains = chains.withColumn("block_id", F.coalesce(F.sum(some + F.col("whole")).over(earlier), F.lit(0)))
    ranges = edges.filter(F.col("edge") == BEFORE).join(chains.select("file", "chain", (F.col("block_id") + some).alias("first")), ["file", "chain"])
    inner = pieces.filter(F.col("edge") == WHOLE).join(F.broadcast(ranges.select("file", "name", "part", "row", "first")), ["file", "name", "part", "row"])
    inner = inner.select("file", (F.col("first") + F.col("block")).alias("block_id"), "score", "rows")
    return inner.unionByName(chains.filter(some > 0).select("file", "block_id", "score", "rows"))


def _lines(texts: pa.Array) -> pa.Array:
    """The lines of what stands between heads of blocks, each without its first letter, and a blank one after each text; see ``_between_heads``."""
    first = _byte(texts, 0)
    head = np.isin(first, np.frombuffer(b" \r\n", np.uint8))  # else a file's beginning
    joined = pc.binary_join_element_wise(pa.array(np.where(head, "a", "")).cast(TEXT), texts, pa.scalar("\n\n", TEXT), pa.scalar("", TEXT))
    letters = np.frombuffer(joined.buffers()[2], np.uint8)
    if (letters == ord("\r")).any():
        letters = np.frombuffer(letters.tobytes().replace(b"\r\n", b"\n").replace(b"\r", b"\n"), np.uint8)
    ends = np.flatnonzero(letters == ord("\n"))
    at = np.append(0, ends - np.arange(len(ends)))
    return pa.LargeStringArray.from_buffers(len(ends), pa.py_buffer(at), pa.py_buffer(letters[letters != ord("\n")]))


def _between_heads(batches: Batches) -> Batches:
    """Whole blocks of texts (name, value), none of which has a part of another's block."""
    for batch in batches:
        name, texts = batch.column(0), batch.column(1).cast(TEXT)
        code = np.array(name.dictionary_encode().indices)
        cuts = np.flatnonzero(np.append(len(code) > 0, code[1:] != code[:-1])).tolist()
        for a, b in zip(cuts, [*cuts[1:], batch.num_rows], strict=True):
            file = name[a].as_py()
            if (found := _Range(file, file, 0, 0, True).add([_lines(texts.slice(a, b - a))])) is not None:
                yield found


def _have_heads(lines: DataFrame) -> bool:
    """Whether blocks may be told apart by the heads of lines as they are read.

    No other line may begin as a head does, no line be so long that it is better
    read by itself, and no two heads be further from each other than a range or two.
    """
    line, head = F.col("line"), F.col("line").isin("a") | F.col("line").startswith("a ")
    size = F.octet_length(line).cast("bigint") + 1
    ranges = lines.groupBy(F.spark_partition_id()).agg(F.sum(size).alias("bytes"), F.max(size).alias("longest"), F.max(head).alias("head"), F.max(line.startswith("a") & ~head).alias("other"))
    most = [F.max(c).alias(c) for c in ("bytes", "longest", "other")]
    found = ranges.agg(*most, F.min("head").alias("head"), F.count("*").alias("n")).first()
    if found["n"] == 0:
        return True
    return found["bytes"] <= RANGE_BYTES and found["longest"] <= LINE_BYTES and not found["other"] and (found["head"] or found["n"] == 1)


def mapped_blocks(spark: SparkSession, paths: str | list[str], each: Callable[[Batches], Batches], schema: str) -> DataFrame:
    """What ``each`` makes of the blocks of alignments, given as batches with their file and rows, where they are read; no block is stored.

    Where a range of a file has heads of blocks, Spark's reader hands on what
    stands between them as one text, however files are cut. Else lines are read,
    once for the edges of ranges and once for the blocks within them, and only
    blocks that a range cuts are brought together first.
    """
    lines = read_lines(spark, paths)
    if not has_blocked(paths) and _have_heads(lines):
        texts = spark.read.option("lineSep", "\na").text(paths).select("_metadata.file_path", "value")
        return texts.mapInArrow(lambda batches: each(b.select(["file", "rows"]) for b in _between_heads(batches)), schema)
    placed = _placed(lines)
    edges = placed.mapInArrow(lambda batches: _pieces(batches, whole=False), PIECES)
    _, chains = _chains(stored(edges.select("file", "name", "part", "row", "edge", "block", _score(), "rows"), "edges"))
    inner = placed.mapInArrow(lambda batches: each(b.select(["file", "rows"]) for b in _pieces(batches, edges=False)), schema)
    return inner.unionByName(chains.filter(F.size("rows") > 0).select("file", "rows").mapInArrow(each, schema))


def read_blocks(spark: SparkSession, paths: str | list[str], folder: bool = False) -> DataFrame:
    return parse_blocks(read_lines(spark, paths), folder)


def sequences(blocks: DataFrame) -> DataFrame:
    """(file, block_id, seq_idx, src, start, size, strand, src_size, text, score): blocks with a row for each sequence."""
    each = blocks.select("file", "block_id", "score", F.posexplode("rows").alias("seq_idx", "r"))
    return each.select("file", "block_id", "seq_idx", *[F.col(f"r.{c}").alias(c) for c in ("src", "start", "size", "strand", "src_size", "text")], "score")


def gathered(rows: DataFrame) -> DataFrame:
    """The blocks of such rows."""
    fields = F.struct("seq_idx", "src", "start", "size", "strand", "src_size", "text")
    found = rows.groupBy("file", "block_id").agg(F.max("score").alias("score"), F.sort_array(F.collect_list(fields)).alias("rows"))
    return found.withColumn("rows", F.transform("rows", lambda r: r.dropFields("seq_idx")))
