"""Blocked gzip files as a data source: written in parallel as one file, read in parallel by ranges of bytes.

A file is a row of gzip members of at most 64 KiB that tell their own size, so a
reader may begin at any of them. Tasks write members of their own rows; on
commit what they wrote is joined in the order of the parts, which is a copy of
bytes, and the empty member that marks the end is added. Rows name the file that
they belong to, so one write may make many files. Files are opened by
``pyarrow.fs``, so paths may be local ones or URIs of the stores it knows.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

#: Fixed value: the empty block that ends a blocked gzip file.
BGZF_END = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")
#: Fixed values of the format: how a member begins, and the bytes around its body.
MAGIC, HEAD, TAIL = b"\x1f\x8b\x08\x04", 18, 8
#: Most bytes of text in a member; the bytes of a range that a task reads; bytes read at once.
BLOCK, RANGE, STEP = 65_280, 64 << 20, 4 << 20
LINES = 10_000
SCHEMA = "file string, part bigint, row bigint, line string"


def member(raw: bytes) -> bytes:
    """One gzip member of at most BLOCK bytes with its size in its header."""
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = packer.compress(raw) + packer.flush()
    head = MAGIC + b"\0\0\0\0\0\xff\x06\0BC\x02\0" + struct.pack("<H", len(body) + HEAD + TAIL - 1)
    return head + body + struct.pack("<II", zlib.crc32(raw), len(raw))


def members(data: Iterator[bytes], block: int = BLOCK) -> Iterator[bytes]:
    """Members of a stream of bytes, without the one at the end."""
    held = bytearray()
    for part in data:
        held += part
        whole = len(held) - len(held) % block
        for k in range(0, whole, block):
            yield member(bytes(held[k : k + block]))
        del held[:whole]
    if held:
        yield member(bytes(held))


def bgzf(data: Iterator[bytes], block: int = BLOCK) -> Iterator[bytes]:
    """Members of a stream of bytes, with the empty one at the end."""
    yield from members(data, block)
    yield BGZF_END


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def member_size(head: bytes) -> int:
    """The bytes of the member that begins with ``head``, 0 where none does."""
    if len(head) < HEAD or head[:4] != MAGIC or head[12:16] != b"BC\x02\0":
        return 0
    return struct.unpack("<H", head[16:18])[0] + 1


def is_blocked(path: str) -> bool:
    """Whether a path is a blocked gzip file that ``pyarrow.fs`` can open."""
    if not path.endswith(".gz"):
        return False
    try:
        where, at = opened(path)
        if where.get_file_info(at).type != fs.FileType.File:
            return False
        with where.open_input_file(at) as f:
            return member_size(f.read(HEAD)) > 0
    except (pa.ArrowInvalid, OSError):  # a store that only Spark reads
        return False


@dataclass
class Parts(WriterCommitMessage):
    """What one task wrote: the name of a file, and its part of it."""

    number: int
    written: list[tuple[str, str]]


@dataclass
class Range(InputPartition):
    path: str
    start: int
    end: int


class _Writer(DataSourceArrowWriter):
    """Rows of (name, line); a task's rows of one file follow each other."""

    def __init__(self, path: str) -> None:
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Parts:
        context = TaskContext.get()
        number, attempt = (context.partitionId(), context.taskAttemptId()) if context else (0, 0)
        where, at = opened(self.path)
        where.create_dir(f"{at}/_parts", recursive=True)
        done = Parts(number, [])
        rows = ((n, x) for batch in iterator for n, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
        for name, own in groupby(rows, key=lambda r: r[0]):
            part = f"{at}/_parts/{number:06d}-{attempt}-{len(done.written):06d}"
            with where.open_output_stream(part, compression=None) as out:
                for block in members(f"{x}\n".encode() for _, x in own):
                    out.write(block)
            done.written.append((name, part))
        return done

    def commit(self, messages: list[Parts | None]) -> None:
        where, at = opened(self.path)
        files: dict[str, list[str]] = {}
        for m in sorted((m for m in messages if m), key=lambda m: m.number):
            for name, part in m.written:
                files.setdefault(name, []).append(part)
        for name, parts in files.items():
            with where.open_output_stream(f"{at}/{name}", compression=None) as out:
                for part in parts:
                    with where.open_input_stream(part, compression=None) as read:
                        while chunk := read.read(STEP):
                            out.write(chunk)
                out.write(BGZF_END)
        where.delete_dir(f"{at}/_parts")

    def abort(self, messages: list[Parts | None]) -> None:
        where, at = opened(self.path)
        if where.get_file_info(f"{at}/_parts").type == fs.FileType.Directory:
            where.delete_dir(f"{at}/_parts")


def _first_member(f, start: int, size: int) -> int:
    """Where the first member from ``start`` on begins: one that the next follows, or the end of the file."""
    if start == 0:
        return 0
    at = start
    while at < size:
        f.seek(at)
        window = f.read(min(1 << 17, size - at))
        k = window.find(MAGIC)
        while 0 <= k:
            n = member_size(window[k : k + HEAD])
            if n:
                f.seek(at + k + n)
                if at + k + n == size or member_size(f.read(HEAD)):
                    return at + k
            elif len(window) - k < HEAD and at + len(window) < size:
                break
            k = window.find(MAGIC, k + 1)
        at += max(k, 1) if k >= 0 else max(len(window) - len(MAGIC) + 1, 1)
    return size


class _Reader(DataSourceReader):
    def __init__(self, paths: list[str], span: int) -> None:
        self.paths, self.span = paths, span

    def partitions(self) -> list[Range]:
        found = []
        for path in self.paths:
            where, at = opened(path)
            size = where.get_file_info(at).size
            found += [Range(path, a, min(a + self.span, size)) for a in range(0, max(size, 1), self.span)]
        return found

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        """Lines that begin in the range; the last of them is read to its end beyond it."""
        where, path = opened(partition.path)
        with where.open_input_file(path) as f:
            size = f.size()
            at = _first_member(f, partition.start, size)
            # A line that begins in the range before is that range's; so is one that begins right at this one's start.
            skip = at > 0
            held, row, lines, nth = bytearray(), 0, [], 0
            while at < size:
                beyond = at >= partition.end
                if beyond and skip:
                    return
                f.seek(at)
                head = f.read(HEAD)
                n = member_size(head)
                if not n:
                    raise ValueError(f"{partition.path} is no blocked gzip file at byte {at}")
                body = f.read(n - HEAD)
                held += zlib.decompress(body[:-TAIL], -15)
                at += n
                if beyond and b"\n" in held:
                    del held[held.index(b"\n") + 1 :]
                cut = held.rfind(b"\n") + 1
                if not cut:
                    continue
                found = held[:cut].decode("utf-8", "replace").split("\n")[:-1]
                del held[:cut]
                if skip:
                    found, skip = found[1:], False
                lines += found
                if len(lines) >= LINES or beyond:
                    yield self._batch(partition, row, lines)
                    row, lines = row + len(lines), []
                if beyond:
                    return
            if held and not skip:
                lines.append(held.decode("utf-8", "replace"))
            if lines:
                yield self._batch(partition, row, lines)

    def _batch(self, partition: Range, row: int, lines: list[str]) -> pa.RecordBatch:
        n = len(lines)
        columns = [pa.array([partition.path] * n, pa.string()), pa.array([partition.start] * n, pa.int64()), pa.array(range(row, row + n), pa.int64()), pa.array(lines, pa.string())]
        return pa.RecordBatch.from_arrays(columns, ["file", "part", "row", "line"])


class BlockedGzip(DataSource):
    """Format ``blocked_gzip``: option ``path``, or ``paths`` parted by line feeds; ``span`` is the bytes of a range."""

    @classmethod
    def name(cls) -> str:
        return "blocked_gzip"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> _Reader:
        paths = self.options["paths"].split("\n") if "paths" in self.options else [self.options["path"]]
        return _Reader(paths, int(self.options.get("span", RANGE)))

    def writer(self, schema, overwrite: bool) -> _Writer:
        return _Writer(self.options["path"])


def read_blocked(spark: SparkSession, paths: str | list[str], span: int = RANGE) -> DataFrame:
    """(file, ordinal, line) of blocked gzip files, in ranges of ``span`` bytes side by side."""
    spark.dataSource.register(BlockedGzip)
    every = [paths] if isinstance(paths, str) else list(paths)
    raw = spark.read.format("blocked_gzip").option("paths", "\n".join(every)).option("span", str(span)).load()
    return raw.select("file", F.struct("part", "row").alias("ordinal"), "line")


def write_blocked(lines: DataFrame, folder: str) -> None:
    """Blocked gzip files in ``folder``, one for each ``name``, of ``line`` in the order of partitions and of rows within them.

    Rows of a file have to follow each other. Files of other names stay as they are.
    """
    lines.sparkSession.dataSource.register(BlockedGzip)
    lines.select("name", "line").write.format("blocked_gzip").mode("append").option("path", folder).save()


def listed(folder: str, ending: str = ".gz") -> list[str]:
    """Paths of a folder's files, in order."""
    where, at = opened(folder)
    found = sorted(i.base_name for i in where.get_file_info(fs.FileSelector(at)) if i.is_file and i.base_name.endswith(ending))
    return [f"{folder}/{name}" for name in found]
