"""Mask files: for each contig ``<contig>.npz`` with a boolean array ``mask``, made in tiles.

A tile of positions is deflated by itself, up to a byte border, so tiles follow
each other as one stream. The checksum of the whole is combined from those of the
tiles. What one task does for a contig is to copy its compressed tiles.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from baseweave.operators.stored import stored

from .blocked import opened

#: Positions of a tile.
TILE = 1 << 22
TILES = "contig string, tile bigint, data binary, crc bigint, length bigint, n bigint"
#: Fixed values of the CRC-32 of zip files, lowest bit first: its polynomial, one, and the eighth power of x.
POLYNOMIAL, ONE, EIGHTH = 0xEDB88320, 1 << 31, 1 << 23


def _product(a: int, b: int) -> int:
    """The product of two polynomials modulo POLYNOMIAL; the highest bit is the constant term."""
    out = 0
    for bit in range(31, -1, -1):
        if a >> bit & 1:
            out ^= b
        b = b >> 1 ^ (POLYNOMIAL if b & 1 else 0)
    return out


def combined_crc(first: int, second: int, length: int) -> int:
    """The checksum of two runs of bytes after each other, from their own; the second has ``length`` bytes."""
    power, base = ONE, EIGHTH
    while length:
        if length & 1:
            power = _product(power, base)
        base, length = _product(base, base), length >> 1
    return _product(power, first) ^ second


def _tile(key: tuple, rows: pa.Table) -> pa.Table:
    contig, tile = key[0].as_py(), key[1].as_py()
    size = rows["length"][0].as_py()
    first, last = tile * TILE, min((tile + 1) * TILE, size)
    mask = np.zeros(last - first, np.uint8)
    for s, e in zip(rows["s"].to_pylist(), rows["e"].to_pylist(), strict=True):
        if s is not None:
            mask[max(s - first, 0) : max(e - first, 0)] = 1
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    data = packer.compress(mask.tobytes()) + packer.flush(zlib.Z_FINISH if last == size else zlib.Z_FULL_FLUSH)
    row = {"contig": contig, "tile": tile, "data": data, "crc": zlib.crc32(mask.tobytes()), "length": last - first, "n": int(mask.sum())}
    return pa.Table.from_pylist([row], schema=pa.schema([("contig", pa.string()), ("tile", pa.int64()), ("data", pa.binary()), ("crc", pa.int64()), ("length", pa.int64()), ("n", pa.int64())]))


def _head(size: int) -> bytes:
    """The header of an array file of ``size`` booleans."""
    text = f"{{'descr': '|b1', 'fortran_order': False, 'shape': ({size},), }}"
    text += " " * (-(len(text) + 11) % 64) + "\n"
    return b"\x93NUMPY\x01\x00" + struct.pack("<H", len(text)) + text.encode()


def _joined(folder: str):
    """Writes each contig's file from its tiles, which come in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, at = opened(folder)
        where.create_dir(at, recursive=True)
        name = b"mask.npy"
        out, contig, crc, packed, whole, n = None, None, 0, 0, 0, 0
        done: list[tuple[str, int]] = []

        def close() -> None:
            if out is None:
                return
            sizes = struct.pack("<QQ", whole, packed)
            out.write(struct.pack("<II", 0x08074B50, crc) + struct.pack("<QQ", packed, whole))
            offset = 30 + len(name) + 20 + packed + 24
            extra = struct.pack("<HH", 1, 24) + sizes + struct.pack("<Q", 0)
            entry = struct.pack("<IHHHHHHIIIHHHHHII", 0x02014B50, 45, 45, 8, 8, 0, 33, crc, 0xFFFFFFFF, 0xFFFFFFFF, len(name), len(extra), 0, 0, 0, 0, 0xFFFFFFFF) + name + extra
            far = struct.pack("<IQHHIIQQQQ", 0x06064B50, 44, 45, 45, 0, 0, 1, 1, len(entry), offset) + struct.pack("<IIQI", 0x07064B50, 0, offset + len(entry), 1)
            out.write(entry + far + struct.pack("<IHHHHIIH", 0x06054B50, 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0))
            out.close()
            done.append((contig, n))

        for batch in batches:
            for row in batch.to_pylist():
                if row["contig"] != contig:
                    close()
                    contig, n = row["contig"], 0
                    head = _head(row["size"])
                    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
                    data = packer.compress(head) + packer.flush(zlib.Z_FULL_FLUSH)
                    crc, packed, whole = zlib.crc32(head), len(data), len(head)
                    out = where.open_output_stream(f"{at}/{contig}.npz", compression=None)
                    extra = struct.pack("<HHQQ", 1, 16, 0, 0)
                    out.write(struct.pack("<IHHHHHIIIHH", 0x04034B50, 45, 8, 8, 0, 33, 0, 0xFFFFFFFF, 0xFFFFFFFF, len(name), len(extra)) + name + extra + data)
                out.write(row["data"])
                crc = combined_crc(crc, row["crc"], row["length"])
                packed, whole, n = packed + len(row["data"]), whole + row["length"], n + row["n"]
        close()
        yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in done], pa.string()), pa.array([k for _, k in done], pa.int64())], ["contig", "n"])

    return run


def write_masks(runs: DataFrame, lengths: DataFrame, folder: str) -> DataFrame:
    """(contig, n): the files of each contig of ``lengths`` from merged intervals, and their numbers of true entries.

    A contig of no length has no file. Files are opened by ``pyarrow.fs``.
    """
    last = F.floor((F.col("length") - 1) / TILE).cast("bigint")
    tiles = lengths.filter("length > 0").select("contig", "length", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("tile"))
    spans = runs.filter("e > s").withColumn("tile", F.explode(F.sequence(F.floor(F.col("s") / TILE).cast("bigint"), F.floor((F.col("e") - 1) / TILE).cast("bigint"))))
    made = tiles.join(spans, ["contig", "tile"], "left").groupBy("contig", "tile").applyInArrow(_tile, TILES)
    made = stored(made, "tiles").join(lengths.select("contig", F.col("length").alias("size")), "contig")
    in_order = made.select("contig", "tile", "data", "crc", "length", "n", "size").repartition("contig").sortWithinPartitions("contig", "tile")
    return in_order.mapInArrow(_joined(folder), "contig string, n long")
