"""Token counts by distinct pre-token, without a text's token ids.

A pre-token is a maximal run of spaces with the non-spaces after it. Where no
piece of the vocabulary joins a non-space to a later space, merges never cross
that border and a text's count is the sum over its pre-tokens. A model that is
not so (``adds_up``) gets whole texts instead.

1. Texts become frequencies of pre-tokens. Those of neighbouring documents are
   packed into one row, a chunk, which numbers its distinct pre-tokens by buckets
   (a hash of their text) and sends each bucket's pre-tokens as one row.
2. Equal pre-tokens meet in their bucket. There the distinct ones are counted once
   each, and the counts joined to the rows of all chunks that have them.
3. What a chunk so knows is joined to its frequencies by the chunk's number, where
   they are multiplied and summed.

A chunk sends each of its pre-tokens once, however often its documents have it.
The number of buckets grows with the input, so that a bucket fits a task; and no
pre-token has more entries in its bucket than there are chunks.
"""

from __future__ import annotations

import re
import struct
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

#: The character by which the vocabulary's library writes a space; in a text it is treated alike.
META_SPACE = "▁"
_BORDER = re.compile(r"(?<=[^ ]) ")
_INNER_SPACE = re.compile(f"[^{META_SPACE}]{META_SPACE}")
#: Characters that a model's own rules may change: spaces of other kinds, ligatures, marks, controls.
_CHANGEABLE = "x\xa0\u3000\u2003\ufb01\u2460e\u0301\uff21\t\n\x1c\u200b\ufeffX"
#: A chunk's frequencies (bucket -1) or its pre-tokens of one bucket. ``tokens``, ``times`` and ``lengths`` are whole numbers
#: (``_packed``); ``sizes`` says how many entries each document has.
CHUNKS = "chunk long, bucket int, doc_ids array<long>, n_bytes array<long>, sizes array<int>, tokens binary, times binary, words binary, lengths binary"
_KINDS = [pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), *[pa.binary()] * 4]
COUNTS = "doc_id long, n_bytes long, n_tokens long"
#: Bytes of text for each bucket, a few hundred thousand pre-tokens of all chunks at most.
BUCKET_BYTES = 16 << 20


def pre_tokens(text: str) -> list[str]:
    """The pre-tokens of a text that is not empty, each without its first space, which the library adds itself."""
    if META_SPACE in text:
        text = text.replace(META_SPACE, " ")
    if "  " in text or text[0] == " ":
        return _BORDER.split(text)
    return text.split(" ")


def _packed(values: np.ndarray) -> bytes:
    """Whole numbers below 2 ** 32 as compressed planes: all lowest bytes, then all second bytes and so on."""
    planes = [zlib.compress(p.tobytes(), 1) for p in values.astype("<u4").view(np.uint8).reshape(-1, 4).T]
    return struct.pack("<4I", *map(len, planes)) + b"".join(planes)


def _unpacked(raw: bytes) -> np.ndarray:
    ends = np.cumsum(struct.unpack("<4I", raw[:16])) + 16
    planes = [np.frombuffer(zlib.decompress(raw[a:b]), np.uint8) for a, b in zip([16, *ends[:-1]], ends, strict=True)]
    return np.ascontiguousarray(np.stack(planes, 1)).view("<u4").ravel().astype(np.int64)


def _chunked(chunk_bytes: int, buckets: int):
    """Documents' frequencies of pre-tokens, packed for about ``chunk_bytes`` of text, and the pre-tokens by bucket."""

    def rows_of(number: int, docs: list[tuple], tokens: array, times: array, local: dict[str, int]) -> pa.RecordBatch:
        words = [t.encode() for t in local]
        bucket = np.array([zlib.crc32(w) % buckets for w in words], np.int64)
        order = np.argsort(bucket, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        ids, n_bytes, sizes = (list(c) for c in zip(*docs, strict=True))
        own, often, at = place[np.frombuffer(tokens, np.uint32)], np.frombuffer(times, np.uint32).copy(), 0
        for n in sizes:  # in order within a document, as differences, which are small
            sort = np.argsort(own[at : at + n])
            own[at : at + n], often[at : at + n] = np.diff(own[at : at + n][sort], prepend=0), often[at : at + n][sort]
            at += n
        rows = [(number, -1, ids, n_bytes, sizes, _packed(own), _packed(often), None, None)]
        length = np.array([len(w) for w in words], np.int64)[order]
        every, begin = np.unique(bucket[order], return_index=True)
        for b, a, z in zip(every.tolist(), begin, np.append(begin[1:], len(order)), strict=True):
            rows.append((number, b, None, None, None, None, None, b"".join([words[k] for k in order[a:z]]), _packed(length[a:z])))
        columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), _KINDS, strict=True)]
        return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in CHUNKS.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        docs, tokens, times, local, held = [], array("I"), array("I"), {}, 0
        for batch in batches:
            for doc_id, n_bytes, text in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                found = Counter(pre_tokens(text)) if text else {}
                tokens.extend([local.setdefault(p, len(local)) for p in found])
                times.extend(found.values())
                docs.append((doc_id, n_bytes, len(found)))
                held += n_bytes + 64
                if held >= chunk_bytes:
                    yield rows_of(number, docs, tokens, times, local)
                    number += 1
                    docs, tokens, times, local, held = [], array("I"), array("I"), {}, 0
        if docs:
            yield rows_of(number, docs, tokens, times, local)

    return run


def _strings(words: bytes, lengths: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    return pa.Array.from_buffers(pa.large_string(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(words)])


#: Models that a worker has read, by path.
_MODELS: dict = {}


def _read(path: str | None):
    from sentencepiece import SentencePieceProcessor

    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    return SentencePieceProcessor(model_file=path)


def _model(path: str | None):
    """The model in a worker, read once; the driver reads it by ``_read`` and so sends none along."""
    if path not in _MODELS:
        _MODELS[path] = _read(path)
    return _MODELS[path]


def adds_up(model) -> bool:
    """Whether a text's count is the sum over its pre-tokens.

    It is if the model writes a space before each text, keeps all spaces and other
    characters as they are, has a piece for a space alone, and no piece with a space
    after another character.
    """
    pieces = (model.id_to_piece(k) for k in range(model.get_piece_size()))
    kept = model.normalize(" a  b ") == "  a  b ".replace(" ", META_SPACE) and model.normalize(_CHANGEABLE) == META_SPACE + _CHANGEABLE
    return kept and model.piece_to_id(META_SPACE) != model.unk_id() and not any(map(_INNER_SPACE.search, pieces))


def _whole(model_path: str | None):
    """Counts of whole texts by the library."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(model_path)
        for batch in batches:
            n_tokens = pa.array([len(model.encode(t)) for t in batch.column(2).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), n_tokens], ["doc_id", "n_bytes", "n_tokens"])

    return run


def _pieces(model_path: str | None):
    """The number of pieces of a bucket's pre-tokens, each distinct one counted once, for every chunk that has them."""

    def run(rows: pa.Table) -> pa.Table:
        model = _model(model_path)
        lengths = [_unpacked(x) for x in rows["lengths"].to_pylist()]
        every = pa.concat_arrays([_strings(w, n) for w, n in zip(rows["words"].to_pylist(), lengths, strict=True)]).dictionary_encode()
        distinct = every.dictionary.to_pylist()
        counts = [n if t else 1 for t, n in zip(distinct, map(len, model.encode(distinct, num_threads=1)), strict=True)]  # a space at the end is a piece of its own
        pieces = np.array(counts, np.int64)[np.array(every.indices)]
        cuts = np.cumsum([len(n) for n in lengths])[:-1]
        packed = pa.array([_packed(p) for p in np.split(pieces, cuts)], pa.binary())
        return pa.table({"chunk": rows["chunk"], "bucket": rows["bucket"], "pieces": packed})

    return run


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, n_bytes, sizes, tokens, times, known = (batch.column(k) for k in range(6))
        for k in range(batch.num_rows):
            size = np.array(sizes[k].values, np.int64)
            parts = sorted(known[k].as_py() or [], key=lambda p: p["bucket"])
            pieces = np.concatenate([np.zeros(0, np.int64), *[_unpacked(p["pieces"]) for p in parts]])
            ends = np.cumsum(size)
            begins = ends - size
            # From differences within each document back to places.
            running = np.concatenate([[0], np.cumsum(_unpacked(tokens[k].as_py()))])
            place = running[1:] - np.repeat(running[begins], size)
            total = np.concatenate([[0], np.cumsum(pieces[place] * _unpacked(times[k].as_py()))])
            columns = [ids[k].values, n_bytes[k].values, pa.array(total[ends] - total[begins])]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_tokens"])


def count_tokens(
    docs: DataFrame,
    model_path: str | None = None,
    limit: int = 4096,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk_bytes: int = 64 << 20,
) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_tokens, over_limit.

    Counts are those of the library for ``model_path`` without begin, end or
    added tokens; control symbols inside a text are ordinary text. Null text
    counts as empty: no bytes, no tokens. Whole texts are read, however long; a
    text of more than ``chunk_bytes`` is a chunk of its own. A model whose counts
    do not add up over pre-tokens counts whole texts. Repeated rows give
    repeated results, null ids stay null; columns other than id and text are not
    read; an empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    over = (F.col("n_tokens") > limit).alias("over_limit")
    if not adds_up(_read(model_path)):
        return source.mapInArrow(_whole(model_path), COUNTS).select("*", over)
    n_bytes = source.agg(F.sum("n_bytes")).first()[0] or 0
    buckets = max(16, -(-n_bytes // BUCKET_BYTES))
    chunks = written(source.mapInArrow(_chunked(chunk_bytes, buckets), CHUNKS), "token-chunks")
    words = chunks.filter("bucket >= 0").select("chunk", "bucket", "words", "lengths")
    counted = words.groupBy("bucket").applyInArrow(_pieces(model_path), "chunk long, bucket int, pieces binary")
    known = counted.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "pieces")).alias("known"))
    both = chunks.filter("bucket < 0").join(known, "chunk", "left").select("doc_ids", "n_bytes", "sizes", "tokens", "times", "known")
    return both.mapInArrow(_summed, COUNTS).select("*", over)
