"""Packing documents into fixed-length token sequences.

Documents are tokenised where they are read and cut at multiples of the
sequence length: whole pieces fill a sequence each, and each document's rest is
packed by first-fit decreasing with a tournament tree of bin capacities. That
runs in randomised groups of documents, independent of each other; only the
rests' lengths and checksums are shuffled, never texts or ids.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

PIECE_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
#: Sequences that a single whole piece fills are numbered from here on.
WHOLE = 1 << 62
#: Fixed value: the pre-tokens of byte-level vocabularies of this kind.
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_WORD, _SPACE = r"[!-~\xa1-\u024f]{1,500}+", r"[\t\n\r ]{1,500}+"
#: Texts of characters on which both encoders have the same classes, without very long runs.
_PLAIN = re.compile(rf"(?:{_SPACE})?(?:{_WORD}(?:{_SPACE}|\Z))*+")


def _byte_of() -> dict[str, int]:
    """Byte by the character that stands for it in a byte-level vocabulary: itself if printable, else 256 on in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def merges_by_rank(spec: dict) -> bool:
    """Whether a tokenizer file is byte-level BPE whose merges stand in the order of their ids, with nothing before or beside them.

    Only then are merges by vocabulary order and ``PRE_TOKENS`` what the file says.
    """
    model, before = spec["model"], spec["pre_tokenizer"] or {}
    if spec["normalizer"] or (before.get("type"), before.get("add_prefix_space"), before.get("use_regex")) != ("ByteLevel", False, True):
        return False
    odd = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback", "ignore_merges")
    if model["type"] != "BPE" or any(model.get(k) for k in odd):
        return False
    vocab, byte_of = model["vocab"], _byte_of()
    made = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    ids = [vocab.get(w, -1) for w in made]
    return all(a < b for a, b in zip(ids, ids[1:])) and vocab.keys() - {t["content"] for t in spec["added_tokens"]} == byte_of.keys() | set(made)


class Encoder:
    """Ids of a tokenizer file as little-endian bytes.

    Plain texts go through a faster encoder with the same merges, if the file is
    one that it can stand for (``merges_by_rank``); all others (rare characters,
    very long words, special strings) go through the file's own library.
    """

    def __init__(self, tokenizer_path: str):
        with open(tokenizer_path, encoding="utf-8") as f:
            spec = json.load(f)
        self.path, self.own, self.fast = tokenizer_path, None, None
        self.special = [t["content"] for t in spec["added_tokens"]]
        if merges_by_rank(spec):
            import tiktoken

            byte_of = _byte_of()
            ranks = {bytes(map(byte_of.__getitem__, w)): i for w, i in spec["model"]["vocab"].items() if w not in self.special}
            self.fast = tiktoken.Encoding("plain", pat_str=PRE_TOKENS, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> bytes:
        if self.fast and _PLAIN.fullmatch(text) and not any(s in text for s in self.special):
            return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes()
        if self.own is None:
            from tokenizers import Tokenizer

            self.own = Tokenizer.from_file(self.path)
        return array("I", self.own.encode(text, add_special_tokens=False).ids).tobytes()


def first_fit_decreasing(sizes: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Bin and offset for each size (each from 1 to ``capacity``).

    The tree holds in each node the largest room among the bins below it, so
    the first bin with enough room is found in as many steps as it has levels.
    """
    leaves = 1
    while leaves < len(sizes):
        leaves *= 2
    room = [capacity] * (2 * leaves)
    bins, offsets = [0] * len(sizes), [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda k: -sizes[k]):
        size, node = sizes[i], 1
        while node < leaves:
            node *= 2
            if room[node] < size:
                node += 1
        bins[i], offsets[i] = node - leaves, capacity - room[node]
        room[node] -= size
        while node > 1:
            node //= 2
            room[node] = max(room[2 * node], room[2 * node + 1])
    return bins, offsets


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str | None = None,
    length: int = 1024,
    end_id: int = 0,
    group_docs: int = 8192,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is its ids and ``end_id``. Null text counts as empty and makes a
    document of that one id, as does empty text. Each id lies in one piece;
    pieces of a sequence follow each other from offset 0 without gaps. Pieces of
    ``length`` are a sequence by themselves. The rests, one at most of a document,
    are dealt to groups of about ``group_docs`` by a hash of the row's number in
    its task, so neither a hot id nor repeated rows gather in one group, and a
    group's packing fits one task at every corpus size. Repeated rows are
    documents of their own, null ids stay null; columns other than id and text
    are not read; an empty table gives no rows.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = tokenizer_path
        if path is None:
            import public_tokenizers

            path = public_tokenizers.path("byte_bpe_50k.json")
        encoder, end, width = Encoder(path), array("I", [end_id]).tobytes(), 4 * length
        names = [c.split()[0] for c in f"{PIECE_SCHEMA}, row long".split(", ")]
        row = TaskContext.get().partitionId() << 36
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                found = encoder.encode(text.as_py()) + end
                for b in range(0, len(found), width):
                    c = found[b : b + width]
                    rows.append((doc_id.as_py(), b // 4, len(c) // 4, zlib.crc32(c), len(found) // 4, row))
                    row += 1
            columns = zip(*rows, strict=True) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    def pack(key: tuple, rests: pd.DataFrame) -> pd.DataFrame:
        rests = rests.sort_values("row", ignore_index=True)
        bins, offsets = first_fit_decreasing(rests["length"].tolist(), length)
        first = int(key[0]) << 32
        return rests.drop(columns="row").assign(sequence_id=[first + b for b in bins], offset=offsets)

    n_docs = docs.select(F.col(id_col)).count()
    groups = max(1, -(-n_docs // group_docs))
    text = F.coalesce(F.col(text_col), F.lit(""))
    # Written, as numbers of rows must not change between the readers.
    pieces = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text")).mapInArrow(cut, f"{PIECE_SCHEMA}, row long")
    pieces = written(pieces, "pieces")
    whole = pieces.filter(F.col("length") == length).withColumns({"sequence_id": F.lit(WHOLE) + F.col("row"), "offset": F.lit(0).cast("long")}).drop("row")
    dealt = pieces.filter(F.col("length") < length).withColumn("group", F.pmod(F.xxhash64("row"), F.lit(groups)))
    packed = dealt.groupBy("group").applyInPandas(pack, f"{PIECE_SCHEMA}, group long, sequence_id long, offset long").drop("group")
    return packed.unionByName(whole)
