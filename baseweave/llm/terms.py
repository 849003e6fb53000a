"""Terms of many texts at once: maximal runs of ASCII letters (digits too, if asked for) and of bytes of other characters.

Only A-Z are lower-cased. Terms are told apart by the 64-bit hashes of ``words``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from .words import CHUNK, hashes_of

_LETTER = np.zeros(256, bool)
_LETTER[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = True
_ALNUM = _LETTER.copy()
_ALNUM[[*range(ord("0"), ord("9") + 1)]] = True
_FOLDED = np.arange(256, dtype=np.uint8)
_FOLDED[ord("A") : ord("Z") + 1] += 32


@dataclass
class Terms:
    """Terms of consecutive texts: the hash of each, where it stands in ``folded``, and the number of its text."""

    folded: np.ndarray
    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray

    def strings(self, which: np.ndarray) -> pa.Array:
        """The terms themselves, as UTF-8."""
        begins, sizes = self.starts[which], self.ends[which] - self.starts[which]
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        at = np.arange(offsets[-1]) - np.repeat(offsets[:-1] - begins, sizes)
        return pa.Array.from_buffers(pa.string(), len(which), [None, pa.py_buffer(offsets), pa.py_buffer(self.folded[at])])


def terms_of(texts: pa.Array, digits: bool) -> Iterator[Terms]:
    """Terms of runs of the texts, about CHUNK bytes each or one longer text. Null texts have none."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    every = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK, "right")) - 1)
        data, own = every[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        inside = (_ALNUM if digits else _LETTER)[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[own] = True
        begin, end = edge[:-1].copy(), edge[1:].copy()
        begin[1:] |= ~inside[:-1]
        end[:-1] |= ~inside[1:]
        starts, ends = np.flatnonzero(begin & inside), np.flatnonzero(end & inside) + 1
        folded = _FOLDED[data]
        number = np.searchsorted(own, starts, "right") - 1 + at
        yield Terms(folded, hashes_of(folded, starts, ends), starts, ends, number)
        at = to
