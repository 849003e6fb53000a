"""Words of many texts at once, as 64-bit hashes in numpy arrays.

A word is a maximal run of bytes other than the six of SPACE, or of letters
only (ASCII letters and all bytes of other characters). Words of a chunk of
texts are hashed side by side, eight bytes at a time.

Two different words or shingles have one hash with a probability of 2 ** -64.
Among a billion distinct words 0.03 such pairs are to be expected, and two sets
of a thousand shingles each share a false one with a probability of 5e-14.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

#: Bytes of text worked on at once; a longer text is a chunk of its own.
CHUNK = 1 << 19
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_NO_LETTER = np.ones(256, bool)
_NO_LETTER[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = False
#: Blocks of a word that are hashed side by side with those of other words; longer words are hashed one by one.
BLOCKS = 32
_FOLDED = np.arange(256, dtype=np.uint8)
_FOLDED[ord("A") : ord("Z") + 1] += 32
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijection of 64-bit integers that spreads each bit over all."""
    x = x + np.uint64((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def hashes_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, salt: int = 0) -> np.ndarray:
    """A hash of the bytes from each start to its end.

    A run of bytes is taken in blocks of eight, each mixed in before the next, so
    hashes of different runs agree by chance only (2 ** -64 for each two).
    """
    eight = np.ndarray(len(data) + 1, "<u8", np.concatenate([data, np.zeros(8, np.uint8)]), strides=(1,))
    left = ends - starts
    state = mixed(left.astype(np.uint64), salt)
    live, at = np.arange(len(starts)), starts
    for _ in range(BLOCKS):
        if not len(live):
            break
        state[live] = mixed(state[live] ^ (eight[at] & _MASKS[np.minimum(left, 8)]))
        more = left > 8
        live, at, left = live[more], at[more] + 8, left[more] - 8
    for k in live:
        state[k] = xxhash.xxh3_64_intdigest(data[starts[k] : ends[k]].tobytes(), salt)
    return state


@dataclass
class Words:
    """Words of consecutive texts. Text k has words ``first[k]`` to ``first[k + 1]``; ``folded`` are the hashed bytes of ``data``."""

    data: np.ndarray
    folded: np.ndarray
    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    offsets: np.ndarray

    def prefixes(self, n_bytes: int) -> np.ndarray:
        """A hash of the first bytes of each word, or of the whole word if it is no longer; differs from ``hashes``."""
        return hashes_of(self.folded, self.starts, np.minimum(self.ends, self.starts + n_bytes), n_bytes)


def _of(data: np.ndarray, offsets: np.ndarray, lower: bool, letters: bool) -> Words:
    word = ~(_NO_LETTER if letters else _SPACE)[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begin = edge[:-1].copy()
    begin[1:] |= ~word[:-1]
    end = edge[1:]
    end[:-1] |= ~word[1:]
    starts, ends = np.flatnonzero(begin & word), np.flatnonzero(end & word) + 1
    folded = _FOLDED[data] if lower else data
    return Words(data, folded, hashes_of(folded, starts, ends), starts, ends, np.searchsorted(starts, offsets), offsets)


def hashed_words(texts: pa.Array, lower: bool, letters: bool = False) -> Iterator[tuple[int, int, Words]]:
    """(from, to, words) for runs of the texts, about CHUNK bytes each. Null texts are empty."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK, "right")) - 1)
        yield at, to, _of(data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at], lower, letters)
        at = to


def runs_of(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash of the ``width`` words from each place on, where so many follow."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, width, np.uint64)
    for k in range(width):
        out *= np.uint64(0xD1342543DE82EF95)
        out += hashes[k : k + n]
    return mixed(out)


def shingle_sets(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, one text after the other, and where each begins.

    A text with fewer words than ``width`` has its whole sequence as its only
    shingle; a text without words has none.
    """
    n_words = np.diff(words.first)
    n = np.where(n_words >= width, n_words - width + 1, n_words > 0)
    begins = np.concatenate([[0], np.cumsum(n)])
    flat = np.empty(begins[-1], np.uint64)
    every = runs_of(words.hashes, width)
    for k in range(len(n)):
        a, b = begins[k], begins[k + 1]
        if n_words[k] >= width:
            flat[a:b] = every[words.first[k] : words.first[k] + n[k]]
            flat[a:b].sort()
        elif b > a:
            flat[a] = runs_of(words.hashes[words.first[k] : words.first[k + 1]], int(n_words[k]))[0]
    new = np.ones(len(flat), bool)
    new[1:] = flat[1:] != flat[:-1]
    new[begins[:-1][n > 0]] = True
    kept = np.concatenate([[0], np.cumsum(new)])
    return flat[new], kept[begins]
