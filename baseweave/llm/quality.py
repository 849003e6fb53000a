"""Quality scores by a factorisation machine over words, structure and metadata.

A document's features are its hashed words and, standardised, some statistics
of its structure and its lengths. Besides a weight each feature has a short
vector, and each pair of features interacts by the product of their vectors.
The sum over all pairs is half of (sum of vectors) squared less the sum of
squared vectors, so a score takes time linear in the words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .labelled import held_out, learnable
from .words import Words, hashed_words

BUCKETS, RANK = 1 << 14, 8
#: Statistics of a document, see ``features``.
STATS = 20
_UPPER, _LOWER, _DIGIT, _MARK, _HIGH, _OTHER = range(6)
_CLASS = np.full(256, _OTHER, np.int64)
_CLASS[ord("A") : ord("Z") + 1], _CLASS[ord("a") : ord("z") + 1], _CLASS[ord("0") : ord("9") + 1], _CLASS[0x80:] = _UPPER, _LOWER, _DIGIT, _HIGH
for _c in (*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)):
    _CLASS[_c] = _MARK
_PAUSE = np.zeros(256, bool)
_PAUSE[[ord(c) for c in ".,;:!?"]] = True


@dataclass
class Features:
    """Of consecutive texts: hashed words (entries from begin[k] to begin[k + 1]) with values, and statistics."""

    index: np.ndarray
    value: np.ndarray
    begin: np.ndarray
    stats: np.ndarray


def _lines(data: bytes) -> tuple[float, float, float]:
    lines = data.split(b"\n")
    n = len(lines)
    return np.log1p(n), 1 - len(set(lines)) / n, np.log1p(len(data) / n)


def features(words: Words) -> Features:
    n = len(words.first) - 1
    n_words = np.diff(words.first)
    text = np.repeat(np.arange(n), n_words)
    key, tf = np.unique(text * BUCKETS + (words.hashes % np.uint64(BUCKETS)).astype(np.int64), return_counts=True)
    doc = key // BUCKETS
    begin = np.searchsorted(doc, np.arange(n + 1))
    value = np.sqrt(tf)
    value = value / np.sqrt(np.maximum(np.bincount(doc, value**2, n), 1))[doc]

    length = words.ends - words.starts
    last, head = words.data[words.ends - 1], words.data[words.starts]
    per_word = [
        length,
        (_CLASS[last] == _MARK) & ~_PAUSE[last],
        _PAUSE[last],
        _CLASS[head] == _UPPER,
        (_CLASS[head] == _MARK) & (length == 1),
        _CLASS[head] == _DIGIT,
        length > 20,
    ]
    some = np.maximum(n_words, 1)
    stats = [np.bincount(text, x, n) / some for x in per_word]
    every = np.bincount(np.repeat(text, length) * 6 + _CLASS[_inside(words)], minlength=6 * n).reshape(n, 6)
    stats += list((every / np.maximum(every.sum(1, keepdims=True), 1)).T)
    raw = words.data.tobytes()
    edges = words.offsets
    stats += list(np.array([_lines(raw[a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)]).T)
    stats += [np.log1p(n_words), np.log1p(np.diff(edges)), np.diff(begin) / some, (n_words == 0).astype(float)]
    return Features((key % BUCKETS).astype(np.int32), value.astype(np.float32), begin, np.stack(stats, 1).astype(np.float32))


def _inside(words: Words) -> np.ndarray:
    """The bytes of all words."""
    inside = np.zeros(len(words.data) + 1, np.int8)
    inside[words.starts] = 1
    inside[words.ends] -= 1
    return words.data[np.cumsum(inside[:-1], dtype=np.int8) > 0]


@dataclass
class Machine:
    """Weights and vectors: ``BUCKETS`` rows for words, then one for each statistic."""

    bias: float
    weight: np.ndarray
    vectors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    def design(self, f: Features) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Entries of the words and of the statistics as one sparse matrix by rows."""
        n, k = f.stats.shape
        dense = np.clip((f.stats - self.mean) / self.scale, -5, 5) / np.sqrt(k)
        counts = np.diff(f.begin)
        begin = f.begin + k * np.arange(n + 1)
        at = begin[:-1, None] + counts[:, None] + np.arange(k)
        index, value = np.empty(begin[-1], np.int64), np.empty(begin[-1], np.float32)
        mask = np.ones(begin[-1], bool)
        mask[at] = False
        index[mask], value[mask] = f.index, f.value
        index[at], value[at] = BUCKETS + np.arange(k), dense
        return index, value, begin

    def forward(self, index: np.ndarray, value: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores before the sigmoid, and the sums of vectors."""
        linear = np.add.reduceat(self.weight[index] * value, begin[:-1])
        scaled = self.vectors[index] * value[:, None]
        total = np.add.reduceat(scaled, begin[:-1], axis=0)
        squares = np.add.reduceat((scaled**2).sum(1), begin[:-1])
        return self.bias + linear + 0.5 * ((total**2).sum(1) - squares), total

    def score(self, f: Features) -> np.ndarray:
        z, _ = self.forward(*self.design(f))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(f: Features, labels: np.ndarray, epochs: int = 12, batch: int = 128, rate: float = 0.05, decay: float = 1e-4, seed: int = 6) -> Machine:
    """A machine fitted by minibatch AdaGrad; classes weigh alike. Without both classes it scores the share of ones."""
    random = np.random.default_rng(seed)
    k = f.stats.shape[1]
    size = BUCKETS + k
    mean, scale = (f.stats.mean(0), f.stats.std(0) + 1e-3) if len(labels) else (np.zeros(k, np.float32), np.ones(k, np.float32))
    m = Machine(0.0, np.zeros(size, np.float32), random.normal(0, 0.05, (size, RANK)).astype(np.float32), mean, scale)
    share = labels.mean() if len(labels) else 0.5
    if share in (0, 1) or not len(labels):
        m.vectors[:] = 0
        m.bias = float(np.clip(np.log((share + 1e-3) / (1 - share + 1e-3)), -4, 4))
        return m
    index, value, begin = m.design(f)
    weigh = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share))
    g_bias, g_weight, g_vectors = 1e-8, np.full(size, 1e-8), np.full((size, RANK), 1e-8)
    for _ in range(epochs):
        order = random.permutation(len(labels))
        for at in range(0, len(order), batch):
            rows = order[at : at + batch]
            counts = begin[rows + 1] - begin[rows]
            own = np.repeat(begin[rows] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
            i, x, b = index[own], value[own], np.concatenate([[0], np.cumsum(counts)])
            z, total = m.forward(i, x, b)
            error = (1 / (1 + np.exp(-z)) - labels[rows]) * weigh[rows] / len(rows)
            of = np.repeat(np.arange(len(rows)), counts)
            used, place = np.unique(i, return_inverse=True)
            pull = error[of] * x
            d_weight = np.bincount(place, pull, len(used)) + decay * m.weight[used]
            each = pull[:, None] * total[of] - (pull * x)[:, None] * m.vectors[i]
            d_vectors = np.stack([np.bincount(place, each[:, r], len(used)) for r in range(RANK)], 1) + decay * m.vectors[used]
            g_bias += error.sum() ** 2
            m.bias -= rate * error.sum() / np.sqrt(g_bias)
            g_weight[used] += d_weight**2
            m.weight[used] -= rate * d_weight / np.sqrt(g_weight[used])
            g_vectors[used] += d_vectors**2
            m.vectors[used] -= rate * d_vectors / np.sqrt(g_vectors[used])
    return m


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Features of documents to learn from, all of their words."""
    for batch in batches:
        for at, to, words in hashed_words(batch.column(2), lower=True):
            f = features(words)
            columns = [batch.column(k).slice(at, to - at) for k in (0, 1)]
            parts = [[x[a:b].tobytes() for a, b in zip(f.begin[:-1], f.begin[1:], strict=True)] for x in (f.index.astype(np.uint16), f.value)]
            columns += [pa.array(x, pa.binary()) for x in (*parts, [row.tobytes() for row in f.stats])]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "label", "index", "value", "stats"])


def learn_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", bound: int = 6000) -> Machine:
    """A machine fitted to at most ``bound`` labelled documents (``learnable``), one row for each id.

    Features are made where the documents are, of whole texts. What comes to the
    driver is bounded, as a document has BUCKETS hashed words at most: some 2 KB for
    a usual document, and ``bound * BUCKETS * 6`` bytes in all if each had every one.
    """
    chosen = learnable(docs, labels, label, bound).select("doc_id", "label", "text")
    got = chosen.mapInArrow(_extract, "doc_id long, label int, index binary, value binary, stats binary").dropDuplicates(["doc_id"]).toPandas()
    # A fixed order, so that the fit does not depend on how tasks ended.
    got = got.sort_values(["stats", "index", "label"], ignore_index=True)
    index = np.frombuffer(b"".join(got["index"]), np.uint16).astype(np.int32)
    value = np.frombuffer(b"".join(got["value"]), np.float32)
    counts = [len(x) // 2 for x in got["index"]]
    stats = np.frombuffer(b"".join(got["stats"]), np.float32).reshape(-1, STATS)
    return fit(Features(index, value, np.concatenate([[0], np.cumsum(counts)]).astype(np.int64), stats), got["label"].to_numpy())


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", bound: int = 6000) -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted.

    ``score`` estimates that ``quality`` is 1, from the whole text alone. Only
    labelled documents that are not held out are learned from, ``bound`` at
    most. Null text counts as empty; empty texts have their own statistics and
    a score. Repeated rows have equal scores. Without usable labels every score
    is one half. Columns other than id and text are not read. An empty table
    gives no rows.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    learned = learn_quality(source, labels, bound=bound)
    parts = source.sparkSession.sparkContext.broadcast([getattr(learned, f.name) for f in fields(Machine)])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Machine(*parts.value)
        for batch in batches:
            for at, to, words in hashed_words(batch.column(1), lower=True):
                scores = pa.array(machine.score(features(words)).astype(np.float64))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, to - at), scores], ["doc_id", "score"])

    scored = source.mapInArrow(score, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
