"""Toxicity scores of texts restored by a noisy-channel model.

Words written with look-alike signs, drawn-out letters, or signs and spaces
between their letters are character lattices: each sign may stand for a letter,
for itself, or for nothing. A Viterbi search takes the path that a character
trigram model of the corpus and the channel's costs find likeliest. Restored
texts are scored by a lexicon of words and word beginnings that tell toxic
documents, learned from labels.

The character model counts every letter of every document. Only words that
could be disguised are decoded: any other word has a single path, as it has no
look-alike beside its letters, no gap between them and no letter twice on end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import row_key, written
from .labelled import held_out, learnable
from .words import hashed_words

#: Letters of the model: a to z, then U+00E0 to U+00FF; class 0 is everything else.
LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xE0, 0x100)))
N = len(LETTERS) + 1
_CLASS = np.zeros(0x180, np.int64)
for _k, _c in enumerate(LETTERS):
    _CLASS[ord(_c)] = _CLASS[ord(_c.upper()) if len(_c.upper()) == 1 and ord(_c.upper()) < 0x180 else ord(_c)] = _k + 1
#: The letters that a sign is used for.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "£": "l", "*": "aeiou",
}
#: Log costs of the channel: a sign for a letter, a sign for nothing, a letter of a run for nothing, one vowel masked by a star,
#: a sign for itself, the second of two equal letters for nothing.
SIGN, NOTHING, DRAWN, MASKED, ITSELF, DOUBLED = -0.7, -0.7, -0.2, -2.0, -6.0, -2.0
_GAPS = ".-_*~"
_LETTER, _SIGN, _GAP, _BLANK = 1, 2, 4, 8
_KIND = np.zeros(0x180, np.uint8)
_KIND[[k for k in range(0x180) if chr(k).isalpha()]] = _LETTER
for _c in LOOKALIKES:
    _KIND[min(ord(_c), 0x17F)] |= _SIGN
for _c in _GAPS:
    _KIND[ord(_c)] |= _GAP
_KIND[0x20] = _BLANK


def disguised(texts: list[str]) -> list[list[tuple[int, int]]]:
    """For each text the places of words that could be disguised.

    These have a letter, and besides a sign next to a letter or to another sign,
    gaps between two of these, or a letter twice on end; or they are three or
    more single characters with gaps or blanks between each two.
    """
    if not texts:
        return []
    code = np.frombuffer("\n".join([*texts, "\n\n\n\n"]).encode("utf-32-le", "replace"), "<u4")
    kind = _KIND[np.minimum(code, 0x17F)]
    letter, sign, gap = (kind & _LETTER) > 0, (kind & _SIGN) > 0, (kind & _GAP) > 0
    between = gap | ((kind & _BLANK) > 0)
    n = len(code)
    either = letter | sign
    odd = np.zeros(n, bool)
    odd[:-1] = sign[:-1] & either[1:]
    odd[1:] |= sign[1:] & either[:-1]
    # A gap's run is between two characters if one stands before its first sign and one after its last.
    plain = np.flatnonzero(~gap)
    apart = np.flatnonzero((np.diff(plain) > 1) & either[plain[:-1]] & either[plain[1:]])
    odd[plain[apart] + 1] = True
    same = _CLASS[np.minimum(code, 0x17F)]
    odd[:-1] |= letter[:-1] & ((code[:-1] == code[1:]) | (same[:-1] > 0) & (same[:-1] == same[1:]))
    one = letter | sign & ~gap
    alone = one.copy()
    alone[1:] &= ~one[:-1]
    alone[:-1] &= ~one[1:]
    single = np.flatnonzero(alone)
    others = np.concatenate([[0], np.cumsum(~between)])
    linked = others[single[1:]] == others[single[:-1] + 1]
    three = np.flatnonzero(linked[:-1] & linked[1:])
    edges = np.bincount(single[three], minlength=n + 1) - np.bincount(single[three + 2] + 1, minlength=n + 1)
    inside = np.cumsum(edges)[:n] > 0
    word = letter | sign | gap | inside
    begins = np.flatnonzero(word & ~np.append(False, word[:-1]))
    ends = np.flatnonzero(word & ~np.append(word[1:], False)) + 1
    odd, lettered, spaced = (np.concatenate([[0], np.cumsum(x)]) for x in (odd, letter, inside))
    some = (odd[ends] > odd[begins]) & (lettered[ends] > lettered[begins]) | (spaced[ends] > spaced[begins])
    begins, ends = begins[some], ends[some]
    first = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    cuts = np.searchsorted(begins, first)
    return [list(zip((begins[a:b] - at).tolist(), (ends[a:b] - at).tolist(), strict=True)) for a, b, at in zip(cuts[:-1], cuts[1:], first[:-1], strict=True)]


def char_counts(docs: DataFrame) -> np.ndarray:
    """How often each three letter classes follow each other in the texts of ``docs`` (column text).

    Each task adds up its documents; the sums over tasks have no more rows than
    there are triples, a constant.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(N**3, np.int64)
        for batch in batches:
            for text in batch.column(0):
                codes = np.frombuffer(f"  {text.as_py()} ".encode("utf-32-le", "replace"), "<u4")
                c = _CLASS[np.minimum(codes, 0x17F)]
                total += np.bincount(c[:-2] * N * N + c[1:-1] * N + c[2:], minlength=N**3) if len(c) > 4096 else 0
                if len(c) <= 4096:
                    np.add.at(total, c[:-2] * N * N + c[1:-1] * N + c[2:], 1)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["triple", "n"])

    got = docs.select("text").mapInArrow(count, "triple long, n long").groupBy("triple").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(N**3)
    counts[got["triple"].to_numpy(np.int64)] = got["n"].to_numpy()
    return counts.reshape(N, N, N)


def char_model(counts: np.ndarray) -> np.ndarray:
    """Log probability of a letter class after two others, interpolated with shorter contexts."""
    one = counts.sum((0, 1)) + 1
    one /= one.sum()
    two = counts.sum(0)
    two = (two + 5 * one) / (two.sum(1, keepdims=True) + 5)
    three = (counts + 5 * two) / (counts.sum(2, keepdims=True) + 5)
    return np.log(three)


class Restorer:
    """Texts with their disguised words replaced by the likeliest plain ones, which are remembered.

    Restorers that are given one ``known`` have one memory, of ``remembered`` words at most.
    """

    def __init__(self, model: np.ndarray, known: dict[str, str] | None = None, remembered: int = 200_000):
        self.model, self.known, self.remembered = model.tolist(), {} if known is None else known, remembered
        self.letter = {c: k + 1 for k, c in enumerate(LETTERS)}
        self.ways: dict[tuple[str, int], list[tuple[str, int, float]]] = {}

    def word(self, seen: str) -> str:
        """Viterbi over the lattice of one disguised word; a state is the last two letters read.

        A look-alike may stand for each of its letters, signs and gaps also for
        nothing, and all of them for themselves. Of a letter twice or more, as
        written or as read, one or two are meant. A state keeps its likeliest
        path as a chain of characters with the one before, so time and memory
        are in proportion to the word.
        """
        seen = seen.lower()
        nothing = (-np.inf, None)
        states: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
        before, nth = "", 0
        for at, c in enumerate(seen):
            nth = nth + 1 if c == before else 1
            before = c
            drawn = 0 if nth == 1 or nth == 2 and seen[at + 1 : at + 2] != c else min(nth, 3) - 1
            ways = self.ways.get((c, drawn)) or self._ways(c, drawn)
            reached: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for state, (score, path) in states.items():
                a, b = state
                after = self.model[a][b]
                for x, k, cost in ways:
                    s = score + cost
                    if not x:
                        if s > reached.get(state, nothing)[0]:
                            reached[state] = (s, path)
                        continue
                    # However its two letters are written, a word is read as one.
                    if k and k == b and s + DOUBLED > reached.get(state, nothing)[0]:
                        reached[state] = (s + DOUBLED, path)
                    s += after[k]
                    if s > reached.get((b, k), nothing)[0]:
                        reached[b, k] = (s, (x, path))
            states = reached
        path = max(((s + self.model[a][b][0], path) for (a, b), (s, path) in states.items()), key=lambda x: x[0])[1]
        read = []
        while path:
            read.append(path[0])
            path = path[1]
        return "".join(reversed(read))

    def _ways(self, c: str, drawn: int) -> list[tuple[str, int, float]]:
        """What a character may stand for, the letter's number, and at what cost.

        ``drawn`` is 1 for the second and 2 for a later one of three or more equal characters.
        """
        if c in self.letter:
            ways = [[(c, 0.0)], [(c, 0.0), ("", DRAWN)], [("", 0.0)]][drawn]
        elif c.isalpha():
            ways = [(c, 0.0)]
        else:
            ways = [(c, ITSELF)] + [(x, MASKED if c == "*" else SIGN) for x in LOOKALIKES.get(c, "")]
            ways += [] if c.isalnum() else [("", NOTHING)]
        self.ways[c, drawn] = [(x, self.letter.get(x, 0), cost) for x, cost in ways]
        return self.ways[c, drawn]

    def texts(self, texts: list[str]) -> list[str]:
        return [self._replaced(t, places) if places else t for t, places in zip(texts, disguised(texts), strict=True)]

    def _replaced(self, text: str, places: list[tuple[int, int]]) -> str:
        parts, at = [], 0
        for begin, end in places:
            seen = text[begin:end]
            found = self.known.get(seen)
            if found is None:
                core = seen.strip(_GAPS.replace("*", " "))
                found = self.word(core) if core else seen
                if len(self.known) > self.remembered:
                    self.known.clear()
                if len(seen) < 200:
                    self.known[seen] = found
            parts += [text[at:begin], " ", found, " "]
            at = end
        return "".join([*parts, text[at:]])


#: Bytes of a word's beginnings that are features; 0 stands for the whole word.
BEGINNINGS = (0, 3, 4, 5, 6)
#: Toxic documents of the sample that a feature needs.
LEAST = 3


def _keys(words, n_bytes: int) -> np.ndarray:
    return words.prefixes(n_bytes) if n_bytes else words.hashes


@dataclass
class Lexicon:
    """Weights of features by the number of their bytes, and the coefficients of a logistic regression."""

    features: dict[int, tuple[np.ndarray, np.ndarray]]
    coefficients: np.ndarray

    def weights(self, keys: list[np.ndarray]) -> np.ndarray:
        """For each word its heaviest feature; ``keys`` has the words' features of each kind."""
        heaviest = np.zeros(len(keys[0]))
        for (own, weight), key in zip(self.features.values(), keys, strict=True):
            if len(own):
                at = np.minimum(np.searchsorted(own, key), len(own) - 1)
                heaviest = np.maximum(heaviest, np.where(own[at] == key, weight[at], 0))
        return heaviest

    def score(self, words) -> np.ndarray:
        running = np.concatenate([[0], np.cumsum(self.weights([_keys(words, n) for n in self.features]))])
        z = evidence(running[words.first[1:]] - running[words.first[:-1]], np.diff(words.first)) @ self.coefficients
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def evidence(weight: np.ndarray, n_words: np.ndarray) -> np.ndarray:
    """What the regression sees of a document: the weight of its mentions against its length."""
    weight = np.maximum(weight, 0)
    return np.stack([np.ones(len(weight)), np.log1p(weight), np.log1p(n_words), weight > 0.5], 1)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.3) -> np.ndarray:
    """Coefficients by Newton's method with a small penalty."""
    c = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ c, -30, 30)))
        curve = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(c))
        step = np.linalg.solve(curve, x.T @ (y - p) - ridge * c)
        c += step * min(1, 4 / max(1e-9, np.abs(step).max()))
    return c


def telling(counts: pd.DataFrame, docs: np.ndarray, words: np.ndarray, own: list[int], least: int = LEAST, ratio: float = 10, sure: float = 15) -> pd.DataFrame:
    """(feature, weight, sure) of the features that tell toxic documents, by the documents of the folds ``own``.

    ``counts`` has for each feature its documents and its mentions by fold and
    label (``_columns``); ``docs`` and ``words`` have all documents' numbers by
    fold and label. A feature tells if ``least`` toxic documents mention it and
    if it is ``ratio`` times as frequent in toxic documents as in others; its
    weight is the logarithm of that. It is sure if as many of its documents are
    toxic as hardly happens by chance (a log-likelihood of ``sure``).
    """
    (good, bad), (mild, harsh) = ([sum((counts[f"{kind}{k}{t}"].to_numpy(float) for k in own), np.zeros(len(counts))) for t in (0, 1)] for kind in "dm")
    n_good, n_bad = docs[own].sum(0)
    base = np.clip(n_bad / max(1, n_good + n_bad), 0.001, 0.999)
    n = np.maximum(bad + good, 1)
    likely = bad * np.log(np.maximum(bad, 0.5) / n / base) + good * np.log(np.maximum(good, 0.5) / n / (1 - base))
    rate = [(m + extra) / (total + 1) for m, extra, total in ((mild, 1, words[own, 0].sum()), (harsh, 0, words[own, 1].sum()))]
    times_as = rate[1] / rate[0]
    tells = (bad >= least) & (times_as >= ratio)
    found = pd.DataFrame({"feature": counts["feature"], "weight": np.log(np.maximum(times_as, 1e-9)), "sure": (bad > base * n) & (likely >= sure)})
    return found[tells]


def choose(found: pd.DataFrame, least: int = LEAST) -> tuple[np.ndarray, np.ndarray]:
    """Sure features, and besides features that cover the toxic documents, the one that covers most first; and their weights.

    A document counts by its mentions, up to five: chance features are mentioned
    once. Each choice takes the documents that it covers out of the count, so
    rare features of these are not learned.
    """
    names, first, f = np.unique(found["feature"].to_numpy(np.uint64), return_index=True, return_inverse=True)
    d, gain = found["doc"].to_numpy(), np.minimum(found["times"].to_numpy(), 5).astype(float)
    chosen = set(np.flatnonzero(found["sure"].to_numpy()[first]).tolist())
    while len(d):
        best = int(np.bincount(f, gain, len(names)).argmax())
        covered = np.unique(d[f == best])
        if len(covered) < least:
            break
        chosen.add(best)
        keep = ~np.isin(d, covered)
        d, f, gain = d[keep], f[keep], gain[keep]
    chosen = sorted(chosen)
    return names[chosen], found["weight"].to_numpy()[first][chosen]


def _mentioned(restorer: Restorer, texts: pa.Array) -> Iterator:
    for start in range(0, len(texts), 64):
        restored = pa.array([t.lower() for t in restorer.texts(texts.slice(start, 64).to_pylist())], pa.large_string())
        for at, to, words in hashed_words(restored, lower=False, letters=True):
            yield start + at, start + to, words


def _columns(folds: int) -> list[str]:
    """Names of a feature's counts: documents (d) and mentions (m) by fold and label."""
    return [f"{kind}{k}{t}" for kind in "dm" for k in range(folds) for t in (0, 1)]


def _sample(chosen: DataFrame, model, folds: int) -> DataFrame:
    """(doc, fold, label, keys) of each distinct document: the features of all its words, decoded once and written."""

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(*model.value)
        for batch in batches:
            for at, to, words in _mentioned(restorer, batch.column(1)):
                keys = [_keys(words, n) for n in BEGINNINGS]
                rows = [np.concatenate([k[a:b] for k in keys]).tobytes() for a, b in zip(words.first[:-1], words.first[1:], strict=True)]
                label = batch.column(0).slice(at, to - at)
                docs = [int.from_bytes(hashlib.blake2b(bytes([t]) + r, digest_size=8).digest(), "little", signed=True) for t, r in zip(label.to_pylist(), rows, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), label, pa.array(rows, pa.binary())], ["doc", "label", "keys"])

    made = chosen.select("label", "text").mapInArrow(extract, "doc long, label int, keys binary")
    # Copies say nothing new.
    made = made.dropDuplicates(["doc"]).select("doc", F.pmod("doc", F.lit(folds)).cast("int").alias("fold"), "label", "keys")
    return written(made, "toxicity-sample")


def _counted(sample: DataFrame, folds: int) -> DataFrame:
    """For each feature of the sample its documents and mentions by fold and label, added up within batches before the shuffle."""
    names = _columns(folds)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            group = np.array(batch.column(0)) * 2 + np.array(batch.column(1))
            each = [np.unique(np.frombuffer(k.as_buffer(), np.uint64), return_counts=True) for k in batch.column(2)]
            if not each:
                continue
            feature, place = np.unique(np.concatenate([f for f, _ in each]), return_inverse=True)
            of = np.repeat(group, [len(f) for f, _ in each])
            total = np.zeros((len(names), len(feature)), np.int64)
            np.add.at(total, (of, place), 1)
            np.add.at(total, (of + 2 * folds, place), np.concatenate([m for _, m in each]))
            yield pa.RecordBatch.from_arrays([pa.array(feature.view(np.int64)), *map(pa.array, total)], ["feature", *names])

    schema = "feature long, " + ", ".join(f"{n} long" for n in names)
    return sample.select("fold", "label", "keys").mapInArrow(count, schema).groupBy("feature").agg(*[F.sum(n).alias(n) for n in names])


def _covering(sample: DataFrame, features: np.ndarray) -> pd.DataFrame:
    """(doc, fold, feature, times): which of the features toxic documents mention, and how often."""
    features = sample.sparkSession.sparkContext.broadcast(np.sort(features))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, fold, keys in zip(*(batch.column(k) for k in range(3)), strict=True):
                own, times = np.unique(np.frombuffer(keys.as_buffer(), np.uint64), return_counts=True)
                known = np.isin(own, features.value)
                n = int(known.sum())
                columns = [np.full(n, doc.as_py()), np.full(n, fold.as_py(), np.int32), own[known].view(np.int64), times[known]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["doc", "fold", "feature", "times"])

    found = sample.filter("label = 1").select("doc", "fold", "keys").mapInArrow(find, "doc long, fold int, feature long, times long").toPandas()
    return found.assign(feature=found["feature"].to_numpy(np.int64).view(np.uint64)).sort_values(["doc", "feature"], ignore_index=True)


def _cross_weighed(sample: DataFrame, lexicons: list[Lexicon]) -> pd.DataFrame:
    """(label, weight, words) of each document: what the lexicon of the other folds finds in it, and its number of words."""
    parts = sample.sparkSession.sparkContext.broadcast([_parts(x) for x in lexicons])

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [Lexicon(*p) for p in parts.value]
        for batch in batches:
            keys = [np.frombuffer(k.as_buffer(), np.uint64).reshape(len(BEGINNINGS), -1) for k in batch.column(2)]
            weight = [float(known[fold].weights(list(k)).sum()) for fold, k in zip(batch.column(0).to_pylist(), keys, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(weight, pa.float64()), pa.array([k.shape[1] for k in keys], pa.int64())], ["label", "weight", "words"])

    rows = sample.select("fold", "label", "keys").mapInArrow(weigh, "label int, weight double, words long").toPandas()
    return rows.sort_values(["words", "weight", "label"], ignore_index=True)


def learn_lexicon(chosen: DataFrame, model, folds: int = 3) -> Lexicon:
    """The lexicon of ``chosen`` (label, text), and the regression of what lexicons of the other folds find in each fold.

    Executors decode the sample once, add up its features by fold and label and
    find where telling ones are mentioned; one pass serves all folds. The driver
    gets the features that may tell, their mentions in toxic documents, and two
    numbers for each document.
    """
    sample = _sample(chosen, model, folds)
    totals = np.zeros((2, folds, 2))
    for r in sample.groupBy("fold", "label").agg(F.count(F.lit(1)).alias("docs"), F.sum(F.octet_length("keys") / (8 * len(BEGINNINGS))).alias("words")).collect():
        totals[:, r["fold"], r["label"]] = r["docs"], r["words"]
    toxic = sum((F.col(f"d{k}1") for k in range(folds)), F.lit(0))
    # A feature that tells in no more documents than this tells in none of the folds' shares either.
    counts = _counted(sample, folds).filter(toxic >= LEAST).toPandas()
    counts = counts.assign(feature=counts["feature"].to_numpy(np.int64).view(np.uint64)).sort_values("feature", ignore_index=True)
    every = list(range(folds))
    own = [every, *[[k for k in every if k != out] for out in every]]
    tell = [telling(counts, *totals, folds_of, LEAST) for folds_of in own]
    found = _covering(sample, np.unique(np.concatenate([t["feature"].to_numpy(np.uint64) for t in tell])))

    def lexicon(folds_of: list[int], tells: pd.DataFrame) -> Lexicon:
        names, weight = choose(found[found["fold"].isin(folds_of)].merge(tells, on="feature"))
        order = np.argsort(names)
        # A hash tells its kind, so each kind may look among all names.
        return Lexicon({n: (names[order], weight[order]) for n in BEGINNINGS}, np.array([-5.0, 0, 0, 0]))

    learned, *others = [lexicon(f, t) for f, t in zip(own, tell, strict=True)]
    if totals[0, :, 1].sum():
        rows = _cross_weighed(sample, others)
        learned.coefficients = logistic(evidence(rows["weight"].to_numpy(), rows["words"].to_numpy()), rows["label"].to_numpy() == 1)
    return learned


def _parts(lexicon: Lexicon) -> list:
    return [getattr(lexicon, f.name) for f in fields(Lexicon)]


#: Labelled documents to learn from, at most, and the score from which a document counts as toxic.
BOUND, SURE = 4000, 0.7


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", bound: int = BOUND) -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted.

    ``score`` estimates that ``toxic`` is 1, from the whole text alone. The
    character model is of all documents; the lexicon is of labelled documents
    that are not held out, ``bound`` at most, one text for each id. Null text counts as empty; an
    empty text has no mentions and the score of such. Repeated rows have equal
    scores. Without usable labels nothing is predicted toxic. Columns other
    than id and text are not read. An empty table gives no rows.
    """
    predicted = (F.col("score") >= SURE).cast("int").alias("predicted")
    return _scored(docs, labels, id_col, text_col, bound).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted)


def _scored(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, bound: int = BOUND, keys: bool = False) -> DataFrame:
    """One row per input row: doc_id, score; with ``keys`` also the key of its row."""
    columns = [F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")]
    source = docs.select(*columns)
    context = source.sparkSession.sparkContext
    # A worker keeps what it was sent from task to task, and so in the dict what it has decoded.
    model = context.broadcast((char_model(char_counts(source)), {}))
    lexicon = learn_lexicon(learnable(source, labels, "toxic", bound), model)
    parts = context.broadcast(_parts(lexicon))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer, learned = Restorer(*model.value), Lexicon(*parts.value)
        for batch in batches:
            for at, to, words in _mentioned(restorer, batch.column(1)):
                scores = pa.array(learned.score(words).astype(np.float64))
                own = [batch.column(k).slice(at, to - at) for k in (0, 2)[: 1 + keys]]
                yield pa.RecordBatch.from_arrays([*own, scores], ["doc_id", "row", "score"] if keys else ["doc_id", "score"])

    if keys:
        source = docs.select(*columns, row_key(id_col, text_col).alias("row"))
    return source.mapInArrow(score, "doc_id long, row binary, score double" if keys else "doc_id long, score double")


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with all their columns.

    Each row is judged by its own text, whether or not its id is null or
    repeated; repeated rows stay or go together. Null and empty texts have no
    mentions and stay. Columns may have any names. An empty table stays empty.
    """
    scored = _scored(docs, labels, id_col, text_col, keys=True)
    bad = scored.filter(F.col("score") >= SURE).select(F.col("row").alias("__bad_row")).distinct()
    return docs.join(bad, row_key(id_col, text_col) == F.col("__bad_row"), "left_anti")
