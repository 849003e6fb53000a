"""What the toxicity lexicon is learned from, recomputed plainly; hot URLs, blocks of shards, phrases that many items share."""

import math
import random
import unicodedata
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from baseweave.llm import decontamination, queries, sharding, token_counts, toxicity, url_filter
from baseweave.llm.words import hashed_words

TEXTS = ["", "a", "Hello, W0rld", "ÀÿŸß÷ſ İK", "\n\t x", "日本 語a", "ab" * 3000, None]


def test_char_counts(spark):
    number = {}
    for k, c in enumerate(toxicity.LETTERS):
        number |= {x: k + 1 for x in (c, c.upper()) if len(x) == 1 and ord(x) < 0x180}
    expected = Counter()
    for t in TEXTS:
        seen = [number.get(c, 0) for c in f"  {t or ''} "]
        expected.update(zip(seen, seen[1:], seen[2:]))
    table = spark.createDataFrame([(t or "",) for t in TEXTS], "text string")
    found = toxicity.char_counts(table)
    assert {tuple(int(k) for k in at): int(found[tuple(at)]) for at in np.argwhere(found)} == expected
    assert not toxicity.char_counts(table.limit(0)).any()


def labelled_keys(rng, n=150, folds=3):
    """(doc, fold, label, keys): toxic documents have features 0 to 4 often, others hardly."""
    made = []
    for doc in range(n):
        label = int(rng.random() < 0.3)
        keys = [rng.randrange(5, 40) for _ in range(rng.randrange(5, 30))]
        keys += [rng.randrange(5) for _ in range(rng.randrange(4))] if label or rng.random() < 0.04 else []
        made.append((doc, doc % folds, label, keys))
    return made


@pytest.mark.parametrize("own", [[0, 1, 2], [0, 2]])
def test_telling_features(spark, own):
    rows = labelled_keys(random.Random(5))
    sample = spark.createDataFrame([(d, f, t, np.array(k, np.uint64).tobytes()) for d, f, t, k in rows], "doc long, fold int, label int, keys binary")
    counts = toxicity._counted(sample, 3).toPandas()
    docs, mentions = Counter(), Counter()
    for _, fold, label, keys in rows:
        docs.update((k, f"d{fold}{label}") for k in set(keys))
        mentions.update((k, f"m{fold}{label}") for k in keys)
    assert {(r["feature"], c): r[c] for _, r in counts.iterrows() for c in toxicity._columns(3) if r[c]} == docs | mentions

    n_docs, n_words = np.zeros((3, 2)), np.zeros((3, 2))
    for _, fold, label, keys in rows:
        n_docs[fold, label] += 1
        n_words[fold, label] += len(keys)
    found = toxicity.telling(counts, n_docs, n_words, own)
    expected = {}
    mine = [(label, keys) for _, fold, label, keys in rows if fold in own]
    base = sum(t for t, _ in mine) / len(mine)
    for key in range(40):
        bad, good = (sum(key in k for t, k in mine if t == label) for label in (1, 0))
        harsh, mild = (sum(k.count(key) for t, k in mine if t == label) for label in (1, 0))
        times_as = harsh / (sum(len(k) for t, k in mine if t) + 1) / ((mild + 1) / (sum(len(k) for t, k in mine if not t) + 1))
        if bad >= 3 and times_as >= 10:
            n = bad + good
            likely = bad * math.log(bad / n / base) + (good * math.log(good / n / (1 - base)) if good else 0)
            expected[key] = (math.log(times_as), bad > base * n and likely >= 15)
    assert expected and set(found["feature"]) == set(expected)
    for r in found.itertuples():
        assert r.weight == pytest.approx(expected[r.feature][0]) and r.sure == expected[r.feature][1]


@pytest.mark.parametrize("seed", range(5))
def test_choice_covers_greedily(seed):
    rng = random.Random(seed)
    times = {(d, f): rng.randrange(1, 9) for d in range(30) for f in rng.sample(range(12), 3)}
    weight, sure = {f: rng.random() for f in range(12)}, {f: rng.random() < 0.1 for f in range(12)}
    found = pd.DataFrame([(d, f, n, weight[f], sure[f]) for (d, f), n in times.items()], columns=["doc", "feature", "times", "weight", "sure"])
    chosen, left = {f for _, f in times if sure[f]}, dict(times)
    while left:
        gain = defaultdict(int)
        for (_, f), n in left.items():
            gain[f] += min(n, 5)
        best = min(gain, key=lambda f: (-gain[f], f))
        covered = {d for d, f in left if f == best}
        if len(covered) < toxicity.LEAST:
            break
        chosen.add(best)
        left = {(d, f): n for (d, f), n in left.items() if d not in covered}
    names, weights = toxicity.choose(found)
    assert dict(zip(names.tolist(), weights.tolist(), strict=True)) == {f: weight[f] for f in chosen}


def only(texts):
    return next(hashed_words(pa.array(texts, pa.large_string()), lower=False, letters=True))[2]


def test_score_is_of_the_heaviest_features():
    known = {0: {"idiot": 2.0, "fool": 0.7}, 3: {"mor": 1.5, "idi": 0.4}, 4: {}, 5: {"ninny": 3.0}, 6: {}}
    features = {}
    for n, own in known.items():
        keys = np.concatenate([np.zeros(0, np.uint64), *[toxicity._keys(only([w + ("x" if n else "")]), n) for w in own]])
        order = np.argsort(keys)
        features[n] = (keys[order], np.array(list(own.values()))[order])
    coefficients = np.array([-3.0, 1.5, -0.2, 0.8])
    texts = ["", "idiot", "an idiotic moron, fool; fools", "ninnyhammer and moronic idiot", "plain words here"]
    scores = toxicity.Lexicon(features, coefficients).score(only(texts))
    for text, score in zip(texts, scores, strict=True):
        own = text.replace(",", "").replace(";", "").split()
        weight = sum(max([0.0, *[w for n, f in known.items() for b, w in f.items() if (x[:n] if n else x) == b]]) for x in own)
        z = -3 + 1.5 * math.log1p(weight) - 0.2 * math.log1p(len(own)) + 0.8 * (weight > 0.5)
        assert score == pytest.approx(1 / (1 + math.exp(-z)))


def test_restorers_share_a_memory():
    model, known = np.full((toxicity.N,) * 3, -4.0), {}
    first = toxicity.Restorer(model, known).texts(["an 1d10t here"])
    assert known
    assert toxicity.Restorer(model, known).texts(["an 1d10t here"]) == first == toxicity.Restorer(model).texts(["an 1d10t here"])


def test_hot_url(spark):
    urls = ["http://a.example.com/en/x"] * 1500 + [None] * 20 + [f"http://h{k % 2900}.net/fr/{k}" for k in range(3000)] + ["http://com:80/"] * 2
    table = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string").repartition(4)
    found = url_filter.judge_urls(table, url_filter.rule_table(spark, queries.RULES)).collect()
    assert Counter(r.page_id for r in found) == Counter(range(len(urls)))
    assert Counter((r.rule, r.verdict) for r in found) == Counter({("example.com/en/", "block"): 1500, ("net/fr/", "block"): 3000, (None, "allow"): 22})


@pytest.mark.parametrize("broadcast", [0, 100])
def test_blocks_change_no_shard(spark, monkeypatch, broadcast):
    rng = random.Random(6)
    rows = [(k, "x" * rng.randrange(300) + str(k % 170)) for k in range(200)] + [(None, None), (None, ""), (3, "again")]
    table = spark.createDataFrame(rows, "doc_id bigint, text string")
    columns = ("doc_id", "size", "text_crc32", "shard", "slot")
    whole = Counter(tuple(r[c] for c in columns) for r in sharding.shard_documents(table, shards=5).collect())
    monkeypatch.setattr(sharding, "BROADCAST_BLOCKS", broadcast)
    found = Counter(tuple(r[c] for c in columns) for r in sharding.shard_documents(table, shards=5, block_rows=8).collect())
    # Which of a group's rows takes which of its slots is open.
    assert Counter({(*k[:4],): 0 for k in whole}).keys() == Counter({(*k[:4],): 0 for k in found}).keys()
    assert sorted(k[3:] for k in found.elements()) == sorted(k[3:] for k in whole.elements())


@pytest.mark.parametrize("shared", [0, 2, 1000])
def test_shared_phrases_hide_no_item(spark, monkeypatch, shared):
    monkeypatch.setattr(decontamination, "SHARED", shared)
    rng = random.Random(7)
    phrase = " ".join(f"p{k}" for k in range(12))
    items = [(k, f"{phrase} " + " ".join(f"i{k}w{j}" for j in range(k % 5 * 3))) for k in range(15)] + [(20, phrase)]
    held = [(k, " ".join(rng.choices("abcdefgh", k=30)) + f" {t}") for k, t in items] + [(50, phrase), (51, "a b c d e f")]
    sets = {}
    for kind, rows in (("item", items), ("doc", held)):
        for k, t in rows:
            w = t.split()
            sets[kind, k] = {tuple(w[j : j + 5]) for j in range(len(w) - 4)}
    expected = {(d, i) for (x, d), s in sets.items() if x == "doc" for (y, i), g in sets.items() if y == "item" and 100 * len(s & g) >= 75 * len(g)}
    table = lambda rows, name: spark.createDataFrame(rows, f"{name} bigint, text string")
    found = decontamination.contaminated(table(held, "doc_id"), table(items, "item_id")).collect()
    assert {(r.doc_id, r.item_id) for r in found} == expected and len(expected) > 40


class Changed:
    """The shipped model but for some answers."""

    def __init__(self, **answers):
        self.model, self.answers = token_counts._read(None), answers

    def __getattr__(self, name):
        return self.answers.get(name) or getattr(self.model, name)


def test_models_that_add_up():
    model = token_counts._read(None)
    assert token_counts.adds_up(model)
    assert not token_counts.adds_up(Changed(id_to_piece=lambda k: "▁of▁the" if k == 500 else model.id_to_piece(k)))
    assert not token_counts.adds_up(Changed(normalize=lambda t: model.normalize(t)[1:]))
    assert not token_counts.adds_up(Changed(normalize=lambda t: model.normalize(" ".join(t.split()))))
    assert not token_counts.adds_up(Changed(normalize=lambda t: unicodedata.normalize("NFKC", model.normalize(t))))
    assert not token_counts.adds_up(Changed(piece_to_id=lambda p: model.unk_id()))


def test_whole_texts_count_alike(spark, monkeypatch):
    table = spark.createDataFrame([*enumerate(TEXTS), (None, " a  b "), (0, "")], "doc_id bigint, text string")
    parts = Counter(token_counts.count_tokens(table).collect())
    monkeypatch.setattr(token_counts, "adds_up", lambda model: False)
    assert Counter(token_counts.count_tokens(table).collect()) == parts
    assert token_counts.count_tokens(table.limit(0)).collect() == []
