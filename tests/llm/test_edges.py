"""What each operator and stage does with hashes made to collide, hot ids, odd rows, very long texts and exact search."""

import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from test_operators import ODD, docs, find_components, labelled, prose, shingles

import corpus_pipeline
from baseweave.llm import decontamination, exact_dedup, labelled as learn, near_dedup, packing, quality, sharding, substring_dedup, token_counts, toxicity, words
from baseweave.llm.fm_index import Bits, FMIndex, WaveletMatrix


def thue_morse(n, letters):
    return "".join(letters[k.bit_count() % 2] for k in range(n))


#: Words that hashes by powers of any odd base modulo 2 ** 64 cannot tell apart.
ONE, OTHER = thue_morse(1024, "ab"), thue_morse(1024, "ba")


def test_hashes_tell_words_apart():
    found = [w.hashes.tolist() for _, _, w in words.hashed_words(pa.array([f"{ONE} {OTHER} {ONE}", "x" * 300 + "y", "x" * 300 + "z"]), lower=False)][0]
    assert found[0] == found[2] and len(set(found)) == 4


def test_near_is_no_hash_accident(spark):
    rows = [(1, ONE), (2, OTHER), (3, f"v w x y {ONE}"), (4, f"v w x y {OTHER}"), (5, ONE)]
    found = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(docs(spark, rows)).collect()}
    assert found == {1: 1, 2: 2, 3: 3, 4: 4, 5: 1}


def test_substring_is_no_hash_accident(spark):
    rng = random.Random(1)
    before, after = prose(rng, 12), prose(rng, 12)
    rows = [(1, f"{before} {ONE} {after}"), (2, f"{before} {OTHER} {after}"), (3, f"{before} {ONE} z")]
    found = {r.doc_id: r.n_removed for r in substring_dedup.substring_dedup(docs(spark, rows)).collect()}
    assert found == {1: 0, 2: 0, 3: 13}


def test_near_texts_of_one_id(spark):
    rng = random.Random(2)
    a, b = prose(rng, 60), prose(rng, 60)
    rows = [(3, a), (7, f"{a} q"), (7, b), (9, f"{b} r"), (11, prose(rng, 60)), (7, "")]
    found = Counter((r.doc_id, r.n_shingles > 0, r.component_id, r.kept) for r in near_dedup.near_duplicates(docs(spark, rows)).collect())
    assert found == Counter({(3, True, 3, True): 1, (7, True, 3, False): 2, (9, True, 3, False): 1, (11, True, 11, True): 1, (7, False, 7, True): 1})
    assert {r.doc_id for r in near_dedup.drop_near_duplicates(docs(spark, rows)).collect()} == {3, 11}


def test_near_small_sets_are_found(spark):
    """10,000 pairs of sets with three of four shingles in common, and how many of them the bands miss."""
    w = [f"u{k}" for k in range(40_000)]
    texts = []
    for k in range(10_000):
        first = [f"{x}.{k}" for x in w[4 * k : 4 * k + 4]] + ["s", "t", "u", f"z{k}"]
        texts += [" ".join(first), " ".join(first[:-1])]  # four shingles, and the first three of them
    rows = list(enumerate(texts))
    assert [len(shingles(t)) for t in texts[:2]] == [4, 3]
    found = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(docs(spark, rows)).collect()}
    assert sum(found[2 * k + 1] != 2 * k for k in range(10_000)) == 0
    assert all(found[2 * k] == 2 * k for k in range(10_000))


@pytest.mark.parametrize("seed", range(6))
def test_matching_statistics(seed):
    rng = random.Random(seed)
    width, letters = rng.choice([2, 5, 13]), rng.choice([1, 2, 30])
    made = lambda n, more=0: [[7 * rng.randrange(letters + more) + 3 for _ in range(rng.randrange(0, 50))] for _ in range(n)]
    indexed, owners = made(12), [rng.randrange(5) for _ in range(12)]
    streamed = made(5, 1) + [s[3:] for s in indexed]
    flat = lambda seqs: (np.array([x for s in seqs for x in s], np.uint64), np.array([len(s) for s in seqs]))
    longest, owner = FMIndex(*flat(indexed), np.array(owners), width).matches(*flat(streamed))
    has = lambda part: [o for o, s in zip(owners, indexed) if any(s[k : k + len(part)] == part for k in range(len(s) - len(part) + 1))]
    expected = []
    for s in streamed:
        for k in range(len(s)):
            n = max(n for n in range(min(width, len(s) - k) + 1) if n == 0 or has(s[k : k + n]))
            expected.append((n, min(has(s[k : k + n])) if n == width else -1))
    assert list(zip(longest.tolist(), owner.tolist())) == expected


def test_matches_come_from_the_wavelet_matrix(monkeypatch):
    monkeypatch.setattr(WaveletMatrix, "rank", lambda self, symbols, at: np.zeros(len(at), np.int64))
    sequence = np.arange(40, dtype=np.uint64)
    longest, _ = FMIndex(sequence, np.array([40]), np.array([0]), 13).matches(sequence, np.array([40]))
    assert longest.max() < 13


def test_bits():
    rng = np.random.default_rng(1)
    for n in (1, 63, 64, 65, 700):
        bits = rng.random(n) < 0.2
        bits[0] = True
        own, every = Bits(bits), np.arange(n)
        assert own.rank(every).tolist() == [int(bits[:k].sum()) for k in every]
        assert own.last_to(every).tolist() == [int(np.flatnonzero(bits[: k + 1])[-1]) for k in every]
        assert own.first_from(every).tolist() == [next((j for j in range(k, n) if bits[j]), n) for k in every]


def test_sample_is_bounded_by_rows(spark):
    rows = [(2, f"text {k}") for k in range(1000)] + [(k, "own") for k in range(100, 160)]
    table = spark.createDataFrame([(2, 1), *((k, 0) for k in range(100, 160))], "doc_id bigint, toxic int")
    source = docs(spark, rows).select("doc_id", "text")
    for bound in (3, 10):
        found = learn.learnable(source, table, "toxic", bound).collect()
        assert len(found) <= bound and len({r.doc_id for r in found}) == len(found)
    every = learn.learnable(source, table, "toxic", 1000).collect()
    assert sorted(r.doc_id for r in every).count(2) == (0 if zlib.crc32(b"2") % 3 == 1 else 1)


def likeliest(restorer, seen):
    """The best path of a lattice by trying all of them; what it costs to double a letter is a path of its own."""
    seen = seen.lower()

    def paths(at, a, b):
        if at == len(seen):
            yield restorer.model[a][b][0], ""
            return
        run = next(k for k in itertools.count() if k > at or seen[at - k] != seen[at])
        n = run + len(re.match(f"{re.escape(seen[at])}*", seen[at + 1 :])[0])
        c = seen[at]
        if c in restorer.letter:
            ways = [(c, 0.0)] if n < 3 or run == 1 else [(c, 0.0), ("", toxicity.DRAWN)] if run == 2 else [("", 0.0)]
        elif c.isalpha():
            ways = [(c, 0.0)]
        else:
            ways = [(c, toxicity.ITSELF)] + [(x, toxicity.MASKED if c == "*" else toxicity.SIGN) for x in toxicity.LOOKALIKES.get(c, "")]
            ways += [] if c.isalnum() else [("", toxicity.NOTHING)]
        for x, cost in ways:
            k = restorer.letter.get(x, 0)
            if not x or (k and k == b):
                for s, rest in paths(at + 1, a, b):
                    yield s + cost + (toxicity.DOUBLED if x else 0), rest
            if x:
                for s, rest in paths(at + 1, b, k):
                    yield s + cost + restorer.model[a][b][k], x + rest

    return max(paths(0, 0, 0), key=lambda p: p[0])


def test_viterbi_is_exhaustive():
    rng = random.Random(4)
    model = np.log(np.random.default_rng(1).dirichlet(np.full(toxicity.N, 0.3), (toxicity.N, toxicity.N)) + 1e-6)
    restorer = toxicity.Restorer(model)
    for _ in range(300):
        seen = "".join(rng.choice("aabbceio013$@*.- é") for _ in range(rng.randrange(1, 7)))
        assert restorer.word(seen) == likeliest(restorer, seen)[1], seen


def test_decoder_takes_linear_time():
    import time

    restorer = toxicity.Restorer(np.full((toxicity.N,) * 3, -4.0))
    took = []
    for n in (20_000, 160_000):
        began = time.process_time()
        restorer.word("1 2 3 4 " * (n // 8))
        took.append(time.process_time() - began)
    assert took[1] < 8 * took[0] * 3


def test_fit_is_gradient_descent():
    """One step of the fit against numerical derivatives of its loss."""
    rng = np.random.default_rng(3)
    n = 12
    counts = rng.integers(1, 5, n)
    begin = np.concatenate([[0], np.cumsum(counts)])
    index = np.concatenate([rng.choice(40, c, replace=False) for c in counts]).astype(np.int32)
    f = quality.Features(index, rng.random(len(index)).astype(np.float32), begin, rng.random((n, quality.STATS)).astype(np.float32))
    y = (np.arange(n) % 3 == 0).astype(int)
    before, after = quality.fit(f, y, epochs=0), quality.fit(f, y, epochs=1, batch=n, decay=0.0)
    share = y.mean()
    weigh = np.where(y == 1, 0.5 / share, 0.5 / (1 - share)) / n

    def loss(m):
        z, _ = m.forward(*m.design(f))
        return float((weigh * (np.logaddexp(0, z) - y * z)).sum())

    for i in (int(index[0]), int(index[5]), quality.BUCKETS + 2):
        before.weight = before.weight.astype(float)
        before.weight[i] += 1e-4
        up = loss(before)
        before.weight[i] -= 2e-4
        slope = (up - loss(before)) / 2e-4
        before.weight[i] += 1e-4
        # The first step of AdaGrad is the rate against the sign of the slope.
        assert np.isclose(after.weight[i] - before.weight[i], -0.05 * np.sign(slope), atol=2e-3), i
    assert loss(after) < loss(before)


def test_files_that_the_fast_encoder_stands_for():
    import json

    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        spec = json.load(f)
    assert packing.merges_by_rank(spec)
    merges = spec["model"]["merges"]
    assert not packing.merges_by_rank(spec | {"model": spec["model"] | {"merges": [merges[1], merges[0], *merges[2:]]}})
    assert not packing.merges_by_rank(spec | {"normalizer": {"type": "NFC"}})
    assert not packing.merges_by_rank(spec | {"pre_tokenizer": {"type": "Whitespace"}})


def test_packing_repeated_and_null_ids(spark):
    rows = [(1, "some words here")] * 50 + [(None, "words without an id")] * 50 + [(None, None), (2, None), (3, "")]
    found = packing.pack_documents(docs(spark, rows), length=16, group_docs=10).collect()
    texts = Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in found)
    assert sorted(texts.values()) == [1, 1, 1, 50, 50]
    used = defaultdict(list)
    for r in found:
        used[r.sequence_id].append((r.offset, r.length))
    for own in used.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= 16


@pytest.fixture(scope="module")
def long_rows():
    """Texts of about 5 MB: many words, one word, single digits, one word repeated."""
    rng = random.Random(5)
    passage = prose(rng, 60)
    many = " ".join(f"w{rng.randrange(50_000)}" for _ in range(600_000)) + " " + passage
    return passage, [(1, passage), (2, many), (3, "x" * 5_000_000), (4, "1 2 3 4 " * 625_000), (5, "again " * 830_000), (6, many + " more")]


def test_long_texts(spark, long_rows):
    passage, rows = long_rows
    table = docs(spark, rows)
    n_words = {i: len(t.split()) for i, t in rows}
    near = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(table).collect()}
    assert near == {i: (len(shingles(t)), 2 if i == 6 else i) for i, t in rows}
    gone = {r.doc_id: (r.n_words, r.n_removed) for r in substring_dedup.substring_dedup(table, keep_text=False).collect()}
    assert gone == {i: (n_words[i], {2: 60, 6: n_words[2]}.get(i, 0)) for i, _ in rows}
    assert {r.doc_id for r in exact_dedup.exact_dedup(table).collect() if r.kept} == set(n_words)
    hits = decontamination.contaminated(table, spark.createDataFrame([(1, passage)], "item_id bigint, text string")).collect()
    assert sorted(r.doc_id for r in hits) == [1, 2, 6]
    assert sum(r.size for r in sharding.shard_documents(table).collect()) == sum(len(t) + 1 for _, t in rows)


def test_long_texts_of_the_other_operators(spark, long_rows):
    _, rows = long_rows
    rows = [(i, t[:2_000_000] if i == 3 else t) for i, t in rows if i in (1, 2, 3, 5)]
    table = docs(spark, rows)
    counted = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(table).collect()}
    assert counted[2] > 600_000 and counted[5] >= 830_000
    pieces = packing.pack_documents(table).collect()
    of = {r.doc_id: r.doc_tokens for r in pieces}
    assert Counter(r.doc_id for r in pieces) == {i: -(-n // 1024) for i, n in of.items()}
    learned, labels = labelled(random.Random(8))
    every = docs(spark, [(1000 + i, t) for i, t in learned] + rows)
    labels = spark.createDataFrame([(1000 + i, q, t) for i, q, t, _ in labels] + [(2, 1, 0)], "doc_id bigint, quality int, toxic int")
    for score in (toxicity.score_toxicity, quality.score_quality):
        assert {r.doc_id for r in score(every, labels).collect()} >= {i for i, _ in rows}


def test_stages_with_odd_rows(spark, tmp_path):
    """Nulls, empty texts, repeated rows and ids, and columns whose names the stages use, through all stages."""
    learned, labels = labelled(random.Random(8))
    rng = random.Random(12)
    item = " ".join(f"q{k}" for k in range(30))
    good = prose(rng, 80)
    rows = [(i, t) for i, t in learned] + [(500, None), (501, ""), (502, "  "), (None, good), (None, None), (503, good), (503, good), (503, f"{good} x"), (504, f"a {item} b"), (505, item), (505, "own words of it")]
    spark.createDataFrame([(i, q, t) for i, q, t, _ in labels], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item), (None, "x"), (2, None)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    table = docs(spark, rows).selectExpr("*", "doc_id as row", "text as hash", "1 as id", "2 as component", "3 as points", "4 as __near_copy2")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, table, str(tmp_path))
        assert left.columns == table.columns
        before, after = (Counter((r.doc_id, r.text) for r in t.select("doc_id", "text").collect()) for t in (table, left))
        assert after <= before
        gone = before - after
        if name == "toxicity":
            bad = {t for _, t in gone}
            assert all(re.search("idiotic|moronic", t) for t in bad) and all(t in bad for _, t in learned if re.search("idiotic|moronic", t))
        if name == "exact_dedup":
            content = lambda t: re.sub("[\x20\x09-\x0d]", "", t or "")
            assert Counter(content(t) for _, t in after.elements()) == Counter({content(t) for _, t in before})
        if name == "near_dedup":
            owned = [(i, t) for i, t in before if i is not None]
            sets = [(i, shingles(t)) for i, t in owned]
            links = [(a, b) for (a, x), (b, y) in itertools.combinations(sets, 2) if a != b and x and y and 100 * len(x & y) >= 75 * len(x | y)]
            of = find_components({i for i, _ in owned}, links)
            assert {i for i, _ in after} == {i for i in of if of[i] == i} | {i for i, _ in before if i is None}
        if name == "decontamination":
            assert {t for _, t in gone} == {t for _, t in before if t and item in t}
        if name in ("toxicity", "decontamination"):
            assert stage(spark, table.limit(0), str(tmp_path)).collect() == []
        table = corpus_pipeline.written(left, f"odd-{name}")
    packed = corpus_pipeline.STAGES[-1][1](spark, table, str(tmp_path)).collect()
    assert Counter(r.doc_id for r in packed if r.start == 0) == Counter(r.doc_id for r in table.select("doc_id").collect())
    assert len(ODD) > 0
