"""Each operator against a brute-force version on small tables with awkward rows."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from baseweave.llm import decontamination, exact_dedup, near_dedup, packing, quality, queries, sharding, substring_dedup, token_counts, toxicity, url_filter
from baseweave.llm.components import components

SPACE = re.compile("[\x20\x09-\x0d]+")
COLUMNS = "doc_id bigint, text string, digest string, salt int, kept boolean, words string"


def docs(spark, rows):
    """Documents with columns whose names operators use themselves."""
    return spark.createDataFrame([(i, t, "x", 3, False, "w") for i, t in rows], COLUMNS)


def words(text):
    return [w for w in SPACE.split(text or "") if w]


def prose(rng, n, vocabulary=200):
    return " ".join(f"w{int(vocabulary * rng.random() ** 2)}" for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    """Copies, near copies, shared passages, short, empty, null and repeated rows."""
    rng = random.Random(3)
    base = [prose(rng, rng.choice([1, 3, 4, 5, 12, 13, 14, 40, 90, 400])) for _ in range(60)]
    passage = prose(rng, 60)
    base += [f"{prose(rng, 20)} {passage} {prose(rng, rng.randrange(1, 40))}" for _ in range(8)]
    original = prose(rng, 150).split(" ")
    for _ in range(12):
        near = list(original)
        for _ in range(rng.randrange(1, 5)):
            near[rng.randrange(len(near))] = f"new{rng.random()}"
        base.append(" ".join(near))
    base += [base[5], base[20].replace(" ", "  "), base[30].replace(" ", "\n") + "\t", base[30].upper(), "", " \n ", "a " * 300, "a " * 300 + "b", "\x0b", "\xa0 \u3000 é"]
    rows = list(enumerate(base))
    rng.shuffle(rows)
    return [*rows, (500, None), (501, None), rows[0], (None, base[5]), (None, None)]


NONE = []


def by_rows(df, *columns):
    return Counter(tuple(r[c] for c in columns) for r in df.collect())


def test_exact(spark, corpus):
    expected = Counter()
    groups = defaultdict(list)
    for i, t in corpus:
        groups[SPACE.sub("", t or "")].append((i, len(t or "")))
    for content, rows in groups.items():
        best = min(rows, key=lambda r: (-r[1], r[0] is None, r[0] or 0))
        kept = False
        for r in rows:
            stays = not kept and r == best
            kept |= stays
            expected[(r[0], best[0], len(rows), stays, hashlib.sha256(content.encode()).hexdigest())] += 1
    columns = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert by_rows(exact_dedup.exact_dedup(docs(spark, corpus)), *columns) == expected
    clashing = exact_dedup.exact_dedup(docs(spark, corpus), digest=lambda c: F.lit("same"))
    assert by_rows(clashing, *columns[:4]) == Counter(itertools.chain.from_iterable([k[:4]] * n for k, n in expected.items()))
    left = exact_dedup.drop_exact_duplicates(docs(spark, corpus))
    assert left.columns == ["doc_id", "text", "digest", "salt", "kept", "words"]
    assert Counter(SPACE.sub("", r.text or "") for r in left.collect()) == Counter(groups.keys())
    assert exact_dedup.exact_dedup(docs(spark, NONE)).collect() == []


def test_exact_hot_groups(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "SHARES", 10)
    monkeypatch.setattr(exact_dedup, "BLOCK", 64)
    rows = [(k, "one text") for k in range(1, 701)] + [(None, "other  text")] * 500 + [(k, f"text {k}") for k in range(1000, 1800)]
    out = exact_dedup.exact_dedup(docs(spark, rows)).collect()
    assert Counter(r.doc_id for r in out) == Counter(i for i, _ in rows)
    assert {(r.keep_id, r.group_size) for r in out if r.doc_id is None} == {(None, 500)}
    assert {(r.keep_id, r.group_size, r.kept) for r in out if r.doc_id and 1 < r.doc_id < 701} == {(1, 700, False)}
    assert Counter(r.doc_id for r in out if r.kept) == Counter([None, 1, *range(1000, 1800)])
    winners = spark.createDataFrame([("a", 700), ("b", 500), ("c", 1)], "digest string, group_size long")
    assert {(r.digest, r.parts) for r in exact_dedup._hot(winners).collect()} == {("a", 6), ("b", 5)}


def shingles(text):
    w = words((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def find_components(ids, links):
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def test_near(spark, corpus):
    rows = [(i, t) for i, t in corpus if i is not None]
    sets = {i: shingles(t) for i, t in rows}
    links = [(a, b) for a, b in itertools.combinations(sets, 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    of = find_components(sets, links)
    expected = Counter((i, len(sets[i]), of[i], i == of[i]) for i, _ in rows)
    found = near_dedup.near_duplicates(docs(spark, corpus)).filter("doc_id is not null")
    assert by_rows(found, "doc_id", "n_shingles", "component_id", "kept") == expected
    left = near_dedup.drop_near_duplicates(docs(spark, rows))
    assert {r.doc_id for r in left.collect()} == {i for i in of if of[i] == i}
    assert near_dedup.near_duplicates(docs(spark, NONE)).collect() == []


def test_near_in_large_buckets(spark, monkeypatch):
    """A group of copies edited apart, with buckets over the bound for pairs."""
    monkeypatch.setattr(near_dedup, "SMALL", 2)
    rng = random.Random(11)
    base = [f"b{k}" for k in range(120)]
    rows = []
    for i in range(60):
        text = list(base)
        for _ in range(rng.randrange(0, 9)):
            text[rng.randrange(len(text))] = f"e{rng.random()}"
        rows.append((i, " ".join(text)))
    sets = {i: shingles(t) for i, t in rows}
    links = [(a, b) for a, b in itertools.combinations(sets, 2) if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    of = find_components(sets, links)
    assert len(set(of.values())) > 3
    assert {r.doc_id: r.component_id for r in near_dedup.near_duplicates(docs(spark, rows)).collect()} == of


def test_components(spark):
    rng = random.Random(5)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(1000 + k, 1001 + k) for k in range(40)]
    ids = {x for link in links for x in link}
    expected = {i: c for i, c in find_components(ids, links).items() if i != c}
    assert {r.id: r.component for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()} == expected


def test_substring(spark, corpus):
    first = {}
    for i, t in corpus:
        w = words(t)
        for k in range(len(w) - 12):
            if i is not None:
                key = tuple(w[k : k + 13])
                first[key] = min(first.get(key, i), i)
    expected = Counter()
    for i, t in corpus:
        w = words(t)
        gone = {k + j for k in range(len(w) - 12) for j in range(13) if i is not None and first[tuple(w[k : k + 13])] < i}
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        expected[(i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept)] += 1
    columns = ("doc_id", "n_words", "n_removed", "kept_sha256", "kept_text")
    for size, crowd in ((1 << 20, 100_000), (2_000, 100_000), (5_000, 3)):
        assert by_rows(substring_dedup.substring_dedup(docs(spark, corpus), shard_bytes=size, crowd=crowd), *columns) == expected
    assert substring_dedup.substring_dedup(docs(spark, NONE)).collect() == []


def test_substring_rows_of_one_id(spark):
    rng = random.Random(9)
    shared, other = prose(rng, 30), prose(rng, 50)
    rows = [(1, shared), (2, f"{shared} {other}"), (2, f"{other} {shared}")]
    found = substring_dedup.substring_dedup(docs(spark, rows)).collect()
    assert sorted((r.doc_id, r.n_removed) for r in found) == [(1, 0), (2, 30), (2, 30)]


def test_containment(spark, corpus):
    rng = random.Random(4)
    items = [(k, prose(rng, n)) for k, n in enumerate([8, 11, 12, 20, 30, 55, 3, 5])] + [(90, None), (91, ""), (None, "x y z w v u")]
    rows = list(corpus)
    for k, (item, text) in enumerate(items[:8]):
        w = text.split(" ")
        rows.append((600 + k, f"{prose(rng, 50)} {text.upper()} {prose(rng, 50)}"))
        rows.append((620 + k, f"{prose(rng, 50)} {' '.join(w[: len(w) * 9 // 10])} {prose(rng, 50)}"))
    rows.append((650, items[6][1]))
    sets, wanted = defaultdict(set), {i: shingles(t) for i, t in items if i is not None and words(t)}
    for i, t in rows:
        sets[i] |= shingles(t)
    expected = {(d, i, len(s & g), len(g)) for d, s in sets.items() if d is not None for i, g in wanted.items() if 100 * len(s & g) >= 75 * len(g)}
    table = spark.createDataFrame([(i, t, "c") for i, t in items], "item_id bigint, text string, hash string")
    found = decontamination.contaminated(docs(spark, rows), table)
    assert {(r.doc_id, r.item_id, r.n_shared, r.n_item) for r in found.collect()} == expected
    assert len(expected) > 10
    left = decontamination.drop_contaminated(docs(spark, rows), table)
    assert {r.doc_id for r in left.collect()} == {i for i, _ in rows} - {d for d, *_ in expected}
    assert decontamination.contaminated(docs(spark, NONE), table).collect() == []
    assert decontamination.contaminated(docs(spark, rows), table.limit(0)).collect() == []


URLS = [
    "http://example.com/en/a", "https://WWW.example.COM/en/", "http://a.b.example.com/en/x?y#z", "http://x.net/es/1", "http://net/fr/", "http://x.org/en/",
    "http://example.com", "http://example.com/en", "no scheme", None, "", "://", "http://www.example.com/EN/", "a://b://c.com/", "http://com/#/en/", "http://notexample.com/en/", "http://com:80/",
]


def judged(url, rules):
    m = re.search("://([^/?#]*)([^?#]*)", url or "")
    host = "".join(c.lower() if c.isascii() else c for c in m[1]) if m else ""
    path = m[2] if m else ""
    fits = [(len(h + p), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, None, "allow"))
    return host, path, best[1], best[2]


def test_urls(spark):
    rows = [*enumerate(URLS), (0, URLS[0]), (None, URLS[3])]
    pages = spark.createDataFrame([(i, u, "h", "r") for i, u in rows], "page_id bigint, url string, html string, rule string")
    rules = [*queries.RULES, ("block", "b.example.com", "/en/x"), ("allow", "org", "")]
    found = url_filter.judge_urls(pages, url_filter.rule_table(spark, rules))
    assert by_rows(found, "page_id", "host", "path", "rule", "verdict") == Counter((i, *judged(u, rules)) for i, u in rows)
    assert url_filter.judge_urls(pages.limit(0), url_filter.rule_table(spark, rules)).collect() == []


def capacity(sizes, shards):
    low, high = max(sizes), sum(sizes)
    while low < high:
        mid, used, room = (low + high) // 2, 1, (low + high) // 2
        for s in sizes:
            if s > room:
                used, room = used + 1, mid
            room -= s
        low, high = (low, mid) if used <= shards else (mid + 1, high)
    return low


def test_sharding(spark, corpus):
    shards = 5
    found = sharding.shard_documents(docs(spark, corpus), shards=shards).collect()
    size = lambda t: len((t or "").encode()) + 1
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in found) == Counter((i, size(t), zlib.crc32((t or "").encode())) for i, t in corpus)
    groups = Counter()
    for _, t in corpus:
        groups[t or ""] += size(t)
    order = sorted(groups, key=lambda t: (-groups[t].bit_length(), hashlib.sha256(t.encode()).hexdigest()))
    load, slots, where = Counter(), defaultdict(list), {}
    texts = {i: t for i, t in corpus}
    for r in found:
        load[r.shard] += r.size
        slots[r.shard].append(r.slot)
        assert where.setdefault(texts[r.doc_id] or "", r.shard) == r.shard or r.doc_id is None
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(load.values()) == capacity([groups[t] for t in order], shards)
    assert sharding.shard_documents(docs(spark, NONE)).collect() == []


def test_one_hot_group(spark):
    rows = [(k, "same text") for k in range(40)] + [(100 + k, f"other {k}") for k in range(40)]
    found = sharding.shard_documents(docs(spark, rows), shards=4).collect()
    assert len({r.shard for r in found if r.doc_id < 100}) == 1 and len(found) == 80


ODD = ["a  b", " a", "a ", "\n a b\tc  ", "<s> a</s>", "", "   ", "x▁ y  ▁z", "<|endoftext|> y <|endoftext|>  z", "x\xa0 y \u2003z 　", "it's  don't\n\nfoo \n bar", "\x1c a b\x1c c", "1 2  3", "é" * 700, " " * 2100 + "x", "日本語 テキスト"]


def test_token_counts(spark, corpus):
    from sentencepiece import SentencePieceProcessor

    rows = [*corpus, *((700 + k, t) for k, t in enumerate(ODD))]
    encode = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model")).encode
    for chunk_bytes in (8 << 20, 500):
        found = token_counts.count_tokens(docs(spark, rows), limit=50, chunk_bytes=chunk_bytes)
        expected = Counter((i, len((t or "").encode()), len(encode(t or "")), len(encode(t or "")) > 50) for i, t in rows)
        assert by_rows(found, "doc_id", "n_bytes", "n_tokens", "over_limit") == expected
    assert token_counts.count_tokens(docs(spark, NONE)).collect() == []


def test_encoder():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    own, other = packing.Encoder(path), Tokenizer.from_file(path)
    rng = random.Random(2)
    texts = ODD + ["".join(rng.choice("ab é ñ\n.,'t1 $€-") for _ in range(60)) for _ in range(500)]
    texts += [t for k in range(0, 50_000, 7) if "\ufffd" not in (t := other.decode([k]))]
    for t in texts:
        assert np.frombuffer(own.encode(t), "<u4").tolist() == other.encode(t, add_special_tokens=False).ids, t


def test_packing(spark, corpus):
    from tokenizers import Tokenizer

    rows = [(i, t) for i, t in corpus if i is not None][:-1] + [(700 + k, t) for k, t in enumerate(ODD)]
    encode = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode
    found = packing.pack_documents(docs(spark, rows), length=64, group_docs=30).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in found:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    seen = set()
    for i, t in rows:
        if i in seen:
            continue
        seen.add(i)
        ids, at = np.array([*encode(t or "", add_special_tokens=False).ids, 0], "<u4"), 0
        for p in sorted({(p.start, p.length, p.ids_crc32, p.doc_tokens) for p in pieces[i]}):
            assert p == (at, p[1], zlib.crc32(ids[at : at + p[1]].tobytes()), len(ids))
            at += p[1]
        assert at == len(ids)
    for own in sequences.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 64
    full = sum(p.length for p in found)
    assert full / (64 * len(sequences)) > 0.9
    assert packing.pack_documents(docs(spark, NONE)).collect() == []


def test_first_fit():
    rng = random.Random(1)
    sizes = [rng.randrange(1, 101) for _ in range(300)]
    bins, offsets = packing.first_fit_decreasing(sizes, 100)
    rooms, expected = [], {}
    for i in sorted(range(300), key=lambda k: -sizes[k]):
        k = next((k for k, r in enumerate(rooms) if r >= sizes[i]), len(rooms))
        rooms += [100] if k == len(rooms) else []
        expected[i] = (k, 100 - rooms[k])
        rooms[k] -= sizes[i]
    assert {i: (b, o) for i, (b, o) in enumerate(zip(bins, offsets, strict=True))} == expected


def labelled(rng):
    rows, labels = [], []
    for i in range(400):
        bad, junk = i % 4 == 0, i % 5 == 0
        w = prose(rng, rng.randrange(20, 120)).split(" ")
        if bad:
            for _ in range(4):
                w.insert(rng.randrange(len(w)), rng.choice(["idiotic", "moronic"]))
        if junk:
            w = [x + "%%" for x in w]
        rows.append((i, " ".join(w)))
        labels.append((i, int(not junk), int(bad), 0.5))
    return rows, labels


def test_classifiers(spark):
    rows, labels = labelled(random.Random(8))
    rows += [(900, None), (901, ""), (None, "x"), rows[0], (902, "you 1d10t1c m.o.r.o.n.i.c thing of w1 w2"), (903, "w1 w2 w3 plain words of no harm")]
    table = spark.createDataFrame([*labels, (None, 1, 1, 0.1), (5, None, None, 0.2)], "doc_id bigint, quality int, toxic int, score double")
    for f, k, threshold in ((quality.score_quality, 1, 0.5), (toxicity.score_toxicity, 2, 0.7)):
        found = f(docs(spark, rows), table).collect()
        assert len(found) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= threshold) for r in found)
        assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in found if r.doc_id is not None)
        own = {r.doc_id: r for r in found}
        right = [own[x[0]].predicted == x[k] for x in labels if own[x[0]].held_out]
        assert len(right) > 100 and sum(right) / len(right) > 0.95
        assert f(docs(spark, NONE), table).collect() == []
        assert len(f(docs(spark, rows[:5]), table.limit(0)).collect()) == 5
    toxic = {r.doc_id: r.predicted for r in toxicity.score_toxicity(docs(spark, rows), table).collect()}
    assert toxic[902] == 1 and toxic[903] == 0
    left = toxicity.drop_toxic(docs(spark, rows), table)
    assert {r.doc_id for r in left.collect()} == {i for i, p in toxic.items() if not p}


def test_factorisation_identity():
    rng = np.random.default_rng(0)
    m = quality.Machine(0.3, rng.normal(size=50), rng.normal(size=(50, 4)), np.zeros(1), np.ones(1))
    index, value = np.array([3, 7, 9, 20, 3]), rng.normal(size=5)
    pairs = sum(m.vectors[i] @ m.vectors[j] * x * y for (i, x), (j, y) in itertools.combinations(zip(index, value, strict=True), 2))
    z, _ = m.forward(index, value, np.array([0, 5]))
    assert np.isclose(z[0], 0.3 + m.weight[index] @ value + pairs)


@pytest.mark.parametrize("seen", ["1d10t", "i d i o t", "idiooot", "i.d.i.o.t", "ID10T", "i-d-i-o-t"])
def test_restoring(seen):
    text = "the idiot was on the street of that idea and it is an idiom for a dot in it "
    codes = np.frombuffer(f"  {text * 20}".encode("utf-32-le"), "<u4")
    c = toxicity._CLASS[codes]
    counts = np.zeros(toxicity.N**3)
    np.add.at(counts, c[:-2] * toxicity.N**2 + c[1:-1] * toxicity.N + c[2:], 1)
    model = toxicity.char_model(counts.reshape((toxicity.N,) * 3))
    assert toxicity.Restorer(model).texts([f"the {seen} of"])[0].split() == ["the", "idiot", "of"]
    assert toxicity.Restorer(model).texts(["plain words, kept. As they are"]) == ["plain words, kept. As they are"]


LATE_SIGNS = {"id107": "idiot", "idio7": "idiot", "a$$": "ass", "sh1+": "shit", "i--d--i--o--t": "idiot", "i  d  i  o  t": "idiot", "i-.d-.i-.o-.t": "idiot", "idiiot": "idiot", "iddiot": "idiot", "IDIoOT": "idiot"}


@pytest.mark.parametrize("seen", LATE_SIGNS)
def test_restoring_signs_anywhere(seen):
    text = "the idiot and the shit of that ass sat with the idiom at this street and the class must pass it is the idea for the dot in it "
    c = toxicity._CLASS[np.frombuffer(f"  {text * 20}".encode("utf-32-le"), "<u4")]
    counts = np.zeros(toxicity.N**3)
    np.add.at(counts, c[:-2] * toxicity.N**2 + c[1:-1] * toxicity.N + c[2:], 1)
    restorer = toxicity.Restorer(toxicity.char_model(counts.reshape((toxicity.N,) * 3)))
    plain, found = (restorer.texts([f"the {w} of"])[0].split() for w in (LATE_SIGNS[seen], seen))
    assert found == plain == ["the", LATE_SIGNS[seen], "of"]
    assert restorer.texts(["Signs alone 107 2024-01 -- and * stay"]) == ["Signs alone 107 2024-01 -- and * stay"]


def test_dropping_decides_by_row(spark):
    rows, labels = labelled(random.Random(8))
    bad, good = "you idiotic moronic thing of w1 w2 idiotic moronic", "w1 w2 w3 plain words of no harm"
    rows += [(None, bad), (None, good), (700, bad), (700, good)]
    table = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int, score double")
    left = [(r.doc_id, r.text) for r in toxicity.drop_toxic(docs(spark, rows), table).collect() if r.doc_id in (None, 700)]
    assert sorted(left, key=str) == [(700, good), (None, good)]

    rows = [(1, "a b"), (None, "a b"), (None, "own"), (2, "ab c"), (2, "abc"), (3, "abc"), (None, "own"), (3, "x y"), (4, "x y"), (3, "x y")]
    left = [(r.doc_id, r.text) for r in exact_dedup.drop_exact_duplicates(docs(spark, rows)).collect()]
    assert sorted(left, key=str) == [(1, "a b"), (2, "ab c"), (3, "x y"), (None, "own")]

    item = " ".join(f"q{k}" for k in range(20))
    rows = [(None, f"a {item} b"), (None, good), (5, f"c {item}"), (5, good), (6, None)]
    left = decontamination.drop_contaminated(docs(spark, rows), spark.createDataFrame([(1, item)], "item_id bigint, text string"))
    assert sorted([(r.doc_id, r.text) for r in left.collect()], key=str) == [(5, good), (6, None), (None, good)]
    assert left.columns == docs(spark, rows).columns


def test_labelled_sample_is_whole():
    assert toxicity.score_toxicity.__defaults__[-1] == 4000
