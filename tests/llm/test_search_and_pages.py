"""Lexical search, page extraction and source divergence against brute force on small tables with awkward rows."""

import html
import math
import random
import re
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pytest

from baseweave.llm import divergence, dom, html_extraction, lexical_search, quality, substring_dedup, wrappers
from baseweave.llm.words import hashed_words

ALNUM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LETTERS = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
COLUMNS = "doc_id bigint, text string, lang string, source string, term string, n bigint, doc bigint, value bigint"


def docs(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows], COLUMNS)


def prose(rng, n, vocabulary=60):
    return " ".join(f"{rng.choice(['Ab', 'é', 'x9', 'İ', 'q'])}{int(vocabulary * rng.random() ** 2)}" for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    rows = [(i, prose(rng, rng.choice([0, 1, 3, 20, 60, 300])), rng.choice(["en", "de", None, ""]), rng.choice(["a", "b", "é", "Z", None])) for i in range(160)]
    rows += [(900, None, "en", "a"), (901, "...", "en", "only"), (902, " \t\n", "xx", "alone"), (903, "1 2 3 x_y AB-ab", None, None)]
    rows += [rows[3], rows[40], (None, rows[40][1], "en", "a"), (None, None, None, None), (904, "ab0 " * 20_000, "de", "b")]
    return rows


def ranked(rows, items, k=10):
    found = [(i, n, Counter(ALNUM.findall((t or "").translate(LOWER)))) for n, (i, t, *_) in enumerate(rows)]
    found = [f for f in found if f[2]]
    n_docs, n_terms = len(found), sum(sum(c.values()) for _, _, c in found)
    df = Counter(t for _, _, c in found for t in c)
    out = Counter()
    for item_id, text in items:
        asked = Counter(ALNUM.findall((text or "").translate(LOWER)))
        scores = []
        for i, n, c in found:
            m = 25 + (75 * sum(c.values()) * n_docs) // n_terms
            score = sum(times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t, times in asked.items() if t in c)
            if score > 0:
                scores.append((-score, i is None, i or 0, n, i))
        for rank, (score, *_, i) in enumerate(sorted(scores)[:k], 1):
            out[(item_id, rank, i, -score)] += 1
    return out


@pytest.mark.parametrize("k", [1, 10, 1000])
def test_search(spark, corpus, k):
    rng = random.Random(6)
    items = [(i, prose(rng, n)) for i, n in enumerate([1, 2, 5, 40, 40])] + [(50, corpus[7][1]), (51, corpus[40][1]), (52, None), (53, "unheard of"), (51, "ab0 ab0 AB1"), (None, "ab2")]
    table = spark.createDataFrame([(*r, "x", 1) for r in items], "item_id bigint, text string, term string, item bigint")
    got = lexical_search.rank_documents(docs(spark, corpus), table, k=k)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert Counter(tuple(r) for r in got.collect()) == ranked(corpus, items, k)


def test_search_of_nothing(spark, corpus):
    items = spark.createDataFrame([(1, "ab0")], "item_id bigint, text string")
    assert lexical_search.rank_documents(docs(spark, []), items).collect() == []
    assert lexical_search.rank_documents(docs(spark, corpus), items.limit(0)).collect() == []
    assert lexical_search.rank_documents(docs(spark, [(1, None, "en", "a")]), items).collect() == []


def diverging(rows, min_docs, top):
    texts = [(r[2] or "", r[3] or "", LETTERS.findall((r[1] or "").translate(LOWER))) for r in rows]
    out = Counter()
    for lang in {t[0] for t in texts}:
        df = Counter(t for x, _, w in texts if x == lang for t in set(w))
        kept = sorted((t for t, n in df.items() if n >= min_docs), key=str.encode)
        counts = defaultdict(Counter)
        for x, source, w in texts:
            if x == lang:
                counts[source].update(t for t in w if df[t] >= min_docs)
        whole = sum(counts.values(), Counter())
        share = lambda c: {t: 1 + 10**9 * (c[t] + 5) // (sum(c.values()) + 5 * len(kept)) for t in kept}  # noqa: E731, B023
        shares, q = {s: share(c) for s, c in counts.items()}, share(whole)
        for s, p in shares.items():
            pairs = [(sum(abs(p[t] - o[t]) for t in kept), x) for x, o in shares.items() if x != s]
            terms = [(p[t] - q[t], t) for t in kept if counts[s][t] and p[t] > q[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                for rank, (value, item) in enumerate(sorted(found, key=lambda f: (-f[0], f[1].encode())), 1):
                    if part == "pair" or rank <= top:
                        out[(lang, s, part, item, value, rank)] += 1
    return out


@pytest.mark.parametrize(("min_docs", "top", "entries"), [(3, 50, 1 << 13), (2, 4, 16), (10_000, 50, 16)])
def test_divergence(spark, corpus, monkeypatch, min_docs, top, entries):
    monkeypatch.setattr(divergence, "ENTRIES", entries)
    got = divergence.source_divergence(docs(spark, corpus), min_docs=min_docs, top=top)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert Counter(tuple(r) for r in got.collect()) == diverging(corpus, min_docs, top)


def test_divergence_of_nothing(spark):
    assert divergence.source_divergence(docs(spark, [])).collect() == []


def test_shares_are_exact():
    counts, total = np.array([0, 7, 10**13, 8 * 10**15]), np.int64(9 * 10**15)
    assert divergence._share(counts, total, 5).tolist() == [1 + 10**9 * (int(c) + 5) // int(total) for c in counts]


def test_counts_are_handed_on(spark, corpus, monkeypatch):
    monkeypatch.setattr(divergence, "HELD", 10)
    held = divergence._Gathered()
    assert held.rows == 0
    got = divergence.source_divergence(docs(spark, corpus), min_docs=3)
    assert Counter(tuple(r) for r in got.collect()) == diverging(corpus, 3, 50)


# Pages


def tree(rng, depth=0):
    label = rng.choice("abc")
    names = rng.sample("abcdef", rng.randrange(0, 5)) if depth < 4 else []
    return (label if depth else "r", [(n, tree(rng, depth + 1)[1]) for n in names])


def skeleton_of(found):
    labels, parents = [], []

    def add(t, parent):
        labels.append(t[0])
        parents.append(parent)
        own = len(labels) - 1
        for c in t[1]:
            add(c, own)

    add(found, -1)
    return wrappers.Skeleton(labels, parents)


def test_alignment_is_simple_tree_matching():
    """The number of matched nodes is that of the textbook recursion; pairs keep labels, parents and order."""
    rng = random.Random(1)

    def freeze(t):
        return (t[0], tuple(freeze(c) for c in t[1]))

    @lru_cache(None)
    def size(a, b):
        if a[0] != b[0]:
            return 0
        m = [[0] * (len(b[1]) + 1) for _ in range(len(a[1]) + 1)]
        for i, x in enumerate(a[1], 1):
            for j, y in enumerate(b[1], 1):
                m[i][j] = max(m[i - 1][j], m[i][j - 1], m[i - 1][j - 1] + size(x, y))
        return m[-1][-1] + 1

    for _ in range(300):
        a, b = tree(rng), tree(rng)
        x, y = skeleton_of(a), wrappers.Skeleton.read(skeleton_of(b).line())
        places = wrappers.align(x, y)
        assert sum(p >= 0 for p in places) == size(freeze(a), freeze(b))
        for k, p in enumerate(places):
            if p > 0:
                assert x.labels[k] == y.labels[p] and places[x.parents[k]] == y.parents[p]
        for k in range(len(places)):
            own = [places[c] for c in x.children[k].values() if places[c] >= 0]
            assert own == sorted(own)


NOTE = "Read our terms before you copy anything from this site."


def paragraphs(rng):
    return [" ".join(f"w{rng.randrange(5000)}" for _ in range(rng.randrange(8, 40))) for _ in range(rng.randrange(2, 7))]


def in_article(rng, text, k):
    body = "".join(f"<p>{'<b>' if rng.random() < 0.3 else ''}{html.escape(t)}{'<br>' if rng.random() < 0.3 else ''}" for t in text)
    return f"""<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var a="</p><article>";</script></head><body>
    <header><h1>Site {k}</h1></header><nav><ul><li><a href="/">w{k}</a><li><a href='/b'>b</a></ul></nav><!-- <p>no</p> --><div class="ad x{k}">Buy {k} now</div>
    <article>{body}<div class="share-buttons">Share {k}</div></article><section id="comments"><article><p>{'so true ' * 90}</p></article></section><footer>&copy; {k}</footer>"""


def in_divs(rng, text, k):
    body = "\n".join(f"<p>\n{html.escape(t)}\n</p>" for t in text)
    return f"""<html><body><div id=top><a href=/>Home</a> <a href=/n>News {k}</a></div><div class='wrap w{k}'><div class="c1">{body}<p>{NOTE}</p></div>
    <div class="c2"><ul><li><a href=/x>Other page {k}</a></li><li><a href=/y>{NOTE}</a></li></ul></div></div>
    <form action=/f>Your name <input name=a><button>Send</button></form><div hidden>secret</div><aside>see {k}</aside></body></html>"""


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id bigint, url string, html string, host string, main bigint")


def test_pages(spark):
    rng, rows, expected = random.Random(2), [], Counter()
    for k in range(40):
        text = paragraphs(rng)
        url, make = ("http://a.example/", in_article) if k % 2 else ("https://B.example?", in_divs)
        rows.append((k, f"{url}{k}", make(rng, text, k)))
        expected[(k, "\n".join(text))] += 1
    copied = paragraphs(rng)  # one text on all pages of a host is no template
    for k in range(40, 46):
        rows.append((k, f"http://copies.example/{k}", in_divs(rng, copied, k)))
        expected[(k, "\n".join([*copied, NOTE]))] += 1
    alone = paragraphs(rng)
    odd = [
        (100, None, f"<p>{alone[0]}", alone[0]),
        (101, "no host", "just &lt;text&gt; &amp; more", "just <text> & more"),
        (102, "http://a.example/", None, ""),
        (103, "http://a.example/", "", ""),
        (104, "http://a.example/", "<nav>only</nav><script>x", ""),
        (105, "http://one.example/", "<main><h2>Title</h2>a<br>b  c<table><tr><td>d<td>e</table></main><p>out", "Title\na b c\nd\ne"),
        (106, "http://one.example/", "<div><b>1 < 2</b> <a title='>'>and</a> <i>3 > 2</div>", "1 < 2 and 3 > 2"),
        (107, "http://deep.example/", "<div>" * 5000 + "inner" + "</div>" * 5000, "inner"),
        (108, "http://long.example/", "<article>" + "<p>long words</p>" * 20_000 + "</article>", "\n".join(["long words"] * 20_000)),
        (None, "http://one.example/", "<p>no id", "no id"),
        (None, "http://one.example/", "<p>no id", "no id"),
    ]
    rows += [r[:3] for r in odd]
    expected += Counter((i, t) for i, _, _, t in odd)
    got = html_extraction.extract_text(pages(spark, rows))
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    found = got.collect()
    assert Counter((r.page_id, r.text) for r in found) == expected
    assert all(r.n_chars == len(r.text) for r in found)
    assert Counter((r.page_id, r.url) for r in found) == Counter(r[:2] for r in rows)


def test_wrappers_beyond_the_broadcast(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(k, f"http://h{k % 3}.example/{k}", in_divs(rng, paragraphs(rng), k)) for k in range(15)]
    first = Counter(tuple(r) for r in html_extraction.extract_text(pages(spark, rows)).collect())
    monkeypatch.setattr(html_extraction, "BROADCAST", -1)
    assert Counter(tuple(r) for r in html_extraction.extract_text(pages(spark, rows)).collect()) == first
    assert not any(NOTE in r[2] for r in first)


def test_pages_of_nothing(spark):
    assert html_extraction.extract_text(pages(spark, [])).collect() == []


def test_parsing_takes_linear_time():
    for odd in ("<b>" * 200_000 + "</i>" * 200_000, "<div>" * 200_000 + "</p>" * 200_000, "<a title=\"" * 3000, "<" * 100_000, "<p class='a" * 3000, "<!--" * 20_000):
        dom.parse(odd)


# Features of the quality classifier


def plain_features(text):
    """The statistics and hashed words of one text, word by word."""
    space = "[\x20\x09-\x0d]+"
    found = [w.encode() for w in re.split(space, text) if w]
    raw, n = text.encode(), max(len(found), 1)
    kind = lambda c: 0 if 65 <= c <= 90 else 1 if 97 <= c <= 122 else 2 if 48 <= c <= 57 else 4 if c >= 128 else 3 if 0x21 <= c < 0x7F else 5
    pause = b".,;:!?"
    stats = [sum(map(len, found)), sum(kind(w[-1]) == 3 and w[-1] not in pause for w in found), sum(w[-1] in pause for w in found), sum(kind(w[0]) == 0 for w in found)]
    stats += [sum(kind(w[0]) == 3 and len(w) == 1 for w in found), sum(kind(w[0]) == 2 for w in found), sum(len(w) > 20 for w in found)]
    stats = [x / n for x in stats]
    every = Counter(kind(c) for w in found for c in w)
    stats += [every[k] / max(sum(every.values()), 1) for k in range(6)]
    lines = raw.split(b"\n")
    stats += [math.log1p(len(lines)), 1 - len(set(lines)) / len(lines), math.log1p(len(raw) / len(lines))]
    counts = Counter()
    for w in found:
        (_, _, words), = hashed_words(pa.array([w.decode()]), lower=True)
        counts[int(words.hashes[0]) % quality.BUCKETS] += 1
    stats += [math.log1p(len(found)), math.log1p(len(raw)), len(counts) / n, float(not found)]
    norm = math.sqrt(max(sum(counts.values()), 1))
    return {k: math.sqrt(c) / norm for k, c in counts.items()}, stats


def test_features_against_plain_recomputation():
    rng = random.Random(9)
    texts = ["", " \n", "One line.\nOne line.\nOther; LINE 12 $ x1 -- done!", "é É x" * 30, "w" * 50, prose(rng, 3000, 2900)]
    got = []
    for _, _, words in hashed_words(pa.array(texts), lower=True):
        f = quality.features(words)
        got += [({int(i): float(v) for i, v in zip(f.index[a:b], f.value[a:b])}, row) for a, b, row in zip(f.begin[:-1], f.begin[1:], f.stats)]
    assert max(len(x) for x, _ in got) > 1024
    for text, (index, stats) in zip(texts, got, strict=True):
        own, expected = plain_features(text)
        assert index.keys() == own.keys() and np.allclose([index[k] for k in own], list(own.values()), atol=1e-5)
        assert np.allclose(stats, expected, atol=1e-5)


def test_all_words_are_learned_from(spark, monkeypatch):
    """Rare words decide, though each document has thousands of others that weigh as much or more."""
    rng = random.Random(1)
    seen = []
    monkeypatch.setattr(quality, "fit", lambda f, labels: seen.append(np.diff(f.begin)) or quality.Machine(0, *[None] * 4))
    rows = [(k, prose(rng, 6000, 5000), "en", "a") for k in range(6)]
    labels = spark.createDataFrame([(k, k % 2) for k in range(6)], "doc_id bigint, quality int")
    quality.learn_quality(docs(spark, rows).select("doc_id", "text"), labels)
    assert min(seen[0]) > 1024


# Repeated passages are decided by the index


def repeats(rng):
    passage = prose(rng, 60, 5000)
    rows = [(k, f"{prose(rng, 30, 5000)} {passage} {prose(rng, 30, 5000)}") for k in range(20)]
    return rows + [(100 + k, rows[3][1]) for k in range(30)] + [(200, passage)]


def test_nothing_goes_without_the_index(spark, monkeypatch):
    rows = [(*r, "en", "a") for r in repeats(random.Random(4))]
    found = {r.doc_id: r.n_removed for r in substring_dedup.substring_dedup(docs(spark, rows)).collect()}
    assert found[0] == 0 and found[200] == 60 and all(found[100 + k] == len(rows[3][1].split()) for k in range(30))
    none = lambda self, sequences, lengths: (np.zeros(len(sequences), np.int8), np.full(len(sequences), -1, np.int64))
    monkeypatch.setattr(substring_dedup.FMIndex, "matches", none)
    assert {r.n_removed for r in substring_dedup.substring_dedup(docs(spark, rows)).collect()} == {0}


@pytest.mark.parametrize("combined", [5, 200_000])
def test_copies_wait_in_small_batches(spark, monkeypatch, combined):
    """The same result whether copies meet in one batch or in many; repeated rows and null ids among them."""
    monkeypatch.setattr(substring_dedup, "COMBINED", combined)
    rows = repeats(random.Random(4))
    rows += [rows[2], (None, rows[3][1]), (None, None), (7, rows[3][1])]
    first, expected = {}, Counter()
    for i, t in rows:
        w = (t or "").split()
        for k in range(len(w) - 12):
            if i is not None:
                key = tuple(w[k : k + 13])
                first[key] = min(first.get(key, i), i)
    for i, t in rows:
        w = (t or "").split()
        gone = {k + j for k in range(len(w) - 12) for j in range(13) if i is not None and first[tuple(w[k : k + 13])] < i}
        expected[(i, len(w), len(gone))] += 1
    table = docs(spark, [(*r, "en", "a") for r in rows])
    for size in (1 << 20, 3000):
        found = substring_dedup.substring_dedup(table, shard_bytes=size).collect()
        assert Counter((r.doc_id, r.n_words, r.n_removed) for r in found) == expected


def test_rows_without_an_id_share_no_bucket(spark, monkeypatch):
    rng, sizes = random.Random(6), spark.sparkContext.accumulator(0)
    rows = [(k if k % 3 else None, prose(rng, 40, 5000), "en", "a") for k in range(900)]
    inner = substring_dedup._kept

    def counted(rows, removals):
        sizes.add(rows.num_rows if "bucket" in rows.column_names else 0)
        return inner(rows, removals)

    monkeypatch.setattr(substring_dedup, "_kept", counted)
    found = substring_dedup.substring_dedup(docs(spark, rows), shard_bytes=4000)
    assert len(found.collect()) == 900 and sizes.value == 600
    buckets = Counter(k % substring_dedup._prime(-(-sum(len(r[1]) for r in rows if r[0] is not None) // 4000)) for k, *_ in rows if k is not None)
    assert max(buckets.values()) < 3 * 600 / len(buckets)
