import contextlib
import io
import random

import pytest

from baseweave.operators import intervals, running, stored, windows

SCHEMA = "contig string, s bigint, e bigint"


@pytest.fixture(autouse=True)
def small_bins(monkeypatch):
    monkeypatch.setattr(running, "BIN", 16)


def some(spark, seed, n=40):
    rng = random.Random(seed)
    rows = [(rng.choice("ab"), s, s + rng.randrange(-1, 12)) for s in (rng.randrange(0, 150) for _ in range(n))]
    return spark.createDataFrame(rows, SCHEMA), {c: {x for k, s, e in rows if k == c for x in range(s, e)} for c in "ab"}


def points(df):
    found = {"a": set(), "b": set()}
    rows = sorted((r.contig, r.s, r.e) for r in df.collect())
    for (c, _, e), (d, s, _) in zip(rows, rows[1:]):
        assert c != d or e < s, "results are merged"
    for c, s, e in rows:
        found[c] |= set(range(s, e))
    return found


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_algebra(spark, seed):
    (x, px), (y, py) = some(spark, seed), some(spark, seed + 100)
    of = lambda f: {c: f(px[c], py[c]) for c in "ab"}
    assert points(intervals.merge(x)) == px
    assert points(intervals.union(x, y)) == of(set.union)
    assert points(intervals.subtract(x, y)) == of(set.difference)
    assert points(intervals.intersect(x, y)) == of(set.intersection)
    lengths = spark.createDataFrame([("a", 170), ("b", 170), ("c", 5)], "contig string, length bigint")
    rest = {(r.contig, p) for r in intervals.complement(x, lengths).collect() for p in range(r.s, r.e)}
    assert rest == {(c, p) for c, n in (("a", 170), ("b", 170), ("c", 5)) for p in range(n) if p not in px.get(c, ())}
    shared = {r.contig: r.bp for r in intervals.overlap_bp(x=x, y=y).collect()}
    assert shared == {c: len(px[c] & py[c]) for c in "ab" if px[c] & py[c]}


def test_points(spark):
    x, px = some(spark, 5)
    every = spark.createDataFrame([(c, p) for c in "abz" for p in range(1, 180)], "contig string, pos bigint")
    found = {(r.contig, r.pos - 1) for r in intervals.points_within(every, x).collect()}
    assert found == {(c, p) for c in "ab" for p in px[c]}


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert intervals.merge(none).collect() == [] and intervals.subtract(none, none).collect() == []


def test_partition_check(spark):
    lengths = spark.createDataFrame([("a", 10), ("b", 10), ("c", 10)], "contig string, length bigint")
    x = spark.createDataFrame([("a", 0, 4), ("b", 0, 6), ("c", 0, 12)], SCHEMA)
    y = spark.createDataFrame([("a", 4, 10), ("b", 4, 10)], SCHEMA)
    assert {r.contig: r.exact for r in intervals.partition_check(lengths, x=x, y=y).collect()} == {"a": True, "b": False, "c": False}


def test_windows(spark):
    lengths = spark.createDataFrame([("a", 25)], "contig string, length bigint")
    spine = [(r.bin, r.start, r.end, r.mid) for r in windows.window_spine(lengths, 10).orderBy("bin").collect()]
    assert spine == [(0, 0, 10, 5), (1, 10, 20, 15), (2, 20, 25, 22)]
    bp = windows.bin_intervals(spark.createDataFrame([("a", 5, 30)], SCHEMA), lengths, 10)
    assert {r.bin: r.bp for r in bp.collect()} == {0: 5, 1: 10, 2: 5}


def test_overlap_of_classes_reads_records_once(spark, monkeypatch):
    from baseweave.operators import running
    from baseweave.plans import contract

    seen, keep = [], running.stored

    def watched(df, name):
        with contextlib.redirect_stdout(io.StringIO()) as out:
            df.explain()
        seen.append(out.getvalue().count("Scan parquet"))
        return keep(df, name)

    monkeypatch.setattr(running, "stored", watched)
    contract.queries()["overlap_bp"](spark, "/root/testdata/sf0.001")
    assert seen == [1]


def test_partitions_grow_with_rows(spark, monkeypatch):
    """Steps along contigs have so many partitions that none holds more than some rows, whatever Spark's own number of them is."""
    x, px = some(spark, 9, 200)
    y, py = some(spark, 10, 200)
    monkeypatch.setattr(stored, "TASK_ROWS", 32)
    found = intervals.segments(x, y)
    with contextlib.redirect_stdout(io.StringIO()) as plan:
        found.explain()
    assert plan.getvalue().count("REPARTITION_BY_NUM") == 2  # by position, then by bin
    both = {(r.contig, p) for r in found.filter("n0 > 0 and n1 > 0").collect() for p in range(r.s, r.e)}
    assert both == {(c, p) for c in "ab" for p in px[c] & py[c]}
