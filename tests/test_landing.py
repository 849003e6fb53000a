"""Streamed groups and gaps are those of a batch."""

import os
import random
from collections import Counter

import pytest

from baseweave.operators import classify, gaps
from baseweave.sources import tables
from baseweave.streaming import landing


def some_records(rng, contig, n):
    pos, rows = 1, []
    for _ in range(n):
        pos += rng.choice([0, 0, 1, 1, 4])
        kind = rng.random()
        if kind < 0.2:
            rows.append(f"{contig}\t{pos}\t.\tA\t<NON_REF>\t.\t.\tEND={pos + rng.randrange(4)}\tGT\t0")
        elif kind < 0.25:
            rows.append(f"{contig}\t{pos}\t.\tA")
        else:
            rows.append(f"{contig}\t{pos}\t.\t{rng.choice(['A', 'AC'])}\t{rng.choice(['G', '.', '*', 'C,T'])}\t.\t.\t.\tGT\t{rng.choice(['0/1', '.'])}")
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_stream_equals_batch(spark, tmp_path, seed):
    rng = random.Random(seed)
    folder, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    folder.mkdir()
    rows = {c: some_records(rng, c, 60) for c in ("c1", "c2")}
    cuts = {c: sorted(rng.sample(range(60), 3)) for c in rows}
    files = []
    for k in range(4):
        body = [r for c in rows for r in rows[c][([0, *cuts[c]])[k] : ([*cuts[c], 60])[k]]]
        files.append("##x\n#CHROM\n" + "\n".join(body) + "\n")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", landing.PROVIDER)
    try:
        for part in (files[:2], files[2:]):  # the second run goes on where the first ended
            for text in part:
                k = len(list(folder.iterdir()))
                (folder / f"{k}.vcf").write_text(text)
                os.utime(folder / f"{k}.vcf", (1_000_000 + k, 1_000_000 + k))  # files are taken by their times
            stream = landing.landed_positions(landing.landing_records(spark, str(folder), files_at_once=1))
            landing.write_positions(stream, out, checkpoint).awaitTermination()
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    left = landing.unfinished(spark, checkpoint)
    got = spark.read.parquet(out).unionByName(left.filter("kind = 'record'"))
    records = tables.read_vcf(spark, [str(folder / f"{k}.vcf") for k in range(4)])
    order = ("file", "ordinal")
    expected = classify.classify(records, order=order)
    found = Counter((r.contig, r.line, r["class"]) for r in got.filter("kind = 'record'").collect())
    wanted = Counter((r.contig, r.line, r["class"]) for r in expected.collect())
    assert found - wanted == wanted - found == Counter()
    spans = gaps.record_spans(tables.with_positions(records.filter("n_cols >= 2")))
    assert sorted((r.contig, r.s, r.e) for r in got.filter("kind = 'gap'").collect()) == sorted((r.contig, r.s, r.e) for r in gaps.missing(spans).collect())
    reach = {r.contig: r.e for r in left.filter("kind = 'reach'").collect()}
    assert reach == {r.contig: r.e for r in spans.groupBy("contig").agg({"e": "max"}).toDF("contig", "e").collect()}
    ordinals = [(r.file, r.part, r.row) for r in got.filter("kind = 'record'").collect()]
    assert len(set(ordinals)) == len(ordinals)
