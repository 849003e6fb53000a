"""Alignment blocks whose lines lie in several ranges or files, against plain reading; queries on several files against their SQL."""

import contextlib
import gzip
import io
import os
import random

import duckdb
import pyarrow as pa
import pytest

from baseweave.functions.vcf import as_bigint
from baseweave.operators import alignment
from baseweave.plans import contract
from baseweave.sources import maf, tables

SMALL = "/root/testdata/sf0.001"


def plan_of(df):
    with contextlib.redirect_stdout(io.StringIO()) as out:
        df.explain()
    return out.getvalue()


def by_sql(name):
    con = duckdb.connect()
    con.sql(f"create view lineitem as select * from '{SMALL}/lineitem.parquet'")
    return con.sql(contract.oracle_sql()[name]).fetchall()


@pytest.fixture
def several_files(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.enabled")


def test_maf_filled_of_several_files(spark, several_files):
    assert sorted(map(tuple, contract.queries()["maf_filled"](spark, SMALL).collect())) == sorted(by_sql("maf_filled"))


def test_maf_one_block_of_several_files(spark, several_files):
    assert sorted(map(tuple, contract.queries()["maf_one_block"](spark, SMALL).collect())) == sorted(by_sql("maf_one_block"))


def test_maf_filled_where_blocks_pass_the_end_of_their_contig(spark, tmp_path):
    con = duckdb.connect()
    some = f"SELECT * REPLACE (l_orderkey + 1249300 AS l_orderkey) FROM '{SMALL}/lineitem.parquet'"
    # Contig 8 is covered up to its end and past it, contig 9 but for six positions, contig 10 short of its last position.
    whole = "SELECT r.* REPLACE (k AS l_orderkey, CAST(c AS INTEGER) AS l_linenumber, CAST(k % 7 AS BIGINT) AS l_partkey) FROM (SELECT unnest(generate_series(1249370, 1250010)) AS k) CROSS JOIN (SELECT unnest([8, 9, 10]) AS c)"
    con.sql(f"COPY ({some} UNION ALL {whole} CROSS JOIN ({some} LIMIT 1) r WHERE c = 8 OR c = 9 AND k <> 1249600 OR c = 10 AND k < 1249999) TO '{tmp_path}/lineitem.parquet' (FORMAT parquet)")
    con.sql(f"CREATE VIEW lineitem AS SELECT * FROM '{tmp_path}/lineitem.parquet'")
    for name in ("maf_filled", "maf_one_block"):
        want = sorted(con.sql(contract.oracle_sql()[name]).fetchall())
        assert any(part == 1999 for _, part, *_ in want) and any(part == 2000 for _, part, *_ in want)
        assert sorted(map(tuple, contract.queries()[name](spark, str(tmp_path)).collect())) == want


def plainly(text):
    """[(score, [sequence start])] of an alignment's text."""
    out, score, own = [], None, []
    for line in [*text.split("\n"), ""]:
        if not line.strip(" ") or line.startswith("a ") or line == "a":
            out += [(score, own)] if own else []
            score, own = (float(line.split("=")[1]) if "score=" in line else None), []
        elif line.startswith("s "):
            own.append(int(line.split()[2]))
    return out


def test_blocks_cut_by_ranges(spark, tmp_path):
    rng, want, n = random.Random(6), [], 0
    for k in range(2):
        lines = []
        for _ in range(40):
            kind = rng.choice("sssssssabA e#")
            n += 1
            lines.append({"s": f"s q {n} 1 + 9 A", "a": f"a score={n}", "b": "", "A": "a", " ": "  ", "e": "e q 1 1 + 9 I", "#": "# note"}[kind])
        (tmp_path / f"f{k}.maf").write_text("\n".join(lines) + "\n")
        want.append(plainly("\n".join(lines)))
    for size in ("60", "100000"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            rows = tables.read_maf(spark, [str(tmp_path / f"f{k}.maf") for k in range(2)]).collect()
            whole = maf.read_blocks(spark, str(tmp_path), folder=True).orderBy("block_id").collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        found = {}
        for r in sorted(rows, key=lambda r: (r.file, r.block_id, r.seq_idx)):
            found.setdefault(r.file, {}).setdefault((r.block_id, r.score), []).append(r.start)
        assert [[(score, own) for (_, score), own in found[f].items()] for f in sorted(found)] == want
        assert [k for f in sorted(found) for k, _ in found[f]] == [k for w in want for k in range(len(w))]
        assert [(r.block_id, r.score, [s.start for s in r.rows]) for r in whole] == [(k, *b) for k, b in enumerate(want[0] + want[1])]


def test_records_of_blocks_need_no_shuffle(spark, tmp_path):
    text = "a score=1\ns c 0 4 + 9 ACGT\ns x 0 4 + 9 ACTT\n\n"
    (tmp_path / "x.maf").write_text(text * 3)
    blocks = maf.stored(maf.read_blocks(spark, str(tmp_path / "x.maf")), "test")
    assert "Exchange" not in plan_of(alignment.sample_records(blocks))
    assert alignment.sample_records(blocks).count() == 9


def test_lines_are_not_sorted(spark, tmp_path):
    (tmp_path / "x.maf").write_text("a score=1\ns c 0 4 + 9 ACGT\ns x 0 4 + 9 ACTT\n\n" * 3)
    plan = plan_of(tables.maf_reference_contigs(tables.read_maf(spark, str(tmp_path / "x.maf"))))
    assert "hashpartitioning(file" in plan and "__run" not in plan and "row_number" not in plan


def plain_walk(r, o, start, kept):
    """The same by going through columns one by one."""
    out, at, c = [], [], start
    for x in r:
        c += x != "-"
        at.append(c - 1)
    kind = ["G" if "-" in (x, y) else "S" if x == y else "D" for x, y in zip(r, o)]
    for s, e in kept if kept is not None else [(start, start + sum(x != "-" for x in r))]:
        cols = [k for k in range(len(r)) if s <= at[k] < e]
        while cols:
            n = 1
            while kind[cols[0]] != "D" and n < len(cols) and kind[cols[n]] == kind[cols[0]]:
                n += 1
            run, cols = cols[:n], cols[n:]
            a = run[0]
            bases, put = ("".join(t[k] for k in run if t[k] != "-") for t in (r, o))
            begin = at[a] + (r[a] == "-")
            if kind[a] == "S":
                out.append((begin + 1, bases[0], "<NON_REF>", f"END={begin + n}"))
            elif kind[a] == "D":
                out.append((begin + 1, bases, f"{o[a]},<NON_REF>", "."))
            elif begin > start and bases + put:
                before = r[:a].replace("-", "")[-1]
                out.append((begin, before + bases, f"{before}{put},<NON_REF>", "."))
    return out


def test_many_pairs_at_once():
    rng, pairs = random.Random(8), []
    for _ in range(300):
        n = rng.randrange(1, 12)
        r, o = ("".join(rng.choice("AC-") for _ in range(n)) for _ in range(2))
        start, kept = rng.randrange(5), None
        if rng.random() < 0.5:
            cuts = sorted(rng.sample(range(start, start + 14), 4))
            kept = [(cuts[0], cuts[1]), (cuts[2], cuts[3])]
        pairs.append((r, o, start, kept))
    own, *columns = alignment.walked(*[list(c) for c in zip(*pairs)])
    found = [[] for _ in pairs]
    for k, *record in zip(own, *columns):
        found[k].append(tuple(record))
    assert found == [plain_walk(*p) for p in pairs]
    assert [list(alignment.walk(*p)) for p in pairs] == found


def test_records_need_no_stored_blocks(spark):
    folder = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    before = set(os.listdir(folder))
    found = contract.queries()["maf_records"](spark, SMALL)
    assert sorted(map(tuple, found.collect())) == sorted(by_sql("maf_records"))
    assert not [n for n in set(os.listdir(folder)) - before if n.startswith("blocks-")]


def test_numbers_of_words(spark):
    words = ["5", "+5", "-5", "007", "5.7", "+", "-", ".", "", "5e3", "0x1", "--5", "5L", "5_0", "\x005", "5\x1f", "\x7f5", "\u0665", None]
    words += ["9223372036854775807", "9223372036854775808", "-9223372036854775808", "-9223372036854775809", "0" * 30 + "5", "9" * 30]
    want = [r.n for r in spark.createDataFrame([(k, w) for k, w in enumerate(words)], "k int, w string").orderBy("k").select(as_bigint("w").alias("n")).collect()]
    assert maf._numbers(pa.array(words)).to_pylist() == want
    assert maf._numbers(pa.array(["5", None, "-6"])).to_pylist() == [5, None, -6]
    assert maf._numbers(pa.array(["5", None, "+6"])).to_pylist() == [5, None, 6]


def odd_alignment(rng, plain):
    """Lines of an alignment: heads with and without a score, blank lines, notes, short lines, both strands; unless ``plain``, blocks without a head and lines that begin as one does."""
    lines = ["##maf version=1"] if rng.random() < 0.5 else []
    for k in range(30):
        lines.append(rng.choice(["a", f"a score={k}", "a "] + ([] if plain else ["", "# no head"])))
        n = rng.randrange(1, 9)
        for _ in range(rng.randrange(4)):
            text = "".join(rng.choice("ACGTacgN-") for _ in range(n if rng.random() < 0.9 else n + 1))
            size, odd = len(text.replace("-", "")), rng.random()
            start = rng.choice(["+3", "x", ""]) if odd < 0.05 else str(rng.randrange(30))
            lines.append(f"s c{rng.randrange(2)} {start} {size} {rng.choice('++-')} 60 {text}" if odd < 0.95 else f"s  c {start}\t{size} + ")
            if rng.random() < 0.2:
                lines.append(rng.choice(["", "i q I 0", "# ab", " a", "e q 1 1 + 9 I", "A", "s"] + ([] if plain else ["abc", "as q 1 1 + 9 A"])))
        if rng.random() < 0.3:
            lines.append(rng.choice(["", "  "]))
    return lines


@pytest.mark.parametrize("seed", range(2))
def test_blocks_walked_where_they_are_read(spark, tmp_path, monkeypatch, seed):
    rng, plain = random.Random(seed), seed % 2 == 0
    for k in range(2):
        text = rng.choice(["\n", "\r\n"]).join(odd_alignment(rng, plain)) + rng.choice(["", "\n"])
        (tmp_path / f"f{k}.maf").write_bytes(text.encode())
    (tmp_path / "g.maf.gz").write_bytes(gzip.compress("\n".join(odd_alignment(rng, plain)).encode()))
    (tmp_path / "empty.maf").write_text("")
    paths = [str(tmp_path / n) for n in ("f0.maf", "f1.maf", "g.maf.gz", "empty.maf")]
    found = lambda df: sorted(map(tuple, df.collect()))
    want = found(alignment.maf_to_gvcf(maf.read_blocks(spark, paths)))
    assert want and maf._have_heads(tables.read_lines(spark, paths)) == plain
    assert found(alignment.records_where_read(spark, paths)) == want
    for heads in (True, False) if plain else (False,):
        monkeypatch.setattr(maf, "_have_heads", lambda lines: heads)  # noqa: B023
        for size in ("37", "113"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "0")
            try:
                assert found(alignment.records_where_read(spark, paths)) == want
            finally:
                spark.conf.unset("spark.sql.files.maxPartitionBytes")
                spark.conf.unset("spark.sql.files.openCostInBytes")


def test_ranges_without_heads_are_read_by_lines(spark, tmp_path):
    (tmp_path / "x.maf").write_text("a\n" + "s c 0 4 + 9 ACGT\ns x 0 4 + 9 ACTT\n\n" * 9)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100")
    try:
        assert not maf._have_heads(tables.read_lines(spark, str(tmp_path / "x.maf")))
        assert alignment.records_where_read(spark, str(tmp_path / "x.maf")).count() == 27
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    (tmp_path / "y.maf").write_text("a\ns c 0 4 + 9 " + "A" * maf.LINE_BYTES + "\n")
    assert not maf._have_heads(tables.read_lines(spark, str(tmp_path / "y.maf")))
    assert alignment.records_where_read(spark, str(tmp_path / "y.maf")).count() == 0
