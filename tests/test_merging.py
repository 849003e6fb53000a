"""Joint records of samples against brute force, and runs whose contigs have files of their own."""

import contextlib
import gzip
import io
import random
import zipfile

import numpy as np
import pytest

from baseweave import cli
from baseweave.operators import alignment, runs, samples
from baseweave.plans import workflow
from baseweave.sources import blocked, masks, tables, text

SCHEMA = "file string, ordinal struct<part: bigint, row: bigint>, line string"


def records(spark, rows):
    """Records of (file, line), fields parted by spaces."""
    return tables.parse_vcf(spark.createDataFrame([(f, (0, k), row.replace(" ", "\t")) for k, (f, row) in enumerate(rows)], SCHEMA))


def brute(rows):
    """(contig, pos) -> (ref, alt, calls) of every position, by going through positions one by one."""
    members, own, covered = {}, {}, {}
    for file, row in rows:
        contig, pos, _, ref, alt, *_, info, _, gt = row.split(" ")
        pos = int(pos)
        members.setdefault(contig, set()).add(file)
        if alt == "<NON_REF>":
            end = int(info[4:]) if info.startswith("END=") else pos + len(ref) - 1
            for p in range(pos, end + 1):
                covered.setdefault((contig, p), set()).add(file)
        else:
            own.setdefault((contig, pos), {})[file] = (ref, alt.split(",")[:-1], gt)
    out = {}
    for contig, files in members.items():
        names = sorted(files)
        for p in range(0, 400):
            here, over = own.get((contig, p)), covered.get((contig, p), set())
            call = ["0" if n in over else "." for n in names]
            if here:
                longest = max((len(r), r) for r, _, _ in here.values())[1]
                longer = lambda a, r: a + longest[len(r) :]  # noqa: E731, B023
                every = sorted({longer(a, r) for r, alts, _ in here.values() for a in alts})
                for n, (r, alts, gt) in here.items():
                    call[names.index(n)] = "/".join(str(every.index(longer(alts[int(g) - 1], r)) + 1) if g not in "0." else g for g in gt.split("/"))
                out[(contig, p)] = (longest, ",".join([*every, "<NON_REF>"]), tuple(call))
            elif over:
                out[(contig, p)] = ("N", "<NON_REF>", tuple(call))
    return out


def expanded(merged):
    out = {}
    for r in merged.collect():
        end = int(r.info[4:]) if r.info.startswith("END=") else r.pos
        assert r.samples == r.cols[9:] and r.line == "\t".join(r.cols)
        for p in range(r.pos, end + 1):
            assert (r.contig, p) not in out, "rows do not overlap"
            out[(r.contig, p)] = (r.ref, r.alt, tuple(r.samples))
    return out


@pytest.mark.parametrize(("seed", "width"), [(1, 1 << 16), (2, 16), (3, 7)])
def test_merged_against_brute_force(spark, monkeypatch, seed, width):
    monkeypatch.setattr(samples, "BIN", width)
    monkeypatch.setattr(samples, "LEAST_BIN", 1)
    rng, rows = random.Random(seed), []
    for file in ("s2", "s0", "s1", "s10"):
        for contig in ("a", "b") if file != "s1" else ("b",):
            taken = set()
            for _ in range(12):
                pos = rng.randrange(1, 200)
                if rng.random() < 0.6:
                    rows.append((file, f"{contig} {pos} . A <NON_REF> . . END={pos + rng.randrange(0, 70)} GT 0"))
                elif pos not in taken:
                    taken.add(pos)
                    ref = rng.choice(["A", "A", "AC", "ACG"])
                    rows.append((file, f"{contig} {pos} . {ref} {rng.choice(['G', 'T', 'G,T', 'GG'])},<NON_REF> . . . GT {rng.choice(['1', '0/1', '.', '1/1'])}"))
    merged = samples.merged_records(records(spark, rows))
    found = expanded(merged)
    assert found == brute(rows)
    assert {len(v[2]) for (c, _), v in found.items() if c == "a"} == {3} and {len(v[2]) for (c, _), v in found.items() if c == "b"} == {4}
    ends = {(r.contig, r.pos - 1): r.samples for r in merged.collect() if not r.info.startswith("END=")}
    blocks = sorted((r.contig, r.pos, int(r.info[4:]), tuple(r.samples)) for r in merged.collect() if r.info.startswith("END="))
    for x, y in zip(blocks, blocks[1:]):
        assert not (x[0] == y[0] and x[2] + 1 == y[1] and x[3] == y[3]), "a stretch is one block, across bins too"
    assert ends


def test_no_records(spark):
    assert samples.merged_records(records(spark, []).limit(0)).collect() == []
    assert samples.merge_samples(records(spark, []).limit(0)).collect() == []


def test_absent_sample_has_no_column(spark):
    rows = [("a", "x 1 . A <NON_REF> . . END=9 GT 0"), ("b", "x 4 . A G,<NON_REF> . . . GT 1"), ("b", "y 2 . C T,<NON_REF> . . . GT 1")]
    found = {(r.contig, r.pos): r.samples for r in samples.merged_records(records(spark, rows)).collect()}
    assert found[("y", 2)] == ["1"] and found[("x", 4)] == ["0", "1"]
    classes = {(r.contig, r.pos): r["class"] for r in workflow.split(samples.merged_records(records(spark, rows))).classified.collect() if r.alt != "<NON_REF>"}
    assert classes == {("x", 4): "clean", ("y", 2): "clean"}


def test_a_thousand_samples(spark):
    n = 1000
    rows = [(f"s{k:04d}", f"c 1 . A <NON_REF> . . END={10 + k % 7} GT 0") for k in range(n)] + [("s0003", "c 30 . A G,<NON_REF> . . . GT 1"), ("s0999", "c 12 . A T,<NON_REF> . . . GT 1")]
    found = {r.pos: (r.info, r.samples) for r in samples.merged_records(records(spark, rows)).collect()}
    assert all(len(s) == n for _, s in found.values()) and found[1] == ("END=10", ["0"] * n)
    assert found[30][1] == ["." if k != 3 else "1" for k in range(n)]
    assert found[12][1] == ["1" if k == 999 else "0" if k % 7 >= 2 else "." for k in range(n)]
    assert sorted(found) == [1, 11, 12, 13, 14, 15, 16, 30]


def test_one_block_of_those_that_overlap(spark, monkeypatch):
    monkeypatch.setattr(alignment, "CHOICE_BIN", 8)
    rng = random.Random(4)
    genome = "".join(rng.choice("ACGT") for _ in range(120))
    blocks, at = [], []
    for k in range(14):
        start, size = rng.randrange(0, 90), rng.randrange(1, 30)
        other = "".join(rng.choice("ACGT") if rng.random() < 0.3 else b for b in genome[start : start + size])
        score = rng.choice([None, 5.0, float(rng.randrange(20))])
        blocks += [("f", k, 0, "c", start, size, "+", 130, genome[start : start + size], score), ("f", k, 1, "x", 0, size, "+", 500, other, score)]
        at.append((start, size, other, score, k))
    table = spark.createDataFrame(blocks, "file string, block_id bigint, seq_idx int, src string, start bigint, size bigint, strand string, src_size bigint, text string, score double")
    expected = {}
    for p in range(130):
        over = [(s is not None, s or 0, -k, other[p - start]) for start, size, other, s, k in at if start <= p < start + size]
        expected[p + 1] = max(over)[3] if over else "N"
    for fill in (False, True):
        found = {}
        for r in alignment.maf_to_gvcf(table, one_block=True, fill_gaps=fill).collect():
            end = int(r.info[4:]) if r.info.startswith("END=") else r.pos
            for p in range(r.pos, end + 1):
                assert p not in found
                found[p] = "N" if r.ref == "N" else r.alt.split(",")[0] if r.info == "." else genome[p - 1]
        assert found == {p: b for p, b in expected.items() if fill or b != "N"}


@pytest.mark.parametrize("seed", range(5))
def test_alleles_roll_together(seed):
    rng = random.Random(seed)
    for _ in range(60):
        genome = "".join(rng.choice("AC") for _ in range(25))
        pos, n = rng.randrange(2, 20), rng.randrange(1, 4)
        ref = genome[pos - 1 : pos - 1 + n]
        alts = [a for a in ("".join(rng.choice("AC") for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(1, 3))) if a != ref]
        if not alts:
            continue
        at, found = alignment.shifted(pos, [ref, *alts], genome[: pos - 1])
        assert [genome[: at - 1] + a + genome[at - 1 + len(found[0]) :] for a in found] == [genome[: pos - 1] + a + genome[pos - 1 + n :] for a in [ref, *alts]]
        # No base is shared at an end, unless the record stands at the beginning of the contig.
        assert (len({a[-1] for a in found}) > 1 or at == 1) and (min(map(len, found)) == 1 or len({a[0] for a in found}) > 1)


def test_symbols_are_carried(spark):
    rows = spark.createDataFrame([("c", 9, "AA", "A,<NON_REF>", "."), ("c", 9, "AA", "*,A,<DEL>", "."), ("c", 9, "A", "<NON_REF>", "END=12"), ("c", 9, "AA", "A", "."), ("c", 9, "A", "A", ".")], "contig string, pos bigint, ref string, alt string, info string")
    pieces = spark.createDataFrame([("c", 0, "CAAA"), ("c", 4, "AAAA"), ("c", 8, "AAAA")], "contig string, start bigint, sequence string")
    found = sorted(tuple(r) for r in alignment.left_aligned(rows, pieces, 4).collect())
    assert found == [("c", 1, "CA", "*,C,<DEL>", "."), ("c", 1, "CA", "C", "."), ("c", 1, "CA", "C,<NON_REF>", "."), ("c", 9, "A", "<NON_REF>", "END=12"), ("c", 9, "A", "A", ".")]


def test_blocked_files(spark, tmp_path):
    rng = random.Random(1)
    lines = [(f"{'ab'[k % 2]}.gz", k, "x" * rng.choice([0, 1, 50, 3000, 90_000 if k % 97 == 0 else 5]) + str(k)) for k in range(3000)]
    rows = spark.createDataFrame(lines, "name string, k int, line string").repartitionByRange(5, "name", "k").sortWithinPartitions("name", "k")
    folder = str(tmp_path / "out")
    blocked.write_blocked(rows, folder)
    assert [p.name for p in sorted((tmp_path / "out").iterdir())] == ["a.gz", "b.gz"]
    for name in ("a.gz", "b.gz"):
        own = [x for n, _, x in lines if n == name]
        raw = (tmp_path / "out" / name).read_bytes()
        assert gzip.decompress(raw).decode().split("\n")[:-1] == own and raw.endswith(blocked.BGZF_END)
        for span in (999, 40_000, 1 << 26):
            found = blocked.read_blocked(spark, f"{folder}/{name}", span).orderBy("ordinal").collect()
            assert [r.line for r in found] == own and len({r.ordinal.part for r in found}) <= 1 + len(raw) // span
    assert text.read_lines(spark, f"{folder}/a.gz").count() == 1500


def test_masks_in_tiles(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(masks, "TILE", 100)
    spans = [("a", 0, 7), ("a", 95, 301), ("a", 1000, 1037), ("c", 3, 4)]
    runs_of, lengths = spark.createDataFrame(spans, "contig string, s bigint, e bigint"), spark.createDataFrame([("a", 1037), ("b", 250), ("c", 100), ("d", 0)], "contig string, length bigint")
    found = {r.contig: r.n for r in masks.write_masks(runs_of, lengths, str(tmp_path / "m")).collect()}
    for contig, n in (("a", 1037), ("b", 250), ("c", 100)):
        expected = np.zeros(n, bool)
        for c, s, e in spans:
            if c == contig:
                expected[s:e] = True
        assert zipfile.ZipFile(tmp_path / f"m/{contig}.npz").testzip() is None
        assert np.array_equal(np.load(tmp_path / f"m/{contig}.npz")["mask"], expected) and found[contig] == expected.sum()
    assert set(found) == {"a", "b", "c"}


def test_checksums_combine():
    import zlib

    for a, b in ((b"", b"x"), (b"ab" * 99, b""), (b"q" * 1000, b"\0" * 12345)):
        assert masks.combined_crc(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


def test_runs_of_positions(spark):
    rng, rows = random.Random(2), []
    for c in "ab":
        pos = 1
        for _ in range(400):
            pos += rng.choice([0, 1, 1, 1, 1, 5])
            rows.append((c, pos))
    df = spark.createDataFrame(rows, "contig string, pos bigint").repartitionByRange(3, "contig", "pos").sortWithinPartitions("contig", "pos")
    found = runs.position_runs(df).collect()
    assert sorted((r.contig, p + 1) for r in found for p in range(r.s, r.e)) == sorted(rows) and len(found) < 300
    assert runs.position_runs(df.limit(0)).collect() == []


def test_lines_of_files_larger_than_a_task(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(text, "RUN", 3)
    rng = random.Random(3)
    sequences = {f"c{k}": "".join(rng.choice("ACGT") for _ in range(rng.randrange(1, 900))) for k in range(6)}
    fasta = "".join(f">{c} x\n" + "".join(s[k : k + 7] + "\n" for k in range(0, len(s), 7)) for c, s in sequences.items())
    (tmp_path / "r.fa").write_text(fasta)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "400")
    try:
        assert dict((r.contig, r.length) for r in tables.read_fasta_contigs(spark, str(tmp_path / "r.fa")).collect()) == {c: len(s) for c, s in sequences.items()}
        pieces = {}
        for r in tables.reference_chunks(text.read_lines(spark, str(tmp_path / "r.fa")), 50).orderBy("contig", "start").collect():
            assert len(pieces.get(r.contig, "")) == r.start
            pieces[r.contig] = pieces.get(r.contig, "") + r.sequence
        assert pieces == sequences
        maf = "".join(f"a score={k}\n" + "".join(f"s q{j} {k} 1 + 9 A\n" for j in range(k % 3 + 1)) + "\n" for k in range(60))
        (tmp_path / "x.maf").write_text("##maf\n\na score=9\n\n" + maf)
        found = [(r.block_id, r.seq_idx, r.start, r.score) for r in tables.read_maf(spark, str(tmp_path / "x.maf")).orderBy("block_id", "seq_idx").collect()]
        assert found == [(k, j, k, float(k)) for k in range(60) for j in range(k % 3 + 1)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


ONE = "##maf\n\na score=1\ns r.1 2 12 + 30 ACGTACGTAC-GT\ns x 0 13 + 50 ACGAACGTACTGT\n\na score=9\ns r.2 4 6 + 40 TTTGGG\ns x 9 4 + 50 TT--GG\n\n"
TWO = "##maf\n\na score=1\ns r.1 0 10 + 30 GGACGTACGT\ns y 0 10 + 50 GGACTTACGT\n\n"
FASTA = ">r.1\nGGACGTACGTACGTGGGGGGGGGGGGGGGG\n>r.2\nAAAATTTGGGAAAAAAAAAAAAAAAAAAAAAAAAAAAAAA\n>r.3\nAC\n"


def contents(folder):
    """Lines of each contig's folder, parts in the order of their names."""
    return {p.name.removeprefix("contig="): "".join(x.read_text() for x in sorted(p.glob("part-*"))).splitlines() for p in folder.iterdir() if p.is_dir()}


@pytest.mark.parametrize("settings", [{}, {"normalize": True, "fill_gaps": True}])
def test_alignments_to_valid_files(spark, tmp_path, settings):
    for name, body in (("x.maf", ONE), ("y.maf", TWO), ("ref.fa", FASTA)):
        (tmp_path / name).write_text(body)
    (tmp_path / "ref.fai").write_text("r.1\t30\nr.2\t40\nr.3\t2\n")
    (tmp_path / "settings.yaml").write_text("reference_fasta: %s\nsample_suffix: _aw\ndrop_cutoff: 5000\nslurm_account: nobody\n%s" % (tmp_path / "ref.fa", "".join(f"{ {'normalize': 'vt_normalize'}.get(k, k)}: true\n" for k in settings)))
    config = workflow.Config.read(str(tmp_path / "settings.yaml"))
    assert config.drop_cutoff == 5000 and config.sample_suffix == "_aw" and config.normalize == bool(settings) and config.fill_gaps == bool(settings)
    result = workflow.run_alignments(spark, [str(tmp_path / "x.maf"), str(tmp_path / "y.maf")], str(tmp_path / "ref.fai"), str(tmp_path / "out"), config)
    names = {"r.1": ["x_aw", "y_aw"], "r.2": ["x_aw"], "r.3": ["x_aw", "y_aw"]}
    sizes = {"r.1": 30, "r.2": 40, "r.3": 2}
    for what in ("combined", "inv", "filtered", "clean"):
        found = contents(tmp_path / "out" / what)
        assert set(found) == set(names)
        for contig, lines in found.items():
            heads = [x for x in lines if x.startswith("#")]
            assert lines[: len(heads)] == heads and heads[0] == "##fileformat=VCFv4.2"
            assert f"##contig=<ID={contig},length={sizes[contig]}>" in heads and sum(x.startswith("##contig") for x in heads) == 1
            assert heads[-1].split("\t") == ["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT", *names[contig]]
            body = [x.split("\t") for x in lines[len(heads) :]]
            assert all(len(r) == 9 + len(names[contig]) and r[0] == contig for r in body)
            assert [int(r[1]) for r in body] == sorted(int(r[1]) for r in body)
        assert len(found["r.3"]) == len([x for x in found["r.3"] if x.startswith("#")]), "a contig without records is a placeholder"
    assert {r.contig: (r.total_bp, r.overlap_bp) for r in result.coverage.collect()} == {"r.1": (30, 0), "r.2": (40, 0), "r.3": (0, 0)}
    status = {tuple(r.value.split("\t")) for r in spark.read.text(str(tmp_path / "out/status")).collect()}
    assert ("y_aw", "r.2", "missing") in status and ("x_aw", "r.2", "present") in status and ("x_aw", "r.3", "missing") in status
    assert any("y_aw is missing contigs: r.2, r.3" in w for w in result.warnings)
    assert any("reference contigs not in the alignments: r.3" in w for w in result.warnings)
    page = "".join(r.value for r in spark.read.text(str(tmp_path / "out/summary.html")).collect())
    for contig in sizes:
        assert all(f"{kind} {contig}" in page for kind in ("dropped and filtered bp", "invariant sites", "variant sites"))


def vcf_of(rows):
    return "##fileformat=VCFv4.2\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\ts\n" + "".join(r.replace(" ", "\t") + "\n" for r in rows)


def test_blocked_run_and_counts(spark, tmp_path):
    (tmp_path / "m.vcf").write_text(vcf_of(["c 1 . A <NON_REF> . . END=6 GT 0", "c 7 . A G . . . GT 0/1", "c 9 . A * . . . GT 0/1"]))
    (tmp_path / "r.fai").write_text("c\t12\n")
    found = workflow.run(spark, str(tmp_path / "m.vcf"), str(tmp_path / "r.fai"), str(tmp_path / "out"), workflow.Config(blocked=True))
    assert found.counts == {"inv": 6, "filtered": 1, "clean": 1}
    assert [p.name for p in (tmp_path / "out/inv").iterdir()] == ["inv.gz"] and blocked.is_blocked(str(tmp_path / "out/inv/inv.gz"))
    lines = gzip.open(tmp_path / "out/inv/inv.gz", "rt").read().splitlines()
    assert [x.split("\t")[1] for x in lines if not x.startswith("#")] == ["1", "2", "3", "4", "5", "6"]
    assert next(r.total_bp for r in found.coverage.collect()) == 12


def test_only_changed_contigs_are_done_again(spark, tmp_path):
    rows = {c: [f"{c} 1 . A <NON_REF> . . END=6 GT 0", f"{c} 7 . A G . . . GT 0/1"] for c in ("c1", "c2", "c3")}
    (tmp_path / "r.fai").write_text("c1\t12\nc2\t12\nc3\t12\n")
    config, out = workflow.Config(incremental=True), tmp_path / "out"

    def go(settings=config):
        (tmp_path / "m.vcf").write_text(vcf_of([r for own in rows.values() for r in own]))
        result = workflow.run(spark, str(tmp_path / "m.vcf"), str(tmp_path / "r.fai"), str(out), settings)
        stamps = {(w, p.parent.name): p.name for w in ("inv", "clean", "filtered.bed") for p in (out / w).glob("contig=*/part-*")}
        return result, stamps

    first, before = go()
    assert first.changed == ["c1", "c2", "c3"]
    again, same = go()
    assert again.changed == [] and same == before and {r.total_bp for r in again.coverage.collect()} == {12}
    rows["c2"].append("c2 9 . A T . . . GT 0/1")
    third, after = go()
    assert third.changed == ["c2"] and {k for k in before if before[k] != after.get(k)} == {(w, "contig=c2") for w in ("inv", "clean", "filtered.bed")}
    assert {r.contig: r.clean_bp for r in third.coverage.collect()} == {"c1": 1, "c2": 2, "c3": 1}
    whole = workflow.run(spark, str(tmp_path / "m.vcf"), str(tmp_path / "r.fai"), str(tmp_path / "whole"), workflow.Config(by_contig=True))
    assert contents(out / "clean").keys() == contents(tmp_path / "whole/clean").keys()
    body = lambda folder: {c: [x for x in lines if not x.startswith("##")] for c, lines in contents(folder).items()}
    assert body(out / "clean") == body(tmp_path / "whole/clean") and body(out / "inv") == body(tmp_path / "whole/inv")
    assert sorted(map(tuple, whole.coverage.collect())) == sorted(map(tuple, third.coverage.select(*whole.coverage.columns).collect()))
    assert go(workflow.Config(incremental=True, filter_multiallelic=True))[0].changed == ["c1", "c2", "c3"]


def test_dropped_indels_by_sample(spark, tmp_path):
    (tmp_path / "in").mkdir()
    head = "##fileformat=VCFv4.2\n##sample={0}\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\t{0}\n"
    for name, rows in (("p", ["c 3 . A G . . . GT 1", "c 5 . AAAAAAAAA A . . . GT 1"]), ("q", ["c 5 . A T . . . GT 1"])):
        (tmp_path / f"in/{name}.gvcf.gz").write_bytes(b"".join(blocked.bgzf(iter([(head.format(name) + "".join(r.replace(" ", "\t") + "\n" for r in rows)).encode()]))))
    cli.main(["drop-indels", str(tmp_path / "in"), "--cutoff", "4", "--out", str(tmp_path / "out")])
    found = {p.name: gzip.open(p, "rt").read().splitlines() for p in (tmp_path / "out/records").iterdir()}
    assert {n: [x.split("\t")[1] for x in lines if x[0] != "#"] for n, lines in found.items()} == {"p.gvcf.gz": ["3"], "q.gvcf.gz": ["5"]}
    for name in ("p", "q"):
        heads = [x for x in found[f"{name}.gvcf.gz"] if x.startswith("#")]
        assert heads == head.format(name).splitlines()


def test_short_filtered_records_are_no_mask(spark):
    from baseweave.operators import classify, mask

    rows = classify.classify(records(spark, [("f", "c 5 . A *"), ("f", "c 9 x")]))
    none = spark.createDataFrame([], "contig string, s bigint, e bigint")
    assert [tuple(r) for r in mask.class_mask(tables.with_positions(rows), none).collect()] == [("c", 4, 5)]


def test_sites_move_once(spark, monkeypatch):
    """Many records of few sites: only the sites go through the rounds."""
    seen, once = [], alignment._shifted_once
    monkeypatch.setattr(alignment, "_shifted_once", lambda rows, *rest: (seen.append(rows.count()), once(rows, *rest))[1])
    rows = spark.range(400).selectExpr("id", "'c' contig", "10 + id % 2 pos", "if(id % 3 = 0, 'A', 'AA') ref", "if(id % 3 = 0, 'c', 'A') alt", "if(id % 5 = 0, 'END=12', '.') info")
    pieces = spark.createDataFrame([("c", 0, "CAAA"), ("c", 4, "AAAA"), ("c", 8, "AAAA")], "contig string, start bigint, sequence string")
    found = {r.id: (r.pos, r.ref, r.alt, r.info) for r in alignment.left_aligned(rows, pieces, 4).collect()}
    own = lambda k: (10 + k % 2, "A" if k % 3 == 0 else "AA", "c" if k % 3 == 0 else "A", "END=12" if k % 5 == 0 else ".")
    assert found == {k: own(k) if k % 5 == 0 else (10 + k % 2, "A", "C", ".") if k % 3 == 0 else (1, "CA", "C", ".") for k in range(400)}
    assert max(seen) == 4


def test_single_bases_are_no_sites(spark, monkeypatch):
    """Records of several alleles: those with nothing to move or trim are not worked on, and keep their other columns."""
    seen, once = [], alignment._shifted_once
    monkeypatch.setattr(alignment, "_shifted_once", lambda rows, *rest: (seen.append({r.alt for r in rows.collect()}), once(rows, *rest))[1])
    rows = spark.createDataFrame([(1, "c", 9, "A", "G,<NON_REF>"), (2, "c", 9, "A", "<NON_REF>"), (3, "c", 9, "AAA", "AA,*,A,<NON_REF>"), (4, "c", 9, "AAA", "AA,*,A,<NON_REF>"), (5, "c", None, "AA", "A")], "id int, contig string, pos bigint, ref string, alt string")
    pieces = spark.createDataFrame([("c", 0, "CAAA"), ("c", 4, "AAAA"), ("c", 8, "AAAA")], "contig string, start bigint, sequence string")
    found = sorted(alignment.left_aligned(rows, pieces, 4).collect())
    assert [tuple(r) for r in found] == [(1, "c", 9, "A", "G,<NON_REF>"), (2, "c", 9, "A", "<NON_REF>"), *[(k, "c", 1, "CAA", "CA,*,C,<NON_REF>") for k in (3, 4)], (5, "c", None, "AA", "A")]
    assert seen[0] == {"AA,*,A,<NON_REF>"}


@pytest.mark.parametrize("cells", [1, 7, 1 << 20])
def test_sweep_in_pieces(monkeypatch, cells):
    """Calls of a bin do not depend on how many stretches are worked on at once, and long bins cost little a position."""
    import time

    import pyarrow as pa

    monkeypatch.setattr(samples, "CELLS", cells)
    rng, width, n = random.Random(3), 1 << 16, 3
    net, loci = {}, {}
    count = 300 if cells < 100 else 20_000
    for _ in range(count):
        s, k = rng.randrange(width - 60), rng.randrange(n)
        for x, d in ((s, 1), (s + rng.randrange(1, 60), -1)):
            net[x, k] = net.get((x, k), 0) + d
        if rng.random() < 0.3:
            loci[rng.randrange(width)] = ([rng.randrange(n)], ["1"])
    rows = [("c", 0, x, k, d, None, None, None, None, n) for (x, k), d in net.items() if d]
    rows += [("c", 0, x, None, None, "A", "C", ks, gts, n) for x, (ks, gts) in loci.items()]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.string()), pa.int32()]
    names = ["contig", "bin", "x", "k", "d", "ref", "alt", "ks", "gts", "n"]
    table = pa.table([pa.array([r[j] for r in rows], kind) for j, kind in enumerate(kinds)], names=names)
    began = time.process_time()
    found = samples._sweep(width)((pa.scalar("c"), pa.scalar(0)), table).to_pylist()
    took = time.process_time() - began
    expected, live, cuts = [], [0] * n, sorted({x for x, _ in net if any(net.get((x, k)) for k in range(n))} | set(loci) | {x + 1 for x in loci})
    for x, y in zip(cuts, [*cuts[1:], None]):
        live = [v + net.get((x, k), 0) for k, v in enumerate(live)]
        calls = ["0" if v else "." for v in live]
        if x in loci:
            calls[loci[x][0][0]] = "1"
            expected.append([x + 1, None, "\t".join(calls)])
        elif any(live) and y is not None:
            if expected and expected[-1][1] == x and expected[-1][2] == "\t".join(calls):
                expected[-1][1] = y
            else:
                expected.append([x + 1, y, "\t".join(calls)])
    assert [[r["pos"], r["end"], r["calls"]] for r in found] == expected
    assert cells < 100 or took < 10e-6 * len(cuts)


def test_a_block_reaches_a_bin_as_one_row(spark):
    rows = [("a", "c 5 . A <NON_REF> . . END=40 GT 0/0"), ("b", "c 41 . A <NON_REF> . . END=70 GT 0/0")]
    numbered = samples._numbered(records(spark, rows), samples.contig_samples(records(spark, rows)))
    found = sorted((r.bin, r.x, r.e, r.k) for r in samples._parts(numbered, 32).collect())
    assert found == [(0, 4, 32, 0), (1, 32, 40, 0), (1, 40, 64, 1), (2, 64, 70, 1)]


def test_loci_are_summed_up_once(spark, monkeypatch):
    """A locus's records meet in one aggregate, and of each sample the first call by reference, alternatives and genotype stays."""
    seen = []
    monkeypatch.setattr(samples, "_called", lambda numbered, loci, members, called=samples._called: (seen.append(loci), called(numbered, loci, members))[1])
    row = "c 5 . {} {},<NON_REF> . . . GT {}"
    rows = [("a", row.format("AC", "A", "1/1")), ("a", row.format("A", "T", "0/1")), ("a", row.format("A", "G", "1/1")), ("b", row.format("A", "T", "1"))]
    merged, outer = samples.merged_records(records(spark, rows)).first(), samples.merge_samples(records(spark, rows)).first()
    assert (merged.ref, merged.alt, merged.samples) == ("AC", "A,GC,TC,<NON_REF>", ["2/2", "3"])
    assert (outer.ref, outer.alt, outer.calls) == ("AC", "A,G,T,<NON_REF>", {"a": "0/1", "b": "1"})
    for loci in seen:
        with contextlib.redirect_stdout(io.StringIO()) as plan:
            loci.explain()
        assert plan.getvalue().count("ObjectHashAggregate") == 2  # before and after


@pytest.mark.parametrize(("seed", "width", "cells"), [(1, 1 << 16, 1 << 20), (2, 16, 1 << 20), (3, 7, 8)])
def test_outer_merge_against_brute_force(spark, monkeypatch, seed, width, cells):
    """Records meet in their bin in one shuffle, several of a sample at a position too, and blocks between loci are not worked out."""
    for name, value in (("BIN", width), ("LEAST_BIN", 1), ("CELLS", cells)):
        monkeypatch.setattr(samples, name, value)
    rng, rows = random.Random(seed), []
    for file in ("s2", "s0", "s1", "s10"):
        for contig in ("a", "b") if file != "s1" else ("b",):
            for _ in range(40):
                pos, ref = rng.randrange(1, 90), rng.choice(["A", "A", "AC", "AG"])
                alt = rng.choice(["<NON_REF>", ".", "G", "T,G,<NON_REF>", "*,<NON_REF>", "<DEL>"])
                info = f"DP=1;END={pos + rng.randrange(-2, 20)}" if rng.random() < 0.2 else "DP=1"
                rows.append((file, f"{contig} {pos} . {ref} {alt} . . {info} GT {rng.choice(['1:3', '0/1', '.', '1/1'])}"))
    own, covered, names = {}, set(), {}
    for file, row in rows:
        contig, pos, _, ref, alt, _, _, info, _, gt = row.split(" ")
        names.setdefault(contig, set()).add(file)
        called = [a for a in alt.split(",") if a not in (".", "<NON_REF>")]
        if "END=" in info or not called:
            end = int(info.split("END=")[1]) if "END=" in info else int(pos) - 1 + len(ref)
            covered |= {(contig, file, p) for p in range(int(pos), end + 1)}
        else:
            own.setdefault((contig, int(pos)), []).append((file, ref, called, gt.split(":")[0]))
    expected = {}
    for (contig, pos), each in own.items():
        calls = {f: "0" if (contig, f, pos) in covered else "." for f in names[contig]}
        calls |= {f: min(gt for g, _, _, gt in each if g == f) for f, *_ in each}
        alt = ",".join([*sorted({a for _, _, called, _ in each for a in called}), "<NON_REF>"])
        expected[contig, pos] = (max((len(r), r) for _, r, _, _ in each)[1], alt, calls)
    merged = samples.merge_samples(records(spark, rows))
    with contextlib.redirect_stdout(io.StringIO()) as plan:
        merged.explain()
    assert "FlatMapGroupsInArrow" in plan.getvalue() and plan.getvalue().count("Exchange hashpartitioning(contig") == 1
    assert {(r.contig, r.pos): (r.ref, r.alt, r.calls) for r in merged.collect()} == expected


def test_merges_are_dealt_by_records(spark, monkeypatch):
    """Both shuffles of a merge have partitions by the number of records, so a task's memory does not go with the input."""
    from baseweave.operators import stored as dealing

    monkeypatch.setattr(dealing, "TASK_ROWS", 5)
    plans = []

    def plan_of(df):
        with contextlib.redirect_stdout(io.StringIO()) as out:
            df.explain()
        plans.append(out.getvalue())
        return df

    monkeypatch.setattr(samples, "_called", lambda numbered, loci, members, called=samples._called: called(numbered, plan_of(loci), members))
    monkeypatch.setattr(samples, "stored", lambda df, name, stored=samples.stored: stored(plan_of(df) if name == "calls" else df, name))
    rows = [(f"s{k % 2}", f"c {k + 1} . A G,<NON_REF> . . . GT 1") for k in range(60)]
    assert samples.merged_records(records(spark, rows)).count() == 60
    assert plan_of(samples.merge_samples(records(spark, rows))).count() == 60
    assert len(plans) == 3 and all(", 12), REPARTITION_BY_NUM" in plan for plan in plans)
