"""The documented cases of splitting, masking, coverage and indel removal."""

import pytest
from pyspark.sql import functions as F

from baseweave.operators import classify, coverage, indels, samples, stored
from baseweave.plans import workflow
from baseweave.sources import tables


def records(spark, *rows):
    lines = [("f", (0, k), row.replace(" ", "\t")) for k, row in enumerate(rows)]
    return tables.parse_vcf(spark.createDataFrame(lines, "file string, ordinal struct<part: bigint, row: bigint>, line string"))


def lengths(spark, **of):
    return spark.createDataFrame([(k.lstrip("_"), v) for k, v in of.items()], "contig string, length bigint")


def bed(spark, *rows):
    return spark.createDataFrame(list(rows), "contig string, s bigint, e bigint")


def spans(df):
    return sorted((r.contig, r.s, r.e) for r in df.collect())


def bp(parts):
    found = {}
    for r in parts.counts.collect():
        found[r["class"]] = found.get(r["class"], 0) + r["bp"]
    return found


def test_missing_with_lengths(spark):
    rows = records(spark, "chrA 4 . G <NON_REF> . . END=9 GT:AD 0/0:7,0", "chrA 13 . CA C . . DP=2 GT:AD 0/1:4,3", "chrA 20 . T G . . DP=9 GT 1/1")
    parts = workflow.split(rows, lengths(spark, chrA=25))
    assert spans(parts.missing) == [("chrA", 0, 3), ("chrA", 9, 12), ("chrA", 14, 19), ("chrA", 20, 25)]


def test_clean_keeps_genotypes_and_drops_symbol(spark):
    rows = records(spark, "c 17 . T C,<NON_REF> . . DP=44 GT:AD:GQ 1/1:0,9:30 ./.:.:. 0/1:6,5:12")
    (row,) = workflow.split(rows, lengths(spark, c=40)).clean.collect()
    assert row.alt == "C" and row.format == "GT:AD:GQ" and row.samples == ["1/1:0,9:30", "./.:.:.", "0/1:6,5:12"]


def test_reformat_is_decided_by_each_file(spark):
    """The first clean record of a file counts, in the file's order and not by position."""
    text = [("f", "c 30 . A G,<NON_REF> . . . GT 0"), ("f", "c 10 . A G,<NON_REF> . . . GT:AD 0/1:2,3"), ("g", "c 30 . A T,<NON_REF> . . . GT:AD 0/1:2,3"), ("g", "c 40 . A T,<NON_REF> . . . GT 0")]
    lines = [(f, (0, k), row.replace(" ", "\t")) for k, (f, row) in enumerate(text)]
    rows = tables.parse_vcf(spark.createDataFrame(lines, "file string, ordinal struct<part: bigint, row: bigint>, line string"))
    found = {(r.file, r.pos): r.alt for r in workflow.split(rows).clean.collect()}
    assert found == {("f", 30): "G,<NON_REF>", ("f", 10): "G,<NON_REF>", ("g", 30): "T", ("g", 40): "T"}


def test_block_is_invariant(spark):
    rows = records(spark, "c 6 . C <NON_REF> . . MIN=3;END=12 GT 0/0")
    parts = workflow.split(rows, lengths(spark, c=12))
    assert bp(parts) == {"inv": 7} and spans(parts.missing) == [("c", 0, 5)]
    assert sorted(r.pos for r in classify.expanded_positions(parts.invariant).collect()) == list(range(6, 13))


def test_invariant_even_with_missing_genotype(spark):
    rows = records(spark, "k 21 . T . . . DP=2 GT .", "k 25 . G <NON_REF> . . DP=6 GT 0", "k 31 . G . . . . GT 0/0")
    assert bp(workflow.split(rows)) == {"inv": 3}


def none(spark):
    return bed(spark).limit(0)


def test_mask_uses_reference_length(spark):
    empty = records(spark).limit(0)
    found = workflow.mask_of(workflow.Split(empty, records(spark, "c 41 . GATTA G . . ."), empty, bed(spark, ("c", 2, 9)), None), none(spark))
    assert spans(found) == [("c", 2, 9), ("c", 40, 45)]


def test_mask_subtracts(spark):
    parts = workflow.Split(records(spark, "c 33 . G . . . DP=7"), records(spark, "c 30 . G A . . END=36"), records(spark, "c 35 . T C . . DP=7"), none(spark), None)
    assert spans(workflow.mask_of(parts, none(spark))) == [("c", 29, 32), ("c", 33, 34), ("c", 35, 36)]


def test_coverage_passes(spark):
    clean, inv = records(spark, "z 2 . C T", "z 5 . C T", "z 6 . C T"), records(spark, "z 1 . A .", "z 3 . A .")
    found = coverage.check_coverage("z", lengths(spark, z=8), clean, inv, bed(spark, ("z", 3, 4), ("z", 6, 8)))
    assert found.lines() == ["chrom=z", "clean_bp=3", "inv_bp=2", "filtered_bed_bp=3", "total_bp=8", "chrom_len=8"]
    every = coverage.check_all(lengths(spark, z=8, y=3), clean, inv, bed(spark, ("z", 3, 4), ("z", 6, 8)))
    assert [r.line for r in coverage.report_lines(every).orderBy("contig", "nth").collect()][7:] == found.lines()


def test_coverage_fails_on_overlap(spark):
    for check in (lambda *a: coverage.check_coverage("z", *a), coverage.check_all):
        with pytest.raises(coverage.CoverageError, match="overlap"):
            check(lengths(spark, z=7), records(spark, "z 4 . C T"), records(spark, "z 6 . A ."), bed(spark, ("z", 0, 4), ("z", 4, 5), ("z", 6, 7)))


def test_coverage_fails_on_gap(spark):
    for check, said in ((lambda *a: coverage.check_coverage("z", *a), "cover 3 of 9"), (coverage.check_all, "3 of 9")):
        with pytest.raises(coverage.CoverageError, match=said):
            check(lengths(spark, z=9), records(spark, "z 4 . C T"), records(spark, "z 6 . A .", "z 9 . A ."), none(spark))


def test_coverage_warns_when_empty(spark):
    empty = records(spark).limit(0)
    found = coverage.check_coverage("u", lengths(spark, u=31), empty, empty, none(spark))
    assert found.warning and found.lines()[-1].startswith("warning=")


def test_large_indels(spark):
    rows = records(spark, "c 8 . G C . . .", "c 15 . TTTTTTC T . . .", "c 40 . T TGGG . . .", "c 40 . T A . . .")
    kept, dropped = workflow.clean_samples(rows, 2)
    assert [r.pos for r in kept.collect()] == [8]
    assert spans(dropped) == [("c", 14, 21), ("c", 39, 40)]
    assert [tuple(r) for r in indels.drop_counts(rows, 2).collect()] == [("f", 4, 1, 3)]


@pytest.mark.parametrize(
    ("row", "expected"),
    [
        ("q 11 . G <NON_REF> . . DP=3 GT 0/0 0/0", "inv"),
        ("q 22 . T C . . DP=31 GT:AD 1/1:0,6 . 0/1:3,3", "filtered"),
        ("q 33 . A *,G . . DP=5 GT 0/2 0/0", "filtered"),
        ("q 44 . C <INS>,<NON_REF> . . . GT 0/1", "filtered"),
        ("q 55 . T A,<NON_REF> . . DP=17 GT:AD 0/1:8,9 1/1:0,17", "clean"),
        ("q 66 . C t . . . GT 0/1", "filtered"),
        ("q 77 . G <DUP> . . END=90 GT 0/1", "inv"),
        ("q 88 . TG . . . DP=1 GT 0/0", "inv"),
        ("q 99 . C T", "filtered"),
        ("q 110 . C T . . END=soon;END=118 GT 0/1", "clean"),
    ],
)
def test_classes(spark, row, expected):
    assert [r["class"] for r in classify.classify(records(spark, row)).collect()] == [expected]


def test_multiallelic_flag(spark):
    row = "m 7 . C A,T . . DP=8 GT 1/2"
    found = [classify.classify(records(spark, row), filter_multiallelic=f).first()["class"] for f in (False, True)]
    assert found == ["clean", "filtered"]


def test_group_goes_one_way_and_blocks_part_groups(spark):
    rows = records(spark, "g 12 . T A . . . GT 0/1", "g 12 . T . . . . GT 0/0", "g 19 . C G . . . GT 0/1", "g 19 . C <NON_REF> . . END=19 GT 0", "g 19 . C *,A . . . GT 0/1")
    found = [r["class"] for r in classify.classify(rows).orderBy("ordinal").collect()]
    assert found == ["inv", "inv", "clean", "inv", "filtered"]


def test_position_that_is_no_number(spark):
    with pytest.raises(Exception, match="not a number"):
        classify.classify(records(spark, "c five . T A . . . GT 0/1")).collect()


def test_workflow_partitions_random_records(spark, tmp_path):
    import random

    rng, rows, pos = random.Random(7), [], 1
    while pos < 400:
        kind = rng.random()
        if kind < 0.3:
            end = pos + rng.randrange(1, 6)
            rows.append(f"c1 {pos} . A <NON_REF> . . END={end} GT 0/0")
            pos = end + 1 + rng.randrange(0, 3)
        else:
            rows.append(f"c1 {pos} . A {rng.choice(['G', '*', 'C,T', '.', '<DEL>'])} . . DP=4 GT {rng.choice(['0/1', '.'])}")
            pos += 1 + rng.randrange(0, 3)
    vcf, fai = tmp_path / "in.vcf", tmp_path / "ref.fai"
    vcf.write_text("##fileformat=VCFv4.2\n##contig=<ID=c1,length=450>\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\ts\n" + "".join(r.replace(" ", "\t") + "\n" for r in rows))
    fai.write_text("c1\t450\t0\t60\t61\n")
    found = workflow.run(spark, str(vcf), str(fai), str(tmp_path / "out"))
    (checked,) = found.coverage.collect()
    assert checked.total_bp == 450 and checked.clean_bp + checked.inv_bp + checked.filtered_bed_bp == 450
    import numpy as np

    assert np.load(tmp_path / "out/accessible/c1.npz")["mask"].sum() == checked.clean_bp + checked.inv_bp
    text = "".join(p.read_text() for p in sorted((tmp_path / "out/clean").glob("part-*"))).splitlines()
    heads = [x for x in text if x.startswith("#")]
    assert text[: len(heads)] == heads and heads[0].startswith("##fileformat") and heads[-1].startswith("#CHROM")
    assert (tmp_path / "out/summary.html").is_dir()


def jobs(spark, work):
    """How many jobs a piece of work starts."""
    tracker, group = spark.sparkContext.statusTracker(), f"jobs-{id(work)}"
    spark.sparkContext.setJobGroup(group, "")
    try:
        work()
    finally:
        found = len(tracker.getJobIdsForGroup(group))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return found


def test_many_contigs_take_no_more_jobs(spark, tmp_path):
    counts = []
    for n in (3, 2000):
        rows = "".join(f"s{k}\t1\t.\tA\t<NON_REF>\t.\t.\tEND=6\tGT\t0\ns{k}\t7\t.\tC\tG\t.\t.\t.\tGT\t1\n" for k in range(n))
        (tmp_path / f"{n}.vcf").write_text("##fileformat=VCFv4.2\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tx\n" + rows)
        (tmp_path / f"{n}.fai").write_text("".join(f"s{k}\t9\t0\t60\t61\n" for k in range(n)))
        found = []
        counts.append(jobs(spark, lambda n=n, found=found: found.append(workflow.run(spark, str(tmp_path / f"{n}.vcf"), str(tmp_path / f"{n}.fai"), str(tmp_path / f"out{n}")))))
        assert {(r.clean_bp, r.inv_bp, r.filtered_bed_bp, r.chrom_len) for r in found[0].coverage.collect()} == {(1, 6, 2, 9)}
    # Spark plans some more stages for more rows; work contig by contig would start thousands of jobs.
    assert counts[1] < 3 * counts[0], counts


MAF = """##maf version=1

a score=1
s 1 2 12 + 30 ACGTACGTAC-GT
s x.1 0 13 + 50 ACGAACGTACTGT

a score=2
s 1 20 6 + 30 TTTGGG
s x.2 9 4 - 50 TT--GG

"""
OTHER = """##maf version=1

a score=1
s 1 0 10 + 30 GGACGTACGT
s y.1 0 10 + 50 GGACTTACGT

a score=2
s 1 6 4 - 30 CCCA
s y.2 0 4 + 50 CCGA

"""


def test_alignments_to_an_exact_partition(spark, tmp_path):
    """From alignment text to classes and a mask that cover each contig exactly."""
    (tmp_path / "x.maf").write_text(MAF)
    (tmp_path / "y.maf").write_text(OTHER)
    (tmp_path / "ref.fai").write_text("chr1\t30\t0\t60\t61\n")
    merged, ploidies, how = workflow.merge_alignments(spark, [str(tmp_path / "x.maf"), str(tmp_path / "y.maf")])
    assert set(ploidies.values()) == {1} and how == "maf"
    found = {(r.pos, r.ref, r.alt, r.info, tuple(r.samples)) for r in merged.collect()}
    # x: c1 3-5 as the reference, 6 differs, an insertion after 12; y: 5 differs, and 23 on the other strand of block two.
    assert (6, "T", "A,<NON_REF>", ".", ("1", "0")) in found
    assert (5, "G", "T,<NON_REF>", ".", ("0", "1")) in found
    assert (12, "C", "CT,<NON_REF>", ".", ("1", ".")) in found
    assert (1, "N", "<NON_REF>", "END=2", (".", "0")) in found
    assert all(len(r.samples) == 2 and r.n_cols == 11 for r in merged.collect())
    result = workflow.run(spark, merged, str(tmp_path / "ref.fai"), str(tmp_path / "out"), workflow.Config(contigs=("chr1", "gone")), facts={"Ploidy": [how]})
    (row,) = result.coverage.collect()
    assert row.contig == "1"
    assert row.total_bp == 30 and row.overlap_bp == 0
    assert any("gone" in w for w in result.warnings)


def test_merged_genotypes_are_renumbered(spark):
    lines = [("a", "c 5 . A G,<NON_REF> . . . GT 0/1"), ("b", "c 5 . AT A,<NON_REF> . . . GT 1|1"), ("d", "c 1 . N <NON_REF> . . END=9 GT 0")]
    lines = [(f, (0, k), row.replace(" ", "\t")) for k, (f, row) in enumerate(lines)]
    rows = tables.parse_vcf(spark.createDataFrame(lines, "file string, ordinal struct<part: bigint, row: bigint>, line string"))
    found = {r.pos: (r.ref, r.alt, r.info, r.samples) for r in samples.merged_records(rows).collect()}
    assert found == {
        1: ("N", "<NON_REF>", "END=4", [".", ".", "0"]),
        5: ("AT", "A,GT,<NON_REF>", ".", ["0/2", "1|1", "0"]),
        6: ("N", "<NON_REF>", "END=9", [".", ".", "0"]),
    }


def test_classes_by_many_partitions(spark, monkeypatch):
    """Records that outgrow Spark's own partitions are dealt to more of them, and go the same way."""
    rows = records(spark, *[f"c {k // 2} . T {'A' if k % 3 else '*'} . . . GT 0/1" for k in range(2, 202)])
    before = {(r.pos, r.alt): r["class"] for r in classify.classify(rows).collect()}
    monkeypatch.setattr(stored, "TASK_ROWS", 10)
    found = classify.classify(rows)
    assert found.rdd.getNumPartitions() == 20
    assert {(r.pos, r.alt): r["class"] for r in found.collect()} == before
