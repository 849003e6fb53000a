"""Names of contigs and files, the target contig, and small readers."""

import pytest
from pyspark.sql import functions as F

from baseweave.functions import names, vcf
from baseweave.operators import contigs, mask, samples
from baseweave.sources import sinks, tables, text


def of(spark, f, *values):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], "x string").select(f(F.col("x"))).collect()]


def test_names(spark):
    assert of(spark, names.contig_from_prefix, "out/combined.chr1", "combined.a.combined.b", "chr1") == ["chr1", "a.combined.b", None]
    assert names.combined_prefix("c7") == "combined.c7"
    assert [names.reference_base(x) for x in ("a/ref.fa", "ref.fasta.gz", "ref.fa.gz", "r.fna")] == ["ref", "ref", "ref", "r.fna"]
    assert names.gvcf_name("s1", "dir/ref.fa.gz") == "s1Toref.gvcf.gz"
    assert of(spark, text.base_name, "d/a.gvcf.gz", "file:/x/b.vcf", "c.gz") == ["a", "b", "c"]


def test_depth_is_replaced_or_added(spark):
    assert of(spark, lambda c: vcf.with_dp(c, F.lit(9)), ".", "DP=3;END=5", "END=5", "MDP=1") == ["DP=9", "DP=9;END=5", "END=5;DP=9", "MDP=1;DP=9"]


def test_window_of_positions(spark):
    found = spark.createDataFrame([(0,), (1,), (100,), (101,)], "p bigint").select(names.window_index(F.col("p"), 100)).collect()
    assert [r[0] for r in found] == [0, 0, 0, 1]


def rows(spark, *of):
    return spark.createDataFrame([(c, k, k) for k, c in enumerate(of)], "contig string, ordinal bigint, pos bigint")


def test_target_contig(spark):
    none, spans = rows(spark).limit(0), spark.createDataFrame([("m", 0, 1)], "contig string, s bigint, e bigint")
    assert mask.target_contig(rows(spark, "a", "a"), rows(spark, "b"), none, spans) == "a"
    assert mask.target_contig(none, rows(spark, "z", "b"), rows(spark, "c"), spans) == "z"
    assert mask.target_contig(none, none, rows(spark, "c"), spans) == "c"
    assert mask.target_contig(none, none, none, spans) == "m"
    assert mask.target_contig(none, none, none, spans.limit(0)) is None
    with pytest.raises(ValueError, match="more than one"):
        mask.target_contig(rows(spark, "a", "b"), none, none, spans)


def test_records_of_present_samples(spark):
    records = spark.createDataFrame([("s", "a"), ("s", "b"), ("t", "a")], "file string, contig string")
    status = spark.createDataFrame([("s", "a", "present"), ("s", "b", "missing"), ("t", "a", "Present")], "base string, contig string, status string")
    assert sorted(tuple(r) for r in contigs.present_only(records, status).select("file", "contig").collect()) == [("s", "a"), ("t", "a")]
    sinks_rows = samples.contig_samples(records).collect()
    assert {r.contig: r.names for r in sinks_rows} == {"a": ["s", "t"], "b": ["s"]}


def test_contig_map_has_to_be_clear(spark):
    frame = lambda *x: spark.createDataFrame([(c,) for c in x], "contig string")
    assert contigs.checked_contig_map(frame("chr1", "chr2"), frame("1", "02", "9")) == {"chr1": "1", "chr2": "02"}
    with pytest.raises(ValueError, match="no contig"):
        contigs.checked_contig_map(frame("a"), frame("b"))
    with pytest.raises(ValueError, match="alike"):
        contigs.checked_contig_map(frame("chr1"), frame("1", "01"))


def test_small_files(spark, tmp_path):
    (tmp_path / "r.fai").write_text("b\t5\t0\n\na\t7\t9\n")
    assert tables.fai_contigs(spark, str(tmp_path / "r.fai")) == ["b", "a"]
    (tmp_path / "x.vcf").write_text("##x\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tp\tq\nc\t1\n")
    header = tables.read_header(spark, str(tmp_path / "x.vcf"))
    assert [(r.nth, r["sample"]) for r in tables.sample_columns(header).orderBy("nth").collect()] == [(0, "p"), (1, "q")]
    assert [(r.k, r.line[:2]) for r in tables.numbered_header(header).orderBy("k").collect()] == [(0, "##"), (1, "#C")]
    status = spark.createDataFrame([("s", "c1", "present"), ("t", "c1", "missing")], "base string, contig string, status string")
    sinks.write_status(status, str(tmp_path / "status"))
    lines = sorted(r.line for r in text.read_lines(spark, str(tmp_path / "status")).collect())
    assert lines == ["s\tc1\tpresent", "t\tc1\tmissing"]
