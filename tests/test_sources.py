import gzip

from pyspark.sql import functions as F

from baseweave.functions import names
from baseweave.operators import alignment, contigs, ploidy
from baseweave.plans import contract
from baseweave.sources import sinks, tables, text
from baseweave.streaming import landing


def col(spark, f, *values):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], "x string").select(f(F.col("x"))).collect()]


def test_contig_names(spark):
    found = col(spark, names.normalized_contig, "chr01", " Chr1 ", "1", "scaffold_007", "chr", "000", "X", "chrX01")
    assert found == ["1", "1", "1", "scaffold_7", "0", "0", "x", "x1"]


def test_index_and_bed(spark, tmp_path):
    (tmp_path / "a.fai").write_text("c1\t5\t0\nbad\nc1\t7\t0\nc2\tx\t1\n")
    (tmp_path / "a.bed.gz").write_bytes(gzip.compress(b"#h\nc1\t1\t3\textra\nc1\t5\t5\nc1\ta\t9\nc1\t2\n"))
    fai = str(tmp_path / "a.fai")
    assert [tuple(r) for r in tables.read_fai(spark, fai).collect()] == [("c1", 7)]
    assert [tuple(r) for r in tables.read_fai(spark, fai, first=True).collect()] == [("c1", 5)]
    assert [tuple(r) for r in tables.read_bed(spark, str(tmp_path / "a.bed.gz")).collect()] == [("c1", 1, 3)]


def test_fasta(spark, tmp_path):
    (tmp_path / "r.fa").write_text("> c1 note\nACGT\nAC\n>c2\nA\n")
    assert sorted(tuple(r) for r in tables.read_fasta_contigs(spark, str(tmp_path / "r.fa")).collect()) == [("c1", 6), ("c2", 1)]


def test_header_contigs(spark, tmp_path):
    (tmp_path / "a.vcf").write_text("##contig=<ID=c1,length=9>\n##contig=<ID=c2>\n#CHROM\nc1\t1\n")
    found = tables.header_contigs(tables.read_header(spark, str(tmp_path / "a.vcf")))
    assert sorted((r.contig, r.length) for r in found.collect()) == [("c1", 9), ("c2", None)]


MAF = "##maf\na score=1\ns ref.c1 4 8 + 20 ACGT-ACGT\ns x.c1 0 8 + 9 ACGAAAC-T\n\na score=2\ns ref.c2 0 2 + 5 AC\ns x.c9 0 2 + 9 AC\ns y.c9 0 2 + 9 AC\n"


def test_alignment(spark, tmp_path):
    (tmp_path / "x.maf").write_text(MAF)
    blocks = tables.read_maf(spark, str(tmp_path / "x.maf"))
    assert sorted(r.contig for r in tables.maf_reference_contigs(blocks).collect()) == ["ref.c1", "ref.c2"]
    assert [r.ploidy for r in ploidy.file_ploidy(blocks).collect()] == [2]
    assert ploidy.resolve_ploidy(ploidy.file_ploidy(blocks)) == (2, "maf")
    found = sorted((r.pos, r.ref, r.alt, r.info) for r in alignment.maf_to_gvcf(blocks).filter("contig = 'ref.c1'").collect())
    assert found == [(5, "A", "<NON_REF>", "END=7"), (8, "T", "A,<NON_REF>", "."), (8, "T", "TA,<NON_REF>", "."), (9, "A", "<NON_REF>", "END=10"), (10, "CG", "C,<NON_REF>", "."), (12, "T", "<NON_REF>", "END=12")]


def test_left_alignment(spark, tmp_path):
    (tmp_path / "r.fa").write_text(">c1 x\nTTGCA\nCACACATG\n>c2\nAC\n")
    chunks = tables.reference_chunks(text.read_lines(spark, str(tmp_path / "r.fa")), chunk=6)
    assert sorted(tuple(r) for r in chunks.collect()) == [("c1", 0, "TTGCAC"), ("c1", 6, "ACACAT"), ("c1", 12, "G"), ("c2", 0, "AC")]
    rows = spark.createDataFrame([("c1", 9, "ACA", "A"), ("c1", 4, "C", "G"), ("c1", 2, "TG", "<DEL>"), ("c1", 5, "ACAC", "ACAT")], "contig string, pos bigint, ref string, alt string")
    found = sorted(tuple(r) for r in alignment.left_aligned(rows, chunks, chunk=6).collect())
    assert found == [("c1", 2, "TG", "<DEL>"), ("c1", 3, "GCA", "G"), ("c1", 4, "C", "G"), ("c1", 8, "C", "T")]


def test_status_and_logs(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("s1\tc1\tpresent\nnoise\n")
    (tmp_path / "b.tsv").write_text("s1\tc2\tMISSING\n")
    status = tables.read_status(spark, [str(tmp_path / "a.tsv"), str(tmp_path / "b.tsv")])
    assert [tuple(r) for r in contigs.missing_contigs(status).collect()] == [("s1", 1, "c2")]
    (tmp_path / "logs").mkdir()
    (tmp_path / "logs/x.log").write_text("ok\nWARNING: no\n")
    assert tables.warning_lines(text.read_lines(spark, str(tmp_path / "logs"), recursive=True)).count() == 1


def test_resolve(spark):
    asked = spark.createDataFrame([("chr1", 1), ("1", 2), ("c9", 3), ("2", 4)], "contig string, ordinal int")
    have = spark.createDataFrame([("1",), ("chr2",), ("2x",)], "contig string")
    found = {r.contig: (r.resolved, r.how) for r in contigs.resolve_contigs(asked, have).collect()}
    assert found == {"chr1": ("1", "remapped"), "c9": (None, "skipped"), "2": ("chr2", "remapped")}


def test_blocked_gzip():
    data = b"line\n" * 50_000
    packed = b"".join(sinks.bgzf(iter([data[:70_001], data[70_001:]])))
    assert gzip.decompress(packed) == data and packed.endswith(sinks.BGZF_END)


def test_report_escapes():
    page = sinks.report_html("t", {"a<": "b"}, ["chr1->1"], [sinks.scatter_svg("x", [])])
    assert "chr1-&gt;1" in page and "no data" in page


def test_landing(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.vcf").write_text("#CHROM\nc1\t3\t.\tA\t.\t.\t.\tDP=1\tGT\t0\n")
    landing.write_partitioned(landing.landing_records(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    (row,) = spark.read.parquet(str(tmp_path / "out")).collect()
    assert row.is_inv and row.pos == 3 and row.contig == "c1"


def test_ploidy_counts_blocks_within_each_file(spark):
    sizes = {("a", 7): 2, ("a", 20_000): 3, ("a", 30_000): 5, ("b", 10_000): 4, ("c", 1): 1}
    blocks = spark.createDataFrame([k for k, n in sizes.items() for _ in range(n)], "file string, block_id bigint")
    found = lambda most: {r.file: r.ploidy for r in ploidy.file_ploidy(blocks, most).collect()}
    assert {r.file: r.ploidy for r in ploidy.file_ploidy(blocks).collect()} == {"a": 4, "b": 3, "c": 1}
    assert found(2) == {"a": 2, "b": 3, "c": 1}
    assert found(1) == {"a": 1, "b": 3, "c": 1}


def test_presence_is_judged_on_all_records(spark):
    sf = "/root/testdata/sf0.01"
    have = {(r.file, r.contig) for r in contract.sites(spark, sf).select("file", "contig").distinct().collect()}
    found = contract.queries()["sample_presence"](spark, sf).collect()
    assert {(r.base, r.contig) for r in found if r.status == "present"} == have
