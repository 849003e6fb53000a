import gzip

import pytest

from baseweave import cli
from baseweave.sources import paths


def test_paths(tmp_path):
    for name in ("b.maf", "a.maf.gz", "b.maf.gz", "x.txt", "r.fasta", "s.vcf", "s.gvcf.gz"):
        (tmp_path / name).touch()
    folder = str(tmp_path)
    assert paths.discover_samples(folder) == ["a", "b"] and paths.discover_samples(folder, ("z",)) == ["z"]
    assert paths.alignment_of(folder, "b").endswith("b.maf") and paths.alignment_of(folder, "a").endswith("a.maf.gz")
    assert paths.find_reference(folder).endswith("r.fasta")
    assert paths.find_records(f"{folder}/s").endswith("s.gvcf.gz") and paths.find_records(f"{folder}/s", paths.SPLIT_ENDINGS).endswith("s.vcf")
    assert paths.prefix_of("a/b.gvcf.gz") == "a/b"
    with pytest.raises(FileNotFoundError):
        paths.find_records(f"{folder}/none")


def test_commands(spark, tmp_path, capsys):
    head = "##fileformat=VCFv4.2\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\ts\n"
    rows = ["c1\t1\t.\tA\t<NON_REF>\t.\t.\tEND=4\tGT\t0/0", "c1\t5\t.\tA\tG\t.\t.\tDP=4\tGT\t0/1", "c1\t6\t.\tAAAAAAAAAAAA\tA\t.\t.\tDP=4\tGT\t0/1"]
    (tmp_path / "in").mkdir()
    (tmp_path / "in/m.gvcf.gz").write_bytes(gzip.compress((head + "\n".join(rows) + "\n").encode()))
    (tmp_path / "r.fai").write_text("c1\t20\n")
    cli.main(["split-and-mask", str(tmp_path / "in/m"), "--fai", str(tmp_path / "r.fai"), "--out", str(tmp_path / "out")])
    assert "filtered_bed_bp=15" in capsys.readouterr().out
    cli.main(["drop-indels", str(tmp_path / "in"), "--cutoff", "9", "--out", str(tmp_path / "dropped")])
    bed = [r["value"] for r in spark.read.text(str(tmp_path / "dropped/dropped_indels.bed")).collect()]
    assert bed == ["c1\t5\t17"]
    kept = [r["value"].split("\t")[1] for r in spark.read.text(str(tmp_path / "dropped/records")).collect() if not r["value"].startswith("#")]
    assert sorted(kept) == ["1", "5"]
    (tmp_path / "maf").mkdir()
    (tmp_path / "maf/q.maf").write_text("a\ns r.c1 0 4 + 9 ACGT\ns q.c1 0 4 + 9 ACGA\n")
    cli.main(["align", str(tmp_path / "maf"), "--out", str(tmp_path / "aligned")])
    assert sorted((r.sample, r.pos) for r in spark.read.parquet(str(tmp_path / "aligned")).collect()) == [("q", 1), ("q", 4)]
