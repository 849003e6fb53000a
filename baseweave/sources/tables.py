"""Readers of records, intervals, indexes, alignments, status files and logs.

Malformed lines are skipped or kept for the filtered class, never fatal, by
each reader's own rule.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from baseweave.functions.vcf import as_bigint, extract_end
from baseweave.operators.stored import stored

from . import maf
from .text import field, in_file_order, read_lines, split_fields

VCF_SCHEMA = (
    "file string, ordinal struct<part: bigint, row: bigint>, line string, cols array<string>, n_cols int, contig string, pos bigint, "
    "ref string, alt string, info string, format string, samples array<string>"
)


def parse_vcf(lines: DataFrame) -> DataFrame:
    """Records of VCF_SCHEMA of the lines that are no header; absent fields are null, absent samples an empty array."""
    rows = split_fields(lines.filter(~F.col("line").startswith("#")))
    named = {"contig": 0, "ref": 3, "alt": 4, "info": 7, "format": 8}
    rows = rows.withColumns({n: field("cols", k) for n, k in named.items()} | {"pos": as_bigint(field("cols", 1))})
    samples = F.when(F.col("n_cols") > 9, F.slice("cols", 10, F.greatest(F.col("n_cols") - 9, F.lit(1)))).otherwise(F.array().cast("array<string>"))
    return rows.withColumn("samples", samples).select("file", "ordinal", "line", "cols", "n_cols", "contig", "pos", "ref", "alt", "info", "format", "samples")


def read_vcf(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return parse_vcf(read_lines(spark, paths))


def as_records(rows: DataFrame) -> DataFrame:
    """Records of VCF_SCHEMA of rows (file, contig, pos, ref, alt, info, format, samples), in the order of their positions.

    At one position blocks with END stand before the others, so groups do not depend on chance.
    """
    dot = F.lit(".")
    fixed = [F.col("contig"), F.col("pos").cast("string"), dot, F.col("ref"), F.col("alt"), dot, dot, F.col("info"), F.col("format")]
    cols = F.concat(F.array(*fixed), "samples")
    rows = rows.withColumns({"cols": cols, "n_cols": F.size(cols), "line": F.array_join(cols, "\t")})
    ordinal = F.struct(F.col("pos").alias("part"), F.when(extract_end(F.col("info")).isNotNull(), 0).otherwise(1).cast("bigint").alias("row"))
    names = ("file", "ordinal", "line", "cols", "n_cols", "contig", "pos", "ref", "alt", "info", "format", "samples")
    return rows.withColumn("ordinal", ordinal).select(*names)


def sample_columns(header: DataFrame) -> DataFrame:
    """(file, nth, sample): the samples that each file's column names tell, in their order."""
    named = header.filter(F.col("line").startswith("#CHROM")).select("file", F.slice(F.split("line", "\t"), 10, 1 << 30).alias("names"))
    return named.select("file", F.posexplode("names").alias("nth", "sample"))


def with_positions(records: DataFrame) -> DataFrame:
    """Records of two columns or more with a position; an absent reference counts as ``N``, absent INFO as ``.``."""
    usable = records.filter("n_cols >= 2 and pos is not null")
    return usable.withColumns({"ref": F.coalesce("ref", F.lit("N")), "info": F.coalesce("info", F.lit("."))})


def read_header(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(file, ordinal, line) of header lines."""
    return read_lines(spark, paths).filter(F.col("line").startswith("#"))


def header_lines(header: DataFrame) -> list[str]:
    """Distinct header lines in the order in which they first come."""
    first = header.groupBy("line").agg(F.min(F.struct("file", "ordinal")).alias("at"))
    return [r["line"] for r in first.orderBy("at").select("line").collect()]


def numbered_header(header: DataFrame) -> DataFrame:
    """(file, k, line): each file's header lines with their number in it."""
    return header.select("file", (F.row_number().over(Window.partitionBy("file").orderBy("ordinal")) - 1).alias("k"), "line")


def header_contigs(header: DataFrame) -> DataFrame:
    """(file, contig, length) that a gVCF's header declares."""
    declared = header.filter(F.col("line").startswith("##contig=<ID="))
    size = F.regexp_extract("line", r"[,<]length=([0-9]+)", 1)
    return declared.select("file", F.regexp_extract("line", r"^##contig=<ID=([^,>]*)", 1).alias("contig"), as_bigint(size).alias("length")).filter("contig <> ''")


def parse_bed(lines: DataFrame) -> DataFrame:
    """(contig, s, e) of lines with three fields or more that are proper intervals."""
    rows = split_fields(lines.filter(~F.col("line").startswith("#"))).filter("n_cols >= 3")
    return rows.select(field("cols", 0).alias("contig"), as_bigint(field("cols", 1)).alias("s"), as_bigint(field("cols", 2)).alias("e")).filter("e > s")


def read_bed(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return parse_bed(read_lines(spark, paths))


def parse_fai(lines: DataFrame) -> DataFrame:
    """(contig, length, ordinal) of an index, malformed lines left out, repeated names kept."""
    rows = split_fields(lines.filter(F.trim("line") != "")).filter("n_cols >= 2")
    return rows.select(field("cols", 0).alias("contig"), as_bigint(field("cols", 1)).alias("length"), "ordinal").filter("length is not null")


def read_fai(spark: SparkSession, path: str, first: bool = False) -> DataFrame:
    """(contig, length): of repeated names the last counts, or the first."""
    rows = parse_fai(read_lines(spark, path))
    pick = F.min_by if first else F.max_by
    return rows.groupBy("contig").agg(pick("length", "ordinal").alias("length"))


def fai_contigs(spark: SparkSession, path: str) -> list[str]:
    """Names in the order of the index."""
    rows = split_fields(read_lines(spark, path).filter(F.trim("line") != ""))
    return [r["contig"] for r in rows.orderBy("ordinal").select(field("cols", 0).alias("contig")).collect()]


def read_fasta_contigs(spark: SparkSession, path: str) -> DataFrame:
    """(contig, length): the first word of each header, and its sequence's letters."""
    return fasta_lengths(read_lines(spark, path))


def fasta_lengths(lines: DataFrame) -> DataFrame:
    is_name = F.col("line").startswith(">")
    rows = in_file_order(lines, {"nth": is_name.cast("bigint")}).filter("nth > 0")
    name = F.max(F.when(is_name, F.regexp_extract("line", r"^>\s*(\S+)", 1)))
    size = F.sum(F.when(is_name, 0).otherwise(F.length(F.trim("line"))))
    return rows.groupBy("file", "nth").agg(name.alias("contig"), size.cast("bigint").alias("length")).select("contig", "length")


def reference_chunks(lines: DataFrame, chunk: int = 10_000) -> DataFrame:
    """(contig, start, sequence) of a FASTA file's lines in pieces of ``chunk`` bases."""
    is_name = F.col("line").startswith(">")
    size = F.when(is_name, 0).otherwise(F.length(F.trim("line"))).cast("bigint")
    rows = stored(in_file_order(lines, {"nth": is_name.cast("bigint"), "upto": size}).filter("nth > 0"), "reference-lines")
    # A sequence begins after its name, whose line has all the letters before it.
    names = rows.filter(is_name).select("file", "nth", F.regexp_extract("line", r"^>\s*(\S+)", 1).alias("contig"), F.col("upto").alias("before"))
    text = F.trim("line")
    rows = rows.filter(~is_name).join(names, ["file", "nth"]).select("contig", (F.col("upto") - F.length(text) - F.col("before")).alias("at"), text.alias("text")).filter("text <> ''")
    first, last = F.floor(F.col("at") / chunk), F.floor((F.col("at") + F.length("text") - 1) / chunk)
    parts = rows.select("contig", "at", "text", F.explode(F.sequence(first, last)).alias("piece"))
    begin = F.greatest(F.col("at"), F.col("piece") * chunk)
    end = F.least(F.col("at") + F.length("text"), (F.col("piece") + 1) * chunk)
    part = F.col("text").substr((begin - F.col("at") + 1).cast("int"), (end - begin).cast("int"))
    parts = parts.select("contig", "piece", F.struct(begin.alias("begin"), part.alias("part")).alias("p"))
    joined = F.array_join(F.transform(F.sort_array(F.collect_list("p")), lambda p: p["part"]), "")
    return parts.groupBy("contig", "piece").agg(joined.alias("sequence")).select("contig", (F.col("piece") * chunk).cast("bigint").alias("start"), "sequence")


def parse_maf(lines: DataFrame) -> DataFrame:
    """(file, block_id, seq_idx, src, start, size, strand, src_size, text, score) of the sequences of ``maf.parse_blocks``."""
    return maf.sequences(maf.parse_blocks(lines))


def read_maf(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return parse_maf(read_lines(spark, paths))


def maf_reference_contigs(blocks: DataFrame) -> DataFrame:
    """(contig) of the first sequence of each block."""
    return blocks.filter("seq_idx = 0").select(F.col("src").alias("contig")).distinct()


def read_status(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(base, contig, status) of each file's first line, if it has three fields."""
    lines = read_lines(spark, paths)
    first = lines.groupBy("file").agg(F.min_by("line", "ordinal").alias("line"))
    rows = split_fields(first).filter("n_cols = 3")
    return rows.select(field("cols", 0).alias("base"), field("cols", 1).alias("contig"), F.trim(field("cols", 2)).alias("status"))


def warning_lines(lines: DataFrame) -> DataFrame:
    return lines.filter(F.col("line").rlike("WARNING|Warning"))
