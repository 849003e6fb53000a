"""Commands: ``python -m baseweave.cli split-and-mask | drop-indels | align | merge-and-mask``."""

from __future__ import annotations

import argparse
from dataclasses import replace

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from baseweave.operators import alignment, coverage, indels
from baseweave.plans import workflow
from baseweave.sources import paths, sinks, tables
from baseweave.sources.text import base_name


def _config(args: argparse.Namespace) -> workflow.Config:
    given = workflow.Config.read(args.config) if args.config else workflow.Config()
    return replace(given, filter_multiallelic=given.filter_multiallelic or args.filter_multiallelic, contigs=tuple(args.contig) or given.contigs)


def _shown(found: workflow.Outcome) -> None:
    """The coverage of the first contigs; all are in the output folder."""
    for r in coverage.report_lines(found.coverage).orderBy("contig", "nth").limit(7 * coverage.SHOWN).collect():
        print(r["line"])
    for warning in found.warnings:
        print(f"WARNING: {warning}")


def _split_and_mask(spark: SparkSession, args: argparse.Namespace) -> None:
    _shown(workflow.run(spark, paths.find_records(args.prefix, paths.SPLIT_ENDINGS), args.fai, args.out, _config(args), args.dropped_bed))


def _merge_and_mask(spark: SparkSession, args: argparse.Namespace) -> None:
    config = _config(args)
    files = [paths.alignment_of(args.folder, s) for s in paths.discover_samples(args.folder, config.samples)]
    _shown(workflow.run_alignments(spark, files, args.fai, args.out, config, dropped_bed=args.dropped_bed))


def _drop_indels(spark: SparkSession, args: argparse.Namespace) -> None:
    """A blocked gzip file for each sample, under its own header, and the intervals of all."""
    files = paths.records_in(args.folder)
    records = tables.with_positions(tables.read_vcf(spark, files))
    kept, dropped = workflow.clean_samples(records, args.cutoff)
    name = F.concat(base_name(F.col("file")), F.lit(".gvcf.gz"))
    sinks.write_records(kept, f"{args.out}/records", tables.numbered_header(tables.read_header(spark, files)), by="file", name=name)
    sinks.write_bed(dropped, f"{args.out}/dropped_indels.bed")
    indels.drop_counts(records, args.cutoff).show(truncate=False)


def _align(spark: SparkSession, args: argparse.Namespace) -> None:
    files = [paths.alignment_of(args.folder, s) for s in paths.discover_samples(args.folder)]
    records = alignment.maf_to_gvcf(tables.read_maf(spark, files))
    records.withColumn("sample", F.regexp_extract("file", r"([^/]+?)\.maf(?:\.gz)?$", 1)).write.mode("overwrite").partitionBy("sample").parquet(args.out)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="baseweave")
    commands = parser.add_subparsers(dest="command", required=True)
    for name, about, source, act in (
        ("split-and-mask", "route records, find gaps, make and prove the mask", "prefix", _split_and_mask),
        ("merge-and-mask", "the same from a folder of alignments, whose samples are merged first", "folder", _merge_and_mask),
    ):
        split = commands.add_parser(name, help=about)
        split.add_argument(source)
        split.add_argument("--fai", required=True)
        split.add_argument("--out", required=True)
        split.add_argument("--config")
        split.add_argument("--dropped-bed")
        split.add_argument("--contig", action="append", default=[])
        split.add_argument("--filter-multiallelic", action="store_true")
        split.set_defaults(run=act)
    drop = commands.add_parser("drop-indels", help="remove sites of very large indels from each sample")
    drop.add_argument("folder")
    drop.add_argument("--cutoff", type=int, default=indels.DEFAULT_CUTOFF)
    drop.add_argument("--out", required=True)
    drop.set_defaults(run=_drop_indels)
    align = commands.add_parser("align", help="records and blocks of all alignments of a folder")
    align.add_argument("folder")
    align.add_argument("--out", required=True)
    align.set_defaults(run=_align)
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName("baseweave").getOrCreate()
    args.run(spark, args)


if __name__ == "__main__":
    main()
