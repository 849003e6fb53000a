"""The workflow: split records into classes, find gaps, make the mask, prove it, report."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from baseweave.functions.vcf import is_variant_alt
from baseweave.operators import accessibility, alignment, classify, contigs, coverage, gaps, indels, mask, ploidy, samples, windows
from baseweave.operators.runs import position_runs
from baseweave.operators.stored import stored
from baseweave.sources import sinks, tables
from baseweave.sources.blocked import listed
from baseweave.sources.masks import write_masks
from baseweave.sources.text import read_lines


#: Entries of a preview in the report; how many more there are is told.
SHOWN = 20
#: Names of settings in files that other tools share, and what they are called here.
ALIASES = {"vt_normalize": "normalize", "reference_fasta": "reference", "bgzip_output": "blocked"}


@dataclass(frozen=True)
class Config:
    """Settings of a run and their defaults.

    ``normalize`` needs ``reference``, a FASTA file. ``blocked`` writes records as
    blocked gzip files instead of folders of text. ``by_contig`` gives each contig
    files of its own, as merged samples always have; ``incremental`` also leaves the
    files of contigs whose input and settings are those of the run before.
    """

    drop_cutoff: int = 4000
    filter_multiallelic: bool = False
    contigs: tuple[str, ...] = ()
    samples: tuple[str, ...] = ()
    sample_suffix: str = ""
    ploidy: int | None = None
    window: int = windows.WIDTH
    one_block: bool = True
    fill_gaps: bool = False
    normalize: bool = False
    reference: str | None = None
    blocked: bool = False
    by_contig: bool = False
    incremental: bool = False

    @classmethod
    def of(cls, settings: dict) -> Config:
        """From a mapping as read from a file; unknown names are an error."""
        given = {ALIASES.get(k, k): v for k, v in settings.items()}
        for name in ("contigs", "samples"):
            given[name] = tuple(str(x) for x in given.get(name) or ())
        for name in ("drop_cutoff", "window"):
            given[name] = int(given.get(name, getattr(cls, name)))
        return cls(**given)

    @classmethod
    def read(cls, path: str) -> Config:
        """From a settings file, JSON or YAML; settings of other tools are left out."""
        with open(path, encoding="utf-8") as f:
            text = f.read()
        if path.endswith(".json"):
            settings = json.loads(text)
        else:
            import yaml  # only for such files

            settings = yaml.safe_load(text)
        return cls.of({k: v for k, v in (settings or {}).items() if ALIASES.get(k, k) in cls.__dataclass_fields__})


@dataclass
class Split:
    """Records of each class, gaps between them, and base pairs by class."""

    invariant: DataFrame
    filtered: DataFrame
    clean: DataFrame
    missing: DataFrame
    counts: DataFrame
    classified: DataFrame | None = None


def split(records: DataFrame, lengths: DataFrame | None = None, filter_multiallelic: bool = False) -> Split:
    """Route records and find gaps. Invariant blocks stay unexpanded; see ``classify.expanded_positions``.

    Records are classified once and stored. The first clean record of each file
    decides whether that file's clean records lose the symbol for other alleles.
    """
    usable = records.filter("n_cols >= 2")
    classified = stored(classify.classify(records, filter_multiallelic=filter_multiallelic), "classified")
    of = {c: classified.filter(F.col("class") == c) for c in (classify.INVARIANT, classify.FILTERED, classify.CLEAN)}
    missing = gaps.missing(gaps.record_spans(tables.with_positions(usable)), lengths)  # gaps part by a record, so none touch
    clean = classify.reformatted(classified, order=("ordinal",), by=("file",))
    return Split(of["inv"], of["filtered"], clean, missing, classify.class_counts(classified), classified)


def mask_of(parts: Split, dropped: DataFrame) -> DataFrame:
    if parts.classified is not None:
        return mask.class_mask(tables.with_positions(parts.classified), parts.missing, dropped)
    kept = [tables.with_positions(p) for p in (parts.filtered, parts.invariant, parts.clean)]
    return mask.filtered_mask(kept[0], parts.missing, dropped, kept[1], kept[2])


def split_and_mask(records: DataFrame, lengths: DataFrame, dropped: DataFrame | None = None, config: Config = Config()) -> tuple[Split, DataFrame]:
    """Classes and mask of merged records; ``dropped`` are intervals of removed indels."""
    parts = split(records, lengths, config.filter_multiallelic)
    none = lengths.select("contig", F.lit(0).cast("bigint").alias("s"), F.lit(0).cast("bigint").alias("e")).limit(0)
    return parts, mask_of(parts, none if dropped is None else dropped)


def clean_samples(records: DataFrame, cutoff: int) -> tuple[DataFrame, DataFrame]:
    """Records without sites of very large indels, and the merged intervals of these."""
    large = indels.large_indels(records, cutoff)
    return indels.drop_sites(records, large), indels.dropped_intervals(large)


@dataclass
class Merged:
    """Records of all samples, each contig with those samples that are on it (``members``: contig, names)."""

    records: DataFrame
    members: DataFrame
    ploidies: dict[str, int] = field(default_factory=dict)
    ploidy: int = 1
    how: str = "default"
    dropped: DataFrame | None = None
    warnings: list[str] = field(default_factory=list)


def joint_call(spark: SparkSession, paths: list[str], config: Config = Config()) -> Merged:
    """Merged records of alignment files: records of each, without very large indels, joined by contig, left-aligned if asked for."""
    blocks = stored(tables.read_maf(spark, paths), "alignments")
    ploidies = ploidy.file_ploidy(blocks.select("file", "block_id"))
    resolved, how = ploidy.resolve_ploidy(ploidies, config.ploidy)
    each = alignment.sample_records(blocks, config.one_block, config.fill_gaps)
    each = stored(each.withColumn("file", F.concat("file", F.lit(config.sample_suffix))), "samples")
    kept, dropped = clean_samples(each, config.drop_cutoff)
    members = stored(samples.contig_samples(kept), "members")
    merged = samples.merged_records(kept, members=members)
    warnings = []
    if config.normalize or config.reference:
        if not config.reference:
            raise ValueError("normalize needs a reference")
        names = tables.read_fasta_contigs(spark, config.reference).select("contig")
        found = contigs.contig_differences(tables.maf_reference_contigs(blocks), names)
        for side, what in (("left", "alignment contigs not in the reference"), ("right", "reference contigs not in the alignments")):
            warnings += _preview(found.filter(F.col("side") == side).select("contig"), what, 5)
    if config.normalize:
        merged = normalized(merged, tables.reference_chunks(read_lines(spark, config.reference)), names)
    return Merged(stored(merged, "merged"), members, {r["file"]: r["ploidy"] for r in ploidies.collect()}, resolved, how, stored(dropped, "dropped"), warnings)


def normalized(records: DataFrame, pieces: DataFrame, names: DataFrame) -> DataFrame:
    """Records left-aligned against a reference, whose contigs (``names``) take the records' names where they only differ in form."""
    to = contigs.checked_contig_map(names, records.select("contig"))
    mapping = records.sparkSession.createDataFrame(list(to.items()), "fasta_name string, gvcf_name string")
    known = contigs.renamed(pieces.select("contig").distinct(), mapping)
    pieces = pieces.join(known, "contig").select(F.col("renamed").alias("contig"), "start", "sequence")
    rows = records.select("file", "contig", "pos", "ref", "alt", "info", "format", "samples")
    return tables.as_records(alignment.left_aligned(rows, pieces))


def merge_alignments(spark: SparkSession, paths: list[str]) -> tuple[DataFrame, dict[str, int], str]:
    """Merged records of alignment files as they are, the ploidy of each file, and where the ploidy of all is from."""
    blocks = stored(tables.read_maf(spark, paths), "alignments")
    ploidies = ploidy.file_ploidy(blocks.select("file", "block_id"))
    _, how = ploidy.resolve_ploidy(ploidies)
    return samples.merged_records(alignment.sample_records(blocks)), {r["file"]: r["ploidy"] for r in ploidies.collect()}, how


def chosen_contigs(records: DataFrame, lengths: DataFrame, wanted: tuple[str, ...]) -> tuple[DataFrame, DataFrame, list[str]]:
    """Records and lengths of the wanted contigs (all, if none is named) under the records' names, and warnings.

    Wanted names and those of the index are looked for among the records' contigs
    as they are, else by their normal form.
    """
    spark, warnings = records.sparkSession, []
    present = stored(records.select("contig").distinct(), "contigs")
    # Of the index's names those that only differ in form take the records' name.
    known = contigs.resolve_contigs(lengths.select("contig", F.col("contig").alias("ordinal")), present)
    lengths = lengths.join(known.select("contig", "resolved"), "contig", "left").select(F.coalesce("resolved", "contig").alias("contig"), "length")
    if not wanted:
        return records, lengths, warnings
    asked = spark.createDataFrame(list(zip(wanted, range(len(wanted)), strict=True)), "contig string, ordinal long")
    available = present.unionByName(lengths.select("contig")).distinct()
    found = contigs.resolve_contigs(asked, available).orderBy("ordinal").collect()
    warnings += [f"contig {r['contig']} was asked for and is nowhere" for r in found if r["how"] == "skipped"]
    warnings += [f"contig {r['contig']} is {r['resolved']} here" for r in found if r["how"] == "remapped"]
    names = spark.createDataFrame([(r["resolved"],) for r in found if r["resolved"]], "contig string")
    return records.join(F.broadcast(names), "contig", "left_semi"), lengths.join(F.broadcast(names), "contig", "left_semi"), warnings


def _preview(names: DataFrame, what: str, most: int = SHOWN) -> list[str]:
    """One line on the rows of one column, if there are any: the first of them in order, and how many more there are."""
    first = names.orderBy(*names.columns).limit(most + 1).collect()
    if not first:
        return []
    more = f" (+{names.count() - most} more)" if len(first) > most else ""
    return [f"{what}: {', '.join(r[0] for r in first[:most])}{more}"]


def contig_headers(lengths: DataFrame, members: DataFrame, meta: list[str], every: list[str]) -> DataFrame:
    """(contig, k, line): the header of each contig, with the samples on it; a contig without any has all (``every``).

    A contig that no length is known of is declared with length 1.
    """
    known = lengths.select("contig", "length").join(members, "contig", "full_outer")
    declared = F.concat(F.lit("##contig=<ID="), "contig", F.lit(",length="), F.coalesce("length", F.lit(1)).cast("string"), F.lit(">"))
    fixed = F.lit("#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT")
    names = F.coalesce("names", F.array(*map(F.lit, every)).cast("array<string>"))
    columns = F.array_join(F.concat(F.array(fixed), names), "\t")
    return known.select("contig", F.posexplode(F.concat(F.array(*map(F.lit, meta)), F.array(declared, columns))).alias("k", "line"))


#: What the header of merged records declares.
DECLARED = ['##ALT=<ID=NON_REF,Description="Any other allele">', '##INFO=<ID=END,Number=1,Type=Integer,Description="End of the block">', '##FORMAT=<ID=GT,Number=1,Type=String,Description="Genotype">']


def densities(clean: DataFrame, invariant_runs: DataFrame, masked: DataFrame, lengths: DataFrame, width: int) -> DataFrame:
    """(contig, kind, bin, mid, n) of every window: masked base pairs, invariant sites and variant sites."""
    shown = clean.filter("n_cols >= 5").filter(is_variant_alt(F.col("alt")))
    of = {
        "dropped and filtered bp": windows.bin_intervals(masked, lengths, width).withColumnRenamed("bp", "n"),
        "invariant sites": windows.bin_intervals(invariant_runs, lengths, width).withColumnRenamed("bp", "n"),
        "variant sites": windows.bin_points(shown, width),
    }
    every = [windows.with_empty_windows(n, lengths, "n", width).select("contig", F.lit(kind).alias("kind"), "bin", "mid", "n") for kind, n in of.items()]
    return reduce(DataFrame.unionByName, every)


def plots_of(found: DataFrame) -> list[str]:
    """A plot of each contig and kind; what comes to the driver is one number for each window."""
    of: dict[tuple[str, str], list[tuple[float, float]]] = {}
    for r in found.orderBy("contig", "kind", "bin").select("contig", "kind", "mid", "n").collect():
        of.setdefault((r["contig"], r["kind"]), []).append((r["mid"], r["n"]))
    return [sinks.scatter_svg(f"{kind} {c}", points) for (c, kind), points in of.items()]


@dataclass
class Outcome:
    """What a run found; the report's text is made of it. ``coverage`` has a row of figures for each contig.

    ``changed`` are the contigs that were worked on, where the run was incremental.
    """

    counts: dict[str, int]
    coverage: DataFrame
    warnings: list[str] = field(default_factory=list)
    changed: list[str] | None = None


def fingerprints(records: DataFrame, lengths: DataFrame, dropped: DataFrame | None, settings: str) -> DataFrame:
    """(contig, fingerprint) of all that a contig's results are made of: lines of records and their order, length, dropped intervals, settings."""
    in_place = F.row_number().over(Window.partitionBy("file", "contig", "pos").orderBy("ordinal"))
    rows = records.withColumn("nth", in_place).groupBy("contig").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("file", "line", "nth")).alias("x"), F.sum(F.xxhash64("line", "nth", "file").cast("decimal(38,0)")).alias("s"))
    found = lengths.join(rows, "contig", "left")
    if dropped is not None:
        of = dropped.groupBy("contig").agg(F.bit_xor(F.xxhash64("s", "e")).alias("d"), F.count("*").alias("m"))
        found = found.join(of, "contig", "left")
    else:
        found = found.withColumns({"d": F.lit(None).cast("long"), "m": F.lit(None).cast("long")})
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("length", "n", "x", "s", "d", "m")]
    return found.select("contig", F.sha2(F.concat_ws("|", *parts, F.lit(settings)), 256).alias("fingerprint"))


def _earlier(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """What a run before left at ``path``, or no rows."""
    try:
        return stored(spark.read.schema(schema).parquet(path), "earlier")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def run(spark: SparkSession, vcf: str | list[str] | DataFrame | Merged, fai: str, folder: str, config: Config = Config(), dropped_bed: str | None = None, logs: str | list[str] | None = None, facts: dict[str, list[str]] | None = None) -> Outcome:
    """Split, mask, check and report records (files, or merged records); results go to ``folder``.

    Every step works on all contigs at once, so the number of jobs does not
    depend on how many there are. Merged records are written too, and their
    contigs have files and headers of their own. What is written is read again
    for the proof, in runs of positions. ``facts`` are further sections of the report.
    """
    lengths = stored(tables.read_fai(spark, fai), "lengths")
    given = isinstance(vcf, DataFrame | Merged)
    if isinstance(vcf, DataFrame):
        vcf = stored(vcf, "records")
        wide = vcf.groupBy("contig").agg(F.max(F.size("samples")).alias("n"))
        vcf = Merged(vcf, wide.select("contig", F.transform(F.sequence(F.lit(1), F.greatest("n", F.lit(1))), lambda k: F.concat(F.lit("sample"), k.cast("string"))).alias("names")))
    records = vcf.records if given else stored(tables.read_vcf(spark, vcf), "records")
    records, lengths, warnings = chosen_contigs(records, lengths, config.contigs)
    lengths = stored(lengths, "lengths")
    dropped = tables.read_bed(spark, dropped_bed) if dropped_bed else None
    if given:
        warnings = [*vcf.warnings, *warnings]
        if vcf.dropped is not None:
            dropped = vcf.dropped if dropped is None else dropped.unionByName(vcf.dropped)
    by_contig = given or config.by_contig or config.incremental
    prints, changed = None, None
    if config.incremental:
        schema = "contig string, fingerprint string"
        prints = stored(fingerprints(records, lengths, dropped, repr(config)), "fingerprints")
        fresh = prints.join(_earlier(spark, f"{folder}/fingerprints", schema), ["contig", "fingerprint"], "left_anti").select("contig")
        changed = sorted(r["contig"] for r in fresh.collect())
        whole, fresh = lengths, F.broadcast(fresh)
        records, lengths = records.join(fresh, "contig", "left_semi"), lengths.join(fresh, "contig", "left_semi")
        dropped = dropped.join(fresh, "contig", "left_semi") if dropped is not None else None
    ending = ".gz" if config.blocked else ""
    outputs = {c: f"{folder}/{c}" for c in (*(("combined",) if given else ()), "inv", "filtered", "clean", "missing.bed", "filtered.bed", "coverage.txt", "summary.html")}
    noted = sinks.provenance("baseweave", "split_and_mask", list(outputs.values()))
    if given:
        header = contig_headers(lengths, vcf.members.join(records.select("contig").distinct(), "contig", "left_semi"), ["##fileformat=VCFv4.2", *noted, *DECLARED], _all_names(vcf.members))
    else:
        header = sinks.ordered_header(tables.header_lines(tables.read_header(spark, vcf)), noted)
    parts, masked = split_and_mask(records, lengths, dropped, config)
    masked, key = stored(masked, "mask"), "contig" if by_contig else None

    def write(rows: DataFrame, what: str) -> int:
        name = None
        if config.blocked:
            name = F.concat(F.lit("combined."), "contig", F.lit(f".{what}{ending}")) if by_contig else F.lit(f"{what}{ending}")
        return sinks.write_records(rows, outputs[what], header, by=key, name=name, keep_others=config.incremental)

    if given:
        write(records, "combined")
    counts = {"inv": write(classify.expanded_positions(parts.invariant), "inv"), "filtered": write(parts.filtered, "filtered"), "clean": write(parts.clean, "clean")}
    counts = {c: n for c, n in counts.items() if n}
    sinks.write_bed(parts.missing, outputs["missing.bed"], by_contig, config.incremental)
    sinks.write_bed(masked, outputs["filtered.bed"], by_contig, config.incremental)
    inv, clean = (_read_again(spark, outputs[c], config.blocked, lengths) for c in ("inv", "clean"))
    inv_runs, clean_runs = (stored(position_runs(df), "runs") for df in (inv, clean))
    figures = coverage.check_all(lengths, clean_runs, inv_runs, _only(tables.read_bed(spark, outputs["filtered.bed"]), lengths))
    write_masks(accessibility.accessible_intervals(clean_runs, inv_runs, lengths), lengths, f"{folder}/accessible").collect()
    shown = densities(clean, inv_runs, masked, lengths, config.window)
    if config.incremental:
        for df, name in ((figures, "figures"), (shown, "densities")):
            df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("contig").parquet(f"{folder}/{name}")
        figures, shown = (_only(spark.read.schema(df.schema).parquet(f"{folder}/{name}"), whole).select(*df.columns) for df, name in ((figures, "figures"), (shown, "densities")))
        lengths = whole
    sinks.write_lines(coverage.report_lines(figures), outputs["coverage.txt"], "contig", "nth")
    warnings += _preview(figures.filter("total_bp = 0").select("contig"), coverage.EMPTY)
    differences = contigs.contig_differences(records.select("contig"), lengths) if not config.incremental else None
    if differences is not None:
        for side, what in (("left", "contigs of records that are not in the index"), ("right", "contigs of the index without records")):
            warnings += _preview(differences.filter(F.col("side") == side).select("contig"), what)
    if given:
        status = stored(_status(vcf.members, lengths), "status")
        sinks.write_status(status, f"{folder}/status")
        lacking = contigs.missing_contigs(status).orderBy("base").collect()
        warnings += [f"{r['base']} is missing contigs: {r['preview']}" for r in lacking]
    steps = {"merge": ["combined"] if given else [], "split": ["inv", "filtered", "clean", "missing.bed"], "mask": ["filtered.bed"], "proof": ["coverage.txt"], "report": ["summary.html"]}
    sections = {"Steps": [f"{step}: {', '.join(outputs[x] for x in made)}" for step, made in steps.items() if made] + [f"accessibility: {folder}/accessible"]}
    sections |= {"Files for ARG estimation": [outputs["clean"], outputs["filtered.bed"], f"{folder}/accessible"]}
    sections |= { **({"Ploidy": [f"{vcf.ploidy} ({vcf.how})", *[f"{f}: {n}" for f, n in sorted(vcf.ploidies.items())]]} if given and vcf.ploidies else {}), **(facts or {})}
    if logs:
        found = tables.warning_lines(read_lines(spark, logs)).orderBy("file", "ordinal")
        sections["Log warnings"] = [r["line"] for r in found.collect()]
    page = sinks.report_html("Site classes", {k: str(v) for k, v in counts.items()}, warnings, plots_of(shown), sections)
    spark.createDataFrame([(page,)], "html string").coalesce(1).write.mode("overwrite").text(outputs["summary.html"])
    if prints is not None:
        prints.write.mode("overwrite").parquet(f"{folder}/fingerprints")
    return Outcome(counts, figures, warnings, changed)


def _all_names(members: DataFrame) -> list[str]:
    return [r["name"] for r in members.select(F.explode("names").alias("name")).distinct().orderBy("name").collect()]


def _status(members: DataFrame, lengths: DataFrame) -> DataFrame:
    """(base, contig, status) of each sample and contig, from the samples that each contig has; no record is read."""
    have = members.select("contig", F.explode("names").alias("base"))
    return contigs.presence(have, lengths, have.withColumnRenamed("base", "file"))


def _only(df: DataFrame, lengths: DataFrame) -> DataFrame:
    return df.join(F.broadcast(lengths.select("contig")), "contig", "left_semi")


def _read_again(spark: SparkSession, path: str, blocked: bool, lengths: DataFrame) -> DataFrame:
    """Records that this run wrote, of its contigs; those of other contigs may be from a run before."""
    return _only(tables.read_vcf(spark, listed(path) if blocked else path), lengths)


def run_alignments(spark: SparkSession, paths: list[str], fai: str, folder: str, config: Config = Config(), **rest) -> Outcome:
    """From alignment files to classes, mask, proof and report."""
    return run(spark, joint_call(spark, paths, config), fai, folder, config, **rest)
