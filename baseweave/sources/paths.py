"""Which files a run reads. Listings are of a driver's folder, as names and not data."""

from __future__ import annotations

from pathlib import Path

#: Endings of record files, in the order in which they are looked for.
MASK_ENDINGS = (".gvcf.gz", ".gvcf", ".vcf.gz", ".vcf")
SPLIT_ENDINGS = (".vcf.gz", ".vcf", ".gvcf.gz", ".gvcf")


def discover_samples(folder: str, configured: tuple[str, ...] = ()) -> list[str]:
    """Stems of the alignments in a folder, plain or compressed, in order; the configured ones if there are any."""
    if configured:
        return list(configured)
    names = [p.name for p in Path(folder).iterdir()]
    return sorted({n.removesuffix(".gz").removesuffix(".maf") for n in names if n.endswith((".maf", ".maf.gz"))})


def alignment_of(folder: str, sample: str) -> str:
    """The sample's alignment, the plain file before the compressed one."""
    plain = Path(folder, f"{sample}.maf")
    return str(plain if plain.exists() else plain.with_name(f"{sample}.maf.gz"))


def records_in(folder: str) -> list[str]:
    """All compressed gVCFs of a folder, in order."""
    return sorted(str(p) for p in Path(folder).glob("*.gvcf.gz"))


def find_records(prefix: str, endings: tuple[str, ...] = MASK_ENDINGS) -> str:
    """A record file given itself or without its ending."""
    if Path(prefix).is_file():
        return prefix
    for ending in endings:
        if Path(prefix + ending).is_file():
            return prefix + ending
    raise FileNotFoundError(f"no records at {prefix} with any of {', '.join(endings)}")


def prefix_of(path: str) -> str:
    for ending in MASK_ENDINGS:
        if path.endswith(ending):
            return path.removesuffix(ending)
    return path


def find_reference(folder: str) -> str:
    """``reference.fa`` of a folder, else its only FASTA file."""
    preferred = Path(folder, "reference.fa")
    if preferred.is_file():
        return str(preferred)
    found = sorted(p for ending in ("*.fa", "*.fasta") for p in Path(folder).glob(ending))
    if len(found) != 1:
        raise FileNotFoundError(f"{folder} holds {len(found)} FASTA files; one is needed")
    return str(found[0])
