"""Writers of records, intervals and reports."""

from __future__ import annotations

import getpass
import html
import socket
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .blocked import BGZF_END, bgzf, write_blocked

__all__ = ["BGZF_END", "bgzf"]


def provenance(source: str, command: str, outputs: list[str], note: str = "") -> list[str]:
    """Header lines that tell where a file is from."""
    return [
        f"##source={source}",
        f"##user={getpass.getuser()}",
        f"##host={socket.gethostname()}",
        f"##date={datetime.now(timezone.utc).isoformat()}",
        f"##command={command}",
        *[f"##output={o}" for o in outputs],
        *([f"##note={note}"] if note else []),
    ]


def ordered_header(header: list[str], added: list[str]) -> list[str]:
    """File format first, then the added lines, other meta lines and the column names."""
    first = [x for x in header if x.startswith("##fileformat")]
    columns = [x for x in header if x.startswith("#CHROM")]
    rest = [x for x in header if x not in first and x not in columns]
    return [*first, *added, *rest, *columns]


def record_lines(records: DataFrame) -> DataFrame:
    """Lines with the current POS and ALT in place of the original ones; lines without them as they are."""
    cols = F.transform("cols", lambda c, k: F.when(k == 1, F.coalesce(F.col("pos").cast("string"), c)).when(k == 4, F.coalesce(F.col("alt"), c)).otherwise(c))
    return records.withColumn("line", F.when(F.col("n_cols") > 4, F.array_join(cols, "\t")).otherwise(F.col("line")))


def write_records(
    records: DataFrame,
    path: str,
    header: list[str] | DataFrame,
    compress: bool = False,
    order: tuple[str, ...] = ("contig", "pos", "ordinal"),
    by: str | None = None,
    name: Column | None = None,
    keep_others: bool = False,
) -> int:
    """Records by contig, position and order in the source, after their header; the number of records written.

    The result is a folder of text parts that follow each other: the parts in
    the order of their names are one valid file, plain or gzip. With ``by``
    (``contig`` or ``file``) each value has a folder ``by=value`` of such parts and a
    header of its own, where ``header`` has (by, k, line); ``keep_others`` leaves the
    folders of values that do not occur. With ``name``, an expression over ``by``, each
    value (all records without ``by``) is one blocked gzip file in the folder ``path`` instead.

    Records are counted by the task that writes them, so counting takes no further job.
    """
    if isinstance(header, DataFrame):
        lines = header
    elif by:  # one header for all
        lines = records.select(by).distinct().select(by, F.posexplode(F.lit(header)).alias("k", "line"))
    else:
        lines = records.sparkSession.createDataFrame(list(enumerate(header)), "k int, line string")
    key = F.col(by) if by else F.lit("")
    rows = record_lines(records).select(key.alias("key"), "line", "contig", "pos", F.struct(*order).alias("nth"), F.lit(1).alias("kind"), F.lit(0).alias("k"))
    absent = {f.name: F.lit(None).cast(f.dataType) for f in rows.schema if f.name in ("contig", "pos", "nth")}
    lines = lines.withColumns({"key": key} | absent | {"kind": F.lit(0)}).select(*rows.columns)
    ordered = rows.unionByName(lines).repartitionByRange("key", "kind", "contig", "pos").sortWithinPartitions("key", "kind", "k", "contig", "pos", "nth")
    seen = Observation()
    ordered = ordered.observe(seen, F.coalesce(F.sum("kind"), F.lit(0)).alias("n"))
    if name is not None:
        write_blocked(ordered.select(F.col("key").alias(by or "key"), "line").select(name.alias("name"), "line"), path)
    elif by:
        writer = ordered.select(F.col("key").alias(by), "line").write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if keep_others else "static").partitionBy(by)
        (writer.option("compression", "gzip") if compress else writer).text(path)
    else:
        writer = ordered.select("line").write.mode("overwrite")
        (writer.option("compression", "gzip") if compress else writer).text(path)
    return int(seen.get["n"])


def write_lines(rows: DataFrame, path: str, *order: str) -> None:
    """A folder of text parts of ``line``, in order."""
    rows.repartitionByRange(*order).sortWithinPartitions(*order).select("line").write.mode("overwrite").text(path)


def write_bed(intervals: DataFrame, path: str, by_contig: bool = False, keep_others: bool = False) -> None:
    """A folder of text parts ordered by contig and start; ``by_contig`` puts each contig into a folder of its own, ``keep_others`` leaves those of others."""
    ordered = intervals.repartitionByRange("contig", "s").sortWithinPartitions("contig", "s")
    lines = ordered.select("contig", F.concat_ws("\t", "contig", F.col("s").cast("string"), F.col("e").cast("string")).alias("line"))
    if by_contig:
        lines.write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if keep_others else "static").partitionBy("contig").text(path)
    else:
        lines.select("line").write.mode("overwrite").text(path)


def write_status(status: DataFrame, path: str) -> None:
    status.select(F.concat_ws("\t", "base", "contig", "status").alias("line"), "contig").write.mode("overwrite").partitionBy("contig").text(path)


def scatter_svg(title: str, points: list[tuple[float, float]], width: int = 900, height: int = 240, ticks: int = 5) -> str:
    """A scatter plot; the y axis begins at 0."""
    if not points:
        return f"<p>{html.escape(title)}: no data.</p>"
    xs, ys = zip(*points, strict=True)
    low, high, top = min(xs), max(xs), max(*ys, 0) or 1
    span = (high - low) or 1
    left, base = 60, height - 30
    x = lambda v: left + (v - low) / span * (width - left - 20)
    y = lambda v: base - v / top * (base - 30)
    marks = "".join(f'<circle cx="{x(a):.1f}" cy="{y(b):.1f}" r="2"/>' for a, b in points)
    axis = "".join(
        f'<text x="{x(low + span * k / (ticks - 1)):.1f}" y="{height - 8}">{low + span * k / (ticks - 1):.0f}</text>'
        f'<text x="4" y="{y(top * k / (ticks - 1)):.1f}">{top * k / (ticks - 1):.0f}</text>'
        for k in range(ticks)
    )
    return f'<svg width="{width}" height="{height}" font-size="10"><text x="{left}" y="16">{html.escape(title)}</text>{marks}{axis}</svg>'


def report_html(title: str, facts: dict[str, str], warnings: list[str], plots: list[str], sections: dict[str, list[str]] | None = None) -> str:
    """A page of facts, warnings, further sections of lines, and plots; all text is escaped."""
    rows = "".join(f"<tr><th>{html.escape(k)}</th><td>{html.escape(v)}</td></tr>" for k, v in facts.items())
    lists = "".join(_section(name, lines) for name, lines in {"Warnings": warnings, **(sections or {})}.items())
    return f"<!doctype html><html><head><title>{html.escape(title)}</title></head><body><h1>{html.escape(title)}</h1><table>{rows}</table>{lists}{''.join(plots)}</body></html>"


def _section(name: str, lines: list[str]) -> str:
    notes = "".join(f"<li>{html.escape(x)}</li>" for x in lines) or "<li>none</li>"
    return f"<h2>{html.escape(name)}</h2><ul>{notes}</ul>"
