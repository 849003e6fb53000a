"""Records as they land: flags of single records, and groups of positions and gaps with state for each contig.

A contig's records have to land in order: by the times of files (their names within
a trigger), and by lines within a file. The state of a contig is the records of its last position, whose
group may go on in the next file, and how far its records reach. Groups are
given out when their position is passed; what is open at last is in the state,
and ``unfinished`` reads it there.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from baseweave.functions import vcf
from baseweave.operators.classify import CLEAN, FILTERED, INVARIANT, flag_records
from baseweave.sources.tables import parse_vcf

RECORD = "file string, part bigint, row bigint, pos bigint, line string"
HELD = f"{RECORD}, inv boolean, bad boolean"
#: Rows of kind ``record`` have a class, those of kind ``gap`` an interval.
LANDED = f"kind string, contig string, {RECORD}, class string, s bigint, e bigint"
COLUMNS = [c.split()[0] for c in LANDED.split(", ")]
#: Where the state store keeps its data; state of this kind needs it.
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def landing_records(spark: SparkSession, folder: str, files_at_once: int | None = None) -> DataFrame:
    """Flagged records of the files that appear in ``folder``, with the order of lines within their file."""
    reader = spark.readStream.schema("value string")
    raw = (reader.option("maxFilesPerTrigger", files_at_once) if files_at_once else reader).text(folder)
    lines = raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("part"), F.col("value").alias("line"))
    numbered = lines.mapInArrow(_numbered, "file string, part bigint, row bigint, line string")
    return flag_records(parse_vcf(numbered.select("file", F.struct("part", "row").alias("ordinal"), "line")))


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines with their number in what the task has read; those of one part of a file come in order."""
    row = 0
    for batch in batches:
        numbers = pa.array(range(row, row + batch.num_rows), pa.int64())
        row += batch.num_rows
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), numbers, batch.column(2)], ["file", "part", "row", "line"])


def _class_of(rows: list[dict]) -> str:
    return INVARIANT if any(r["inv"] for r in rows) else FILTERED if any(r["bad"] for r in rows) else CLEAN


class Positions(StatefulProcessor):
    """Groups of positions and gaps of one contig."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.open = handle.getListState("open", HELD)
        self.reach = handle.getValueState("reach", "reach bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        contig = key[0]
        names = [c.split()[0] for c in HELD.split(", ")]
        group = [dict(zip(names, r, strict=True)) for r in self.open.get()]
        reach = self.reach.get()[0] if self.reach.exists() else 0
        new = pd.concat(list(rows), ignore_index=True).sort_values(["file", "part", "row"], ignore_index=True)
        out: list[tuple] = []

        def give(some: list[dict], name: str) -> None:
            out.extend(("record", contig, *(r[c] for c in names[:5]), name, None, None) for r in some)

        for r in new.to_dict("records"):
            pos, reaches = (None if pd.isna(r[c]) else int(r[c]) for c in ("pos", "reaches"))
            r["pos"] = pos
            if pos is not None and r["n_cols"] >= 2:
                if pos - 1 > reach:
                    out.append(("gap", contig, None, None, None, None, None, None, reach, pos - 1))
                reach = max(reach, reaches)
            if r["n_cols"] < 8:
                give([r], FILTERED)
            elif r["block"]:
                give(group, _class_of(group))
                group = []
                give([r], INVARIANT)
            else:
                if group and group[-1]["pos"] != pos:
                    give(group, _class_of(group))
                    group = []
                group.append(r)
        self.open.put([tuple(r[c] for c in names) for r in group]) if group else self.open.clear()
        self.reach.update((reach,))
        yield pd.DataFrame(out, columns=COLUMNS)

    def close(self) -> None:
        pass


def landed_positions(flagged: DataFrame) -> DataFrame:
    """Rows of LANDED of ``landing_records``: classes of records whose group is complete, and gaps.

    A contig's records of one trigger are one task's; limit the files of a
    trigger where contigs are large. The session's state store has to be PROVIDER.
    """
    reaches = vcf.covered_end(F.col("pos"), F.coalesce("ref", F.lit("N")), F.coalesce("info", F.lit(".")))
    rows = flagged.select(
        F.coalesce("contig", F.lit("")).alias("contig"),
        "file",
        "ordinal.part",
        "ordinal.row",
        "pos",
        "line",
        "n_cols",
        reaches.alias("reaches"),
        F.col("end").isNotNull().alias("block"),
        F.coalesce("is_inv", F.lit(False)).alias("inv"),
        (F.coalesce("is_filtered", F.lit(False)) | F.coalesce("has_missing_gt", F.lit(False))).alias("bad"),
    )
    return rows.groupBy("contig").transformWithStateInPandas(Positions(), LANDED, "Append", "None")


def unfinished(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Rows of LANDED for the groups that a stopped query had still open, and (kind ``reach``) how far each contig's records reach, in ``e``."""
    read = lambda name: spark.read.format("statestore").option("stateVarName", name).load(checkpoint)
    held = read("open").select(F.col("key.contig").alias("contig"), F.col("list_element.*"))
    of = held.groupBy("contig").agg(F.bool_or("inv").alias("i"), F.bool_or("bad").alias("b"))
    name = F.when(F.col("i"), INVARIANT).when(F.col("b"), FILTERED).otherwise(CLEAN)
    records = held.join(of, "contig").withColumns({"kind": F.lit("record"), "class": name})
    reach = read("reach").select(F.col("key.contig").alias("contig"), F.col("value.reach").alias("e")).withColumn("kind", F.lit("reach"))
    both = records.unionByName(reach, allowMissingColumns=True).withColumn("s", F.lit(None).cast("bigint"))
    return both.select(*COLUMNS)


def write_partitioned(records: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Append flagged records to Parquet by contig, once for each file, then stop."""
    flat = records.select("file", "ordinal", "contig", "pos", "ref", "alt", "info", "end", "is_inv", "is_filtered", "has_missing_gt")
    writer = flat.writeStream.format("parquet").option("checkpointLocation", checkpoint).partitionBy("contig")
    return writer.trigger(availableNow=True).start(folder)


def write_positions(positions: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Append rows of LANDED to Parquet, for all files that are there, then stop; a later call goes on from there."""
    return positions.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(folder)
