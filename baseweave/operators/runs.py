"""Positions that follow each other as runs, folded where they are read."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    open_run: tuple[str, int, int] | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        contig, pos = batch.column(0), np.array(batch.column(1))
        code = np.array(contig.dictionary_encode().indices)
        new = np.flatnonzero(np.append(True, (code[1:] != code[:-1]) | (np.diff(pos) != 1)))
        names = contig.take(pa.array(new)).to_pylist()
        s, e = (pos[new] - 1).tolist(), pos[np.append(new[1:], len(pos)) - 1].tolist()
        if open_run:
            if open_run[0] == names[0] and open_run[2] == s[0]:
                s[0] = open_run[1]
            else:
                names, s, e = [open_run[0], *names], [open_run[1], *s], [open_run[2], *e]
        open_run = (names.pop(), s.pop(), e.pop())
        yield _batch(names, s, e)
    if open_run:
        yield _batch(*([x] for x in open_run))


def _batch(names: list, s: list, e: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(s, pa.int64()), pa.array(e, pa.int64())], ["contig", "s", "e"])


def position_runs(records: DataFrame) -> DataFrame:
    """(contig, s, e): rows of (contig, pos) of which each is one after the row before it, as one interval.

    A run has one row at each of its positions; runs overlap where positions come
    repeatedly. Rows are folded in the order in which a task reads them, so
    records that were written in order leave few rows to shuffle.
    """
    return records.filter("pos is not null").select("contig", "pos").mapInArrow(_folded, "contig string, s bigint, e bigint")
