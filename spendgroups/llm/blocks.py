"""Groups of rows in tasks: reading sorted partitions, and splitting large groups."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def groups(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[pa.Table]:
    """The groups of a partition that is sorted by whole-number ``keys``, one by one."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        changed = np.zeros(batch.num_rows - 1, bool)
        for column in columns:
            changed |= column[1:] != column[:-1]
        cuts = [0, *(np.flatnonzero(changed) + 1), batch.num_rows]
        for a, z in zip(cuts, cuts[1:]):
            key = tuple(column[a] for column in columns)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, z - a))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def whole_groups(
    batches: Iterator[pa.RecordBatch], keys: Sequence[str], rows: int = 1 << 13
) -> Iterator[pa.Table]:
    """As ``groups``, but many groups at a time: tables of about ``rows`` rows, or of a single
    larger group, that cut no group."""
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        while batch.num_rows:
            if n < rows:
                part = batch.slice(0, rows - n)
                held.append(part)
                batch, n = batch.slice(part.num_rows), n + part.num_rows
                continue
            # Up to the end of the group that the last row held is in.
            last = [held[-1].column(k)[-1].as_py() for k in keys]
            same = np.ones(batch.num_rows, bool)
            for k, value in zip(keys, last):
                same &= batch.column(k).to_numpy(zero_copy_only=False) == value
            end = batch.num_rows if same.all() else int(np.argmin(same))
            if end:
                held.append(batch.slice(0, end))
                batch, n = batch.slice(end), n + end
            if batch.num_rows:
                yield pa.Table.from_batches(held)
                held, n = [], 0
    if held:
        yield pa.Table.from_batches(held)


def in_block_pairs(rows: DataFrame, group: str, size: str, key: str, block: int) -> DataFrame:
    """Rows with ``block_i, block_j, side``: every two rows of a group meet in one task.

    A group of ``size`` rows is dealt by a hash of ``key`` into blocks of about
    ``block`` rows; a task gets two blocks, or one with itself. So a task is bounded
    whatever the size of a group, and a row is sent as often as its group has blocks.
    """
    n = F.ceil(F.col(size) / block).cast("int")
    mine = F.pmod(F.xxhash64(group, key), n).cast("int")
    dealt = rows.withColumns({"_mine": mine, "_other": F.explode(F.sequence(F.lit(0), n - 1))})
    return dealt.select(
        *rows.columns,
        F.least("_mine", "_other").alias("block_i"),
        F.greatest("_mine", "_other").alias("block_j"),
        (F.col("_mine") > F.col("_other")).cast("int").alias("side"),
    )
