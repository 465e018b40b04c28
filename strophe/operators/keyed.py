"""Sorted groups in Python: one shuffle, then whole groups in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame


def group_starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    """Positions at which a run of equal keys starts; null equals null."""
    n = table.num_rows
    new = np.zeros(n, dtype=bool)
    if n:
        new[0] = True
    for key in keys:
        column = table[key].combine_chunks() if isinstance(table[key], pa.ChunkedArray) else table[key]
        if n > 1:
            a, b = column.slice(0, n - 1), column.slice(1)
            differs = pc.fill_null(pc.not_equal(a, b), False).to_numpy(zero_copy_only=False)
            valid = pc.is_valid(column).to_numpy(zero_copy_only=False)
            new[1:] |= differs | (valid[1:] != valid[:-1])
    return np.flatnonzero(new)


def whole_groups(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of complete groups with the positions at which the groups start.

    What is held back is at most one group and one batch, so groups must be bounded by the caller
    (a block number in the key).
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([*held, batch]).combine_chunks()
        starts = group_starts(table, keys)
        last = int(starts[-1])
        if last:
            yield table.slice(0, last), starts[:-1]
        held = table.slice(last).combine_chunks().to_batches()
    if held:
        table = pa.Table.from_batches(held).combine_chunks()
        yield table, group_starts(table, keys)


def map_groups(df: DataFrame, keys: list[str], order: list[str], function: Callable[[pa.Table, np.ndarray], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """Bring the rows of each key together, sorted, and map tables of whole groups.

    Unlike a grouped pandas function this has no cost a group: a table holds many groups.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_groups(batches, keys):
            yield from function(table, starts)

    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(run, schema)
