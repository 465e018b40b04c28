"""Greedy chunks of ordered rows, found in blocks.

A chunk goes on while a row's reach lies within a limit of the chunk's origin. Where a chunk begins depends on all
rows before, but a block of rows needs only the origin of the chunk that is open at its start: for each origin it
may be, the row of the block that closes that chunk is one of a few, and from there on all is settled. So each block
gives these rows with what each leads to, one pass over a row a block strings them together, and each block then
numbers its rows. No task holds a key.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strophe.operators.folds import fold_rows
from strophe.operators.keyed import map_groups

_OPEN = -1.7e308


def _next(origin: float, at: int, end: int, reach: np.ndarray, hard: np.ndarray, limit: float) -> int:
    """The first row from `at` on that opens a new chunk after one with this origin; end if there is none. Looks ahead in growing steps."""
    step = 16
    while at < end:
        until = min(end, at + step)
        found = np.flatnonzero(hard[at:until] | (reach[at:until] - origin > limit))
        if len(found):
            return at + int(found[0])
        at, step = until, step * 4
    return end


def _summary(origin: np.ndarray, reach: np.ndarray, hard: np.ndarray, limit: float) -> tuple[list[float], list[float], list[int]]:
    """For each row that may be the first to open a chunk in a block: the reach it is seen by (infinite for a hard one), and the origin that is open at the block's end and the number of chunks from it on."""
    n = len(origin)
    following: dict[int, int] = {}

    def ends(i: int) -> tuple[float, int]:
        count = 1
        while True:
            if i not in following:
                following[i] = _next(origin[i], i + 1, n, reach, hard, limit)
            if following[i] == n:
                return float(origin[i]), count
            i, count = following[i], count + 1

    seen, opens, counts = [], [], []
    top = -np.inf
    for i in range(n):
        if hard[i] or reach[i] > top:
            top = max(top, reach[i])
            last = ends(i)
            seen.append(float("inf") if hard[i] else float(reach[i]))
            opens.append(last[0])
            counts.append(last[1])
            # No open chunk has a later origin than the block's first row, so none gets beyond the row that would close that one's.
            if hard[i] or reach[i] - origin[0] > limit:
                break
    return seen, opens, counts


def greedy_chunks(df: DataFrame, key: str, order: list[str], bucket: Column, origin: Column, reach: Column, limit: float, hard: Column | None = None) -> DataFrame:
    """df with chunk_no, counted from 0 for each key: a row opens a chunk if `hard` says so or its reach lies more than `limit` beyond the origin of the open chunk's first row.

    origin must not fall along the order (ties are settled by the order's columns); bucket must not fall either and spreads a key over tasks.
    A null reach opens nothing, a null origin counts as 0. A null key is a key of its own.
    """
    names = [c for c in df.columns if c != key]
    rows = df.withColumn("__b", bucket.cast("long")).withColumn("__o", F.coalesce(origin.cast("double"), F.lit(0.0))).withColumn("__r", F.coalesce(reach.cast("double"), F.lit(_OPEN))).withColumn("__h", F.coalesce(hard, F.lit(False)) if hard is not None else F.lit(False))
    kind = dict(df.dtypes)[key]

    def summary(table: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        o, r, h = table["__o"].to_numpy(), table["__r"].to_numpy(), table["__h"].to_numpy(zero_copy_only=False)
        found = [_summary(o[i:j], r[i:j], h[i:j], limit) for i, j in zip(starts.tolist(), [*starts[1:].tolist(), len(o)], strict=True)]
        picked = table.select(["key", "__b"]).take(pa.array(starts))
        lists = [pa.array([f[k] for f in found], t) for k, t in enumerate((pa.list_(pa.float64()), pa.list_(pa.float64()), pa.list_(pa.int64())))]
        yield from pa.Table.from_arrays([picked["key"], picked["__b"], *lists], ["key", "block", "seen", "opens", "counts"]).combine_chunks().to_batches()

    def string(blocks: Iterator[tuple]) -> Iterator[tuple]:
        now: float | None = None
        number = -1
        for block, seen, opens, counts in blocks:
            yield block, now, number
            for s, opened, count in zip(seen, opens, counts, strict=True):
                if now is None or s - now > limit:
                    now, number = opened, number + count
                    break

    slim = rows.select(F.col(key).alias("key"), "__b", *[F.col(c).alias(f"__k{i}") for i, c in enumerate(order)], "__o", "__r", "__h")
    sums = map_groups(slim, ["key", "__b"], [f"__k{i}" for i in range(len(order))], summary, f"key {kind}, block long, seen array<double>, opens array<double>, counts array<long>")
    entries = fold_rows(sums, "key", ["block"], ["block", "seen", "opens", "counts"], string, [("block", "long"), ("entry", "double"), ("number", "long")])
    entries = entries.select(F.col("key").alias("__key"), F.col("block").alias("__block"), F.col("entry").alias("__entry"), F.col("number").alias("__number"))
    joined = rows.join(entries, F.col(key).eqNullSafe(F.col("__key")) & (F.col("__b") == F.col("__block"))).drop("__key", "__block")
    joined = joined.select(F.col(key).alias("__key"), *names, "__b", "__o", "__r", "__h", "__entry", "__number")

    def number(table: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        n = table.num_rows
        o, r, h = table["__o"].to_numpy(), table["__r"].to_numpy(), table["__h"].to_numpy(zero_copy_only=False)
        entry, first = table["__entry"], table["__number"].to_numpy()
        new = np.zeros(n, dtype=np.int64)
        base = np.zeros(n, dtype=np.int64)
        for i, j in zip(starts.tolist(), [*starts[1:].tolist(), n], strict=True):
            base[i:j] = first[i]
            now = entry[i].as_py()
            at = i if now is None else _next(now, i, j, r, h, limit)
            while at < j:
                new[at] = 1
                at = _next(o[at], at + 1, j, r, h, limit)
            base[i:j] += np.cumsum(new[i:j])
        out = table.select(["__key", *names]).append_column("chunk_no", pa.array(base))
        yield from out.rename_columns([key, *names, "chunk_no"]).combine_chunks().to_batches()

    kinds = dict(df.dtypes)
    schema = f"`{key}` {kind}, " + ", ".join(f"`{c}` {kinds[c]}" for c in names) + ", chunk_no long"
    return map_groups(joined, ["__key", "__b"], order, number, schema)


def running_sum(df: DataFrame, key: str, order: list[str], size: Column, bucket: Column) -> DataFrame:
    """df with sum_before and sum_after: the sizes of the key's rows before each row, and with it. Windows see a bucket; the buckets' sums are added over one row a bucket."""
    inside = Window.partitionBy(key, "__b").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = df.withColumn("__b", bucket).withColumn("__s", F.coalesce(size.cast("double"), F.lit(0.0)))
    rows = rows.withColumn("__i", F.sum("__s").over(inside))
    sums = rows.groupBy(F.col(key).alias("__k"), F.col("__b").alias("__bb")).agg(F.sum("__s").alias("__t"))
    ahead = F.sum("__t").over(Window.partitionBy("__k").orderBy("__bb").rowsBetween(Window.unboundedPreceding, -1))
    sums = sums.select("__k", "__bb", F.coalesce(ahead, F.lit(0.0)).alias("__ahead"))
    joined = rows.join(sums, F.expr(f"`{key}` <=> __k and __b = __bb")).withColumn("sum_after", F.col("__i") + F.col("__ahead"))
    return joined.withColumn("sum_before", F.col("sum_after") - F.col("__s")).drop("__b", "__s", "__i", "__ahead", "__k", "__bb")


def last_joined(chunked: DataFrame, key: str, brief: Column) -> DataFrame:
    """chunked, with each key's last chunk joined to the one before if the aggregate `brief` holds for it."""
    each = chunked.groupBy(F.col(key).alias("__key"), F.col("chunk_no").alias("__no")).agg(F.coalesce(brief, F.lit(False)).alias("__brief"))
    last = each.groupBy("__key").agg(F.max("__no").alias("__last"), F.max_by("__brief", "__no").alias("__brief"))
    rows = chunked.join(last, F.col(key).eqNullSafe(F.col("__key")), "left")
    joins = F.col("__brief") & (F.col("chunk_no") == F.col("__last")) & (F.col("__last") > 0)
    return rows.withColumn("chunk_no", F.col("chunk_no") - F.coalesce(joins, F.lit(False)).cast("long")).drop("__key", "__last", "__brief")
