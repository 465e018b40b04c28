"""Continuous periods and gaps: an ordered map of disjoint intervals for each key."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import chain
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strophe.operators.keyed import group_starts
from strophe.session import cut_lineage

_SAME = "key <=> key_ and bucket = bucket_"


class IntervalMap:
    """Disjoint half-open intervals in order. Touching intervals are one."""

    __slots__ = ("ends", "starts")

    def __init__(self, starts: list[int] | None = None, ends: list[int] | None = None) -> None:
        self.starts, self.ends = list(starts or ()), list(ends or ())

    def add(self, start: int, end: int) -> None:
        """Insert [start, end). The intervals that overlap or touch it lie between two binary searches; they become one."""
        if end <= start:
            return
        starts, ends = self.starts, self.ends
        if not ends or start > ends[-1]:
            starts.append(start)
            ends.append(end)
            return
        low = bisect_left(ends, start)
        high = bisect_right(starts, end, low)
        if low < high:
            start, end = min(start, starts[low]), max(end, ends[high - 1])
        starts[low:high] = [start]
        ends[low:high] = [end]

    def gaps(self) -> list[tuple[int, int]]:
        return list(zip(self.ends[:-1], self.starts[1:], strict=True))


def _maps(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Any, int, IntervalMap]]:
    """The interval map of each (key, bucket), from batches (key, bucket, s, e) in which a key's bucket comes in one run. Only the open map is held, in whatever order its intervals come."""
    held: tuple[Any, int] | None = None
    kept = IntervalMap()
    for batch in batches:
        if not batch.num_rows:
            continue
        starts = group_starts(pa.Table.from_batches([batch]), ["key", "bucket"]).tolist()
        keys, buckets, s, e = (c.to_pylist() for c in batch.columns)
        for i, j in zip(starts, [*starts[1:], batch.num_rows], strict=True):
            if held != (keys[i], buckets[i]):
                if held is not None:
                    yield *held, kept
                held, kept = (keys[i], buckets[i]), IntervalMap()
            for k in range(i, j):
                kept.add(s[k], e[k])
    if held is not None:
        yield *held, kept


def bucketed(df: DataFrame, key: str, start: str, end: str, bucket: int) -> DataFrame:
    """key, bucket, s, e: intervals by integer start and end with the bucket of time they start in; rows that are none are left out."""
    rows = df.select(F.col(key).alias("key"), F.col(start).cast("long").alias("s"), F.col(end).cast("long").alias("e")).filter("e > s")
    return rows.select("key", F.expr(f"s div {bucket}L - if(s < 0, 1, 0)").alias("bucket"), "s", "e")


def _mapped(df: DataFrame, key: str, start: str, end: str, bucket: int, gaps: bool) -> DataFrame:
    """key, bucket, kind, a, b: of each key's bucket of time its disjoint periods (kind period), or else the gaps between them (gap) and one row (span) from its first start to its last end.

    Rows with a null start or an end that is null or not after the start cover nothing. A null key is a key of its own. What goes on is
    written once, since it is read several times; it is no longer than the periods are.
    """
    rows = bucketed(df, key, start, end, bucket).repartition("key", "bucket").sortWithinPartitions("key", "bucket")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is None:
            return
        types = [first.schema[0].type, pa.int64(), pa.string(), pa.int64(), pa.int64()]
        out: list[list] = [[], [], [], [], []]
        for name, number, kept in _maps(chain([first], batches)):
            found = [("gap", a, b) for a, b in kept.gaps()] + [("span", kept.starts[0], kept.ends[-1])] if gaps else [("period", a, b) for a, b in zip(kept.starts, kept.ends, strict=True)]
            for kind, a, b in found:
                for column, value in zip(out, (name, number, kind, a, b), strict=True):
                    column.append(value)
            if len(out[0]) >= 8192:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], ["key", "bucket", "kind", "a", "b"])
                out = [[], [], [], [], []]
        if out[0]:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], ["key", "bucket", "kind", "a", "b"])

    return cut_lineage(rows.mapInArrow(run, f"key {dict(df.dtypes)[key]}, bucket long, kind string, a long, b long"))


def _carried(spans: DataFrame) -> DataFrame:
    """key_, bucket_, carried: the furthest end before each bucket. The window over a key sees one row a bucket, however many intervals there are."""
    before = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    return spans.select(F.col("key").alias("key_"), F.col("bucket").alias("bucket_"), F.max("b").over(before).alias("carried"))


def settled_gaps(mapped: DataFrame, key: str, longest: int | None = None) -> DataFrame:
    """key, gap_from, gap_to from the gaps and spans of all buckets (key, bucket, kind, a, b): a gap of a bucket is cut by what reaches into it from the buckets before."""
    spans = mapped.filter("kind = 'span'")
    first = F.struct(F.col("carried").alias("f"), F.col("a").alias("t"))
    # A span's row stands for the gap before its bucket.
    both = mapped.join(_carried(spans), F.expr(_SAME)).withColumn("gap", F.when(F.col("kind") == "span", first).otherwise(F.struct(F.greatest("a", "carried").alias("f"), F.col("b").alias("t"))))
    gaps = both.select("key", "gap.f", "gap.t").filter("t > f")
    if longest is not None:
        gaps = gaps.filter(F.col("t") - F.col("f") <= longest)
    return gaps.select(F.col("key").alias(key), F.col("f").alias("gap_from"), F.col("t").alias("gap_to"))


def interval_gaps(df: DataFrame, key: str, start: str, end: str, longest: int | None = None, bucket: int = 3_600_000) -> DataFrame:
    """key, gap_from, gap_to: each stretch between the key's first start and last end that no interval covers.

    start and end are integers. Rows with a null start or an end that is null or not after the start are no intervals: they cover
    nothing and are no first start or last end. Gaps longer than `longest` are left out.
    Repeated rows and ties change nothing; an empty table has no gaps. A key with a third of all rows is spread over its buckets of
    time, each an interval map of its own.
    """
    return settled_gaps(_mapped(df, key, start, end, bucket, True), key, longest)


def continuous_periods(df: DataFrame, key: str, start: str, end: str, bucket: int = 3_600_000) -> DataFrame:
    """key, period_from, period_to: the continuous covered periods of each key; cases as in interval_gaps."""
    periods = _mapped(df, key, start, end, bucket, False)
    spans = periods.groupBy("key", "bucket").agg(F.max("b").alias("b"))
    reach = periods.join(_carried(spans), F.expr(_SAME)).select("key", "bucket", "a", "b", "carried")
    # Periods of a bucket are apart already: one goes on with what came before it only if that reaches in from an earlier bucket.
    fresh = F.coalesce(F.col("a") > F.col("carried"), F.lit(True)).cast("int")
    inside = Window.partitionBy("key", "bucket").orderBy("a")
    numbered = reach.withColumn("part", F.sum(fresh).over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    parts = numbered.groupBy("key", "bucket", "part").agg(F.min("a").alias("s"), F.max("b").alias("e"))
    # A part 0 goes on with what came before its bucket: only parts at the ends of a bucket meet the window over the key.
    counted = parts.groupBy(F.col("key").alias("key_"), F.col("bucket").alias("bucket_")).agg(F.max("part").alias("most"))
    parts = parts.join(counted, F.expr(_SAME)).drop("key_", "bucket_")
    edges = parts.filter("part = 0 or part = most")
    chained = Window.partitionBy("key").orderBy("bucket", "part").rowsBetween(Window.unboundedPreceding, 0)
    edges = edges.withColumn("chain", F.sum(F.when(F.col("part") > 0, 1).otherwise(0)).over(chained))
    joined = edges.groupBy("key", "chain").agg(F.min("s").alias("s"), F.max("e").alias("e")).drop("chain")
    whole = joined.unionByName(parts.filter("part > 0 and part < most").select("key", "s", "e"))
    return whole.select(F.col("key").alias(key), F.col("s").alias("period_from"), F.col("e").alias("period_to"))
