"""Neighbours and runs within a key in order, without a window over a whole key.

A key may hold a third of all rows. Windows run over buckets of a key; what a bucket's first and last row need
from beyond it comes from a window over one row a bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def time_bucket(start: str = "start", seconds: int = 3600, number: str = "seg_no") -> Column:
    """Bucket of a time in seconds; rows without one come first, as they do in ascending order, in buckets of their numbers (those without a number before them)."""
    return F.coalesce(F.floor(F.col(start) / seconds), F.floor(F.col(number) / 4096) - F.lit(2**40), F.lit(-(2**41))).cast("long")


def _same(key: str) -> Column:
    return F.expr(f"`{key}` <=> __k and __b = __bb")


def with_neighbours(df: DataFrame, key: str, order: list[str], columns: list[str], bucket: Column) -> DataFrame:
    """df with structs `before` and `after`: the columns of the row before and after in the key's order; null at its ends. Ties in order are settled by the columns."""
    row = F.struct(*columns)
    inside = Window.partitionBy(key, "__b").orderBy(*order, *[c for c in columns if c not in order])
    rows = df.withColumn("__b", bucket).withColumn("__p", F.lag(row).over(inside)).withColumn("__n", F.lead(row).over(inside))
    place = F.struct(*order, *[c for c in columns if c not in order])
    edges = rows.groupBy(F.col(key).alias("__k"), F.col("__b").alias("__bb")).agg(F.min_by(row, place).alias("first"), F.max_by(row, place).alias("last"))
    chain = Window.partitionBy("__k").orderBy("__bb")
    edges = edges.select("__k", "__bb", F.lag("last").over(chain).alias("__pp"), F.lead("first").over(chain).alias("__nn"))
    joined = rows.join(edges, _same(key))
    return joined.withColumn("before", F.coalesce("__p", "__pp")).withColumn("after", F.coalesce("__n", "__nn")).drop("__b", "__p", "__n", "__pp", "__nn", "__k", "__bb")


def with_run_numbers(df: DataFrame, key: str, order: list[str], new: Column, bucket: Column) -> DataFrame:
    """df with run_no: how many rows of the key up to each row begin a run (`new`)."""
    inside = Window.partitionBy(key, "__b").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = df.withColumn("__b", bucket).withColumn("__new", new.cast("long"))
    rows = rows.withColumn("__i", F.sum("__new").over(inside))
    sums = rows.groupBy(F.col(key).alias("__k"), F.col("__b").alias("__bb")).agg(F.sum("__new").alias("__s"))
    ahead = F.sum("__s").over(Window.partitionBy("__k").orderBy("__bb").rowsBetween(Window.unboundedPreceding, -1))
    sums = sums.select("__k", "__bb", F.coalesce(ahead, F.lit(0)).alias("__ahead"))
    return rows.join(sums, _same(key)).withColumn("run_no", F.col("__i") + F.col("__ahead")).drop("__b", "__new", "__i", "__ahead", "__k", "__bb")
