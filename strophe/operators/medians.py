"""Exact medians of groups of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def group_medians(rows: DataFrame, keys: list[str], value: str, width: float = 0.05) -> DataFrame:
    """keys and median of the values that are no null or NaN (the mean of the middle two).

    No group's values are held: they are counted with a map-side part, the counts of blocks of `width` show where the middle lies, and only
    the blocks that hold it are looked at closer. Null keys are groups of their own.
    """
    counts = rows.filter(F.col(value).isNotNull() & ~F.isnan(value)).groupBy(*keys, F.col(value).cast("double").alias("__x")).agg(F.count("*").alias("__n")).withColumn("__b", F.floor(F.col("__x") / width))
    order = Window.partitionBy(*keys).orderBy("__b")
    blocks = counts.groupBy(*keys, "__b").agg(F.sum("__n").alias("__s")).withColumn("__to", F.sum("__s").over(order)).withColumn("__all", F.sum("__s").over(Window.partitionBy(*keys)))
    low, high = F.floor((F.col("__all") - 1) / 2), F.floor(F.col("__all") / 2)
    picked = blocks.withColumn("__from", F.col("__to") - F.col("__s")).filter((F.col("__from") <= high) & (F.col("__to") > low))
    picked = picked.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col("__b").alias("__bb"), "__from", "__all")
    same = F.col("__b") == F.col("__bb")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    near = counts.join(picked, same)
    inside = Window.partitionBy(*keys, "__b").orderBy("__x").rowsBetween(Window.unboundedPreceding, 0)
    near = near.withColumn("__to", F.col("__from") + F.sum("__n").over(inside)).withColumn("__at", F.col("__to") - F.col("__n"))
    middle = near.filter((F.col("__at") <= high) & (F.col("__to") > low))
    return middle.groupBy(*keys).agg(((F.min("__x") + F.max("__x")) / 2).alias("median"))
