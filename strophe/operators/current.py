"""Current versions of redelivered rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def current_rows(df: DataFrame, key: str, at: str, **columns: Column | str) -> DataFrame:
    """The row with the latest `at` for each `key`, as `key` and the named columns.

    It is an aggregate with a map-side part, so a key that is delivered very often is reduced
    before the shuffle. Only the named columns are read and shuffled.
    Null `at` is older than any time. Of several rows with the same time the one with the largest
    columns (in the order given, null smallest) is taken, so a plain repetition changes nothing.
    Rows with a null key have no other version: all of them stay, exact repetitions once.
    """
    named = [(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in columns.items()]
    lone = F.when(F.col(key).isNull(), F.to_json(F.struct(*named), {"ignoreNullFields": "false"}))
    picked = df.select(F.col(key).alias("__key"), lone.alias("__lone"), F.struct(F.col(at).alias("__at"), *named).alias("__row"))
    newest = picked.groupBy("__key", "__lone").agg(F.max("__row").alias("__row"))
    return newest.select(F.col("__key").alias(key), *[F.col(f"__row.{n}").alias(n) for n in columns])
