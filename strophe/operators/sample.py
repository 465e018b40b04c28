"""Samples to fit models on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bounded_sample(df: DataFrame, by: list[str], rows: int) -> DataFrame:
    """About `rows` rows of df, all of them if it has no more: those whose hash of the columns `by` is below a threshold.

    The threshold follows from the number of rows, so the sample is the same for the same table and each task keeps only its
    share. Rows with equal `by` come together or not at all.
    """
    total = df.count()
    if total <= rows:
        return df
    return df.filter(F.pmod(F.xxhash64(*by), F.lit(1 << 30)) < int((1 << 30) * rows / total))
