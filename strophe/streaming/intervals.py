"""The interval map as a stream: keyed state holds the disjoint intervals of each key's bucket of time."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from strophe.operators.intervals import IntervalMap, bucketed, settled_gaps


def interval_stream(stream: DataFrame, key: str, start: str, end: str, bucket: int = 3_600_000) -> DataFrame:
    """key, bucket, version, kind, a, b: of each key's bucket that new intervals changed, its gaps and its span as they are now (update mode).

    An interval belongs to the bucket it starts in, so a state holds no more than a bucket's disjoint intervals, and buckets without
    news say nothing. Rows that are no intervals, as in interval_gaps, are left out.
    """
    kind = dict(stream.dtypes)[key]

    def run(keys: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        starts, ends, version = state.get if state.exists else ([], [], 0)
        kept = IntervalMap(list(starts), list(ends))
        for frame in frames:
            for a, b in zip(frame["s"].tolist(), frame["e"].tolist(), strict=True):
                kept.add(a, b)
        if kept.starts == list(starts) and kept.ends == list(ends):
            return
        state.update((kept.starts, kept.ends, version + 1))
        rows = [("gap", a, b) for a, b in kept.gaps()] + [("span", kept.starts[0], kept.ends[-1])]
        yield pd.DataFrame([(*keys, version + 1, *r) for r in rows], columns=["key", "bucket", "version", "kind", "a", "b"])

    schema = f"key {kind}, bucket long, version long, kind string, a long, b long"
    return bucketed(stream, key, start, end, bucket).groupBy("key", "bucket").applyInPandasWithState(run, schema, "starts array<long>, ends array<long>, version long", "update", GroupStateTimeout.NoTimeout)


def streamed_gaps(stream: DataFrame, key: str, start: str, end: str, folder: str, longest: int | None = None, bucket: int = 3_600_000) -> DataFrame:
    """The gaps of all intervals that have arrived, as interval_gaps gives them. What has arrived is worked off; with the same folder a later call goes on from there.

    Each batch of changes is written to a folder of its own below `folder`, which all executors must reach, so one that is repeated after a failure
    replaces itself. Of a bucket the latest version counts.
    """
    spark = stream.sparkSession

    def keep(changes: DataFrame, number: int) -> None:
        changes.write.mode("overwrite").parquet(f"{folder}/changes/batch={number}")

    changes = interval_stream(stream, key, start, end, bucket)
    changes.writeStream.outputMode("update").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).foreachBatch(keep).start().awaitTermination()
    name = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/changes")
    if not name.getFileSystem(spark._jsc.hadoopConfiguration()).exists(name):
        return spark.createDataFrame([], f"`{key}` {dict(stream.dtypes)[key]}, gap_from long, gap_to long")
    seen = spark.read.option("basePath", f"{folder}/changes").parquet(f"{folder}/changes").select("key", "bucket", "version", "kind", "a", "b")
    last = seen.groupBy(F.col("key").alias("k_"), F.col("bucket").alias("b_")).agg(F.max("version").alias("v_"))
    mapped = seen.join(last, F.expr("key <=> k_ and bucket = b_ and version = v_")).select("key", "bucket", "kind", "a", "b")
    return settled_gaps(mapped, key, longest)
