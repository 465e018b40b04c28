"""Manifests as they arrive: the batch transforms behind a file source. An extension."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strophe.operators.pairing import MANIFEST


def manifest_stream(spark: SparkSession, folder: str) -> DataFrame:
    """audio_path, lyric_path, language of the whole lines of new manifest files."""
    rows = spark.readStream.text(folder).select(F.from_json("value", MANIFEST).alias("p"))
    return rows.select("p.audio_path", "p.lyric_path", "p.language").filter("audio_path is not null and lyric_path is not null")


def files_stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The files of a Parquet table as a stream, be it one file of that name in the folder or a folder of files."""
    table = spark.read.parquet(f"{folder}/{name}")
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
    stream = spark.readStream.schema(table.schema)
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path).isDirectory():
        return stream.parquet(f"{folder}/{name}")
    return stream.option("pathGlobFilter", name).parquet(folder)


def run_available(stream: DataFrame, checkpoint: str, sink: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Work off what has arrived. With a checkpoint a restart repeats no finished batch."""
    return stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(sink).start()
