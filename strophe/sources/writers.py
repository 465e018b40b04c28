"""Writers: partitioned tables, manifests and lists instead of one file a song."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strophe.functions.text import kept_path


def song_documents(segments: DataFrame, songs: DataFrame) -> DataFrame:
    """One row a song with its segments in order. For sinks only: a song's segments must fit a row."""
    columns = [c for c in segments.columns if c not in ("song_id", "seg_no")]
    rows = segments.groupBy("song_id").agg(F.array_sort(F.collect_list(F.struct("seg_no", *columns))).alias("segments"))
    return songs.join(rows, "song_id", "left")


def write_routed(df: DataFrame, path: str, by: list[str], form: str = "parquet", mode: str = "error") -> None:
    """Rows in a folder for each value of `by`."""
    df.write.mode(mode).partitionBy(*by).format(form).save(path)


def write_by_folder(df: DataFrame, file_path: str, path: str, mode: str = "error") -> None:
    """JSON rows in a folder for each parent folder of the songs' files, with each row's path below it (the last two parts), so that where a song came from is kept without a file a song."""
    kept = kept_path(F.col(file_path))
    df.withColumn("kept_path", kept).withColumn("folder", F.when(kept.contains("/"), F.split(kept, "/")[0]).otherwise("others")).write.mode(mode).partitionBy("folder").json(path)


def write_sharded(df: DataFrame, path: str, index: str, size: int, offset: int = 0, mode: str = "error") -> None:
    """JSON rows in folders of `size` lines of the whole list each."""
    df.withColumn("shard", F.floor((F.col(index) + offset) / size)).write.mode(mode).partitionBy("shard").json(path)


def write_manifest(df: DataFrame, path: str, mode: str = "error") -> None:
    """audio_path and lyric_path as lines of JSON."""
    df.select("audio_path", "lyric_path").write.mode(mode).json(path)


def write_lines(df: DataFrame, column: str, path: str, mode: str = "error") -> None:
    df.select(F.col(column).alias("value")).write.mode(mode).text(path)
