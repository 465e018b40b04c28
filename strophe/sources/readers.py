"""Readers of lists, manifests, lyric files, song documents and feeds."""

from __future__ import annotations

import io
import tarfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strophe.functions.text import file_name, file_stem, trim_all
from strophe.operators.neighbours import with_neighbours
from strophe.operators.pairing import numbered_lines

SEGMENT = (
    "text string, start double, end double, speaker string, is_lyric boolean, lang_type string, lyric_count int, average_duration double, is_duration_ill boolean, "
    "reset_end_time boolean, vad_anomaly boolean, start_time double, end_time double, speaker_id string, umap_segment_labels string"
)
SONG = f"audio_path string, audio_length double, error_loading boolean, structures array<struct<label string, start double, end double>>, segments array<struct<{SEGMENT.replace(' string', ': string').replace(' double', ': double').replace(' boolean', ': boolean').replace(' int', ': int')}>>"


SONG_ROW = f"{SONG}, file_path string"


def path_list(spark: SparkSession, path: str, comments: bool = False, column: int | None = None) -> DataFrame:
    """Lines of a list of paths, stripped, without blank ones; column takes one field between tabs, comments drops lines that begin with #."""
    line = trim_all(F.col("value"))
    rows = spark.read.text(path).select(line.alias("line")).filter("line <> ''")
    if comments:
        rows = rows.filter(~F.col("line").startswith("#"))
    if column is not None:
        rows = rows.select(F.get(F.split("line", "\t"), F.lit(column)).alias("line"))
    return rows.withColumnRenamed("line", "path")


def id_path_list(spark: SparkSession, path: str) -> DataFrame:
    """id, path of lines "id path"; the path is all that follows the first white space, so it may hold spaces."""
    rows = path_list(spark, path, comments=True)
    two = F.split("path", r"\s+", 2)
    return rows.select(F.when(F.size(two) > 1, two[0]).alias("id"), F.when(F.size(two) > 1, two[1]).otherwise(two[0]).alias("path"))


def lrc_rows(lines: DataFrame, restart: float = 10.0) -> DataFrame:
    """song_id, line_no, tag_no, start, text, strange: timestamped lines (song_id, line_no, raw), one row for each time mark.

    Byte order marks are dropped and no-break spaces are spaces; lines without text or time have no row. From the first line on
    whose earliest time lies more than `restart` seconds before that of the row before, rows are strange (a translation that
    starts again).
    """
    raw = F.regexp_replace(F.translate("raw", " ﻿", " "), r"^\s+|\s+$", "")
    pattern = r"\[(\d+):(\d+(?:\.\d+)?)\]"
    text = trim_all(F.regexp_replace(raw, pattern, ""))
    tags = F.regexp_extract_all(raw, F.lit(pattern), F.lit(0))
    seconds = F.transform(tags, lambda t: F.regexp_extract(t, pattern, 1).cast("int") * 60 + F.regexp_extract(t, pattern, 2).cast("double"))
    rows = lines.select("song_id", "line_no", text.alias("text"), seconds.alias("times")).filter("text <> '' and size(times) > 0")
    rows = with_neighbours(rows.withColumn("first", F.array_min("times")), "song_id", ["line_no"], ["line_no", "first"], F.floor(F.col("line_no") / 4096))
    jump = F.col("first") < F.col("before.first") - restart
    cut = rows.withColumn("jump", F.coalesce(jump, F.lit(False))).groupBy("song_id").agg(F.min(F.when(F.col("jump"), F.col("line_no"))).alias("cut"))
    rows = rows.join(cut, "song_id").select("song_id", "line_no", "text", "cut", F.posexplode("times").alias("tag_no", "start"))
    return rows.select("song_id", "line_no", "tag_no", "start", "text", F.coalesce(F.col("line_no") >= F.col("cut"), F.lit(False)).alias("strange"))


def read_lrc(spark: SparkSession, path: str) -> DataFrame:
    """Lyric files as (song_id, line_no, raw); the song is the file's stem."""
    rows = spark.read.text(path, wholetext=True).select(file_stem(F.col("_metadata.file_path")).alias("song_id"), F.posexplode(F.split("value", r"\r\n|\n|\r")).alias("line_no", "raw"))
    return rows


def read_songs(spark: SparkSession, path: str) -> DataFrame:
    """Song documents, one object for each file, with the file's path. Missing fields are null; a broken file has only its path."""
    return spark.read.schema(SONG).option("multiLine", True).option("recursiveFileLookup", True).json(path).select("*", F.col("_metadata.file_path").alias("file_path"))


def song_paths(spark: SparkSession, path: str) -> DataFrame:
    """path of the song documents that a path means: itself if it ends in .json, the lines of any other file, or all .json files below a folder. A path that doesn't exist is an error."""
    name = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = name.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(name):
        raise FileNotFoundError(path)
    if files.getFileStatus(name).isDirectory():
        return file_index(spark, path, "*.json").select("path")
    if path.endswith(".json"):
        return spark.createDataFrame([(path,)], "path string")
    return path_list(spark, path)


def read_listed_songs(spark: SparkSession, path: str, first: int = 0, count: int = 100_000) -> DataFrame:
    """Song documents of a slice of a list of paths: lines first .. first + count - 1 of those that aren't blank. Documents without audio_path or without segments are left out.

    The driver holds the paths of one slice, which is a job's share; a path that can't be read is an error.
    """
    lines = spark.read.text(path).select(F.monotonically_increasing_id().alias("line_no"), F.col("value").alias("raw"))
    numbered = numbered_lines(lines).filter(F.col("idx").between(first, first + count - 1))
    paths = [r.raw.strip() for r in numbered.select("raw").collect()]
    songs = spark.read.schema(SONG).option("multiLine", True).json(paths).select("*", F.col("_metadata.file_path").alias("file_path")) if paths else spark.createDataFrame([], SONG_ROW)
    return songs.filter("audio_path <> '' and size(segments) > 0")


def song_segments(songs: DataFrame) -> DataFrame:
    """Segments of song documents, with the names that older tools gave their fields."""
    rows = songs.select(file_stem(F.col("file_path")).alias("song_id"), "audio_length", F.posexplode("segments").alias("seg_no", "s"))
    who = F.coalesce("s.speaker", "s.speaker_id", "s.umap_segment_labels")
    return rows.select("song_id", "audio_length", "seg_no", "s.text", F.coalesce("s.start", "s.start_time").alias("start"), F.coalesce("s.end", "s.end_time").alias("end"), who.alias("speaker"), "s.is_lyric", "s.lang_type", "s.lyric_count", "s.average_duration", "s.is_duration_ill", "s.reset_end_time", "s.vad_anomaly")


def lyric_only(segments: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Segments that are lyric, and those that aren't as side information. Null counts as lyric."""
    flag = F.coalesce("is_lyric", F.lit(True))
    return segments.filter(flag), segments.filter(~flag)


def checked_lyrics(songs: DataFrame) -> DataFrame:
    """song_id, error_loading, segments, side: of documents that a service checked the segments that are lyric, and the others as side information. Null counts as lyric; a null error as none."""
    flag = lambda s: F.coalesce(s["is_lyric"], F.lit(True))
    return songs.select(file_stem(F.regexp_replace("file_path", r"\.lyric\.json$", ".json")).alias("song_id"), F.coalesce("error_loading", F.lit(False)).alias("error_loading"), F.filter("segments", flag).alias("segments"), F.filter("segments", lambda s: ~flag(s)).alias("side"))


def archive_members(spark: SparkSession, path: str, pattern: str = "*.tar*") -> DataFrame:
    """archive, name, content of the files in tar archives (compressed or not). A file in a broken archive that can't be read any more has a null name."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for archive, content in zip(frame["path"], frame["content"], strict=True):
                try:
                    with tarfile.open(fileobj=io.BytesIO(content)) as tar:
                        for member in tar:
                            if member.isfile():
                                yield pd.DataFrame({"archive": [archive], "name": [member.name], "content": [tar.extractfile(member).read()]})
                except (tarfile.TarError, EOFError, OSError):
                    yield pd.DataFrame({"archive": [archive], "name": [None], "content": [None]})

    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path).select("path", "content")
    return rows.mapInPandas(run, "archive string, name string, content binary")


def file_index(spark: SparkSession, path: str, pattern: str = "*", folders: str | None = None) -> DataFrame:
    """stem, name, path of all files below a folder (contents aren't read); folders is a pattern that a folder of the path must match. Of one stem the last path counts."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path).select("path")
    if folders is not None:
        rows = rows.filter(F.col("path").rlike(f"/(?:{folders})/"))
    return rows.select(file_stem(F.col("path")).alias("stem"), file_name(F.col("path")).alias("name"), "path").groupBy("stem").agg(F.max("path").alias("path")).select("stem", file_name(F.col("path")).alias("name"), "path")


def read_keyed_json(spark: SparkSession, path: str, schema: str, key: str = "id") -> DataFrame:
    """Lines of JSON from several files, one row for each key: the last file's last line."""
    rows = spark.read.schema(schema).json(path).select("*", F.col("_metadata.file_path").alias("__file"), F.monotonically_increasing_id().alias("__at"))
    others = [c for c in rows.columns if c not in (key, "__file", "__at")]
    return rows.groupBy(key).agg(F.max_by(F.struct(*others), F.struct("__file", "__at")).alias("r")).select(key, "r.*")


def read_metadata_array(spark: SparkSession, path: str, schema: str, text: str, key: str | None = None) -> DataFrame:
    """Rows of one document that is an array, those with text; with a key one row for each, the last."""
    rows = spark.read.schema(schema).option("multiLine", True).json(path).filter(F.col(text) != "")
    if key is None:
        return rows
    rows = rows.withColumn("__at", F.monotonically_increasing_id())
    others = [c for c in rows.columns if c not in (key, "__at")]
    return rows.groupBy(key).agg(F.max_by(F.struct(*others), "__at").alias("r")).select(key, "r.*")


def read_feed(spark: SparkSession, path: str, row_tag: str = "item", schema: str = "title string, link string, pubDate string, description string") -> DataFrame:
    """Entries of XML feeds."""
    return spark.read.format("xml").option("rowTag", row_tag).schema(schema).load(path)


def read_episodes(spark: SparkSession, path: str, schema: str = "id string, title string, description string") -> DataFrame:
    """Metadata of episodes, one JSON document each, with the file's stem; a broken document has only that."""
    return spark.read.schema(schema).option("multiLine", True).json(path).select(file_stem(F.col("_metadata.file_path")).alias("stem"), "*")


def with_metadata(songs: DataFrame, episodes: DataFrame, feed: DataFrame, key: str = "stem", title: str = "title") -> DataFrame:
    """songs with the fields of their episode, or, where it has none, those of the feed's entry of the same title."""
    known = songs.join(episodes, key, "left")
    entries = feed.filter(F.col(title).isNotNull()).groupBy(F.col(title).alias("__title")).agg(F.max("description").alias("__description"), F.max("link").alias("link"))
    return known.join(entries, F.col(title) == F.col("__title"), "left").withColumn("description", F.coalesce("description", "__description")).drop("__title", "__description")


def convert_lyric_map(lyrics: Column) -> Column:
    """Lyrics given as (offset, duration, text) as segments: end is offset plus duration, line breaks become spaces or stops."""
    text = lambda x: F.regexp_replace(F.regexp_replace(x["text"], r"\]\n", "] "), r"\n", ". ")
    return F.transform(lyrics, lambda x: F.struct(text(x).alias("text"), x["offset"].alias("start"), (x["offset"] + x["duration"]).alias("end")))
