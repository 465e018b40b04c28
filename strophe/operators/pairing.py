"""Lists of files: manifests, lyric and audio pairs, what is missing or already done."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strophe.functions.text import file_name, file_stem, file_suffix

# Audio formats, best first.
AUDIO_FORMATS = (".flac", ".wav", ".mp3", ".ogg", ".m4a", ".aac", ".wma", ".opus", ".aiff", ".ape", ".alac", ".webm")
MANIFEST = "audio_path string, lyric_path string, language string, url string, name string"


def numbered_lines(df: DataFrame, line: str = "line_no", raw: str = "raw") -> DataFrame:
    """idx over the lines that aren't blank, in order, from 0.

    The number is a count of the lines before: lines are counted in blocks, so no task sees them all.
    """
    rows = df.select(line, raw).filter(F.trim(raw) != "").withColumn("block", F.floor(F.col(line) / 65536))
    before = rows.groupBy("block").count().withColumn("ahead", F.sum("count").over(Window.orderBy("block")) - F.col("count")).select("block", "ahead")
    inside = F.row_number().over(Window.partitionBy("block").orderBy(line)) - 1
    return rows.withColumn("n", inside).join(before, "block").select(line, raw, (F.col("n") + F.col("ahead")).alias("idx"))


def manifest_slice(df: DataFrame, first: int, count: int | None = None) -> DataFrame:
    """idx, audio_path, lyric_path, language, problem: lines first .. first + count - 1 of those that aren't blank. Broken and incomplete lines keep their index and have a problem."""
    rows = numbered_lines(df).filter(F.col("idx") >= first)
    if count is not None:
        rows = rows.filter(F.col("idx") < first + count)
    parsed = F.from_json("raw", MANIFEST + ", _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    rows = rows.withColumn("p", parsed)
    problem = F.when(F.col("p._bad").isNotNull() | F.col("p").isNull(), "malformed").when(F.col("p.audio_path").isNull() | F.col("p.lyric_path").isNull(), "missing key")
    return rows.select("idx", "p.audio_path", "p.lyric_path", "p.language", problem.alias("problem"))


def lyric_stem(path: Column) -> Column:
    """Stem of a lyric file: .lyric.json goes as a whole."""
    return F.when(path.endswith(".lyric.json"), F.regexp_replace(file_name(path), r"\.lyric\.json$", "")).otherwise(file_stem(path))


def pair_files(paths: DataFrame, path: str = "path", position: str = "position") -> DataFrame:
    """stem, audio_path, lyric_path: the best audio file of each stem by format (of equal ones the first) and the last lyric file; null where there is none. Other files are ignored."""
    p = F.col(path)
    suffix = file_suffix(p)
    lyric = (F.regexp_extract(file_name(p), r".(\.[^.]*)$", 1) == ".lrc") | p.endswith(".lyric.json")
    rank = F.array_position(F.array(*map(F.lit, AUDIO_FORMATS)), suffix)
    lyrics = paths.filter(lyric).groupBy(lyric_stem(p).alias("stem")).agg(F.max_by(path, position).alias("lyric_path"))
    audio = paths.filter(~lyric & (rank > 0)).groupBy(file_stem(p).alias("stem")).agg(F.min_by(path, F.struct(rank, F.col(position))).alias("audio_path"))
    return audio.join(lyrics, "stem", "full_outer").select("stem", "audio_path", "lyric_path")


def pair_counts(pairs: DataFrame) -> DataFrame:
    return pairs.agg(
        F.count("audio_path").alias("audio"), F.count("lyric_path").alias("lyrics"), F.count_if(F.col("audio_path").isNotNull() & F.col("lyric_path").isNotNull()).alias("pairs"),
        F.count_if(F.col("lyric_path").isNull()).alias("missing_lyric"), F.count_if(F.col("audio_path").isNull()).alias("missing_audio"),
    )


def all_pairs_by_stem(paths: DataFrame, path: str = "path") -> DataFrame:
    """lyric_path, audio_path: every .lrc file with every wav, flac or mp3 file (suffix in small letters) of its stem."""
    p = F.col(path)
    left = paths.filter(p.endswith(".lrc")).select(file_stem(p).alias("stem"), p.alias("lyric_path"))
    right = paths.filter(p.rlike(r"\.(wav|flac|mp3)$")).select(file_stem(p).alias("stem"), p.alias("audio_path"))
    return left.join(right, "stem").select("stem", "lyric_path", "audio_path")


def not_done(wanted: DataFrame, done: DataFrame, on: list[str]) -> DataFrame:
    """Rows of wanted without a row in done: what is left to do, missed, failed or orphaned. A null key is never done."""
    return wanted.join(done.select(*on).distinct(), on, "left_anti")


def without_errors(paths: DataFrame, path: str = "path") -> tuple[DataFrame, DataFrame]:
    """Paths that don't have "error" in them, in capitals or not, and those that do. A null path is kept."""
    wrong = F.coalesce(F.lower(path).contains("error"), F.lit(False))
    return paths.filter(~wrong), paths.filter(wrong)


def one_at_random(df: DataFrame, column: str, seed: int) -> DataFrame:
    """One row, chosen by a hash of the column and a seed: each value is as likely, and a seed always gives the same."""
    return df.orderBy(F.xxhash64(F.col(column), F.lit(seed)), column).limit(1)


def only_done(wanted: DataFrame, done: DataFrame, on: list[str]) -> DataFrame:
    return wanted.join(done.select(*on).distinct(), on, "left_semi")


def last_by_key(df: DataFrame, key: str, position: str) -> DataFrame:
    """The last row of each key."""
    columns = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*columns), position).alias("r")).select(key, "r.*")


def mirrored_path(path: Column, root: str, target: str) -> Column:
    """Where a file's result goes: its directory under the root is kept; a file at the root goes to others."""
    relative = F.regexp_replace(path, "^" + root.rstrip("/") + "/", "")
    folder = F.regexp_extract(relative, r"^(.*)/[^/]*$", 1)
    return F.concat(F.lit(target.rstrip("/") + "/"), F.when(folder == "", F.lit("others")).otherwise(folder), F.lit("/"), file_stem(path), F.lit(".json"))


def merged_name(path: Column, seconds: int) -> Column:
    return F.concat(file_stem(path), F.lit(f".merged.{seconds}s.json"))


def diarized_name(path: Column) -> Column:
    return F.concat(file_stem(path), F.lit(".diarized.json"))


def part_path(path: Column, part: str, suffix: str = ".flac") -> Column:
    """Where a part of a sound (voice, the rest) goes: in a folder of the file's stem."""
    return F.concat(file_stem(path), F.lit(f"/{part}{suffix}"))


def orphans(done: DataFrame, stages: dict[str, DataFrame], on: list[str]) -> DataFrame:
    """stage and key of intermediate results whose final result doesn't exist. They are reported, nothing is deleted. A null key is an orphan."""
    found = [not_done(rows.select(*on).distinct(), done, on).select(F.lit(stage).alias("stage"), *on) for stage, rows in stages.items()]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def shard(index: Column, size: int, offset: int = 0) -> Column:
    """Number of the output folder of a line, by its index in the whole list."""
    return F.floor((index + offset) / size)


def even_share(index: Column, total: Column, job: int, jobs: int) -> Column:
    """Whether a line belongs to a job of an even split of `total` lines."""
    return F.floor(index / F.ceil(total / jobs)) == job
