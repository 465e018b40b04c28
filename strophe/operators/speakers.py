"""Who speaks how much: counts, shares, turns and labels of speakers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strophe.operators.neighbours import time_bucket, with_neighbours, with_run_numbers


def plain_label(label: Column) -> Column:
    """A cluster label without its outlier mark; null for none."""
    return F.when(label != "", F.regexp_replace(F.trim(label), r"_OUTLIER$", ""))


def is_outlier(label: Column) -> Column:
    return label.rlike(r"_OUTLIER$")


def effective_speakers(segments: DataFrame, least: int = 2, share: float = 0.1) -> DataFrame:
    """song_id, speakers: labels with at least `least` segments and that share of the song's labelled segments. A song without labels has 0."""
    counts = segments.groupBy("song_id", "speaker").agg(F.count("speaker").alias("n"))
    sums = counts.groupBy("song_id").agg(F.sum("n").alias("total"))
    good = (F.col("n") >= least) & (F.col("n") >= F.col("total") * share)
    return counts.join(sums, "song_id").groupBy("song_id").agg(F.count_if(good).alias("speakers"))


def speaker_classes(effective: DataFrame) -> DataFrame:
    """class, songs: songs with no, one, and two or more speakers."""
    return effective.groupBy(F.least("speakers", F.lit(2)).alias("class")).agg(F.count("*").alias("songs"))


def speaker_histogram(segments: DataFrame) -> DataFrame:
    """song_id, counts: "Speaker k: n" of each label that is no outlier, most frequent first."""
    counts = segments.filter(F.col("speaker").isNotNull() & ~is_outlier(F.col("speaker"))).groupBy("song_id", "speaker").count()
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("count")).alias("n"), "speaker")))
    return counts.groupBy("song_id").agg(F.array_join(F.transform(ordered, lambda x: F.concat(F.lit("Speaker "), x["speaker"], F.lit(": "), (-x["n"]).cast("string"))), ", ").alias("counts"))


def relabel_by_appearance(segments: DataFrame) -> DataFrame:
    """song_id, seg_no, speaker_no: labels numbered from 0 by their first segment. Unlabelled segments have no row.

    First appearances are an aggregate of a row for each label, so a long song costs no window over its segments.
    """
    rows = segments.filter("speaker is not null").select("song_id", "seg_no", "speaker")
    first = rows.groupBy("song_id", "speaker").agg(F.min("seg_no").alias("first"))
    numbers = first.withColumn("speaker_no", F.dense_rank().over(Window.partitionBy("song_id").orderBy("first", "speaker")) - 1).drop("first")
    return rows.join(numbers, ["song_id", "speaker"]).select("song_id", "seg_no", "speaker_no")


def put_back(segments: DataFrame, diarized: DataFrame, label: str = "label") -> DataFrame:
    """segments with speaker_no from rows (song_id, seg_no, label) that only some of them have: labels less their outlier mark, numbered from 0 by first appearance in the song; null for the rest.

    Of several rows of one segment the largest label counts.
    """
    plain = F.regexp_replace(F.col(label).cast("string"), "_OUTLIER", "")
    named = diarized.groupBy("song_id", "seg_no").agg(F.max(plain).alias("speaker"))
    numbers = relabel_by_appearance(named)
    return segments.join(numbers, ["song_id", "seg_no"], "left")


def same_speaker_runs(segments: DataFrame) -> DataFrame:
    """song_id, run_no, speaker, first_seg, last_seg, start, end: neighbouring segments of one label as one."""
    rows = with_neighbours(segments, "song_id", ["start", "seg_no"], ["start", "seg_no", "speaker"], time_bucket())
    new = F.col("before").isNull() | ~F.col("before.speaker").eqNullSafe(F.col("speaker"))
    rows = with_run_numbers(rows, "song_id", ["start", "seg_no"], new, time_bucket())
    place = F.struct("start", "seg_no")
    return rows.groupBy("song_id", "run_no").agg(F.first("speaker").alias("speaker"), F.min_by("seg_no", place).alias("first_seg"), F.max_by("seg_no", place).alias("last_seg"), F.min("start").alias("start"), F.max_by("end", place).alias("end"))


@dataclass(frozen=True)
class TalkRules:
    """Limits of a conversation that is kept."""

    speech: float = 0.6
    least: int = 1
    most: int = 4
    turn_ms: int = 3000
    longest_ms: int | None = None
    share: float = 0.1
    silence: str = "<非语音>"


def talk_quality(segments: DataFrame, rules: TalkRules = TalkRules()) -> DataFrame:
    """song_id, speech_ms, audio_ms, turns, num_effective, is_valid: how much of a conversation is speech, by how many speakers, in how long turns.

    The audio ends with the last segment. Segments of silence or without a label count for nothing; times are whole milliseconds.
    """
    ms = lambda c: F.round(F.col(c) * 1000).cast("long")
    rows = segments.withColumn("s", ms("start")).withColumn("e", ms("end"))
    audio = rows.groupBy("song_id").agg(F.max_by("e", F.struct("start", "seg_no")).alias("audio_ms"))
    spoken = rows.filter(F.col("speaker").isNotNull() & ~F.col("text").contains(rules.silence) & (F.col("e") > F.col("s"))).withColumn("speaker", plain_label(F.col("speaker"))).filter("speaker is not null")
    beside = with_neighbours(spoken, "song_id", ["start", "seg_no"], ["start", "seg_no", "speaker"], time_bucket())
    turn = (F.col("before").isNull() | ~F.col("speaker").eqNullSafe(F.col("before.speaker"))).cast("int")
    parts = beside.withColumn("turn", turn).groupBy("song_id", "speaker").agg(F.sum(F.col("e") - F.col("s")).alias("ms"), F.sum("turn").alias("turns"))
    sums = parts.groupBy("song_id").agg(F.sum("ms").alias("speech_ms"), F.sum("turns").alias("turns"))
    enough = parts.join(sums.select("song_id", "speech_ms"), "song_id").groupBy("song_id").agg(F.count_if(F.col("ms") >= F.col("speech_ms") * rules.share).alias("num_effective"))
    out = sums.join(enough, "song_id").join(audio, "song_id")
    good = (F.col("speech_ms") >= F.col("audio_ms") * rules.speech) & F.col("num_effective").between(rules.least, rules.most) & (F.col("speech_ms") >= F.col("turns") * rules.turn_ms)
    if rules.longest_ms is not None:
        good = good & (F.col("speech_ms") <= F.col("turns") * rules.longest_ms)
    return out.select("song_id", "speech_ms", "audio_ms", "turns", "num_effective", F.coalesce(good, F.lit(False)).alias("is_valid"))


def narrow_dump(segments: DataFrame) -> DataFrame:
    """song_id, seg_no, speaker ('N/A' without one), text."""
    return segments.select("song_id", "seg_no", F.coalesce(F.when(F.col("speaker") != "", F.col("speaker")), F.lit("N/A")).alias("speaker"), "text")
