"""Pace of lyrics: seconds for each word or character, robustly by song and family, and what doesn't fit."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strophe.operators.medians import group_medians
from strophe.functions.text import count_characters, count_words, is_cjk, only_brackets, without_brackets


@dataclass(frozen=True)
class RateRules:
    """outlier: largest robust z of a segment that counts. ratio, short, short_part, slack: of the flag. stretch, reset: a slow flagged segment is cut
    after stretch times its expected time, if that is reset seconds before its end. least, few, part: of the song filter."""

    outlier: float = 3.5
    ratio: float = 3.0
    short: float = 3.0
    short_part: float = 5.0
    slack: float = 6.0
    stretch: float = 2.0
    reset: float = 7.0
    least: int = 15
    few: int = 2
    part: float = 0.1


def with_rates(segments: DataFrame) -> DataFrame:
    """text_ori, text, lang_type, lyric_count, average_duration: a segment that is no lyric keeps only its brackets as text.

    A null is_lyric counts as lyric. Without words lang_type and average_duration are null; a length that isn't positive or not
    known has no average either. Columns of these names are replaced.
    """
    text = F.when(F.coalesce("is_lyric", F.lit(True)), F.col("text")).otherwise(only_brackets(F.col("text")))
    bare = without_brackets(F.col("text"))
    length = F.col("end") - F.col("start")
    count = F.when(F.col("lang_type") == "cjk", count_characters(F.col("text"))).when(F.col("lang_type") == "western", count_words(F.col("text"))).otherwise(0)
    return (
        segments.withColumn("text_ori", F.col("text")).withColumn("text", text)
        .withColumn("lang_type", F.when(bare == "", F.lit(None).cast("string")).when(is_cjk(bare), "cjk").when(bare.isNotNull(), "western"))
        .withColumn("lyric_count", count.cast("int"))
        .withColumn("average_duration", F.when((length > 0) & (F.col("lyric_count") > 0), length / F.col("lyric_count")))
    )


def song_rates(rated: DataFrame, rules: RateRules = RateRules()) -> DataFrame:
    """song_id, lang_type, number, total_dur, average_duration over the lyric segments whose logarithmic pace is no outlier (median and MAD).

    Segments of no positive length are left out first. With a MAD of zero nothing is kept and the average is 0.
    """
    length = F.col("end") - F.col("start")
    rows = rated.filter("coalesce(is_lyric, true) and lang_type is not null and lyric_count > 0").filter(length > 0)
    rows = rows.select("song_id", "lang_type", "lyric_count", length.alias("dur"), F.log(F.try_divide(length, F.col("lyric_count"))).alias("x"))
    keys = ["song_id", "lang_type"]
    middle = group_medians(rows, keys, "x")
    away = rows.join(middle, keys).withColumn("away", F.abs(F.col("x") - F.col("median")))
    spread = group_medians(away, keys, "away").withColumnRenamed("median", "mad")
    kept = F.try_divide(0.6745 * F.col("away"), F.col("mad")) <= rules.outlier
    kept = F.coalesce(kept, F.lit(False))
    sums = away.join(spread, keys).groupBy(*keys).agg(F.sum(F.when(kept, F.col("lyric_count")).otherwise(0)).alias("number"), F.sum(F.when(kept, F.col("dur")).otherwise(0.0)).alias("total_dur"))
    return sums.withColumn("average_duration", F.coalesce(F.try_divide("total_dur", "number"), F.lit(0.0)))


def with_ill_flags(rated: DataFrame, rules: RateRules = RateRules()) -> DataFrame:
    """is_duration_ill and song_average: segments whose pace is far from that of their song and family; false where either isn't known."""
    averages = song_rates(rated, rules).select("song_id", "lang_type", F.col("average_duration").alias("song_average"))
    joined = rated.join(averages, ["song_id", "lang_type"], "left")
    own, song, length = F.col("average_duration"), F.col("song_average"), F.col("end") - F.col("start")
    far = (own > song * rules.ratio) | (own < song / rules.ratio)
    brief = (length < rules.short) & (own > song / rules.short_part)
    ill = (song > 0) & (own > 0) & far & ~brief & (F.abs(F.col("lyric_count") * song - length) >= rules.slack)
    return joined.withColumn("is_duration_ill", F.coalesce(ill, F.lit(False)))


def reset_slow(flagged: DataFrame, rules: RateRules = RateRules()) -> DataFrame:
    """Flagged segments that are too slow end where they should; the rest of their time becomes a segment of their brackets only.

    part_no is 0 for a segment and 1 for such a rest; reset_end_time says which segments were cut.
    """
    new_end = F.col("start") + F.col("song_average") * F.col("lyric_count") * rules.stretch
    cut = F.coalesce(F.col("is_duration_ill") & (F.col("average_duration") > F.col("song_average")) & (F.col("end") - new_end >= rules.reset), F.lit(False))
    rows = flagged.withColumn("new_end", F.when(cut, new_end)).withColumn("part_no", F.explode(F.when(cut, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    rest, was = F.col("part_no") == 1, F.col("new_end").isNotNull()
    return rows.select(
        "song_id", "seg_no", "part_no",
        F.when(rest, only_brackets(F.col("text"))).otherwise(F.col("text")).alias("text"),
        F.when(rest, F.col("new_end")).otherwise(F.col("start")).alias("start"),
        F.when(was & ~rest, F.col("new_end")).otherwise(F.col("end")).alias("end"),
        F.when(rest, False).otherwise(F.col("is_lyric")).alias("is_lyric"),
        F.when(~rest, F.col("lang_type")).alias("lang_type"),
        F.when(~rest, F.col("lyric_count")).alias("lyric_count"),
        F.when(was & ~rest, (F.col("new_end") - F.col("start")) / F.col("lyric_count")).when(~rest, F.col("average_duration")).alias("average_duration"),
        (F.col("is_duration_ill") & ~rest).alias("is_duration_ill"), (was & ~rest).alias("reset_end_time"),
    )


def song_audit(reset: DataFrame, rules: RateRules = RateRules()) -> DataFrame:
    """song_id, total_seg_num, is_duration_ill_cnt, ill_duration_seg_ratio, has_reset, has_unresolved, passes, route.

    Counts are of the segments before any was cut. route is reset or ori, and filtered or filtered_out by the song filter.
    """
    whole = F.col("part_no") == 0
    ill = F.col("is_duration_ill") & whole
    rows = reset.groupBy("song_id").agg(
        F.count_if(whole).alias("total_seg_num"), F.count_if(ill).alias("is_duration_ill_cnt"),
        F.coalesce(F.bool_or(F.col("reset_end_time")), F.lit(False)).alias("has_reset"), F.coalesce(F.bool_or(ill & ~F.col("reset_end_time")), F.lit(False)).alias("has_unresolved"),
    )
    ratio = F.try_divide(F.col("is_duration_ill_cnt").cast("double"), F.col("total_seg_num"))
    rows = rows.withColumn("ill_duration_seg_ratio", F.coalesce(ratio, F.lit(0.0)))
    passes = (F.col("total_seg_num") > rules.least) & (~F.col("has_unresolved") | ((F.col("is_duration_ill_cnt") <= rules.few) & (F.col("ill_duration_seg_ratio") < rules.part)))
    return rows.withColumn("passes", passes).withColumn("route", F.concat_ws("/", F.when(F.col("has_reset"), "reset").otherwise("ori"), F.when(F.col("passes"), "filtered").otherwise("filtered_out")))


def song_wrapper(flagged: DataFrame, reset: DataFrame, rules: RateRules = RateRules()) -> DataFrame:
    """song_id, segments, has_reset_segments, western_number, western_seconds, cjk_number, cjk_seconds: what a song's document says of its segments after those that were too slow are cut.

    The numbers are of the segments whose pace counts in their song (song_rates); 0 where there is none.
    """
    rates = song_rates(flagged, rules).groupBy("song_id").agg(*[F.sum(F.when(F.col("lang_type") == f, F.col(c)).otherwise(0)).alias(f"{f}_{n}") for f in ("western", "cjk") for c, n in (("number", "number"), ("total_dur", "seconds"))])
    rows = reset.groupBy("song_id").agg(F.count("*").alias("segments"), F.coalesce(F.bool_or("reset_end_time"), F.lit(False)).alias("has_reset_segments"))
    return rows.join(rates, "song_id", "left").na.fill(0)


def scp_line(path: Column) -> Column:
    """A song's line of a list: path, segments, flagged segments, their share to four digits; separated by tabs."""
    return F.concat_ws("\t", path, F.col("total_seg_num").cast("string"), F.col("is_duration_ill_cnt").cast("string"), F.format_string("%.4f", F.col("ill_duration_seg_ratio")))


def duration_histogram(segments: DataFrame, width: float = 1.0, bins: int = 30) -> DataFrame:
    """bin, count: lengths of lyric segments with a language, the last bin open; bins without any have a 0."""
    length = F.col("end") - F.col("start")
    counts = segments.filter("coalesce(is_lyric, true) and lang_type is not null").filter(length > 0).groupBy(F.least(F.floor(length / width), F.lit(bins - 1)).cast("long").alias("bin")).agg(F.count("*").alias("count"))
    return segments.sparkSession.range(bins).select(F.col("id").alias("bin")).join(counts, "bin", "left").select("bin", F.coalesce("count", F.lit(0)).alias("count"))


def text_audio_ratio(rows: DataFrame, count: Column, most: float = 10.0, least: float = 1.0) -> DataFrame:
    """num_chars, ratio (units of text a second, 0 for no positive or known length) and whether it is abnormal: outside [least, most], over twice or under half the song's mean."""
    length = F.col("end") - F.col("start")
    rows = rows.withColumn("num_chars", count).withColumn("ratio", F.when(length > 0, F.coalesce("num_chars", F.lit(0)) / length).otherwise(0.0))
    stats = rows.groupBy("song_id").agg(F.avg("ratio").alias("ratio_mean"), F.stddev_pop("ratio").alias("ratio_std"))
    rows = rows.join(stats, "song_id")
    by_mean = (F.col("ratio_mean") > 0) & ((F.col("ratio") > 2 * F.col("ratio_mean")) | (F.col("ratio") < 0.5 * F.col("ratio_mean")))
    by_limit = (F.col("ratio") < least) | (F.col("ratio") > most)
    return rows.withColumn("abnormal_by_threshold", by_limit).withColumn("abnormal_by_mean", by_mean).withColumn("abnormal_ratio", by_limit | by_mean)
