"""Segments on the time line of their song: bounds, gaps, overlaps with structure, voice activity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strophe.functions.text import without_brackets
from strophe.operators.neighbours import time_bucket, with_neighbours, with_run_numbers

_ORDER = ["start", "seg_no"]


def _beside(segments: DataFrame, *columns: str) -> DataFrame:
    """Segments with the named columns of those before and after them in their song."""
    return with_neighbours(segments, "song_id", _ORDER, list(dict.fromkeys([*_ORDER, *columns])), time_bucket())


def vad_windows(segments: DataFrame, songs: DataFrame) -> DataFrame:
    """song_id, seg_no, window_from, window_to: each line's voice activity is looked for up to the next line's start, the last one's up to the audio's end."""
    rows = _beside(segments).join(songs.select("song_id", "audio_length"), "song_id", "left")
    return rows.select("song_id", "seg_no", F.col("start").alias("window_from"), F.coalesce("after.start", "audio_length").alias("window_to"))


def fill_gaps(segments: DataFrame, songs: DataFrame, short: float = 0.3, gap: float = 1.5) -> DataFrame:
    """song_id, start, end, text: continuous segments. Those shorter than `short` are left out; a gap of at least `gap` seconds becomes a blank
    segment, a smaller one is added to the segment before it; so is the end of the audio.

    Times are compared in whole milliseconds. Segments without both times are left out like short ones. A song none of whose segments is kept gets one blank segment if it is long enough.
    """
    ms = lambda c: F.round(F.col(c) * 1000).cast("long")
    kept = segments.select("song_id", "seg_no", "text", ms("start").alias("s"), ms("end").alias("e")).filter(F.col("e") - F.col("s") >= int(short * 1000))
    lengths = songs.select("song_id", ms("audio_length").alias("total")).filter("total is not null")
    beside = with_neighbours(kept, "song_id", ["s", "seg_no"], ["s", "seg_no", "e"], F.floor(F.col("s") / 3_600_000))
    rows = beside.join(lengths, "song_id").withColumn("following", F.col("after.s")).withColumn("before", F.coalesce("before.e", F.lit(0)))
    wide = int(gap * 1000)
    until = F.coalesce("following", "total")
    blank = F.when(F.col("s") - F.col("before") >= wide, F.struct(F.col("before").alias("s"), F.col("s").alias("e"), F.lit("").alias("text")))
    own = F.struct(F.col("s"), F.when(until - F.col("e") >= wide, F.col("e")).otherwise(until).alias("e"), F.col("text"))
    tail = F.when(F.col("following").isNull() & (F.col("total") - F.col("e") >= wide), F.struct(F.col("e").alias("s"), F.col("total").alias("e"), F.lit("").alias("text")))
    filled = rows.select("song_id", F.inline(F.array_compact(F.array(blank, own, tail))))
    empty = lengths.join(kept.select("song_id").distinct(), "song_id", "left_anti").filter(F.col("total") >= wide).select("song_id", F.lit(0).cast("long").alias("s"), F.col("total").alias("e"), F.lit("").alias("text"))
    return filled.unionByName(empty).select("song_id", F.col("s").alias("start_ms"), F.col("e").alias("end_ms"), "text")


def short_segments(segments: DataFrame, short: float = 0.3) -> DataFrame:
    """The segments that fill_gaps leaves out."""
    return segments.filter(F.round((F.col("end") - F.col("start")) * 1000) < short * 1000)


def continuity(segments: DataFrame, songs: DataFrame, slack: float = 0.01) -> DataFrame:
    """song_id, first_gap_seg, overruns: the first segment that doesn't begin where the one before ends, and whether the last one ends after the audio. Where an end isn't known nothing is said of the next segment, and the last known end counts."""
    gap = F.abs(F.col("start") - F.col("before.end")) > slack
    rows = _beside(segments, "end").withColumn("gap", F.coalesce(gap, F.lit(False)))
    place = F.struct(*_ORDER)
    found = rows.groupBy("song_id").agg(F.min(F.when(F.col("gap"), place)).alias("g"), F.max_by("end", F.when(F.col("end").isNotNull(), place)).alias("last_end"))
    return found.join(songs.select("song_id", "audio_length"), "song_id", "left").select("song_id", F.col("g.seg_no").alias("first_gap_seg"), F.coalesce(F.col("last_end") > F.col("audio_length") + slack, F.lit(False)).alias("overruns"))


def end_time_audit(segments: DataFrame, songs: DataFrame, slack: float = 0.1) -> DataFrame:
    """song_id, reason: what is wrong with a song's length or its last end; songs with nothing wrong have no row."""
    last = segments.groupBy("song_id").agg(F.max_by("end", F.struct("start", "seg_no")).alias("last_end"))
    rows = songs.join(last.withColumn("has", F.lit(True)), "song_id", "left")
    reason = (
        F.when(F.col("audio_length").isNull(), "no audio_length").when(F.col("has").isNull(), "no segments").when(F.col("last_end").isNull(), "no end")
        .when(F.abs(F.round(F.col("audio_length") * 1000) - F.round(F.col("last_end") * 1000)) > slack * 1000, "end differs")
    )
    return rows.select("song_id", reason.alias("reason")).filter("reason is not null")


def overlap_labels(segments: DataFrame, structures: DataFrame, bucket: int = 120_000) -> DataFrame:
    """song_id, seg_no, label, overlap_ms: the structure label that shares most time with each segment, over all its stretches; of equal ones the one that begins first.

    Both sides are cut at the borders of `bucket` milliseconds and meet by song and bucket, where their shares of an overlap are summed;
    so a song with very many rows is spread, and nothing is compared that lies far apart. What reaches beyond the other side's first
    start and last end is cut off first. Rows without both times, the end after the start, and null labels overlap nothing.
    """
    s = segments.select("song_id", "seg_no", F.round(F.col("start") * 1000).cast("long").alias("s"), F.round(F.col("end") * 1000).cast("long").alias("e")).filter("e > s")
    st = structures.select("song_id", F.lower("label").alias("label"), F.round(F.col("start") * 1000).cast("long").alias("a"), F.round(F.col("end") * 1000).cast("long").alias("b")).filter("label is not null and b > a")
    reach = s.groupBy("song_id").agg(F.min("s").alias("low"), F.max("e").alias("high")).join(st.groupBy("song_id").agg(F.min("a").alias("a"), F.max("b").alias("b")), "song_id")
    reach = reach.select("song_id", F.greatest("low", "a").alias("low"), F.least("high", "b").alias("high")).filter("high > low")

    def cut(rows: DataFrame, start: str, end: str) -> DataFrame:
        inside = rows.join(reach, "song_id").withColumn("u", F.greatest(start, "low")).withColumn("v", F.least(end, "high")).filter("v > u")
        parts = inside.withColumn("k", F.explode(F.sequence(F.floor(F.col("u") / bucket), F.floor((F.col("v") - 1) / bucket))))
        return parts.withColumn("u", F.greatest("u", F.col("k") * bucket)).withColumn("v", F.least("v", (F.col("k") + 1) * bucket)).drop("low", "high")

    left, right = cut(s, "s", "e"), cut(st, "a", "b").select("song_id", "k", "label", "a", F.col("u").alias("u2"), F.col("v").alias("v2"))
    both = left.join(right, ["song_id", "k"]).withColumn("ov", F.least("v", "v2") - F.greatest("u", "u2")).filter("ov > 0")
    sums = both.groupBy("song_id", "seg_no", "label").agg(F.sum("ov").alias("ov"), F.min("a").alias("first"))
    top = F.max_by(F.struct("label", "ov"), F.struct(F.col("ov"), -F.col("first"), "label"))
    return sums.groupBy("song_id", "seg_no").agg(top.alias("t")).select("song_id", "seg_no", "t.label", F.col("t.ov").alias("overlap_ms"))


def label_runs(structures: DataFrame, songs: DataFrame | None = None) -> DataFrame:
    """song_id, run_no, label, start, end: neighbouring stretches of one label (small, without digits) as one. With songs, sections that begin at or after the end of the audio are left out; those of a length that isn't known stay."""
    label = F.regexp_replace(F.lower("label"), r"\d+", "")
    rows = structures.withColumn("label", label)
    if songs is not None:
        rows = rows.join(songs.select("song_id", F.col("audio_length").alias("total")), "song_id", "left").filter(F.coalesce(F.col("start") < F.col("total"), F.lit(True))).drop("total")
    rows = with_neighbours(rows, "song_id", ["start", "st_no"], ["start", "st_no", "label"], time_bucket(number="st_no"))
    new = F.col("before").isNull() | ~F.col("before.label").eqNullSafe(F.col("label"))
    rows = with_run_numbers(rows, "song_id", ["start", "st_no"], new, time_bucket(number="st_no"))
    return rows.groupBy("song_id", "run_no").agg(F.first("label").alias("label"), F.min("start").alias("start"), F.max("end").alias("end"))


def voiced_share(vad_res: Column) -> Column:
    """The share of voiced values in a written list; 0 for an empty, missing or unreadable one."""
    values = F.from_json(vad_res, "array<double>")
    voiced = F.aggregate(values, F.lit(0.0), lambda a, x: a + F.coalesce(x, F.lit(0.0)))
    return F.coalesce(F.try_divide(voiced, F.size(values).cast("double")), F.lit(0.0))


def voiced_stretches(vad: DataFrame, step: float = 0.25) -> DataFrame:
    """song_id, start, end: stretches of voice within each segment in absolute time, from a written list with a value for each `step` seconds."""
    rows = vad.select("song_id", F.col("start").alias("at"), F.col("end").alias("to"), F.from_json("vad_res", "array<double>").alias("v")).filter("size(v) > 0 and at is not null")
    place = F.expr("sequence(0, size(v) - 1)")
    sung = lambda i: F.coalesce(F.get("v", i), F.lit(0.0)) > 0
    first, last = F.filter(place, lambda i: sung(i) & ~sung(i - 1)), F.filter(place, lambda i: sung(i) & ~sung(i + 1))
    rows = rows.select("song_id", "at", "to", F.explode(F.arrays_zip(first.alias("a"), last.alias("b"))).alias("x"))
    return rows.select("song_id", (F.col("at") + F.col("x.a") * step).alias("start"), F.least(F.col("to"), F.col("at") + (F.col("x.b") + 1) * step).alias("end"))


def voice_audit(segments: DataFrame, vad: DataFrame, quiet: float = 0.5, loud: float = 0.3) -> DataFrame:
    """song_id, seg_no, share, vad_anomaly: lyric lines with little voice, other lines with much. Only segments with a row of voice activity."""
    rows = segments.join(vad.select("song_id", "seg_no", voiced_share(F.col("vad_res")).alias("share")), ["song_id", "seg_no"])
    sung = without_brackets(F.col("text")) != ""
    return rows.select("song_id", "seg_no", "share", F.when(sung, F.col("share") <= quiet).otherwise(F.col("share") >= loud).alias("vad_anomaly"))


def zipped(left: Column, right: Column) -> Column:
    """The elements of two arrays side by side (a, b), or null if they aren't of one length: then nothing can be said of who belongs to whom."""
    return F.when(F.size(left) == F.size(right), F.arrays_zip(left.alias("a"), right.alias("b")))


def song_verdict(audited: DataFrame) -> DataFrame:
    """song_id, segments, anomalies, total_correct: of a voice_audit whether all segments of a song agree with their voice activity. A segment of which nothing is known counts as right."""
    odd = F.coalesce("vad_anomaly", F.lit(False))
    return audited.groupBy("song_id").agg(F.count("*").alias("segments"), F.count_if(odd).alias("anomalies"), (~F.bool_or(odd)).alias("total_correct"))


def pad_context(segments: DataFrame, songs: DataFrame, pad: float = 0.2, least: float = 0.5, more: float = 0.1) -> DataFrame:
    """song_id, seg_no, padded_from, padded_to: segments with context, a short one with `more` on each side besides, within the audio, where its length is known. Segments without both times, the end after the start, have no row."""
    extra = F.lit(pad) + F.when(F.col("end") - F.col("start") < least, more).otherwise(0.0)
    rows = segments.join(songs.select("song_id", "audio_length"), "song_id", "left").filter("end > start")
    return rows.select("song_id", "seg_no", F.greatest(F.lit(0.0), F.col("start") - extra).alias("padded_from"), F.least(F.col("audio_length"), F.col("end") + extra).alias("padded_to"))


def words_to_sentences(words: DataFrame) -> DataFrame:
    """Rows (item, word_no, word, start, end) as sentences: each ends with a word that ends in . ! or ?, or with the item. Words without times (no start and end) last from their number to the next.

    Words are looked at in buckets of their numbers, so an item may be of any length; a sentence must fit a row.
    """
    bucket = F.floor(F.col("word_no") / 4096)
    rows = with_neighbours(words, "item", ["word_no"], ["word_no", "word"], bucket)
    closed = F.coalesce(F.col("before.word").rlike(r"[.!?]$"), F.lit(False))
    rows = with_run_numbers(rows.withColumn("closed", closed).drop("before", "after"), "item", ["word_no"], F.col("closed"), bucket).withColumnRenamed("run_no", "sentence_no")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("word_no", "word"))), lambda x: x["word"]), " ")
    times = (F.min("start"), F.max("end")) if "start" in words.columns else (F.min("word_no").cast("double"), F.max("word_no") + F.lit(1.0))
    return rows.groupBy("item", "sentence_no").agg(text.alias("sentence"), times[0].alias("start"), times[1].alias("end"))


def length_report(segments: DataFrame, threshold: float = 30.0) -> DataFrame:
    """song_id, longest_ms, longest_seg, shortest_ms, shortest_seg, over: extremes of segment lengths and how many exceed the threshold."""
    rows = segments.withColumn("ms", F.round((F.col("end") - F.col("start")) * 1000).cast("long")).filter("ms > 0")
    return rows.groupBy("song_id").agg(
        F.max("ms").alias("longest_ms"), F.max_by("seg_no", F.struct("ms", -F.col("seg_no"))).alias("longest_seg"), F.min("ms").alias("shortest_ms"),
        F.min_by("seg_no", F.struct("ms", "seg_no")).alias("shortest_seg"), F.count_if(F.col("ms") > threshold * 1000).alias("over"),
    )


def over_length(segments: DataFrame, threshold: float = 30.0) -> DataFrame:
    """song_id, seg_no, ms: the segments that last over the threshold."""
    rows = segments.withColumn("ms", F.round((F.col("end") - F.col("start")) * 1000).cast("long"))
    return rows.filter(F.col("ms") > threshold * 1000).select("song_id", "seg_no", "ms")


def viewer_rows(segments: DataFrame) -> DataFrame:
    """song_id, seg_no, style: rows that can be drawn (both times, start before end), with the style of their gravest flag."""
    style = F.when(F.coalesce("reset_end_time", F.lit(False)), "reset").when(F.coalesce("is_duration_ill", F.lit(False)), "ill").when(F.coalesce("vad_anomaly", F.lit(False)), "vad").otherwise("normal")
    return segments.filter("start < end").select("song_id", "seg_no", style.alias("style"))


def adjust_bounds(segments: DataFrame, voiced: DataFrame | None = None, edge: float = 0.2, wide: float = 1.0, part: float = 0.5) -> DataFrame:
    """song_id, seg_no, new_from, new_to: speech segments with their bounds moved into the gaps beside them.

    The first starts `edge` earlier (not before 0), the last ends as much later. A gap of up to `wide` seconds is shared half and half, a wider
    one gives each side `part`; a wider one that voice reaches across (a stretch of `voiced` from before its start to after its end) is shared too.
    An overlap ends with the later segment's start. Segments without both times, the end after the start, have no row and are nobody's neighbours. A bound depends on its two neighbours only, so lag and lead are enough.
    """
    rows = _beside(segments.filter("end > start"), "end").withColumn("before", F.col("before.end")).withColumn("following", F.col("after.seg_no")).withColumn("after", F.col("after.start"))
    if voiced is not None:
        # A hot recording's gaps meet the stretches of their minute only.
        minute = lambda c: F.floor(F.col(c) / 60)
        v = voiced.filter(F.col("end") - F.col("start") > wide).select(F.col("song_id").alias("vs"), F.col("start").alias("va"), F.col("end").alias("vb"), F.explode(F.sequence(minute("start"), minute("end"))).alias("vm"))
        wider = rows.filter(F.col("start") - F.col("before") > wide).select("song_id", "seg_no", "start", "before", minute("before").alias("m"))
        across = wider.join(v, F.expr("song_id = vs and m = vm and va < before and vb > start"), "left_semi").select("song_id", "seg_no", F.lit(True).alias("voice_before"))
        following = across.select("song_id", F.col("seg_no").alias("following"), F.lit(True).alias("voice_after"))
        rows = rows.join(across, ["song_id", "seg_no"], "left").join(following, ["song_id", "following"], "left")
    else:
        rows = rows.withColumn("voice_before", F.lit(False)).withColumn("voice_after", F.lit(False))
    move = lambda gap, voice: F.when((gap > 0) & F.coalesce(voice, F.lit(False)), gap / 2).when(gap > wide, part).when(gap >= 0, gap / 2)
    left, right = F.col("start") - F.col("before"), F.col("after") - F.col("end")
    start = F.when(F.col("before").isNull(), F.greatest(F.lit(0.0), F.col("start") - edge)).otherwise(F.col("start") - F.coalesce(move(left, F.col("voice_before")), F.lit(0.0)))
    end = F.when(F.col("after").isNull(), F.col("end") + edge).when(right < 0, F.col("after")).otherwise(F.col("end") + F.coalesce(move(right, F.col("voice_after")), F.lit(0.0)))
    return rows.select("song_id", "seg_no", start.alias("new_from"), end.alias("new_to"))
