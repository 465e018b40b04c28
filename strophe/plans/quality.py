"""Queries of problems 2 and 3 over segments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strophe.functions.text import is_cjk, millis, without_brackets
from strophe.operators.current import current_rows
from strophe.operators.intervals import continuous_periods, interval_gaps
from strophe.operators.spikes import flag_spikes
from strophe.session import shared_folder, table
from strophe.streaming.intervals import streamed_gaps
from strophe.streaming.manifest import files_stream

#: Longer stretches lie between two recordings.
BREAK_MS = 600_000


def p2_spikes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every implausible average_duration with its ratio to the song's pace and the reason."""
    segments = current_rows(table(spark, sf_dir, "segments"), "segment_id", "loaded_at", song_id="song_id", seg_no="seg_no", average_duration="average_duration", cjk=is_cjk(without_brackets(F.col("text"))))
    return flag_spikes(segments, "song_id", "seg_no", "average_duration", F.col("cjk"), "segment_id")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p2_spikes(spark, sf_dir).select("segment_id")


def p2_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Why each implausible average_duration can't be believed."""
    return p2_spikes(spark, sf_dir).select("segment_id", "reason")


def _spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return current_rows(table(spark, sf_dir, "segments"), "segment_id", "loaded_at", song_id="song_id", start_ms=millis(F.col("start")), end_ms=millis(F.col("end")))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    gaps = interval_gaps(_spans(spark, sf_dir), "song_id", "start_ms", "end_ms", BREAK_MS)
    return gaps.select("song_id", F.col("gap_from").alias("gap_from_ms"), F.col("gap_to").alias("gap_to_ms"))


def p3_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The continuous covered periods of each song."""
    periods = continuous_periods(_spans(spark, sf_dir), "song_id", "start_ms", "end_ms")
    return periods.select("song_id", F.col("period_from").alias("from_ms"), F.col("period_to").alias("to_ms"))


def gaps_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gaps that no delivered version of any segment covers, by the interval map over a stream of the table's files."""
    stream = files_stream(spark, sf_dir, "segments.parquet")
    rows = stream.withColumn("s", millis(F.col("start"))).withColumn("e", millis(F.col("end")))
    return streamed_gaps(rows, "song_id", "s", "e", shared_folder(spark))


QUERIES = {"gaps_stream": gaps_stream, "p2_found": p2_found, "p2_spikes": p2_spikes, "p2_reasons": p2_reasons, "p3_found": p3_found, "p3_periods": p3_periods}

_LAST = "last_rows AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY segment_id ORDER BY loaded_at DESC) AS rn FROM segments) WHERE rn = 1)"
_COVER = f"""
{_LAST}, spans AS (SELECT song_id, CAST(round("start" * 1000) AS BIGINT) AS s, CAST(round("end" * 1000) AS BIGINT) AS e FROM last_rows),
reach AS (SELECT *, max(e) OVER (PARTITION BY song_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS r FROM spans WHERE e > s)"""
# The same by medians of whole songs instead of charts: what isn't implausible lies far from the limits.
ORACLE = {
    "gaps_stream": """WITH spans AS (SELECT song_id, CAST(round("start" * 1000) AS BIGINT) AS s, CAST(round("end" * 1000) AS BIGINT) AS e FROM segments),
reach AS (SELECT *, max(e) OVER (PARTITION BY song_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS r FROM spans WHERE e > s) SELECT song_id, r AS gap_from, s AS gap_to FROM reach WHERE s > r""",
    "p2_found": rf"""WITH {_LAST}, f AS (SELECT segment_id, song_id, seg_no, average_duration AS v, coalesce(regexp_matches(regexp_replace(text, '\[[^\]]*\]', '', 'g'), '[\x{{4e00}}-\x{{9fff}}\x{{3040}}-\x{{30ff}}\x{{ac00}}-\x{{d7af}}\x{{0e00}}-\x{{0e7f}}]'), false) AS cjk FROM last_rows WHERE average_duration IS NOT NULL),
g AS (SELECT *, row_number() OVER (PARTITION BY song_id ORDER BY seg_no) - row_number() OVER (PARTITION BY song_id, v ORDER BY seg_no) AS k FROM f),
r AS (SELECT *, count(*) OVER (PARTITION BY song_id, v, k) AS n, median(CASE WHEN v > 0 AND isfinite(v) THEN v END) OVER (PARTITION BY song_id, cjk) AS m FROM g)
SELECT segment_id FROM r WHERE v <= 0 OR NOT isfinite(v) OR v >= 3 * m OR v <= m / 3 OR n >= 5""",
    "p3_found": f"WITH {_COVER} SELECT song_id, r AS gap_from_ms, s AS gap_to_ms FROM reach WHERE s > r AND s - r <= {BREAK_MS}",
    "p3_periods": f"""WITH {_LAST}, spans AS (SELECT song_id, CAST(round("start" * 1000) AS BIGINT) AS s, CAST(round("end" * 1000) AS BIGINT) AS e FROM last_rows),
reach AS (SELECT *, max(e) OVER (PARTITION BY song_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS r FROM spans WHERE e > s),
parts AS (SELECT *, sum(CASE WHEN r IS NULL OR s > r THEN 1 ELSE 0 END) OVER (PARTITION BY song_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS part FROM reach)
SELECT song_id, min(s) AS from_ms, max(e) AS to_ms FROM parts GROUP BY song_id, part""",
}
ORACLE["p2_reasons"] = ORACLE["p2_found"].replace("SELECT segment_id FROM r WHERE", "SELECT segment_id, CASE WHEN v <= 0 OR NOT isfinite(v) THEN 'limit' WHEN v >= 3 * m OR v <= m / 3 THEN 'spike' ELSE 'stuck' END AS reason FROM r WHERE")
