"""Queries over texts and the pace of lyrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strophe.functions import text as T
from strophe.operators import rates as R
from strophe.operators.current import current_rows
from strophe.session import cut_lineage, table

COLUMNS = ("song_id", "seg_no", "text", "start", "end", "is_lyric", "speaker")


def segments_now(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The current version of each segment."""
    return current_rows(table(spark, sf_dir, "segments"), "segment_id", "loaded_at", **{c: c for c in columns or COLUMNS})


def _rated(spark: SparkSession, d: str) -> DataFrame:
    return R.with_rates(segments_now(spark, d))


def _rated_once(spark: SparkSession, d: str) -> DataFrame:
    """The rated segments written once: the statistics of a song pass over them several times."""
    return cut_lineage(_rated(spark, d).drop("text_ori", "speaker"))


def _flagged(spark: SparkSession, d: str) -> DataFrame:
    return R.with_ill_flags(_rated_once(spark, d))


def reset_rows(spark: SparkSession, d: str) -> DataFrame:
    return R.reset_slow(_flagged(spark, d))


def _audit(spark: SparkSession, d: str) -> DataFrame:
    return R.song_audit(reset_rows(spark, d))


def bracket_label(spark, d):
    t = F.col("text")
    return table(spark, d, "segments").select("segment_id", T.only_brackets(t).alias("brackets"), T.without_brackets(t).alias("bare"), T.bracket_label(t).alias("label"), T.leading_label(t).alias("lead"), T.after_label(t).alias("after")).distinct()


def lang_and_counts(spark, d):
    t = F.col("text")
    return table(spark, d, "segments").select("segment_id", "text").distinct().select("segment_id", "text", T.language_family(T.without_brackets(t)).alias("family"), T.count_words(t).alias("words"), T.count_characters(t).alias("characters"))


def document_counts(spark, d):
    t = F.col("text")
    return table(spark, d, "documents").select("doc_id", T.language_family(t).alias("family"), T.count_words(t).alias("words"), T.count_characters(t).alias("characters"), T.approximate_tokens(t).alias("tokens"))


def normalize_text(spark, d):
    t = F.col("text")
    return table(spark, d, "segments").select("text").distinct().select("text", T.normalize_spoken(t).alias("spoken"), T.count_mixed(t).alias("mixed"), T.without_punctuation(t).alias("letters"), T.without_punctuation(t, keep_space=True).alias("spaced"), T.ends_with_mark(t).alias("closed"))


def clean_laughter(spark, d):
    rows = segments_now(spark, d, "text").withColumn("cleaned", T.clean_laughter(F.col("text")))
    return rows.filter("cleaned <> ''").select("segment_id", F.col("text").alias("text_ori"), "cleaned", (F.col("cleaned") != F.col("text")).alias("is_modified"))


def segment_rows(spark, d):
    return _rated(spark, d).select("segment_id", "text_ori", "text", "lang_type", "lyric_count", F.round("average_duration", 6).alias("average_duration"))


def segment_rate(spark, d):
    return R.song_rates(_rated_once(spark, d)).select("song_id", "lang_type", "number", F.round("total_dur", 3).alias("total_dur"), F.round("average_duration", 6).alias("average_duration"))


def ill_flag(spark, d):
    """Which segments have a pace that doesn't fit their song."""
    return _flagged(spark, d).select("segment_id", "song_id", "lang_type", "lyric_count", "is_duration_ill", F.round("song_average", 6).alias("song_average"))


def reset_split(spark, d):
    rows = reset_rows(spark, d)
    return rows.select("song_id", "seg_no", "part_no", "text", F.round("start", 3).alias("start"), F.round("end", 3).alias("end"), "is_lyric", "lang_type", "lyric_count", "is_duration_ill", "reset_end_time")


def song_filter_route(spark, d):
    return _audit(spark, d).withColumn("ill_duration_seg_ratio", F.round("ill_duration_seg_ratio", 9))


def route_lines(spark, d):
    return _audit(spark, d).select("route", R.scp_line(F.concat(F.col("song_id"), F.lit(".json"))).alias("line"))


def corpus_totals(spark, d):
    return R.song_rates(_rated_once(spark, d)).groupBy("lang_type").agg(F.sum("number").alias("number"), F.round(F.sum("total_dur"), 1).alias("total_dur"))


def duration_histogram(spark, d):
    return R.duration_histogram(_rated(spark, d))


def duration_summary(spark, d):
    length = F.round((F.col("end") - F.col("start")) * 1000).cast("long")
    rows = _rated(spark, d).filter("coalesce(is_lyric, true) and lang_type is not null").filter(length > 0)
    return rows.agg(F.count("*").alias("n"), F.min(length).alias("least_ms"), F.max(length).alias("most_ms"), F.sum(length).alias("total_ms"))


def text_audio_ratio(spark, d):
    rows = R.text_audio_ratio(segments_now(spark, d), T.count_mixed(F.col("text")))
    return rows.select("segment_id", "num_chars", F.round("ratio", 6).alias("ratio"), F.round("ratio_mean", 6).alias("ratio_mean"), F.round("ratio_std", 6).alias("ratio_std"), "abnormal_by_threshold", "abnormal_by_mean", "abnormal_ratio")


def song_documents(spark, d):
    """What each song's document says of its segments."""
    flagged = _flagged(spark, d)
    rows = R.song_wrapper(flagged, R.reset_slow(flagged))
    return rows.withColumn("western_seconds", F.round("western_seconds", 3)).withColumn("cjk_seconds", F.round("cjk_seconds", 3))


QUERIES = {f.__name__: f for f in (song_documents, ill_flag, bracket_label, lang_and_counts, document_counts, normalize_text, clean_laughter, segment_rows, segment_rate, reset_split, song_filter_route, route_lines, corpus_totals, duration_histogram, duration_summary, text_audio_ratio)}

_CJK = r"[\x{4e00}-\x{9fff}\x{3040}-\x{30ff}\x{ac00}-\x{d7af}\x{0e00}-\x{0e7f}]"
# All Unicode white space, for patterns of an engine whose \s is ASCII.
_WS = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_NOT_WS = r"\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def _trim(x: str) -> str:
    return f"regexp_replace({x}, '^{_WS}+|{_WS}+$', '', 'g')"


def _bare(x: str) -> str:
    return _trim(rf"regexp_replace({x}, '\[[^\]]*\]', '', 'g')")


def _brackets(x: str) -> str:
    return rf"array_to_string(regexp_extract_all({x}, '\[[^\]]*\]'), '')"


def _words(b: str) -> str:
    marks = T.LOOSE_MARKS.replace("'", "''")
    return (
        f"CASE WHEN {b} = '' THEN 0 WHEN len(regexp_split_to_array({b}, '{_WS}+')) > 1 THEN len(regexp_split_to_array({b}, '{_WS}+')) "
        f"WHEN len(regexp_extract_all({b}, '[{T.LATIN_LETTERS}]+')) > 0 THEN len(regexp_extract_all({b}, '[{T.LATIN_LETTERS}]+')) ELSE greatest(1, length(regexp_replace({b}, '{marks}', '', 'g'))) END"
    )


_LAST = "last_rows AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY segment_id ORDER BY loaded_at DESC) AS rn FROM segments) WHERE rn = 1)"
_RATED = f"""{_LAST},
texts AS (SELECT segment_id, song_id, seg_no, text AS text_ori, is_lyric, "start" AS s, "end" AS e, CASE WHEN coalesce(is_lyric, true) THEN text ELSE {_brackets("text")} END AS text FROM last_rows),
bare AS (SELECT *, {_bare("text")} AS b FROM texts),
fam AS (SELECT *, CASE WHEN b = '' THEN NULL WHEN regexp_matches(b, '{_CJK}') THEN 'cjk' WHEN b IS NOT NULL THEN 'western' END AS lang_type FROM bare),
counted AS (SELECT *, CAST(CASE lang_type WHEN 'cjk' THEN len(regexp_extract_all(b, '{_CJK}')) WHEN 'western' THEN {_words("b")} ELSE 0 END AS INT) AS lyric_count FROM fam),
rated AS (SELECT *, CASE WHEN e - s > 0 AND lyric_count > 0 THEN (e - s) / lyric_count END AS average_duration FROM counted)"""
_SONGS = f"""{_RATED},
x AS (SELECT song_id, lang_type, lyric_count, e - s AS dur, ln((e - s) / lyric_count) AS x FROM rated WHERE coalesce(is_lyric, true) AND lang_type IS NOT NULL AND lyric_count > 0 AND e - s > 0),
med AS (SELECT song_id, lang_type, median(x) AS m FROM x GROUP BY ALL),
away AS (SELECT x.*, abs(x.x - m) AS away FROM x JOIN med USING (song_id, lang_type)),
mad AS (SELECT song_id, lang_type, median(away) AS mad FROM away GROUP BY ALL),
rate AS (SELECT song_id, lang_type, CAST(sum(CASE WHEN keep THEN lyric_count ELSE 0 END) AS BIGINT) AS number, sum(CASE WHEN keep THEN dur ELSE 0 END) AS total_dur
    FROM (SELECT away.*, mad > 0 AND 0.6745 * away / nullif(mad, 0) <= 3.5 AS keep FROM away JOIN mad USING (song_id, lang_type)) GROUP BY ALL),
songs_rate AS (SELECT *, coalesce(total_dur / nullif(number, 0), 0) AS song_average FROM rate)"""
_FLAG = f"""{_SONGS},
flagged AS (SELECT r.*, song_average, coalesce(song_average > 0 AND average_duration > 0 AND (average_duration > song_average * 3 OR average_duration < song_average / 3)
    AND NOT (e - s < 3 AND average_duration > song_average / 5) AND abs(lyric_count * song_average - (e - s)) >= 6, false) AS ill
    FROM rated r LEFT JOIN songs_rate USING (song_id, lang_type))"""
_RESET = f"""{_FLAG},
marked AS (SELECT *, CASE WHEN ill AND average_duration > song_average AND e - (s + song_average * lyric_count * 2) >= 7 THEN s + song_average * lyric_count * 2 END AS ne FROM flagged),
parts AS (SELECT song_id, seg_no, 0 AS part_no, text, s, coalesce(ne, e) AS e, is_lyric, lang_type, lyric_count, ill, ne IS NOT NULL AS reset_end_time FROM marked
    UNION ALL SELECT song_id, seg_no, 1, {_brackets("text")}, ne, e, false, NULL, NULL, false, false FROM marked WHERE ne IS NOT NULL)"""
_AUDIT = f"""{_RESET},
counts AS (SELECT song_id, count_if(part_no = 0) AS total_seg_num, count_if(ill AND part_no = 0) AS is_duration_ill_cnt, bool_or(reset_end_time) AS has_reset, bool_or(ill AND part_no = 0 AND NOT reset_end_time) AS has_unresolved FROM parts GROUP BY song_id),
ratios AS (SELECT *, is_duration_ill_cnt / total_seg_num AS r FROM counts),
audit AS (SELECT *, total_seg_num > 15 AND (NOT has_unresolved OR (is_duration_ill_cnt <= 2 AND r < 0.1)) AS passes FROM ratios),
routed AS (SELECT *, CASE WHEN has_reset THEN 'reset' ELSE 'ori' END || '/' || CASE WHEN passes THEN 'filtered' ELSE 'filtered_out' END AS route FROM audit)"""
_HAN = r"[\x{4e00}-\x{9fff}]"
_PAIRS = rf"regexp_replace(text, '({_HAN})({_HAN})', '\1 \2', 'g')"
_SPACED = rf"regexp_replace({_PAIRS}, '({_HAN})({_HAN})', '\1 \2', 'g')"
_KEPT = rf"regexp_replace({_SPACED}, '[^\p{{L}}\p{{N}}_{_NOT_WS}'']', '', 'g')"
_SQUEEZED = f"regexp_replace({_KEPT}, '{_WS}+', ' ', 'g')"
_SPOKEN = f"lower({_trim(_SQUEEZED)})"
_LABEL = r"regexp_extract(text, '\[([^\]]+)\]', 1)"
_QUIET = rf"""regexp_replace(regexp_replace(text, '(?i)laughter[.,!?''"]*', '', 'g'), '{_WS}+', ' ', 'g')"""
ORACLE = {
    "text_audio_ratio": rf"""WITH {_LAST}, n AS (SELECT segment_id, song_id, "end" - "start" AS len, {_SPOKEN} AS spoken FROM last_rows),
m AS (SELECT *, CASE WHEN spoken IS NOT NULL THEN len(regexp_extract_all(spoken, '[\x{{4e00}}-\x{{9fff}}]')) + len(list_filter(regexp_split_to_array(spoken, '{_WS}+'), lambda t: regexp_replace(t, '[\x{{4e00}}-\x{{9fff}}]', '', 'g') <> '')) END AS num_chars FROM n),
r AS (SELECT *, CASE WHEN len > 0 THEN coalesce(num_chars, 0) / len ELSE 0.0 END AS ratio FROM m), s AS (SELECT *, avg(ratio) OVER w AS mean, stddev_pop(ratio) OVER w AS std FROM r WINDOW w AS (PARTITION BY song_id)),
f AS (SELECT *, ratio < 1 OR ratio > 10 AS t, mean > 0 AND (ratio > 2 * mean OR ratio < 0.5 * mean) AS b FROM s)
SELECT segment_id, num_chars, round(ratio, 6) AS ratio, round(mean, 6) AS ratio_mean, round(std, 6) AS ratio_std, t AS abnormal_by_threshold, b AS abnormal_by_mean, t OR b AS abnormal_ratio FROM f""",
    "bracket_label": rf"""SELECT DISTINCT segment_id, {_brackets("text")} AS brackets, {_bare("text")} AS bare, CASE WHEN regexp_extract(text, '\[([^\]]+)\]', 1) <> '' THEN {_trim("lower(" + _LABEL + ")")} END AS label,
CASE WHEN regexp_matches(text, '^\[[^\n]*?\]') THEN regexp_extract(text, '^\[([^\n]*?)\]', 1) END AS lead, CASE WHEN regexp_matches(text, '^\[[^\n]*?\]') THEN regexp_extract(text, '^\[[^\n]*?\]\s*([^\n]*)', 1) ELSE text END AS after FROM segments""",
    "lang_and_counts": f"""SELECT segment_id, text, CASE WHEN regexp_matches(b, '{_CJK}') THEN 'cjk' ELSE 'western' END AS family, {_words("b")} AS words, len(regexp_extract_all(b, '{_CJK}')) AS characters FROM (SELECT DISTINCT segment_id, text, {_bare("text")} AS b FROM segments)""",
    "document_counts": f"""SELECT doc_id, CASE WHEN regexp_matches(text, '{_CJK}') THEN 'cjk' ELSE 'western' END AS family, {_words("b")} AS words, len(regexp_extract_all(b, '{_CJK}')) AS characters, length(text) // 4 AS tokens FROM (SELECT *, {_bare("text")} AS b FROM documents)""",
    "normalize_text": rf"""SELECT text, spoken, len(regexp_extract_all(spoken, '[\x{{4e00}}-\x{{9fff}}]')) + len(list_filter(regexp_split_to_array(spoken, '{_WS}+'), lambda t: regexp_replace(t, '[\x{{4e00}}-\x{{9fff}}]', '', 'g') <> '')) AS mixed,
regexp_replace(text, '[^\p{{L}}\p{{N}}\p{{M}}]', '', 'g') AS letters, regexp_replace(translate(text, '-‐‑‒–—―−', '        '), '[^\p{{L}}\p{{N}}\p{{M}}{_NOT_WS}]', '', 'g') AS spaced, regexp_matches(text, '[.!?。！？,，;；]\s*$') AS closed FROM (SELECT DISTINCT text, {_SPOKEN} AS spoken FROM segments)""",
    "segment_rows": f"WITH {_RATED} SELECT segment_id, text_ori, text, lang_type, lyric_count, round(average_duration, 6) AS average_duration FROM rated",
    "song_documents": f"""WITH {_RESET}, w AS (SELECT song_id, CAST(sum(CASE WHEN lang_type = 'western' THEN number ELSE 0 END) AS BIGINT) AS western_number, round(sum(CASE WHEN lang_type = 'western' THEN total_dur ELSE 0 END), 3) AS western_seconds, CAST(sum(CASE WHEN lang_type = 'cjk' THEN number ELSE 0 END) AS BIGINT) AS cjk_number, round(sum(CASE WHEN lang_type = 'cjk' THEN total_dur ELSE 0 END), 3) AS cjk_seconds FROM songs_rate GROUP BY song_id),
g AS (SELECT song_id, count(*) AS segments, bool_or(reset_end_time) AS has_reset_segments FROM parts GROUP BY song_id)
SELECT song_id, segments, has_reset_segments, coalesce(western_number, 0) AS western_number, coalesce(western_seconds, 0.0) AS western_seconds, coalesce(cjk_number, 0) AS cjk_number, coalesce(cjk_seconds, 0.0) AS cjk_seconds FROM g LEFT JOIN w USING (song_id)""",
    "segment_rate": f"WITH {_SONGS} SELECT song_id, lang_type, number, round(total_dur, 3) AS total_dur, round(song_average, 6) AS average_duration FROM songs_rate",
    "ill_flag": f"WITH {_FLAG} SELECT segment_id, song_id, lang_type, lyric_count, ill AS is_duration_ill, round(song_average, 6) AS song_average FROM flagged",
    "reset_split": f"""WITH {_RESET} SELECT song_id, seg_no, part_no, text, round(s, 3) AS "start", round(e, 3) AS "end", is_lyric, lang_type, lyric_count, ill AS is_duration_ill, reset_end_time FROM parts""",
    "song_filter_route": f"WITH {_AUDIT} SELECT song_id, total_seg_num, is_duration_ill_cnt, has_reset, has_unresolved, round(r, 9) AS ill_duration_seg_ratio, passes, route FROM routed",
    "route_lines": rf"WITH {_AUDIT} SELECT route, song_id || '.json' || chr(9) || total_seg_num || chr(9) || is_duration_ill_cnt || chr(9) || printf('%.4f', r) AS line FROM routed",
    "corpus_totals": f"WITH {_SONGS} SELECT lang_type, CAST(sum(number) AS BIGINT) AS number, round(sum(total_dur), 1) AS total_dur FROM songs_rate GROUP BY lang_type",
    "duration_histogram": f"""WITH {_RATED}, h AS (SELECT least(CAST(floor(e - s) AS BIGINT), 29) AS bin, count(*) AS n FROM rated WHERE coalesce(is_lyric, true) AND lang_type IS NOT NULL AND e - s > 0 GROUP BY 1)
SELECT range AS bin, coalesce(n, 0) AS "count" FROM range(30) LEFT JOIN h ON range = bin""",
    "duration_summary": f"""WITH {_RATED}, l AS (SELECT CAST(round((e - s) * 1000) AS BIGINT) AS ms FROM rated WHERE coalesce(is_lyric, true) AND lang_type IS NOT NULL) SELECT count(*) AS n, min(ms) AS least_ms, max(ms) AS most_ms, CAST(sum(ms) AS BIGINT) AS total_ms FROM l WHERE ms > 0""",
    "clean_laughter": rf"""WITH {_LAST}, c AS (SELECT segment_id, text, {_trim(_QUIET)} AS b FROM last_rows),
k AS (SELECT segment_id, text, CASE WHEN lower(regexp_replace(b, '[\[\].]', '', 'g')) = 'noise' THEN '[noise]' ELSE b END AS cleaned FROM c) SELECT segment_id, text AS text_ori, cleaned, cleaned <> text AS is_modified FROM k WHERE cleaned <> ''""",
}
