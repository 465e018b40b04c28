"""Queries over songs, files, structure, voice activity and speakers."""

from __future__ import annotations

from pyspark.sql import functions as F

from strophe.functions import text as T
from strophe.operators import pairing as P
from strophe.operators import speakers as S
from strophe.operators import timeline as L
from strophe.operators.current import current_rows
from strophe.plans import lyrics
from strophe.plans.lyrics import _LAST, _RESET, segments_now
from strophe.session import table
from strophe.sources.readers import lrc_rows


def songs_now(spark, d):
    return current_rows(table(spark, d, "songs"), "song_id", "loaded_at", audio_path="audio_path", audio_length="audio_length", media="media")


def lrc_parse_restart(spark, d):
    return lrc_rows(table(spark, d, "lrc_line")).select("song_id", "line_no", "tag_no", F.round("start", 3).alias("start"), "text", "strange")


def manifest_slice(spark, d):
    return P.manifest_slice(table(spark, d, "manifest"), 20, 150)


def _paths(spark, d):
    """Audio and lyric paths of songs and manifest lines as one list."""
    parsed = P.manifest_slice(table(spark, d, "manifest"), 0).filter("problem is null")
    lyrics = parsed.select(F.col("lyric_path").alias("path"), (F.col("idx") * 2).alias("position"))
    audio = parsed.select(F.col("audio_path").alias("path"), (F.col("idx") * 2 + 1).alias("position"))
    more = songs_now(spark, d).select(F.col("audio_path").alias("path"), F.lit(10**9).cast("long").alias("position"))
    return lyrics.unionByName(audio).unionByName(more).filter("path is not null")


def best_audio_pair(spark, d):
    return P.pair_files(_paths(spark, d))


def pair_counts(spark, d):
    return P.pair_counts(P.pair_files(_paths(spark, d)))


def audio_by_stem(spark, d):
    return P.all_pairs_by_stem(_paths(spark, d).select("path").distinct())


def missing_songs(spark, d):
    """Songs without any lyric line."""
    return P.not_done(songs_now(spark, d).select("song_id"), table(spark, d, "lrc_line"), ["song_id"])


def resumed_songs(spark, d):
    """Songs whose lyric lines exist."""
    return P.only_done(songs_now(spark, d).select("song_id", "media"), table(spark, d, "lrc_line"), ["song_id"])


def output_paths(spark, d):
    p = F.col("audio_path")
    return songs_now(spark, d).select("song_id", P.mirrored_path(p, "/vault", "/out").alias("mirrored"), P.merged_name(p, 10).alias("merged"), P.diarized_name(p).alias("diarized"), P.part_path(p, "vocals").alias("vocals"), T.kept_path(p).alias("kept"), T.file_stem(p).alias("stem"), T.file_suffix(p).alias("suffix"))


def singer_parse(spark, d):
    p = F.col("audio_path")
    return songs_now(spark, d).select("song_id", T.singer_text(p).alias("singer"), F.array_join(T.singers(p), "|").alias("singers"), F.size(T.singers(p)).alias("n"), T.diarized_singer_text(p).alias("diarized_singer"))


def top_singers(spark, d):
    rows = songs_now(spark, d).select(F.explode(T.singers(F.col("audio_path"))).alias("singer"))
    return rows.groupBy("singer").agg(F.count("*").alias("songs")).orderBy(F.desc("songs"), "singer").limit(10)


def singer_totals(spark, d):
    n = F.size(T.singers(F.col("audio_path")))
    return songs_now(spark, d).groupBy(F.least(n, F.lit(2)).alias("singers")).agg(F.count("*").alias("songs"))


def vad_windows(spark, d):
    return L.vad_windows(segments_now(spark, d, "song_id", "seg_no", "start"), songs_now(spark, d))


def gap_fill(spark, d):
    return L.fill_gaps(segments_now(spark, d), songs_now(spark, d))


def short_segments(spark, d):
    return L.short_segments(segments_now(spark, d, "song_id", "seg_no", "start", "end")).select("segment_id")


def continuity(spark, d):
    return L.continuity(segments_now(spark, d), songs_now(spark, d))


def end_time_audit(spark, d):
    return L.end_time_audit(segments_now(spark, d), songs_now(spark, d))


def overlap_label(spark, d):
    return L.overlap_labels(segments_now(spark, d), table(spark, d, "structures"))


def label_runs(spark, d):
    return L.label_runs(table(spark, d, "structures"), songs_now(spark, d))


def vad_consistency(spark, d):
    rows = L.voice_audit(segments_now(spark, d), table(spark, d, "vad"))
    return rows.withColumn("share", F.round("share", 6))


def length_report(spark, d):
    return L.length_report(segments_now(spark, d))


def song_durations(spark, d):
    last = segments_now(spark, d).groupBy("song_id").agg(F.max_by("end", F.struct("start", "seg_no")).alias("last_end"))
    ms = F.round(F.coalesce("audio_length", "last_end", F.lit(0.0)) * 1000).cast("long")
    rows = songs_now(spark, d).join(last, "song_id", "left").select("media", ms.alias("ms"))
    return rows.groupBy("media").agg(F.count("*").alias("songs"), F.sum("ms").alias("total_ms"), F.min("ms").alias("least_ms"), F.max("ms").alias("most_ms"))


def effective_speakers(spark, d):
    return S.effective_speakers(segments_now(spark, d))


def speaker_classes(spark, d):
    return S.speaker_classes(S.effective_speakers(segments_now(spark, d)))


def speaker_histogram(spark, d):
    return S.speaker_histogram(segments_now(spark, d))


def speaker_relabel(spark, d):
    return S.relabel_by_appearance(segments_now(spark, d))


def speaker_runs(spark, d):
    return S.same_speaker_runs(segments_now(spark, d)).select("song_id", "run_no", "speaker", "first_seg", "last_seg")


def turn_stats(spark, d):
    return S.talk_quality(segments_now(spark, d))


def narrow_dump(spark, d):
    return S.narrow_dump(segments_now(spark, d))


def boundary_adjust(spark, d):
    rows = L.adjust_bounds(segments_now(spark, d), L.voiced_stretches(table(spark, d, "vad")))
    return rows.select("song_id", "seg_no", F.round("new_from", 4).alias("new_from"), F.round("new_to", 4).alias("new_to"))


def context_pad(spark, d):
    rows = L.pad_context(segments_now(spark, d), songs_now(spark, d))
    return rows.select("song_id", "seg_no", F.round("padded_from", 4).alias("padded_from"), F.round("padded_to", 4).alias("padded_to"))


def viewer_rows(spark, d):
    """Rows that can be drawn, with their gravest flag: cut by reset_slow, out of pace, or at odds with the voice activity."""
    rows = lyrics.reset_rows(spark, d).filter("part_no = 0")
    heard = L.voice_audit(segments_now(spark, d), table(spark, d, "vad")).groupBy("song_id", "seg_no").agg(F.bool_or("vad_anomaly").alias("vad_anomaly"))
    return L.viewer_rows(rows.join(heard, ["song_id", "seg_no"], "left"))


def shards(spark, d):
    """Output folder and job of each manifest line."""
    lines = table(spark, d, "manifest")
    total = lines.filter(F.trim("raw") != "").agg(F.count("*").alias("total"))
    rows = P.numbered_lines(lines).crossJoin(F.broadcast(total))
    return rows.select("idx", P.shard(F.col("idx"), 50, 7).alias("shard"), P.even_share(F.col("idx"), F.col("total"), 1, 3).alias("mine"))


def seeded_sample(spark, d):
    """A hundred documents of a seeded shuffle; the limit is the feature."""
    return table(spark, d, "documents").select("doc_id", F.md5(F.concat(F.col("doc_id").cast("string"), F.lit("/42"))).alias("h")).orderBy("h", "doc_id").limit(100).select("doc_id")


def sentences_of_words(spark, d):
    """Words of all documents put together again as sentences."""
    rows = table(spark, d, "documents").select(F.col("doc_id").alias("item"), F.posexplode(F.split("text", r"\s+")).alias("word_no", "word"))
    return L.words_to_sentences(rows).select("item", F.col("sentence_no").cast("long").alias("sentence_no"), F.md5("sentence").alias("digest"), "start", "end")


def long_segments(spark, d):
    return L.over_length(segments_now(spark, d, "song_id", "seg_no", "start", "end"))


def speaker_class_list(spark, d):
    """The songs with no, one, and two or more speakers, in order."""
    rows = S.effective_speakers(segments_now(spark, d))
    return rows.select(F.least("speakers", F.lit(2)).alias("class"), "song_id").orderBy("class", "song_id")


def singer_files(spark, d):
    """Each singer text with its songs, how many singers it names, and how many songs it has."""
    p = F.col("audio_path")
    rows = songs_now(spark, d).select(T.singer_text(p).alias("singer"), F.size(T.singers(p)).alias("n"), "song_id", T.file_stem(p).alias("stem"))
    return rows.join(rows.groupBy("singer").agg(F.count("*").alias("songs")), "singer").select("singer", "n", "song_id", "stem", "songs")


def top_multi_singers(spark, d):
    """The ten texts of several singers with most songs."""
    p = F.col("audio_path")
    rows = songs_now(spark, d).filter(F.size(T.singers(p)) > 1).select(T.singer_text(p).alias("singer"))
    return rows.groupBy("singer").agg(F.count("*").alias("songs")).orderBy(F.desc("songs"), "singer").limit(10)


def orphans(spark, d):
    """Songs that segments, voice activity or sections name but the table of songs doesn't have, and lyric lines of songs without segments."""
    songs, segments = songs_now(spark, d), segments_now(spark, d, "song_id")
    found = P.orphans(songs, {"segments": segments, "vad": table(spark, d, "vad"), "structures": table(spark, d, "structures")}, ["song_id"])
    return found.unionByName(P.orphans(segments, {"lrc_line": table(spark, d, "lrc_line"), "songs": songs}, ["song_id"]))


def metadata_of_songs(spark, d):
    """Songs with what the manifest says of their audio file: of several lines the last."""
    lines = P.last_by_key(P.manifest_slice(table(spark, d, "manifest"), 0).filter("problem is null").withColumn("stem", T.file_stem(F.col("audio_path"))).select("stem", "idx", "lyric_path", "language"), "stem", "idx")
    return songs_now(spark, d).select("song_id", T.file_stem(F.col("audio_path")).alias("stem")).join(lines, "stem").select("song_id", "stem", "lyric_path", "language")


def diarized_back(spark, d):
    """Speakers of the segments that were diarized (those with a label), put back on all segments."""
    rows = segments_now(spark, d, "song_id", "seg_no", "speaker")
    return S.put_back(rows.select("song_id", "seg_no"), rows.filter("speaker is not null"), "speaker")


def voice_verdict(spark, d):
    """Whether all segments of a song agree with their voice activity."""
    return L.song_verdict(L.voice_audit(segments_now(spark, d), table(spark, d, "vad")))


def clean_paths(spark, d):
    """Paths with an "error" in them, and others."""
    good, bad = P.without_errors(_paths(spark, d))
    return good.select("path", F.lit(False).alias("wrong")).unionByName(bad.select("path", F.lit(True).alias("wrong"))).distinct()


def zipped_lists(spark, d):
    """Section labels and starts of each song side by side."""
    order = F.struct("start", "st_no", "label")
    rows = table(spark, d, "structures").groupBy("song_id").agg(F.array_sort(F.collect_list(order)).alias("r"))
    pairs = rows.select("song_id", F.posexplode(L.zipped(F.transform("r", lambda x: x["label"]), F.transform("r", lambda x: x["start"]))).alias("place", "z"))
    return pairs.select("song_id", "place", F.col("z.a").alias("label"), F.col("z.b").alias("start"))


QUERIES = {
    f.__name__: f
    for f in (
        lrc_parse_restart, manifest_slice, best_audio_pair, pair_counts, audio_by_stem, missing_songs, resumed_songs, output_paths, singer_parse, top_singers, singer_totals, vad_windows,
        gap_fill, short_segments, continuity, end_time_audit, overlap_label, label_runs, vad_consistency, length_report, song_durations, effective_speakers, speaker_classes,
        speaker_histogram, speaker_relabel, speaker_runs, turn_stats, narrow_dump, boundary_adjust, context_pad, viewer_rows, shards, seeded_sample, sentences_of_words,
        long_segments, speaker_class_list, singer_files, top_multi_singers, orphans, metadata_of_songs, diarized_back, voice_verdict, clean_paths, zipped_lists,
    )
}

_SONGS = "songs_now AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY song_id ORDER BY loaded_at DESC) AS rn FROM songs) WHERE rn = 1)"
_TIMES = f"""{_LAST}, {_SONGS}, t AS (SELECT segment_id, song_id, seg_no, text, speaker, "start", "end", CAST(round("start" * 1000) AS BIGINT) AS s, CAST(round("end" * 1000) AS BIGINT) AS e FROM last_rows)"""
_JSON = r"""lines AS (SELECT line_no, raw, row_number() OVER (ORDER BY line_no) - 1 AS idx FROM manifest WHERE trim(raw) <> ''),
parsed AS (SELECT idx, CASE WHEN json_valid(raw) THEN raw END AS j FROM lines),
fields AS (SELECT idx, json_extract_string(j, '$.audio_path') AS audio_path, json_extract_string(j, '$.lyric_path') AS lyric_path, json_extract_string(j, '$.language') AS language,
    CASE WHEN j IS NULL THEN 'malformed' WHEN json_extract_string(j, '$.audio_path') IS NULL OR json_extract_string(j, '$.lyric_path') IS NULL THEN 'missing key' END AS problem FROM parsed)"""
_STEM = r"regexp_replace(regexp_extract(path, '([^/]*)/*$', 1), '(.)\.[^.]*$', '\1')"
_SUFFIX = r"lower(regexp_extract(regexp_extract(path, '([^/]*)/*$', 1), '.(\.[^.]*)$', 1))"
_FORMATS = "[" + ", ".join(f"'{x}'" for x in P.AUDIO_FORMATS) + "]"
_PATHS = f"""{_SONGS}, {_JSON}, paths AS (SELECT lyric_path AS path, idx * 2 AS position FROM fields WHERE problem IS NULL UNION ALL SELECT audio_path, idx * 2 + 1 FROM fields WHERE problem IS NULL
UNION ALL SELECT audio_path, 1000000000 FROM songs_now WHERE audio_path IS NOT NULL),
stems AS (SELECT path, position, {_STEM} AS stem, {_SUFFIX} AS suffix FROM paths),
lyr AS (SELECT stem, arg_max(path, position) AS lyric_path FROM stems WHERE path LIKE '%.lrc' GROUP BY stem),
aud AS (SELECT stem, arg_min(path, ROW(list_position({_FORMATS}, suffix), position)) AS audio_path FROM stems WHERE list_position({_FORMATS}, suffix) > 0 GROUP BY stem),
paired AS (SELECT stem, audio_path, lyric_path FROM aud FULL JOIN lyr USING (stem))"""
_SINGER = r"""singer_rows AS (SELECT song_id, trim(string_split(regexp_replace(regexp_extract(audio_path, '([^/]*)/*$', 1), '(\.(flac|mp3|wav|m4a))?\.json$', ''), ' - ')[1]) AS singer FROM songs_now),
singer_lists AS (SELECT song_id, singer, list_filter(list_transform(string_split(singer, '、'), lambda x: trim(x)), lambda x: x <> '') AS l FROM singer_rows)"""
_EFF = f"""{_LAST}, c AS (SELECT song_id, speaker, count(speaker) AS n FROM last_rows GROUP BY ALL), eff AS (SELECT song_id, count_if(n >= 2 AND n >= total * 0.1) AS speakers FROM (SELECT *, sum(n) OVER (PARTITION BY song_id) AS total FROM c) GROUP BY song_id)"""
ORACLE = {
    "lrc_parse_restart": r"""WITH c AS (SELECT song_id, line_no, regexp_replace(replace(replace(raw, chr(160), ' '), chr(65279), ''), '^\s+|\s+$', '', 'g') AS r FROM lrc_line),
p AS (SELECT song_id, line_no, trim(regexp_replace(r, '\[(\d+):(\d+(?:\.\d+)?)\]', '', 'g'), chr(32) || chr(12288) || chr(160)) AS text, list_transform(regexp_extract_all(r, '\[(\d+):(\d+(?:\.\d+)?)\]'), lambda x: CAST(regexp_extract(x, '\[(\d+):', 1) AS INT) * 60 + CAST(regexp_extract(x, ':(\d+(?:\.\d+)?)\]', 1) AS DOUBLE)) AS times FROM c),
k AS (SELECT * FROM p WHERE text <> '' AND len(times) > 0),
j AS (SELECT *, list_min(times) < lag(list_min(times)) OVER (PARTITION BY song_id ORDER BY line_no) - 10 AS jump FROM k),
w AS (SELECT *, min(CASE WHEN jump THEN line_no END) OVER (PARTITION BY song_id) AS cut FROM j)
SELECT song_id, line_no, CAST(unnest(generate_series(0, len(times) - 1)) AS INT) AS tag_no, round(unnest(times), 3) AS "start", text, coalesce(line_no >= cut, false) AS strange FROM w""",
    "manifest_slice": f"WITH {_JSON} SELECT idx, audio_path, lyric_path, language, problem FROM fields WHERE idx >= 20 AND idx < 170",
    "best_audio_pair": f"WITH {_PATHS} SELECT stem, audio_path, lyric_path FROM paired",
    "pair_counts": f"WITH {_PATHS} SELECT count(audio_path) AS audio, count(lyric_path) AS lyrics, count_if(audio_path IS NOT NULL AND lyric_path IS NOT NULL) AS pairs, count_if(lyric_path IS NULL) AS missing_lyric, count_if(audio_path IS NULL) AS missing_audio FROM paired",
    "audio_by_stem": rf"WITH {_PATHS}, u AS (SELECT DISTINCT path, stem FROM stems) SELECT a.stem, a.path AS lyric_path, b.path AS audio_path FROM u a JOIN u b USING (stem) WHERE a.path LIKE '%.lrc' AND regexp_matches(b.path, '\.(wav|flac|mp3)$')",
    "missing_songs": f"WITH {_SONGS} SELECT song_id FROM songs_now WHERE song_id NOT IN (SELECT song_id FROM lrc_line WHERE song_id IS NOT NULL)",
    "resumed_songs": f"WITH {_SONGS} SELECT song_id, media FROM songs_now WHERE song_id IN (SELECT song_id FROM lrc_line)",
    "output_paths": rf"""WITH {_SONGS}, p AS (SELECT song_id, audio_path AS path, regexp_replace(audio_path, '^/vault/', '') AS rel FROM songs_now) SELECT song_id, '/out/' || CASE WHEN regexp_extract(rel, '^(.*)/[^/]*$', 1) = '' THEN 'others' ELSE regexp_extract(rel, '^(.*)/[^/]*$', 1) END || '/' || {_STEM} || '.json' AS mirrored, {_STEM} || '.merged.10s.json' AS merged, {_STEM} || '.diarized.json' AS diarized, {_STEM} || '/vocals.flac' AS vocals, CASE WHEN len(string_split(path, '/')) >= 2 THEN array_to_string(string_split(path, '/')[-2:], '/') ELSE path END AS kept, {_STEM} AS stem, {_SUFFIX} AS suffix FROM p""",
    "singer_parse": rf"WITH {_SONGS}, {_SINGER}, b AS (SELECT song_id, regexp_replace(regexp_extract(audio_path, '([^/]*)/*$', 1), '(\.(flac|mp3|wav|m4a))?\.json$', '') AS b FROM songs_now) SELECT song_id, singer, coalesce(array_to_string(l, '|'), '') AS singers, len(l) AS n, trim(string_split(b, CASE WHEN contains(b, ' - ') THEN ' - ' ELSE '-' END)[1]) AS diarized_singer FROM singer_lists JOIN b USING (song_id)",
    "top_singers": f"WITH {_SONGS}, {_SINGER}, u AS (SELECT unnest(l) AS singer FROM singer_lists) SELECT singer, count(*) AS songs FROM u GROUP BY singer ORDER BY songs DESC, singer LIMIT 10",
    "singer_totals": f"WITH {_SONGS}, {_SINGER} SELECT least(len(l), 2) AS singers, count(*) AS songs FROM singer_lists GROUP BY 1",
    "vad_windows": f"""WITH {_TIMES} SELECT t.song_id, seg_no, t."start" AS window_from, coalesce(lead(t."start") OVER (PARTITION BY t.song_id ORDER BY t."start", seg_no), audio_length) AS window_to FROM t LEFT JOIN songs_now USING (song_id)""",
    "gap_fill": f"""WITH {_TIMES}, kept AS (SELECT song_id, seg_no, text, s, e FROM t WHERE e - s >= 300), len AS (SELECT song_id, CAST(round(audio_length * 1000) AS BIGINT) AS total FROM songs_now WHERE audio_length IS NOT NULL),
r AS (SELECT kept.*, total, coalesce(lag(e) OVER w, 0) AS p, lead(s) OVER w AS n FROM kept JOIN len USING (song_id) WINDOW w AS (PARTITION BY song_id ORDER BY s, seg_no))
SELECT song_id, p AS start_ms, s AS end_ms, '' AS text FROM r WHERE s - p >= 1500 UNION ALL SELECT song_id, s, CASE WHEN coalesce(n, total) - e >= 1500 THEN e ELSE coalesce(n, total) END, text FROM r
UNION ALL SELECT song_id, e, total, '' FROM r WHERE n IS NULL AND total - e >= 1500 UNION ALL SELECT song_id, 0, total, '' FROM len WHERE total >= 1500 AND song_id NOT IN (SELECT song_id FROM kept)""",
    "short_segments": f"""WITH {_LAST} SELECT segment_id FROM last_rows WHERE round(("end" - "start") * 1000) < 300""",
    "continuity": f"""WITH {_TIMES}, g AS (SELECT *, abs("start" - lag("end") OVER (PARTITION BY song_id ORDER BY "start", seg_no)) > 0.01 AS gap FROM t),
f AS (SELECT song_id, (arg_min(seg_no, ROW("start", seg_no)) FILTER (WHERE gap)) AS first_gap_seg, (arg_max("end", ROW("start", seg_no)) FILTER (WHERE "end" IS NOT NULL)) AS le FROM g GROUP BY song_id) SELECT song_id, first_gap_seg, coalesce(le > audio_length + 0.01, false) AS overruns FROM f LEFT JOIN songs_now USING (song_id)""",
    "end_time_audit": f"""WITH {_TIMES}, l AS (SELECT song_id, e AS le FROM (SELECT *, row_number() OVER (PARTITION BY song_id ORDER BY "start" DESC, seg_no DESC) AS k FROM t) WHERE k = 1),
r AS (SELECT songs_now.song_id, CASE WHEN audio_length IS NULL THEN 'no audio_length' WHEN l.song_id IS NULL THEN 'no segments' WHEN le IS NULL THEN 'no end' WHEN abs(round(audio_length * 1000) - le) > 100 THEN 'end differs' END AS reason FROM songs_now LEFT JOIN l USING (song_id)) SELECT * FROM r WHERE reason IS NOT NULL""",
    "overlap_label": f"""WITH {_TIMES}, st AS (SELECT song_id, lower(label) AS label, CAST(round("start" * 1000) AS BIGINT) AS a, CAST(round("end" * 1000) AS BIGINT) AS b FROM structures WHERE label IS NOT NULL),
o AS (SELECT song_id, seg_no, label, CAST(sum(least(e, b) - greatest(s, a)) AS BIGINT) AS ov, min(a) AS f FROM t JOIN st USING (song_id) WHERE a < e AND b > s AND e > s AND b > a GROUP BY ALL)
SELECT song_id, seg_no, label, ov AS overlap_ms FROM (SELECT *, row_number() OVER (PARTITION BY song_id, seg_no ORDER BY ov DESC, f, label DESC) AS k FROM o) WHERE k = 1""",
    "label_runs": rf"""WITH {_SONGS}, n AS (SELECT *, regexp_replace(lower(label), '\d+', '', 'g') AS l, row_number() OVER (PARTITION BY song_id ORDER BY "start", st_no) AS i FROM (SELECT structures.* FROM structures LEFT JOIN songs_now USING (song_id) WHERE coalesce("start" < audio_length, true))), m AS (SELECT *, lag(l) OVER (PARTITION BY song_id ORDER BY "start", st_no) AS p FROM n),
r AS (SELECT *, sum(CASE WHEN i = 1 OR l IS DISTINCT FROM p THEN 1 ELSE 0 END) OVER (PARTITION BY song_id ORDER BY "start", st_no ROWS UNBOUNDED PRECEDING) AS run_no FROM m)
SELECT song_id, CAST(run_no AS BIGINT) AS run_no, any_value(l) AS label, min("start") AS "start", max("end") AS "end" FROM r GROUP BY song_id, run_no""",
    "vad_consistency": rf"""WITH {_LAST}, v AS (SELECT song_id, seg_no, CASE WHEN vad_res LIKE '[%]' AND length(vad_res) > 2 THEN list_transform(string_split(vad_res[2:-2], ','), lambda x: CAST(trim(x) AS DOUBLE)) END AS l FROM vad),
j AS (SELECT song_id, seg_no, coalesce(list_sum(l) / len(l), 0.0) AS share, trim(regexp_replace(text, '\[[^\]]*\]', '', 'g'), chr(32) || chr(12288) || chr(160)) <> '' AS sung FROM last_rows JOIN v USING (song_id, seg_no))
SELECT song_id, seg_no, round(share, 6) AS share, CASE WHEN sung THEN share <= 0.5 ELSE share >= 0.3 END AS vad_anomaly FROM j""",
    "length_report": f"""WITH {_TIMES}, l AS (SELECT *, CAST(round(("end" - "start") * 1000) AS BIGINT) AS ms FROM t) SELECT song_id, max(ms) AS longest_ms, arg_max(seg_no, ROW(ms, -seg_no)) AS longest_seg, min(ms) AS shortest_ms, arg_min(seg_no, ROW(ms, seg_no)) AS shortest_seg, count_if(ms > 30000) AS over FROM l WHERE ms > 0 GROUP BY song_id""",
    "song_durations": f"""WITH {_TIMES}, l AS (SELECT song_id, "end" AS le FROM (SELECT *, row_number() OVER (PARTITION BY song_id ORDER BY "start" DESC, seg_no DESC) AS k FROM t WHERE "end" IS NOT NULL) WHERE k = 1),
m AS (SELECT media, CAST(round(coalesce(audio_length, le, 0) * 1000) AS BIGINT) AS ms FROM songs_now LEFT JOIN l USING (song_id)) SELECT media, count(*) AS songs, CAST(sum(ms) AS BIGINT) AS total_ms, min(ms) AS least_ms, max(ms) AS most_ms FROM m GROUP BY media""",
    "effective_speakers": f"WITH {_EFF} SELECT song_id, speakers FROM eff",
    "speaker_classes": f"""WITH {_EFF} SELECT least(speakers, 2) AS "class", count(*) AS songs FROM eff GROUP BY 1""",
    "speaker_histogram": f"""WITH {_LAST}, c AS (SELECT song_id, speaker, count(*) AS n FROM last_rows WHERE speaker IS NOT NULL AND NOT regexp_matches(speaker, '_OUTLIER$') GROUP BY ALL) SELECT song_id, string_agg('Speaker ' || speaker || ': ' || n, ', ' ORDER BY n DESC, speaker) AS counts FROM c GROUP BY song_id""",
    "speaker_relabel": f"""WITH {_LAST}, f AS (SELECT song_id, speaker, min(seg_no) AS m FROM last_rows WHERE speaker IS NOT NULL GROUP BY ALL), n AS (SELECT *, dense_rank() OVER (PARTITION BY song_id ORDER BY m, speaker) - 1 AS speaker_no FROM f) SELECT song_id, seg_no, CAST(speaker_no AS INT) AS speaker_no FROM last_rows JOIN n USING (song_id, speaker)""",
    "speaker_runs": f"""WITH {_LAST}, m AS (SELECT *, lag(speaker) OVER w AS p, row_number() OVER w AS i FROM last_rows WINDOW w AS (PARTITION BY song_id ORDER BY "start", seg_no)), r AS (SELECT *, sum(CASE WHEN i = 1 OR speaker IS DISTINCT FROM p THEN 1 ELSE 0 END) OVER (PARTITION BY song_id ORDER BY "start", seg_no ROWS UNBOUNDED PRECEDING) AS run_no FROM m)
SELECT song_id, CAST(run_no AS BIGINT) AS run_no, any_value(speaker) AS speaker, arg_min(seg_no, ROW("start", seg_no)) AS first_seg, arg_max(seg_no, ROW("start", seg_no)) AS last_seg FROM r GROUP BY song_id, run_no""",
    "turn_stats": rf"""WITH {_TIMES}, a AS (SELECT song_id, e AS audio_ms FROM (SELECT *, row_number() OVER (PARTITION BY song_id ORDER BY "start" DESC, seg_no DESC) AS k FROM t WHERE e IS NOT NULL) WHERE k = 1),
sp AS (SELECT *, CASE WHEN speaker <> '' THEN regexp_replace(trim(speaker), '_OUTLIER$', '') END AS who FROM t WHERE speaker <> '' AND text NOT LIKE '%<非语音>%' AND e > s),
tu AS (SELECT *, CASE WHEN who IS DISTINCT FROM lag(who) OVER (PARTITION BY song_id ORDER BY "start", seg_no) THEN 1 ELSE 0 END AS turn FROM sp),
pt AS (SELECT song_id, who, sum(e - s) AS ms, sum(turn) AS turns FROM tu GROUP BY ALL), su AS (SELECT *, sum(ms) OVER (PARTITION BY song_id) AS total FROM pt),
q AS (SELECT song_id, CAST(any_value(total) AS BIGINT) AS speech_ms, CAST(sum(turns) AS BIGINT) AS turns, count_if(ms >= total * 0.1) AS num_effective FROM su GROUP BY song_id)
SELECT song_id, speech_ms, audio_ms, turns, num_effective, speech_ms >= audio_ms * 0.6 AND num_effective BETWEEN 1 AND 4 AND speech_ms >= turns * 3000 AS is_valid FROM q JOIN a USING (song_id)""",
    "boundary_adjust": f"""WITH {_LAST}, o AS (SELECT song_id, seg_no, "start" AS a, "end" AS e, lag("end") OVER w AS p, lead("start") OVER w AS n FROM last_rows WHERE "end" > "start" WINDOW w AS (PARTITION BY song_id ORDER BY "start", seg_no))
SELECT song_id, seg_no, round(CASE WHEN p IS NULL THEN greatest(0.0, a - 0.2) WHEN a - p > 1 THEN a - 0.5 WHEN a - p >= 0 THEN a - (a - p) / 2 ELSE a END, 4) AS new_from, round(CASE WHEN n IS NULL THEN e + 0.2 WHEN n - e < 0 THEN n WHEN n - e > 1 THEN e + 0.5 ELSE e + (n - e) / 2 END, 4) AS new_to FROM o""",
    "context_pad": f"""WITH {_LAST}, {_SONGS} SELECT song_id, seg_no, round(greatest(0.0, "start" - (0.2 + CASE WHEN "end" - "start" < 0.5 THEN 0.1 ELSE 0.0 END)), 4) AS padded_from, round(least(coalesce(audio_length, 1e300), "end" + (0.2 + CASE WHEN "end" - "start" < 0.5 THEN 0.1 ELSE 0.0 END)), 4) AS padded_to FROM last_rows LEFT JOIN songs_now USING (song_id) WHERE "end" > "start" """,
    "viewer_rows": rf"""WITH {_RESET}, v AS (SELECT song_id, seg_no, CASE WHEN vad_res LIKE '[%]' AND length(vad_res) > 2 THEN list_transform(string_split(vad_res[2:-2], ','), lambda x: CAST(trim(x) AS DOUBLE)) END AS l FROM vad),
j AS (SELECT song_id, seg_no, bool_or(CASE WHEN trim(regexp_replace(text, '\[[^\]]*\]', '', 'g'), chr(32) || chr(12288) || chr(160)) <> '' THEN coalesce(list_sum(l) / len(l), 0.0) <= 0.5 ELSE coalesce(list_sum(l) / len(l), 0.0) >= 0.3 END) AS odd FROM last_rows JOIN v USING (song_id, seg_no) GROUP BY ALL)
SELECT song_id, seg_no, CASE WHEN reset_end_time THEN 'reset' WHEN ill THEN 'ill' WHEN coalesce(odd, false) THEN 'vad' ELSE 'normal' END AS style FROM parts LEFT JOIN j USING (song_id, seg_no) WHERE part_no = 0 AND s < e""",
    "shards": f"WITH {_JSON} SELECT idx, (idx + 7) // 50 AS shard, idx // CAST(ceil((SELECT count(*) FROM lines) / 3) AS BIGINT) = 1 AS mine FROM lines",
    "seeded_sample": "SELECT doc_id FROM (SELECT doc_id, md5(doc_id || '/42') AS h FROM documents) ORDER BY h, doc_id LIMIT 100",
    "sentences_of_words": r"""WITH w AS (SELECT doc_id AS item, generate_subscripts(l, 1) - 1 AS i, unnest(l) AS word FROM (SELECT doc_id, regexp_split_to_array(text, '[\s\x{0b}]+') AS l FROM documents)),
c AS (SELECT *, coalesce(regexp_matches(lag(word) OVER (PARTITION BY item ORDER BY i), '[.!?]$'), false) AS k FROM w), s AS (SELECT *, sum(k::INT) OVER (PARTITION BY item ORDER BY i ROWS UNBOUNDED PRECEDING) AS sentence_no FROM c)
SELECT item, CAST(sentence_no AS BIGINT) AS sentence_no, md5(string_agg(word, ' ' ORDER BY i)) AS digest, min(i)::DOUBLE AS "start", max(i)::DOUBLE + 1 AS "end" FROM s GROUP BY ALL""",
    "long_segments": f"""WITH {_LAST}, l AS (SELECT song_id, seg_no, CAST(round(("end" - "start") * 1000) AS BIGINT) AS ms FROM last_rows) SELECT * FROM l WHERE ms > 30000""",
    "speaker_class_list": f"""WITH {_EFF} SELECT least(speakers, 2) AS "class", song_id FROM eff""",
    "singer_files": f"WITH {_SONGS}, {_SINGER} SELECT singer, len(l) AS n, song_id, {_STEM.replace('path', 'audio_path')} AS stem, count(*) OVER (PARTITION BY singer) AS songs FROM singer_lists JOIN songs_now USING (song_id)",
    "top_multi_singers": f"WITH {_SONGS}, {_SINGER} SELECT singer, count(*) AS songs FROM singer_lists WHERE len(l) > 1 GROUP BY singer ORDER BY songs DESC, singer LIMIT 10",
    "orphans": f"""WITH {_LAST}, {_SONGS} SELECT DISTINCT 'segments' AS stage, song_id FROM last_rows ANTI JOIN songs_now USING (song_id) UNION ALL SELECT DISTINCT 'vad', song_id FROM vad ANTI JOIN songs_now USING (song_id) UNION ALL SELECT DISTINCT 'structures', song_id FROM structures ANTI JOIN songs_now USING (song_id)
UNION ALL SELECT DISTINCT 'lrc_line', song_id FROM lrc_line ANTI JOIN last_rows USING (song_id) UNION ALL SELECT DISTINCT 'songs', song_id FROM songs_now ANTI JOIN last_rows USING (song_id)""",
    "metadata_of_songs": f"""WITH {_SONGS}, {_JSON}, m AS (SELECT {_STEM.replace('path', 'audio_path')} AS stem, idx, lyric_path, language FROM fields WHERE problem IS NULL), k AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY stem ORDER BY idx DESC) AS r FROM m) WHERE r = 1)
SELECT song_id, stem, lyric_path, language FROM (SELECT song_id, {_STEM.replace('path', 'audio_path')} AS stem FROM songs_now) JOIN k USING (stem)""",
    "diarized_back": f"""WITH {_LAST}, n AS (SELECT song_id, seg_no, replace(speaker, '_OUTLIER', '') AS speaker FROM last_rows WHERE speaker IS NOT NULL), f AS (SELECT song_id, speaker, min(seg_no) AS m FROM n GROUP BY ALL), k AS (SELECT *, dense_rank() OVER (PARTITION BY song_id ORDER BY m, speaker) - 1 AS speaker_no FROM f)
SELECT last_rows.song_id, last_rows.seg_no, CAST(speaker_no AS INT) AS speaker_no FROM last_rows LEFT JOIN (SELECT song_id, seg_no, speaker_no FROM n JOIN k USING (song_id, speaker)) USING (song_id, seg_no)""",
    "voice_verdict": rf"""WITH {_LAST}, v AS (SELECT song_id, seg_no, CASE WHEN vad_res LIKE '[%]' AND length(vad_res) > 2 THEN list_transform(string_split(vad_res[2:-2], ','), lambda x: CAST(trim(x) AS DOUBLE)) END AS l FROM vad),
j AS (SELECT song_id, coalesce(CASE WHEN trim(regexp_replace(text, '\[[^\]]*\]', '', 'g'), chr(32) || chr(12288) || chr(160)) <> '' THEN coalesce(list_sum(l) / len(l), 0.0) <= 0.5 ELSE coalesce(list_sum(l) / len(l), 0.0) >= 0.3 END, false) AS odd FROM last_rows JOIN v USING (song_id, seg_no))
SELECT song_id, count(*) AS segments, count_if(odd) AS anomalies, NOT bool_or(odd) AS total_correct FROM j GROUP BY song_id""",
    "clean_paths": f"WITH {_PATHS} SELECT DISTINCT path, contains(lower(path), 'error') AS wrong FROM paths",
    "zipped_lists": """SELECT song_id, CAST(row_number() OVER (PARTITION BY song_id ORDER BY "start" NULLS FIRST, st_no, label) - 1 AS INT) AS place, label, "start" FROM structures""",
    "narrow_dump": f"WITH {_LAST} SELECT song_id, seg_no, CASE WHEN speaker <> '' THEN speaker ELSE 'N/A' END AS speaker, text FROM last_rows",
}
