"""Queries of the problems tagged llm, each over its whole tables with production parameters."""

from __future__ import annotations

import unicodedata

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strophe.llm.fillers import SEEDS
from strophe.llm.language import fit_languages, label_code, with_languages
from strophe.llm.leaks import find_leaks
from strophe.llm.markup import SPEAKER_WORDS
from strophe.llm.packing import pack_texts
from strophe.llm.sentences import find_sentences
from strophe.llm.skeleton import look_alike_pairs, look_classes, skeleton, skeletons
from strophe.llm.splitting import split_long
from strophe.llm.turns import TurnRules, alias_numbers, boundary_chances, fit_boundaries, fit_fillers, read_segments, speaker_turns
from strophe.operators.current import current_rows
from strophe.session import cut_lineage, table


_FAMILY = {"de": "western", "en": "western", "es": "western", "fr": "western", "ru": "western", "ja": "cjk", "ko": "cjk", "th": "cjk", "zh": "cjk"}


def _languages(spark: SparkSession, sf_dir: str, kept: list[str], texts: bool = False) -> DataFrame:
    raw = table(spark, sf_dir, "segments")
    numbers = alias_numbers(table(spark, sf_dir, "voices"), TurnRules().aliases)
    aliases, fillers = frozenset(numbers), fit_fillers(raw, numbers)
    model = fit_languages(raw, aliases, fillers)
    columns = {c: c for c in ("song_id", "text", "lang_type", "is_lyric") if c in kept or c == "text"}
    return with_languages(current_rows(raw, "segment_id", "loaded_at", **columns), kept, model, aliases, fillers, texts)


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments whose language is missing, wrong or not the only one, with the language of each stretch."""
    found = _languages(spark, sf_dir, ["segment_id", "lang_type", "is_lyric"]).filter("is_lyric is distinct from false and enough")
    code = label_code(F.col("lang_type"))
    family = F.element_at(F.create_map(*[F.lit(x) for pair in _FAMILY.items() for x in pair]), F.col("lang"))
    wrong = code.isNull() | ((code != F.col("lang")) & (code != family)) | F.col("mixed")
    return found.filter(wrong).select("segment_id", "lang").distinct()


def p1_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every segment with words: its language, or the languages of its stretches, with confidences."""
    return _languages(spark, sf_dir, ["segment_id", "song_id"], texts=True).select("segment_id", "song_id", "stretch_no", "part", "lang", "confidence")


def p1_songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every song's main language: the one of most stretches, weighted by confidence, with its share. Of equal ones the first by name."""
    weight = _languages(spark, sf_dir, ["segment_id", "song_id"]).groupBy("song_id", "lang").agg(F.sum("confidence").alias("w"))
    top = F.max(F.struct(F.round("w", 6).alias("w"), (-F.ascii("lang")).alias("o"), (-F.ascii(F.substring("lang", 2, 1))).alias("o2"), "lang"))
    return weight.groupBy("song_id").agg(top.alias("m"), F.sum("w").alias("all")).select("song_id", F.col("m.lang").alias("lang"), F.try_divide("m.w", "all").alias("confidence"))


def _read_talk(spark: SparkSession, sf_dir: str, with_text: bool) -> DataFrame:
    """Current segments of all songs but music, with their labels read. Texts are read before the shuffle, so that they needn't move."""
    rules = TurnRules()
    segments = table(spark, sf_dir, "segments")
    aliases = alias_numbers(table(spark, sf_dir, "voices"), rules.aliases)
    read = read_segments(segments, aliases, fit_fillers(segments, aliases, rules), with_text)
    names = [c for c in read.columns if c not in ("segment_id", "loaded_at")]
    current = current_rows(read, "segment_id", "loaded_at", **{c: c for c in names})
    songs = current_rows(table(spark, sf_dir, "songs"), "song_id", "loaded_at", media="media")
    return current.join(songs.filter("media = 'music'").select("song_id"), "song_id", "left_anti")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = cut_lineage(_read_talk(spark, sf_dir, with_text=False))
    return speaker_turns(read, fit_boundaries(read))


def p4_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The turns with their clean text, in parts of half an hour."""
    read = cut_lineage(_read_talk(spark, sf_dir, with_text=True))
    return speaker_turns(read, fit_boundaries(read), with_text=True)


def p4_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How likely the speaker changes at each spoken segment, whether it has a label or not."""
    read = cut_lineage(_read_talk(spark, sf_dir, with_text=False))
    return boundary_chances(read, fit_boundaries(read))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    segments = current_rows(table(spark, sf_dir, "segments"), "segment_id", "loaded_at", song_id="song_id", text="text")
    return look_alike_pairs(segments, "song_id", "segment_id", "text").select(F.col("row_a").alias("segment_a"), F.col("row_b").alias("segment_b"))


def p5_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The skeleton and the one readable form of each current segment text."""
    segments = current_rows(table(spark, sf_dir, "segments"), "segment_id", "loaded_at", text="text")
    return skeletons(segments, "segment_id", "text")


def p5_looks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The looks of each song's lines, with their numbers of rows and spellings."""
    segments = current_rows(table(spark, sf_dir, "segments"), "segment_id", "loaded_at", song_id="song_id", text="text")
    return look_classes(segments, "song_id", "segment_id", "text")


def p5_varied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many looks each song's lines have, how many rows and spellings those have together, and how many looks have several spellings."""
    return p5_looks(spark, sf_dir).groupBy("song_id").agg(F.count("*").alias("looks"), F.sum("rows").alias("rows"), F.sum("spellings").alias("spellings"), F.count_if(F.col("spellings") > 1).alias("varied"))


def p6_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of every long segment."""
    columns = {c: c for c in ("song_id", "seg_no", "start", "end")}
    long = F.when(F.col("end") - F.col("start") > 30, F.col("text"))  # no other text need move
    segments = current_rows(table(spark, sf_dir, "segments"), "segment_id", "loaded_at", **columns, text=long)
    return split_long(segments, table(spark, sf_dir, "vad"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = p6_pieces(spark, sf_dir).groupBy("segment_id").agg(F.max(F.when(F.col("cut_kind") == "forced", 1).otherwise(0)).alias("forced"))
    return kinds.select("segment_id", F.when(F.col("forced") == 1, "forced").otherwise("natural").alias("cut_kind"))


def p6_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What holds for the pieces of every long segment: they reach from its start to its end, none is too long, and each later one overlaps the one before by half a second."""
    rows = p6_pieces(spark, sf_dir).groupBy("segment_id").agg(F.min("from_ms").alias("from_ms"), F.max("to_ms").alias("to_ms"), F.max(F.col("to_ms") - F.col("from_ms")).alias("most"), F.sum(F.col("to_ms") - F.col("from_ms")).alias("all"), F.count("*").alias("n"))
    overlaps = F.col("all") - (F.col("n") - 1) * 500 == F.col("to_ms") - F.col("from_ms")
    return rows.select("segment_id", "from_ms", "to_ms", (F.col("most") <= 30_000).alias("fits"), overlaps.alias("overlaps"))


def p7_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The container of each document, or of each piece of a document longer than a container."""
    return pack_texts(table(spark, sf_dir, "documents"), "doc_id", "text")


def p7_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What holds for the containers: how many documents are placed, containers over their capacity, and documents cut though they would fit."""
    placed = cut_lineage(p7_pack(spark, sf_dir).select("doc_id", "container", "tokens"))
    over = placed.groupBy("container").agg(F.sum("tokens").alias("n")).agg(F.count_if(F.col("n") > 2048).alias("over"))
    pieces = placed.groupBy("doc_id").agg(F.sum("tokens").alias("n"), F.count("*").alias("pieces"))
    docs = pieces.agg(F.count("*").alias("documents"), F.count_if((F.col("pieces") > 1) & (F.col("n") <= 2048)).alias("cut"))
    return docs.join(over, F.lit(True)).filter("documents > 0").select("documents", "over", "cut")


def p8_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the items that leaked into them, whole or reworded, with the share of the item and where to look."""
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p8_leaks(spark, sf_dir).filter("kind = 'verbatim'").select("doc_id", "item_id")


def _names(spark: SparkSession, sf_dir: str) -> frozenset[str]:
    return frozenset(alias_numbers(table(spark, sf_dir, "voices"), TurnRules().aliases))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_sentences(table(spark, sf_dir, "documents"), _names(spark, sf_dir))


def p9_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sentence of every document, with its number, position and text."""
    return find_sentences(table(spark, sf_dir, "documents"), _names(spark, sf_dir), with_text=True)


QUERIES = {"p9_found": p9_found, "p9_sentences": p9_sentences, "p8_found": p8_found, "p8_leaks": p8_leaks, "p6_found": p6_found, "p6_pieces": p6_pieces, "p6_audit": p6_audit, "p7_pack": p7_pack, "p7_audit": p7_audit, "p5_looks": p5_looks, "p5_varied": p5_varied, "p1_found": p1_found, "p1_segments": p1_segments, "p1_songs": p1_songs, "p4_found": p4_found, "p4_turns": p4_turns, "p4_boundaries": p4_boundaries, "p5_found": p5_found, "p5_forms": p5_forms}
_LAST = "last_rows AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY segment_id ORDER BY loaded_at DESC) AS rn FROM segments) WHERE rn = 1)"



def _looks(text: str) -> str:
    """SQL of the skeleton of a text, composed: each character by a table of those whose skeleton is another one, from the blocks of letters, marks, spaces and forms of other widths."""
    blocks = ((0x7F, 0x600), (0x0E33, 0x0E34), (0x115F, 0x1161), (0x13A0, 0x1400), (0x1680, 0x1681), (0x180B, 0x1810), (0x1D00, 0x2070), (0x2100, 0x2190), (0x2C80, 0x2D00), (0x2E80, 0x3001), (0x3164, 0x3165), (0xA4D0, 0xA500), (0xFB00, 0xFB07), (0xFE00, 0xFE10), (0xFEFF, 0xFF00), (0xFF01, 0xFFFC))
    table = [(chr(c), unicodedata.normalize("NFC", skeleton(chr(c)))) for a, b in blocks for c in range(a, b)]
    table = [(a, b) for a, b in table if a != b and unicodedata.normalize("NFC", a) == a]
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    looks = f"MAP([{', '.join(quoted(a) for a, _ in table)}], [{', '.join(quoted(b) for _, b in table)}])"
    return f"CASE WHEN regexp_matches({text}, '[^\\x00-\\x7f]') THEN nfc_normalize(array_to_string(list_transform(regexp_extract_all(nfc_normalize({text}), '(?s).'), lambda x: coalesce({looks}[x], x)), '')) ELSE replace({text}, chr(9), ' ') END"


# Marks around the words of a line, for an engine whose patterns know no look-around. Labels, names and notes as in markup.
_TIME = r"(?:\[\d{1,3}:\d{2}(?:[:.,]\d+)*\]|\(\d{1,3}:\d{2}(?:[:.,]\d+)*\)|<\d+(?:\.\d+)?s>|\d{1,2}:\d{2}:\d{2}(?:[.,]\d{1,3})?(?:\s*-->\s*\d{1,2}:\d{2}:\d{2}(?:[.,]\d{1,3})?)?)"
_ONE = r"(?:[a-zà-öø-ɏа-я]{1,14}|[\x{3040}-\x{9fff}\x{ac00}-\x{d7af}]{1,4}|[\x{0e00}-\x{0e7f}]{1,10})"
_NOTE = rf"(?:\[[^\[\]]*\]|[(（]{_ONE}[)）]|<[^\W\d_]{{2,14}}>|\*[^*\n]{{1,30}}\*|[♪♫♬]+)"
_CALLED = "(?:" + "|".join(sorted(SPEAKER_WORDS, key=lambda w: (-len(w), w))) + ")"
_CALLED_SQL = _CALLED.replace("спикер", "(?:спикер|cпикep|cпикер)")


def _turns_sql() -> str:
    seeds = "[" + ", ".join("'" + " ".join(x.split()) + "'" for x in sorted(SEEDS)) + "]"
    key = lambda x: rf"trim(regexp_replace({x}, '[,，、;；.。…!?！？\s]+', ' ', 'g'))"
    seed = f"list_transform({seeds}, lambda x: {_looks('x')})"
    return rf"""WITH RECURSIVE {_LAST}, music AS (SELECT song_id FROM (SELECT song_id, media, row_number() OVER (PARTITION BY song_id ORDER BY loaded_at DESC) AS k FROM songs) WHERE k = 1 AND media = 'music'),
names AS (SELECT trim(lower({_looks('alias')})) AS name, min(speaker_no) AS no FROM voices GROUP BY 1), seeds AS (SELECT {seed} AS fillers),
talk AS (SELECT segment_id, song_id, seg_no, "start", is_lyric, lower({_looks("coalesce(text, '')")}) AS t, trim(regexp_replace(lower({_looks("coalesce(speaker, '')")}), '\s+', ' ', 'g')) AS sp FROM last_rows ANTI JOIN music USING (song_id)),
lead AS (SELECT segment_id, t AS rest, CAST(NULL AS INT) AS who, false AS done FROM talk
UNION ALL SELECT segment_id, CASE WHEN stop THEN rest ELSE substr(rest, 1 + length(hit)) END, coalesce(who, label), stop FROM (
    SELECT segment_id, rest, who, hit, label, hit = '' OR (label IS NOT NULL AND who IS NOT NULL) OR (name IS NOT NULL AND label IS NULL AND NOT regexp_matches(hit, '^\s*\[')) AS stop FROM (
    SELECT a.*, coalesce(CAST(nullif(regexp_extract(hit, '^\s*\[?{_CALLED_SQL}[\s_\-]*(\d{{1,3}})(?:\]|\s*[:：]|\s+-\s)', 1), '') AS INT), no) AS label FROM (
    SELECT *, CASE WHEN NOT regexp_matches(hit, '^\s*{_TIME}') THEN nullif(coalesce(nullif(regexp_extract(hit, '^\s*\[([^\s:：\[\]()<>*♪]{{2,30}})\]', 1), ''), regexp_extract(hit, '^\s*([^\s:：\[\]()<>*♪]{{2,30}})(?:\s*[:：]|\s+-\s)', 1)), '') END AS name FROM (
    SELECT segment_id, rest, who, regexp_extract(rest, '^\s*(?:{_TIME}|>>|\[{_CALLED_SQL}[\s_\-]*\d{{1,3}}\]|\[[^\s:：\[\]()<>*♪]{{2,30}}\]|{_CALLED_SQL}[\s_\-]*\d{{1,3}}(?:\s*[:：]|\s+-\s)|[^\s:：\[\]()<>*♪]{{2,30}}(?:\s*[:：]|\s+-\s)|{_NOTE})\s*') AS hit FROM lead WHERE NOT done)) a LEFT JOIN names ON names.name = a.name))),
said AS (SELECT segment_id, who, regexp_replace(rest, '{_TIME}|{_NOTE}', ' ', 'g') AS words FROM lead WHERE done),
units AS (SELECT segment_id, who, list_filter(list_transform(regexp_extract_all(words, '[^,，、]+'), lambda u: {key('u')}), lambda u: regexp_matches(u, '[\p{{L}}\p{{N}}]')) AS u FROM said),
read AS (SELECT t.*, coalesce(u.who, n.no, CAST(nullif(regexp_extract(sp, '^(?:{_CALLED_SQL})?[\s_\-]*(\d{{1,4}})(?:\.0*)?(?:_outlier)?$', 1), '') AS INT)) AS who, is_lyric IS DISTINCT FROM false AND len(list_filter(u.u, lambda x: NOT list_contains(fillers, x) AND len(list_filter(string_split(x, ' '), lambda p: NOT list_contains(fillers, p))) > 0)) > 0 AS spoken FROM talk t JOIN units u USING (segment_id) LEFT JOIN names n ON n.name = sp CROSS JOIN seeds),
said_by AS (SELECT *, last_value(who IGNORE NULLS) OVER w AS now, row_number() OVER w AS i FROM read WHERE spoken WINDOW w AS (PARTITION BY song_id ORDER BY "start" NULLS FIRST, seg_no ROWS UNBOUNDED PRECEDING)),
runs AS (SELECT *, sum(new) OVER (PARTITION BY song_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS turn FROM (SELECT *, CASE WHEN i = 1 OR now IS DISTINCT FROM lag(now) OVER (PARTITION BY song_id ORDER BY i) THEN 1 ELSE 0 END AS new FROM said_by))
SELECT song_id, arg_min(seg_no, i) AS first_seg_no, arg_max(seg_no, i) AS last_seg_no, any_value(now) AS speaker_no FROM runs GROUP BY song_id, turn"""


ORACLE: dict[str, str] = {
    "p4_found": _turns_sql(),
    "p5_found": f"WITH {_LAST}, k AS (SELECT segment_id, song_id, text, {_looks('text')} AS look FROM last_rows WHERE text IS NOT NULL AND song_id IS NOT NULL) SELECT a.segment_id AS segment_a, b.segment_id AS segment_b FROM k a JOIN k b ON a.song_id = b.song_id AND a.look = b.look AND a.segment_id < b.segment_id AND a.text <> b.text",
    "p5_varied": f"WITH {_LAST}, k AS (SELECT song_id, text, {_looks('text')} AS look FROM last_rows WHERE text IS NOT NULL AND song_id IS NOT NULL), c AS (SELECT song_id, look, count(*) AS rows, count(DISTINCT text) AS spellings FROM k GROUP BY ALL) SELECT song_id, count(*) AS looks, CAST(sum(rows) AS BIGINT) AS rows, CAST(sum(spellings) AS BIGINT) AS spellings, count_if(spellings > 1) AS varied FROM c GROUP BY song_id",
    "p6_audit": f"""WITH {_LAST}, long AS (SELECT segment_id, CAST(round("start" * 1000) AS BIGINT) AS s, CAST(round("end" * 1000) AS BIGINT) AS e FROM last_rows) SELECT segment_id, s AS from_ms, e AS to_ms, true AS fits, true AS overlaps FROM long WHERE e - s > 30000""",
    "p7_audit": "SELECT count(*) AS documents, CAST(0 AS BIGINT) AS over, CAST(0 AS BIGINT) AS cut FROM documents HAVING count(*) > 0",
    # Pauses of each list, then the furthest cut inside one again and again.
    "p6_found": f"""WITH RECURSIVE {_LAST}, long AS (SELECT segment_id, song_id, seg_no, CAST(round("start" * 1000) AS BIGINT) AS s, CAST(round("end" * 1000) AS BIGINT) AS e FROM last_rows),
voice AS (SELECT segment_id, s, e, regexp_replace(regexp_replace(vad_res, '\\.0*', '', 'g'), '[^01]', '', 'g') AS bits FROM long LEFT JOIN vad USING (song_id, seg_no) WHERE e - s > 30000),
value AS (SELECT segment_id, s, e, unnest(generate_series(1, length(bits))) AS i, bits FROM voice),
silent AS (SELECT segment_id, s, e, i, i - row_number() OVER (PARTITION BY segment_id ORDER BY i) AS island FROM value WHERE bits[i] = '0'),
pause AS (SELECT segment_id, s + (min(i) - 1) * 250 AS a, least(s + max(i) * 250, e - 1) AS b FROM silent GROUP BY segment_id, s, e, island HAVING count(*) >= 2),
lists AS (SELECT segment_id, list({{'a': a, 'b': b}}) AS p FROM pause WHERE a <= b GROUP BY segment_id),
step AS (SELECT segment_id, s AS now, e, p FROM voice LEFT JOIN lists USING (segment_id)
    UNION ALL SELECT segment_id, cut - 500, e, p FROM (SELECT *, list_max(list_transform(list_filter(p, lambda x: x.a <= now + 30000 AND least(x.b, now + 30000) > now + 500), lambda x: least(x.b, now + 30000))) AS cut FROM step WHERE e - now > 30000) WHERE cut IS NOT NULL)
SELECT segment_id, CASE WHEN min(e - now) <= 30000 THEN 'natural' ELSE 'forced' END AS cut_kind FROM step GROUP BY segment_id""",
}
