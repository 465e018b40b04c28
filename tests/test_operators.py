"""Operators on small rows: borders of their rules, and brute force."""

import math
import random
from statistics import median

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strophe.functions import text as T
from strophe.operators import chunks, folds, models, pairing, rates, speakers, timeline, vectors
from strophe.operators.batch_calls import by_speaker
from strophe.operators.current import current_rows
from strophe.operators.intervals import IntervalMap, continuous_periods, interval_gaps
from strophe.operators.keyed import whole_groups
from strophe.operators.medians import group_medians
from strophe.operators.sample import bounded_sample
from strophe.operators.spikes import ChartRules, flag_spikes, run_lengths
from strophe.sources import readers


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_current_rows_take_the_latest_and_settle_ties(spark):
    df = spark.createDataFrame([(1, 1, "old"), (1, 2, "b"), (1, 2, "a"), (2, None, "x"), (None, 1, "u"), (None, 1, "v"), (None, 1, "v")], "id int, at int, t string")
    assert rows_of(current_rows(df, "id", "at", t="t"), "id", "t") == [(1, "b"), (2, "x"), (None, "u"), (None, "v")]


def test_whole_groups_hold_a_group_over_batches():
    import pyarrow as pa

    batches = [pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array(v)], ["k", "v"]) for k, v in (([1, 1], [1, 2]), ([1, 2], [3, 4]), ([2, None], [5, 6]), ([None], [7]))]
    out = [(t["v"].to_pylist(), s.tolist()) for t, s in whole_groups(batches, ["k"])]
    groups = [v[a:b] for v, s in out for a, b in zip(s, [*s[1:], len(v)], strict=True)]
    assert groups == [[1, 2, 3], [4, 5], [6, 7]]


def test_bounded_sample_keeps_small_tables_whole(spark):
    df = spark.range(100)
    assert bounded_sample(df, ["id"], 100).count() == 100
    assert 20 <= bounded_sample(spark.range(10_000), ["id"], 100).count() <= 300


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 60), st.integers(-3, 20)), max_size=40))
def test_interval_map_against_points(pairs):
    kept = IntervalMap()
    for a, n in pairs:
        kept.add(a, a + n)
    covered = {p for a, n in pairs for p in range(a, a + n)}
    assert {p for a, b in zip(kept.starts, kept.ends, strict=True) for p in range(a, b)} == covered
    assert all(b < c for b, c in zip(kept.ends, kept.starts[1:], strict=False))


def _gaps(spans):
    good = sorted((s, e) for s, e in spans if s is not None and e is not None and e > s)
    out, reach = [], None
    for s, e in good:
        if reach is not None and s > reach:
            out.append((reach, s))
        reach = max(reach, e) if reach is not None else e
    return out


def test_gaps_and_periods_against_a_loop_over_buckets(spark):
    random.seed(4)
    data = []
    for key in "abcdefgh":
        for _ in range(random.choice([1, 3, 30, 60])):
            s = random.randrange(0, 400)
            data.append((key, s, random.choice([None, s, s - 3, s + random.randrange(1, 12), s + random.randrange(1, 150)])))
    data += [("z", 5, 9), ("z", 5, 9), ("y", None, 7), ("n", -20, -10), ("n", -5, 3)]
    df = spark.createDataFrame(data, "k string, s long, e long")
    for bucket in (7, 64, 10_000):
        want = sorted((k, a, b) for k in {d[0] for d in data} for a, b in _gaps([d[1:] for d in data if d[0] == k]))
        assert rows_of(interval_gaps(df, "k", "s", "e", None, bucket), "k", "gap_from", "gap_to") == sorted(want, key=str)
        periods = []
        for k in {d[0] for d in data}:
            kept = IntervalMap()
            for d in data:
                if d[0] == k and d[1] is not None and d[2] is not None:
                    kept.add(d[1], d[2])
            periods += [(k, a, b) for a, b in zip(kept.starts, kept.ends, strict=True)]
        assert rows_of(continuous_periods(df, "k", "s", "e", bucket), "k", "period_from", "period_to") == sorted(periods, key=str)
    assert rows_of(interval_gaps(df, "k", "s", "e", 1, 64), "k") == sorted(((k,) for k, a, b in want if b - a <= 1), key=str)


def test_run_lengths():
    nan = math.nan
    assert run_lengths(np.array([1, 1, nan, nan, nan, 2, 2.0]), np.array([0, 0, 0, 0, 0, 0, 1])).tolist() == [2, 2, 3, 3, 3, 1, 1]


def test_spikes_limits_and_stuck_values_over_blocks(spark):
    random.seed(1)
    data, want = [], {}
    for song in ("long", "short"):
        n = 900 if song == "long" else 40
        for i in range(n):
            v = 0.3 * math.exp(random.uniform(-0.4, 0.4))
            if i % 37 == 5:
                v, want[song, i] = v * 9, "spike"
            elif i % 41 == 6:
                v, want[song, i] = v / 9, "spike"
            elif i % 97 == 7:
                v, want[song, i] = random.choice([0.0, -1.0, math.nan, math.inf]), "limit"
            data.append((song, i, v, f"{song}{i}"))
    for i in range(398, 404):  # a run across the border of two blocks
        data[i] = ("long", i, 0.31, f"long{i}")
        want["long", i] = "stuck"
    for i in range(20, 24):  # four equal values are no run
        data[900 + i] = ("short", i, 0.3, f"short{i}")
        want.pop(("short", i), None)
    data.append(("short", 500, None, "none"))
    df = spark.createDataFrame(data, "song string, no int, v double, id string")
    found = flag_spikes(df, "song", "no", "v", F.lit(True), "id", ChartRules(block=400, context=50))
    assert {(r.song, int(r.id.lstrip("longshrt"))): r.reason for r in found.collect()} == want
    assert not flag_spikes(df.limit(0), "song", "no", "v", F.lit(True), "id").count()


@pytest.mark.parametrize(("text", "words", "characters", "family", "label"), [
    ("[verse] a b c", 3, 0, "western", "verse"), ("[]", 0, 0, "western", None), ("", 0, 0, "western", None), ("[x]", 0, 0, "western", "x"), ("don't", 2, 0, "western", None),
    ("　你好　", 2, 2, "cjk", None), ("한국 말", 2, 3, "cjk", None), ("ไทย", 3, 3, "cjk", None), ("かな", 2, 2, "cjk", None), ("éà", 1, 0, "western", None), ("!!!", 1, 0, "western", None), (None, None, None, None, None),
])
def test_text_counts(spark, text, words, characters, family, label):
    t = F.col("t")
    row = spark.createDataFrame([(text,)], "t string").select(T.count_words(t), T.count_characters(t), F.when(t.isNotNull(), T.language_family(t)), T.bracket_label(t)).first()
    assert tuple(row) == (words, characters, family, label)


def test_text_forms(spark):
    t = F.col("t")
    row = spark.createDataFrame([("中文ab, It's 中 ",)], "t string").select(T.normalize_spoken(t), T.count_mixed(t), T.without_punctuation(t)).first()
    assert tuple(row) == ("中 文ab it's 中", 5, "中文abIts中")
    got = spark.createDataFrame([("Laughter, hi   there",), ("[noise]",), ("laughter!",)], "t string").select(T.clean_laughter(t)).collect()
    assert [r[0] for r in got] == ["hi there", "[noise]", ""]


def test_singers(spark):
    p = F.col("p")
    rows = spark.createDataFrame([("/x/A、B - t.flac.json",), ("/x/ - t.mp3.json",), ("/x/only.json",), ("/x/A - b - c.wav",)], "p string").select(T.singer_text(p), T.singers(p)).collect()
    assert [tuple(r) for r in rows] == [("A、B", ["A", "B"]), ("", []), ("only", ["only"]), ("A", ["A"])]


def test_lrc_marks_restart_and_odd_lines(spark):
    lines = ["[ti:x]", "﻿[00:01]a", "[00:05.50][01:00]b c", "[00:20]", "[00:50]d", "[00:40]e", "[00:29.9]f", "[00:31]g"]
    df = spark.createDataFrame([("s", i, x) for i, x in enumerate(lines)], "song_id string, line_no int, raw string")
    got = [(r.line_no, r.start, r.text, r.strange) for r in readers.lrc_rows(df).orderBy("line_no", "tag_no").collect()]
    assert got == [(1, 1.0, "a", False), (2, 5.5, "b c", False), (2, 60.0, "b c", False), (4, 50.0, "d", False), (5, 40.0, "e", False), (6, 29.9, "f", True), (7, 31.0, "g", True)]


def test_gap_fill_borders(spark):
    seg = [("a", 0, "x", 1.4, 3.0), ("a", 1, "y", 4.5, 6.0), ("a", 2, "z", 7.499, 7.799), ("a", 3, "q", 8.0, 8.299), ("b", 0, "s", 0.0, 0.2)]
    songs = [("a", 9.2), ("b", 1.5), ("c", 1.4)]
    got = rows_of(timeline.fill_gaps(spark.createDataFrame(seg, "song_id string, seg_no int, text string, start double, end double"), spark.createDataFrame(songs, "song_id string, audio_length double")), "song_id", "start_ms", "end_ms", "text")
    assert got == [("a", 1400, 3000, "x"), ("a", 3000, 4500, ""), ("a", 4500, 7499, "y"), ("a", 7499, 9200, "z"), ("b", 0, 1500, "")]


def test_overlap_ties_sums_and_misses(spark):
    seg = spark.createDataFrame([("a", 0, 0.0, 4.0), ("a", 1, 4.0, 10.0), ("a", 2, 20.0, 21.0)], "song_id string, seg_no int, start double, end double")
    stt = spark.createDataFrame([("a", "V", 0.0, 2.0), ("a", "c", 2.0, 4.0), ("a", "x", 4.0, 5.0), ("a", "y", 5.0, 7.5), ("a", "x", 7.5, 9.5), (("a"), None, 9.5, 10.0)], "song_id string, label string, start double, end double")
    assert rows_of(timeline.overlap_labels(seg, stt), "seg_no", "label", "overlap_ms") == [(0, "v", 2000), (1, "x", 3000)]


def test_rates_borders(spark):
    def seg(i, n, length, lyric=True):
        return ("s", i, " ".join(["w"] * n), 100.0 * i, 100.0 * i + length, lyric)

    schema = "song_id string, seg_no int, text string, start double, end double, is_lyric boolean"
    data = [seg(i, 4, 2.0 + 0.01 * i) for i in range(9)] + [seg(9, 4, 40.0), seg(10, 30, 2.0), seg(11, 2, 0.0), seg(12, 2, 3.0, False)]
    rated = rates.with_rates(spark.createDataFrame(data, schema))
    got = {r.lang_type: r for r in rates.song_rates(rated).collect()}
    kept = [2.0 + 0.01 * i for i in range(9)]
    assert got["western"].number == 36 and math.isclose(got["western"].average_duration, sum(kept) / 36)
    flagged = {r.seg_no: r for r in rates.with_ill_flags(rated).collect()}
    assert [i for i, r in flagged.items() if r.is_duration_ill] == [9, 10] or sorted(i for i, r in flagged.items() if r.is_duration_ill) == [9, 10]
    reset = rates.reset_slow(rates.with_ill_flags(rated))
    parts = {(r.seg_no, r.part_no): r for r in reset.collect()}
    assert parts[9, 0].reset_end_time and parts[9, 1].text == "" and parts[9, 0].end == parts[9, 1].start and (10, 1) not in parts
    audit = rates.song_audit(reset).first()
    assert (audit.total_seg_num, audit.is_duration_ill_cnt, audit.passes, audit.route) == (13, 2, False, "reset/filtered_out")
    # All equal: the deviation is zero and nothing is kept.
    same = rates.song_rates(rates.with_rates(spark.createDataFrame([seg(i, 4, 2.0) for i in range(3)], schema))).first()
    assert (same.number, same.average_duration) == (0, 0.0)
    assert median(kept) > 0


def test_speakers(spark):
    rows = [("a", i, s, float(i), i + 1.0, "t") for i, s in enumerate(["x", "x", "y_OUTLIER", "x", None, "z"] + ["x"] * 5)] + [("b", 0, None, 0.0, 1.0, "t")]
    df = spark.createDataFrame(rows, "song_id string, seg_no int, speaker string, start double, end double, text string")
    assert rows_of(speakers.effective_speakers(df), "song_id", "speakers") == [("a", 1), ("b", 0)]
    assert {r.seg_no: r.speaker_no for r in speakers.relabel_by_appearance(df).collect()} == {0: 0, 1: 0, 2: 1, 3: 0, 5: 2, **{i: 0 for i in range(6, 11)}}
    assert speakers.speaker_histogram(df).first().counts == "Speaker x: 8, Speaker z: 1"
    assert speakers.talk_quality(df).first().turns == 5


def test_pairs(spark):
    paths = ["/a/x.WAV", "/a/x.flac", "/a/x.lrc", "/b/x.lyric.json", "/a/y.v1.mp3", "/a/y.v1.lrc", "/a/z.mp3", "/a/w.lrc", "/a/none", "/a/x2.flac"]
    df = spark.createDataFrame(list(enumerate(paths)), "position int, path string")
    got = {r.stem: (r.audio_path, r.lyric_path) for r in pairing.pair_files(df).collect()}
    assert got == {"x": ("/a/x.flac", "/b/x.lyric.json"), "y.v1": ("/a/y.v1.mp3", "/a/y.v1.lrc"), "z": ("/a/z.mp3", None), "w": (None, "/a/w.lrc"), "x2": ("/a/x2.flac", None)}
    assert tuple(pairing.pair_counts(pairing.pair_files(df)).first()) == (4, 3, 2, 2, 1)


def test_manifest_lines_keep_their_index(spark):
    raw = ['{"audio_path":"a","lyric_path":"l"}', "", "  ", "{broken", '{"audio_path":"b"}', '{"audio_path":"c","lyric_path":"m","language":"en"}']
    df = spark.createDataFrame(list(enumerate(raw)), "line_no int, raw string")
    assert [(r.idx, r.audio_path, r.problem) for r in pairing.manifest_slice(df, 1, 3).orderBy("idx").collect()] == [(1, None, "malformed"), (2, "b", "missing key"), (3, "c", None)]


def test_merged_lines(spark):
    rows = [("s", 0, "v", "a", 0.0, 5.0, 0), ("s", 1, "v", "b.", 5.0, 15.0, 0), ("s", 2, "v", "c", 15.0, 15.1, 1), ("s", 3, "c", "", 16.0, 17.0, 2), ("s", 4, None, "d", 17.0, 18.0, 3), ("s", 5, None, "e", 18.0, 19.0, 3), ("s", 6, None, "", 18.5, 19.5, 3), (None, 0, "x", "y", 0.0, 1.0, 0)]
    df = spark.createDataFrame(rows, "song_id string, seg_no int, label string, rest string, start double, end double, chunk_no long")
    got = rows_of(folds.merged_lines(df, "song_id"), "song_id", "text", "start", "end", "merged_count")
    assert got == sorted([("s", "[v] a. b.", 0.0, 15.0, 2), ("s", "[v] c", 15.0, 15.1, 1), ("s", "[c] ", 16.0, 17.0, 1), ("s", "d. e", 17.0, 19.5, 3), (None, "[x] y", 0.0, 1.0, 1)], key=str)


def _chunks(rows, limit):
    """Chunk of each (origin, reach, hard) by the rule as it is said."""
    out, number, now = [], -1, None
    for origin, reach, hard in rows:
        if now is None or hard or reach is not None and reach - now > limit:
            now, number = origin, number + 1
        out.append(number)
    return out


@pytest.mark.parametrize("width", [3, 50, 10**6])
def test_chunks_over_blocks_against_a_loop(spark, width):
    random.seed(12)
    rows, want = [], []
    for key in ("a", "b", "c", None):
        t, own = 0.0, []
        for _ in range(random.choice([1, 40, 150])):
            t += random.choice([0.0, 1.0, 2.5, 30.0])
            own.append((t, random.choice([None, t, t + random.random() * 12, t + 1, t - 3]), random.random() < 0.05))
        rows += [(key, i, o, r, h) for i, (o, r, h) in enumerate(own)]
        want += [(key, i, n) for i, n in enumerate(_chunks(own, 10.0))]
    df = spark.createDataFrame(rows, "k string, i int, o double, r double, h boolean").repartition(3)
    got = chunks.greedy_chunks(df, "k", ["o", "i"], F.floor(F.col("o") / width), F.col("o"), F.col("r"), 10.0, F.col("h"))
    assert rows_of(got, "k", "i", "chunk_no") == sorted(want, key=str)
    sums = chunks.running_sum(df, "k", ["i"], F.col("i"), F.floor(F.col("i") / 7))
    assert all(r.sum_after == r.i * (r.i + 1) / 2 and r.sum_before == r.sum_after - r.i for r in sums.collect())
    assert chunks.greedy_chunks(df.limit(0), "k", ["o"], F.lit(0), F.col("o"), F.col("r"), 1.0).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(-2, 9), st.booleans()), min_size=1, max_size=30), st.integers(-5, 0))
def test_summaries_of_blocks_lead_on(steps, before):
    """What a block says of any chunk open at its start is what a loop over its rows gives."""
    t, rows = 0, []
    for step, ahead, hard in steps:
        t += step
        rows.append((float(t), float(t + ahead), hard and ahead > 6))
    origin, reach, hard = (np.array(x) for x in zip(*rows, strict=True))
    seen, opens, counts = chunks._summary(origin, reach, hard, 4.0)
    now, number = float(before), 0
    for o, r, h in rows:
        if h or r - now > 4.0:
            now, number = o, number + 1
    hit = next((k for k, s in enumerate(seen) if s - before > 4.0), None)
    assert (now, number) == ((float(before), 0) if hit is None else (opens[hit], counts[hit]))


def test_medians_of_groups(spark):
    random.seed(2)
    rows = [(random.choice(["a", "b", "c", None]), random.choice([None, float("nan"), 1.0, 1.0, random.gauss(0, 3)])) for _ in range(700)] + [("one", 5.0)]
    got = {r.k: r.median for r in group_medians(spark.createDataFrame(rows, "k string, x double"), ["k"], "x").collect()}
    want = {k: median(x for key, x in rows if key == k and x is not None and x == x) for k in {k for k, _ in rows}}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_chunks_lose_and_repeat_nothing():
    rows = [("verse", "[verse]", "one", 0.0, 6.0), ("chorus", "[chorus]", "two", 6.0, 8.0), ("verse", "[verse]", "three", 8.0, 10.0)]
    for given_rows in (rows, [rows[0], rows[1], ("verse", "[verse]", "three", 8.5, 10.0)]):
        words = "\t".join(r[0].partition("] ")[2] for r in folds.chunk_lyrics(iter(given_rows), mode=1)).split("\t")
        assert sorted(words) == ["one", "three", "two"]
    random.seed(3)
    for _ in range(200):
        t, rows = 0.0, []
        for i in range(random.randrange(1, 25)):
            length = random.choice([0.5, 2.0, 4.0, 7.0])
            label = random.choice(["v", "c", None])
            rows.append((label, f"[{label}]" if label else "", random.choice([f"w{i}", ""]), t, t + length))
            t += length
        for mode in (1, 2, 3):
            out = list(folds.chunk_lyrics(iter(rows), mode=mode))
            assert sorted(x for r in out for x in r[0].replace("\t", " ").split() if x[0] == "w") == sorted(r[2] for r in rows if r[2])
            assert all(a[2] <= b[1] + 1e-9 for a, b in zip(out, out[1:], strict=False))


def test_short_wordless_chunk_is_split():
    rows = [("v", "", "a", 0.0, 5.0), ("v", "", "", 5.0, 6.5), ("c", "", "b", 6.5, 10.0)]
    assert [r[1:3] for r in folds.chunk_lyrics(iter(rows), mode=3)] == [(0.0, 5.5), (5.5, 10.0)]
    assert [r[1:3] for r in folds.chunk_lyrics(iter(rows), mode=2)] == [(0.0, 5.0), (5.0, 6.0), (6.0, 10.0)]


def test_batches(spark):
    def batches(talk, longest):
        df = spark.createDataFrame([("x", i, s, a, b) for i, s, a, b in talk], "f string, seg_no int, speaker string, start double, end double")
        return [r.batch_id for r in sorted(by_speaker(df, "f", longest).collect(), key=lambda r: r.seg_no)]

    talk = [(i, s, 10.0 * i, 10.0 * i + 10) for i, s in enumerate("aabbbbccccccaaaabb")]
    assert batches(talk, 60.0) == [0] * 6 + [1] * 6 + [2] * 6
    assert batches(talk[:14], 60.0) == [0] * 6 + [1] * 8
    assert batches(talk[:3], 600.0) == [0] * 3


def test_tidy_boundaries_and_speech():
    marks = [(0.0, "a"), (0.5, "b"), (5.0, "b"), (50.0, "c"), (90.0, "c"), (95.0, "d"), (95.5, "end")]
    assert list(folds.tidy_boundaries(iter(marks))) == [(0.0, "b"), (50.0, "c"), (95.5, "end")]
    assert list(folds.tidy_boundaries(iter(marks[:2]))) == marks[:2]
    speech = [(1, 1, None, "a", 0.0, 2.0), (1, 2, 0.9, "b", 2.5, 5.0), (3, 3, 0.9, "c", 5.1, 9.0), (4, 4, 0.0, "d", 9.2, 9.5)]
    assert list(folds.merge_speech(iter(speech))) == [("a b", 0.0, 5.0, 2), ("c d", 5.1, 9.5, 2)]


def test_adjusted_bounds(spark):
    rows = [("a", 0, 0.1, 1.0), ("a", 1, 1.6, 3.0), ("a", 2, 5.0, 6.0), ("a", 3, 5.5, 7.0)]
    df = spark.createDataFrame(rows, "song_id string, seg_no int, start double, end double")
    got = {r.seg_no: (round(r.new_from, 3), round(r.new_to, 3)) for r in timeline.adjust_bounds(df).collect()}
    assert got == {0: (0.0, 1.3), 1: (1.3, 3.5), 2: (4.5, 5.5), 3: (5.5, 7.2)}
    voiced = spark.createDataFrame([("a", 2.9, 5.1)], "song_id string, start double, end double")
    got = {r.seg_no: (round(r.new_from, 3), round(r.new_to, 3)) for r in timeline.adjust_bounds(df, voiced).collect()}
    assert got[1] == (1.3, 4.0) and got[2] == (4.0, 5.5)


def test_clusters(spark):
    plan = vectors.merge_plan([3, 1, 2], np.array([[0.0, 2.0], [1.0, 0.0], [10.0, 1.0]]), np.array([1, 1, 10]), 0.7)
    assert plan == {3: 3, 1: 1, 2: 1}
    df = spark.createDataFrame([(0, 1, [1.0, 0.0]), (0, 1, [1.0, 0.1]), (0, 2, [0.9, 0.05]), (0, 3, [0.0, 1.0]), (1, 3, [0.0, 1.0])], "k int, l int, v array<double>")
    assert rows_of(vectors.merge_clusters(df, "k", "l", "v"), "k", "l", "merged_label") == [(0, 1, 1), (0, 2, 1), (0, 3, 3), (1, 3, 3)]
    zero = spark.createDataFrame([([0.0], [1.0]), (None, [1.0])], "a array<double>, b array<double>").select(vectors.cosine(F.col("a"), F.col("b"))).collect()
    assert [r[0] for r in zero] == [None, None]


def test_neighbours_and_runs_over_buckets(spark):
    from strophe.operators.neighbours import time_bucket, with_neighbours, with_run_numbers

    random.seed(9)
    data = [(k, float(random.randrange(300)), i, random.choice("xy")) for k in "abc" for i in range(80)] + [("a", None, 99, "x"), (None, 1.0, 0, "x"), (None, 2.0, 1, "x")]
    df = spark.createDataFrame(data, "k string, start double, no int, v string")
    rows = with_neighbours(df, "k", ["start", "no"], ["start", "no", "v"], time_bucket(seconds=20, number="no"))
    runs = with_run_numbers(rows, "k", ["start", "no"], F.col("before").isNull() | (F.col("before.v") != F.col("v")), time_bucket(seconds=20, number="no"))
    got = {(r.k, r.no): (r.before and r.before.no, r.after and r.after.no, r.run_no) for r in runs.collect()}
    want = {}
    for k in {d[0] for d in data}:
        own = sorted((d for d in data if d[0] == k), key=lambda d: (d[1] is not None, d[1] or 0, d[2]))
        run = 0
        for i, d in enumerate(own):
            run += i == 0 or own[i - 1][3] != d[3]
            want[k, d[2]] = (own[i - 1][2] if i else None, own[i + 1][2] if i + 1 < len(own) else None, run)
    assert got == want


@pytest.mark.parametrize("lines", [1, 7, 21, 500])
def test_each_line_has_one_job(spark, lines, tmp_path):
    from strophe.plans import songs

    df = spark.range(lines).withColumn("total", F.lit(lines))
    shares = [pairing.even_share(F.col("id"), F.col("total"), job, 3).cast("int") for job in range(3)]
    assert {r[0] for r in df.select(shares[0] + shares[1] + shares[2]).collect()} == {1}
    spark.range(lines).select(F.col("id").alias("line_no"), F.lit("{}").alias("raw")).union(spark.sql("SELECT 9999L, ' '")).write.parquet(str(tmp_path / "manifest.parquet"))
    each = -(-lines // 3)
    got = {r.idx: r.mine for r in songs.shards(spark, str(tmp_path)).collect()}
    assert got == {i: i // each == 1 for i in range(lines)}


def test_prompts_are_all_searched(spark, small, tmp_path):
    from strophe.plans import folding
    from tests.oracle import assert_same

    cosine = "list_dot_product(e.v, p.v) / (sqrt(list_dot_product(e.v, e.v)) * sqrt(list_dot_product(p.v, p.v)))"
    assert_same(spark, small, folding.prompt_scores, f"WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings) SELECT e.vec_id, round(max({cosine}), 5) AS prompt_score FROM e CROSS JOIN e p WHERE p.vec_id % 20 = 0 GROUP BY e.vec_id")
    rng = np.random.default_rng(1)
    rows = [(i, rng.standard_normal(3).tolist()) for i in range(1200)] + [(1200, None), (1201, [0.0, 0.0, 0.0]), (1202, [1.0, None, 1.0]), (1203, [1.0])]
    df = spark.createDataFrame(rows, "id int, v array<double>")
    m = np.array([v for _, v in rows[:1200]])
    unit = m / np.linalg.norm(m, axis=1, keepdims=True)
    for block in (500, 65_536):
        got = {r.id: r.prompt_score for r in vectors.prompt_likeness(df, "v", df.filter("id % 1203 > 50"), "v", block).collect()}
        assert np.allclose([got[i] for i in range(1200)], (unit @ unit[51:].T).max(axis=1)) and {got[i] for i in (1200, 1201, 1202, 1203)} == {None}
    assert {r.prompt_score for r in vectors.prompt_likeness(df, "v", df.filter("id < 0"), "v").collect()} == {None}


def test_sentences_of_all_documents(spark, small):
    from strophe.plans import songs
    from tests.oracle import assert_same

    words = r"SELECT doc_id AS item, generate_subscripts(l, 1) - 1 AS i, unnest(l) AS word FROM (SELECT doc_id, regexp_split_to_array(text, '[\s\x{0b}]+') AS l FROM documents)"
    closed = "SELECT *, coalesce(regexp_matches(lag(word) OVER (PARTITION BY item ORDER BY i), '[.!?]$'), false) AS k FROM w"
    numbered = "SELECT *, sum(k::INT) OVER (PARTITION BY item ORDER BY i ROWS UNBOUNDED PRECEDING) AS sentence_no FROM c"
    sql = f"""WITH w AS ({words}), c AS ({closed}), s AS ({numbered}) SELECT item, CAST(sentence_no AS BIGINT) AS sentence_no, md5(string_agg(word, ' ' ORDER BY i)) AS digest, min(i)::DOUBLE AS "start", max(i)::DOUBLE + 1 AS "end" FROM s GROUP BY ALL"""
    assert_same(spark, small, songs.sentences_of_words, sql)


def test_bounds_see_the_voice_activity(spark, tmp_path):
    from strophe.plans import songs

    vad = spark.createDataFrame([("a", 0, 50.0, 71.0, str([1] * 84)), ("a", 1, 51.0, 53.1, "[0, 1, 1, 0, 0, 1, 0, 1, 1]"), ("a", 2, 1.0, 2.0, None), ("a", 3, 1.0, 2.0, "no")], "song_id string, seg_no int, start double, end double, vad_res string")
    assert rows_of(timeline.voiced_stretches(vad), "start", "end") == [(50.0, 71.0), (51.25, 51.75), (52.25, 52.5), (52.75, 53.1)]
    rows = [(i, "a", i, "t", s, e, True, None, 1) for i, (s, e) in enumerate([(50.0, 71.0), (51.0, 53.1), (61.1, 62.0), (80.0, 81.0)])]
    seg = spark.createDataFrame(rows, "segment_id long, song_id string, seg_no int, text string, start double, end double, is_lyric boolean, speaker string, loaded_at int")
    seg.write.parquet(str(tmp_path / "segments.parquet"))
    vad.write.parquet(str(tmp_path / "vad.parquet"))
    got = {r.seg_no: (r.new_from, r.new_to) for r in songs.boundary_adjust(spark, str(tmp_path)).collect()}
    assert got[1][1] == got[2][0] == 57.1 and got[2][1] == 62.5 and got[3][0] == 79.5


def test_overlaps_of_hot_songs_are_cut_into_buckets(spark):
    random.seed(6)
    seg = [(random.choice("ab"), i, a, random.choice([None, a - 1, a + random.random() * 300])) for i in range(80) for a in [random.random() * 900]] + [("a", 80, 0.0, 1e9)]
    sts = [(random.choice("ab"), i, random.choice(["Verse", "chorus", None]), a, a + random.random() * 200) for i in range(40) for a in [random.random() * 900]]
    ms = lambda x: None if x is None else round(x * 1000)
    want = []
    for song, no, a, b in seg:
        if b is None or ms(b) <= ms(a):
            continue
        total, first = {}, {}
        for other, _, label, u, v in sts:
            ov = min(ms(b), ms(v)) - max(ms(a), ms(u))
            if song == other and label and ov > 0:
                total[label.lower()] = total.get(label.lower(), 0) + ov
                first[label.lower()] = min(ms(u), first.get(label.lower(), 10**12))
        if total:
            label = max(total, key=lambda x: (total[x], -first[x], x))
            want.append((song, no, label, total[label]))
    got = timeline.overlap_labels(spark.createDataFrame(seg, "song_id string, seg_no int, start double, end double"), spark.createDataFrame(sts, "song_id string, st_no int, label string, start double, end double"), 60_000)
    assert rows_of(got, "song_id", "seg_no", "label", "overlap_ms") == sorted(want, key=str)


def test_labels_are_put_back_and_lists_zipped(spark):
    seg = spark.createDataFrame([("s", i) for i in range(5)], "song_id string, seg_no int")
    found = spark.createDataFrame([("s", 1, "7"), ("s", 3, "2_OUTLIER"), ("s", 4, "7_OUTLIER"), ("s", 4, "7")], "song_id string, seg_no int, label string")
    assert rows_of(speakers.put_back(seg, found), "seg_no", "speaker_no") == [(0, None), (1, 0), (2, None), (3, 1), (4, 0)]
    rows = spark.createDataFrame([([1, 2], ["a", "b"]), ([1], ["a", "b"]), (None, ["a"])], "x array<int>, y array<string>").select(timeline.zipped(F.col("x"), F.col("y")).alias("z"))
    assert [r.z and [tuple(p) for p in r.z] for r in rows.collect()] == [[(1, "a"), (2, "b")], None, None]


def test_clusters_over_chunks(spark):
    random.seed(1)
    centers = np.eye(4)[:3]
    rows = [("s", i, (centers[i % 3] + np.array([random.gauss(0, 0.05) for _ in range(4)])).tolist(), i // 20) for i in range(60)] + [("s", 60, None, 2)]
    df = spark.createDataFrame(rows, "key string, vec_id int, v array<double>, chunk_no int")
    got = {r.vec_id: r.label for r in vectors.cluster_in_chunks(df, "key", "v", vectors.nearest_first(0.5)).collect()}
    assert len(got) == 60 and len(set(got.values())) == 3 and all(got[i] == got[i % 3] for i in got)
    labels = spark.createDataFrame([("s", 0, 5), ("s", 0, 9), ("s", 1, 5), ("s", 1, None)], "key string, chunk_no int, label int")
    assert rows_of(vectors.offset_labels(labels, "key", "chunk_no", "label"), "chunk_no", "label", "chunk_label") == [(0, 5, 0), (0, 9, 1), (1, 5, 2), (1, None, None)]
    table = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0005, 1.0])], "label int, center array<double>")
    assert vectors.similarity_table(table, "label").first().likeness == 0.0  # 0.0005 goes to the even digit


def test_errors_stay_with_their_rows(spark):
    out = models.map_or_null(spark.createDataFrame([(1,), (0,)], "n int"), lambda r: {"inverse": 1 / r["n"]}, "inverse double")
    assert sorted(((r.inverse, r.error and r.error.split(":")[0]) for r in out.collect()), key=str) == [(1.0, None), (None, "ZeroDivisionError")]
    assert models.voice_detector("energy")(np.zeros(1600), 16_000) == []
    with pytest.raises(KeyError):
        models.voice_detector("none")


def test_paths_of_songs(spark, tmp_path):
    (tmp_path / "d").mkdir()
    for name, text in (("a", '{"audio_path": "a.flac", "segments": [{"text": "x"}]}'), ("b", '{"audio_path": "b.flac", "segments": []}'), ("c", '{"segments": [{"text": "x"}]}'), ("d", '{"audio_path": "d.flac", "segments": [{"text": "y"}]}')):
        (tmp_path / "d" / f"{name}.json").write_text(text)
    lines = tmp_path / "list.scp"
    lines.write_text("\n".join(f"{tmp_path}/d/{n}.json" for n in ("a", "", "b", "c", "d") if n) + "\n\n")
    assert [r.audio_path for r in readers.read_listed_songs(spark, str(lines)).orderBy("audio_path").collect()] == ["a.flac", "d.flac"]
    assert [r.audio_path for r in readers.read_listed_songs(spark, str(lines), 1, 3).collect()] == ["d.flac"]
    assert readers.song_paths(spark, str(tmp_path / "d")).count() == readers.song_paths(spark, str(lines)).count() == 4
    assert readers.song_paths(spark, f"{tmp_path}/d/a.json").count() == 1
    with pytest.raises(FileNotFoundError):
        readers.song_paths(spark, f"{tmp_path}/none")
    paths = spark.createDataFrame([("/x/Error_1.json",), ("/x/b.json",), (None,)], "path string")
    good, bad = pairing.without_errors(paths)
    assert good.count() == 2 and bad.count() == 1
    assert pairing.one_at_random(paths, "path", 3).collect() == pairing.one_at_random(paths.repartition(3), "path", 3).collect()
