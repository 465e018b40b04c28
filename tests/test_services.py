"""Sound, text comparison, service batches, files and streams."""

import json
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strophe.functions import compare, signal
from strophe.operators import batch_calls as B
from strophe.operators import refine, run_modes
from strophe.operators.models import energy_detector, map_sounds
from strophe.operators.refine import RefineRules
from strophe.sources import readers, writers
from strophe.operators.intervals import interval_gaps
from strophe.streaming.intervals import streamed_gaps
from strophe.streaming.manifest import manifest_stream, run_available


def tone(seconds, rate=16_000, level=0.5):
    return level * np.sin(2 * np.pi * 440 * np.arange(int(seconds * rate)) / rate)


def test_energy_voice():
    rate = 16_000
    sound = np.concatenate([tone(2), np.zeros(rate // 2), tone(1), np.zeros(2 * rate), tone(1)])
    (start, end), = energy_detector(sound, rate)
    assert start == 0 and abs(end - 3.5) < 0.1
    assert energy_detector(np.zeros(rate), rate) == [] and energy_detector(np.zeros(0), rate) == []


def test_sound_files_and_levels(spark, tmp_path):
    (tmp_path / "a.wav").write_bytes(signal.write_wave(tone(1), 16_000))
    (tmp_path / "b.wav").write_bytes(b"none")
    files = spark.read.format("binaryFile").load(str(tmp_path))
    rows = {r.path[-5:]: r for r in map_sounds(files, energy_detector).collect()}
    assert abs(rows["a.wav"].end - 1) < 0.05 and rows["b.wav"].error
    assert signal.wave_seconds(signal.write_wave(tone(2), 8000)) == 4.0 and signal.wave_seconds(b"") is None
    loud, factor = signal.to_loudness(tone(1))
    assert abs(20 * math.log10(np.sqrt(np.mean(loud**2))) + 25) < 0.1
    safe, divisor = signal.without_clipping(loud * 100)
    assert np.abs(safe).max() < 1 and np.allclose(signal.restored(safe, factor * 100, divisor), tone(1))
    assert signal.si_snr(tone(1), tone(1)) > 60 > signal.si_snr(tone(1) + 0.1 * np.random.default_rng(0).standard_normal(16_000), tone(1))
    assert len(signal.stretched(np.arange(3), 7)) == 9


def _errors(a, b):
    """Fewest errors, then fewest added words, by the plain recurrence."""
    row = [(j, j) for j in range(len(b) + 1)]
    for i, x in enumerate(a, 1):
        new = [(i, 0)]
        for j, y in enumerate(b, 1):
            new.append(min((row[j - 1][0] + (x != y), row[j - 1][1]), (row[j][0] + 1, row[j][1]), (new[-1][0] + 1, new[-1][1] + 1)))
        row = new
    errors, added = row[-1]
    missing = added + len(a) - len(b)
    return [added, missing, errors - added - missing]


def test_comparison(spark):
    assert compare.comparable("Ｈello, ＷORLD! é") == "helloworldé"
    texts = ["Ｈello, ＷORLD! é", "plain, ASCII 1", "가 각ガ", "", None, "ﬂ²"]
    forms = spark.createDataFrame([(t,) for t in texts], "t string").select(compare.comparable_text("t")).collect()
    assert [r[0] for r in forms] == [t and compare.comparable(t) if t else t for t in texts]
    cases = {"你，好": ["你", "，好"], "如果我 have 一个 banana .": ["如", "果", "我", "have", "一", "个", "banana."], "我love你": ["我", "love", "你"], "你好。": ["你", "好。"], "，": ["，"], "你，，好": ["你", "，，", "好"], "（你）": ["（你）"], "": []}
    got = spark.createDataFrame([(t,) for t in cases], "t string").select("t", compare.mixed_tokens(F.col("t")).alias("x")).collect()
    assert {r.t: r.x for r in got} == cases
    assert compare.character_difference("aab", "abc") == ("a", "c")
    row = spark.createDataFrame([("aab", "abc")], "a string, b string").select(compare.missing_and_extra(F.col("a"), F.col("b")).alias("c")).first().c
    assert (row.missing, row.extra) == (1, 1)


def test_word_errors(spark):
    random.seed(3)
    pairs = [([random.choice("abcd") for _ in range(random.randrange(0, 20))], [random.choice("abcd") for _ in range(random.randrange(0, 20))]) for _ in range(400)]
    assert compare.word_error_counts(pairs, 300).tolist() == [_errors(a, b) for a, b in pairs]
    assert compare.word_error_counts([]).shape == (0, 3)
    rows = [("A, b c d", "a x c d e"), (None, "x"), ("", ""), ("a b c", None), ("same same", "Same, same!"), ("你好", "你 们")]
    got = [r.e for r in spark.createDataFrame(rows, "r string, h string").coalesce(1).select(compare.word_error_rates(F.col("r"), F.col("h")).alias("e")).collect()]
    assert [(e.wer, e.ins, e["del"], e.sub, e.hallucinated) for e in got] == [(0.5, 1, 0, 1, False), (100.0, 100, 0, 0, True), (100.0, 100, 0, 0, True), (1.0, 0, 3, 0, True), (0.0, 0, 0, 0, False), (0.5, 0, 0, 1, False)]
    assert got[1].ins_ratio == 1.0


def test_checked_calls():
    rows = [{"text": "hi you", "speaker": "0"}]
    replies = iter(["no", '```json\n[{"text": "Hi, them."}]\n```', '```\n[{"text": "Hi, you."}]\n```'])
    seen = []

    def client(prompt):
        seen.append(prompt)
        return next(replies)

    result = B.call_checked(rows, B.Punctuate(), client)
    assert result["success"] and result["attempts"] == 3 and "changed words" in seen[-1]
    assert B.Punctuate().apply(result["reply"], rows) == [{"text": "Hi, you.", "speaker": "0", "text_ori_punc": "hi you", "is_modified_punc": True}]

    def broken(prompt):
        raise OSError("429")

    assert B.call_checked(rows, B.LyricCheck(), broken, B.CallRules(calls=2))["error"] == "429"
    number = B.NumberRewrite()
    assert number.check('[{"text": "abc"}]', [{"text": "abcdefghij"}]) == "changed length" and number.check('[{"text": "abcd"}]', [{"text": "abcdefghij"}]) is None
    assert number.check('[{"text": "aaa"}]', [{"text": "a"}]) == "changed length"


def test_services_by_success():
    now = [0.0]
    pool = B.ServicePool({"good": lambda p: "ok", "bad": lambda p: 1 / 0}, clock=lambda: now[0])
    assert {pool("x") for _ in range(20)} == {"ok"}
    assert pool.weight("bad") < 0.02 < 1 < pool.weight("good")
    now[0] = 601.0
    assert pool.weight("bad") == 1.01


def test_files_are_kept_whole(spark):
    seg = spark.createDataFrame([(f, i, f"t{i}", "a" if i < 2 else "b", 100.0 * i, 100.0 * i + 90) for f in ("x", "y") for i in range(4)], "file string, seg_no int, text string, speaker string, start double, end double")
    tasks = B.plan_tasks(B.plan_batches(seg, True, 200.0))

    def client(prompt):
        rows = json.loads(prompt.split("\n")[2])
        return json.dumps([{"text": r["text"] if "t3" not in prompt else 1} for r in rows])

    results = B.run_tasks(tasks, B.NumberRewrite(), client, B.CallRules(calls=1, checks=2))
    assert {(r.file, r.saved, r.failed_batches) for r in B.whole_files(results).collect()} == {("x", False, 1), ("y", False, 1)}
    assert all(r.saved for r in B.whole_files(results, partial=True).collect())
    assert B.run_summary(results).first().batches == 4


def test_every_segment_has_a_task(spark, small):
    from strophe.plans import folding
    from strophe.plans.lyrics import segments_now

    rows = [("x", i, "t", None, 50.0 * i, 50.0 * i + 50) for i in range(7)] + [("x", 7, "t", "a", 350.0, 400.0), ("x", 8, "t", "a", 400.0, None), ("y", 0, "t", None, 5.0, 5.0), (None, 0, "t", "a", 1.0, 2.0)]
    seg = spark.createDataFrame(rows, "file string, seg_no int, text string, speaker string, start double, end double")
    got = {(r.file, r.seg_no): r.batch_id for r in B.plan_batches(seg, True, 120.0).collect()}
    assert [got["x", i] for i in range(9)] == [0, 0, 1, 1, 2, 2, 3, 3, 3] and got["y", 0] == got[None, 0] == 0
    tasks = {r[0]: r[1] for r in folding.service_tasks(spark, small).groupBy("file").agg(F.sum("n")).collect()}
    assert tasks == {r[0]: r[1] for r in segments_now(spark, small).groupBy("song_id").count().collect()}


def test_replies_of_all_tasks_are_checked(spark, small):
    from strophe.plans import folding

    rows = spark.sql("""SELECT * FROM VALUES (1, 'lyric', '[{"text":"a","is_lyric":true}]', array('a')), (2, 'lyric', '[{"text":"b","is_lyric":true}]', array('a')), (3, 'lyric', 'no', array('a')), (4, 'lyric', '[{"text":"a","is_lyric":"x"}]', array('a')),
        (5, 'number', '[{"text":"abc"}]', array('abcdefghij')), (6, 'number', '[{"text":"abcd"}]', array('abcdefghij')), (7, 'punct', '[{"text":"Hi, you."}]', array('hi you')), (8, 'punct', '[{"text":"Hi, me."}]', array('hi you')), (9, 'number', '[]', array('a')) AS t(id, kind, reply, texts)""")
    want = {1: None, 2: "changed text", 3: "not a list", 4: "is_lyric is no boolean", 5: "changed length", 6: None, 7: None, 8: "changed words", 9: "wrong length"}
    seg = F.transform("texts", lambda t: F.struct(t.alias("text")))
    for kind in ("lyric", "number", "punct"):
        got = rows.filter(F.col("kind") == kind).select("id", B.reply_problem(kind, F.col("reply"), seg).alias("problem")).collect()
        assert got and all(r.problem == want[r.id] for r in got)
    tasks = {(r.file, r.batch_id): [s.text for s in r.segments] for r in folding._tasks(spark, small).collect()}
    found = folding.reply_checks(spark, small).collect()
    assert len(found) == 9 * len(tasks) > 0 and {(r.file, r.batch_id) for r in found} == set(tasks)
    for r in found:
        assert r.problem == (want[r.id] if r.id != 5 or any(tasks[r.file, r.batch_id]) else None)


def test_documents_round_trip(spark, tmp_path):
    songs = spark.createDataFrame([("a", 9.0), ("b", 1.0)], "song_id string, audio_length double")
    seg = spark.createDataFrame([("a", 1, "y", 1.0, 2.0), ("a", 0, "x", 0.0, 1.0)], "song_id string, seg_no int, text string, start double, end double")
    docs = writers.song_documents(seg, songs)
    (tmp_path / "in").mkdir()
    for row in docs.collect():
        (tmp_path / "in" / f"{row.song_id}.json").write_text(json.dumps({"audio_length": row.audio_length, "segments": [s.asDict() for s in row.segments or []]}))
    (tmp_path / "in" / "bad.json").write_text("{")
    back = readers.song_segments(readers.read_songs(spark, str(tmp_path / "in")))
    assert sorted((r.song_id, r.seg_no, r.text) for r in back.collect()) == [("a", 0, "x"), ("a", 1, "y")]
    lines = tmp_path / "list.txt"
    lines.write_text("# c\n\n/a b.json\t3\n  /c.json\t4  \n")
    assert [r.path for r in readers.path_list(spark, str(lines), comments=True, column=0).collect()] == ["/a b.json", "/c.json"]
    lines.write_text("1 /a b.json\n/c.json\n")
    assert [tuple(r) for r in readers.id_path_list(spark, str(lines)).collect()] == [("1", "/a b.json"), (None, "/c.json")]
    writers.write_sharded(spark.range(7), str(tmp_path / "sharded"), "id", 3, 1)
    assert spark.read.json(str(tmp_path / "sharded")).groupBy("shard").count().count() == 3
    (tmp_path / "x.lrc").write_text("[00:01]a\n[00:02]b")
    assert readers.lrc_rows(readers.read_lrc(spark, str(tmp_path / "x.lrc"))).count() == 2
    assert [r.stem for r in readers.file_index(spark, str(tmp_path / "in"), "*.json").orderBy("stem").collect()] == ["a", "b", "bad"]
    (tmp_path / "f.xml").write_text("<rss><item><title>t</title></item><item><title>u</title></item></rss>")
    assert readers.read_feed(spark, str(tmp_path / "f.xml")).count() == 2
    (tmp_path / "k1.json").write_text('{"id": 1, "v": "a"}\n{"id": 1, "v": "b"}')
    assert readers.read_keyed_json(spark, str(tmp_path / "k1.json"), "id int, v string").first().v == "b"
    lyrics = spark.createDataFrame([([("[v]\na\nb", 1.0, 2.0)],)], "l array<struct<text string, offset double, duration double>>").select(readers.convert_lyric_map(F.col("l")).alias("s")).first().s
    assert tuple(lyrics[0]) == ("[v] a. b", 1.0, 3.0)


def test_streams(spark, tmp_path):
    for name in ("in", "lines"):
        (tmp_path / name).mkdir()
    spark.createDataFrame([("a", 0, 5), ("a", 9, 12), ("b", 0, 1)], "k string, s long, e long").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("k string, s long, e long").parquet(str(tmp_path / "in"))
    gaps = lambda: sorted(tuple(r) for r in streamed_gaps(stream, "k", "s", "e", str(tmp_path / "c1"), bucket=8).collect())
    assert gaps() == [("a", 5, 9)]
    spark.createDataFrame([("a", 4, 10), ("a", 20, 21), ("a", 3, 3), ("a", None, 9), ("b", 0, 1)], "k string, s long, e long").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    assert gaps() == gaps() == [("a", 12, 20)]
    # Only buckets that changed were written: the first run's two, then two of a, none of b.
    assert spark.read.parquet(str(tmp_path / "c1" / "changes")).filter("kind = 'span'").groupBy("key").count().orderBy("key").collect() == [("a", 4), ("b", 1)]
    random.seed(5)
    spans = [(random.choice("xyz"), a, a + random.randrange(0, 40)) for a in (random.randrange(-500, 500) for _ in range(300))]
    for i in range(3):
        spark.createDataFrame(spans[i::3], "k string, s long, e long").repartition(2).write.mode("append").parquet(str(tmp_path / "in2"))
        stream = spark.readStream.schema("k string, s long, e long").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in2"))
        got = streamed_gaps(stream, "k", "s", "e", str(tmp_path / "c3"), bucket=50).collect()
    want = interval_gaps(spark.createDataFrame(spans, "k string, s long, e long"), "k", "s", "e", bucket=10**6).collect()
    assert sorted(got) == sorted(want) and want
    (tmp_path / "lines" / "m.jsonl").write_text('{"audio_path":"a","lyric_path":"l"}\n{bad\n{"audio_path":"b"}\n')
    got = []
    run_available(manifest_stream(spark, str(tmp_path / "lines")), str(tmp_path / "c2"), lambda df, i: got.extend(r.audio_path for r in df.collect())).awaitTermination()
    assert got == ["a"]


def test_documents_of_files(spark):
    seg = spark.createDataFrame([(f, i, f"t{i}" if f == "x" else f"bad{i}", None, 100.0 * i, 100.0 * i + 90) for f in ("x", "y") for i in range(4)], "file string, seg_no int, text string, speaker string, start double, end double")
    tasks = B.plan_tasks(B.plan_batches(seg, False, 200.0))

    def client(prompt):
        rows = json.loads(prompt.split("\n")[2])
        return json.dumps([{"text": r["text"] + "!" if "bad3" not in prompt else None} for r in rows])

    results = B.run_tasks(tasks, B.NumberRewrite(), client, B.CallRules(calls=1, checks=2))
    whole = B.file_documents(tasks, results, B.NumberRewrite(), "done").collect()
    assert [(r.file, r.done, [s.text for s in r.segments]) for r in whole] == [("x", True, ["t0!", "t1!", "t2!", "t3!"])]
    assert [s.is_modified_number for s in whole[0].segments] == ["true"] * 4 and whole[0].segments[0].text_ori_number == "t0"
    part = {r.file: r for r in B.file_documents(tasks, results, B.NumberRewrite(), "done", partial=True).collect()}
    assert [(s.text, s.is_success) for s in part["y"].segments] == [("bad0!", "success"), ("bad1!", "success"), ("bad2!", "success"), ("bad3", "fail")] and part["y"].failed_batches == [1]


def test_refinement_in_two_stages(spark):
    rows = [(f, i, 10.0 * i, 10.0 * i + 5, "0_OUTLIER" if i == 1 else "0", f"line {i}" if i else "") for f in ("x", "y") for i in range(5)] + [("z", 0, None, None, None, None)]
    seg = spark.createDataFrame(rows, "file string, seg_no int, start double, end double, speaker string, text string")
    rules = RefineRules(sample=14, batch=2, tries=2, rounds=2)
    samples = {r.file: r.sample for r in refine.sample_texts(seg, rules).collect()}
    assert samples == {f: "line 1\nline 2\nline 3" for f in ("x", "y")}

    def client(prompt):
        if prompt.startswith("stage 1"):
            return "```json\n" + json.dumps({"hotwords": ["lane"], "speaker_map": {"0": "Dar"}}) + "\n```"
        lines = [x[6:] for x in prompt.splitlines() if x.startswith("text: ")]
        count = prompt.count("Segment ")
        return json.dumps({"data": [{"text": (lines[i - count] if i >= count - len(lines) else "") + ".", "speaker": "Dar"} for i in range(count)][: count - ("Segment 4" in prompt and "fail" in prompt)]})

    out = {(r.file, r.seg_no): r for r in refine.refine(seg, client, lambda t: "en", rules).collect()}
    assert len(out) == 11 and out["x", 2].text_gpt == "line 2." and out["x", 1].speaker_gpt == "Dar" and out["x", 0].hotwords == '["lane"]' and out["x", 0].language == "en" and out["z", 0].language is None
    batches = {(r.file, r.batch_id): r for r in refine.refine_batches(seg, rules).collect()}
    assert [len(batches["x", i].rows) for i in range(3)] == [2, 2, 1] and batches["x", 0].lines == "Segment 0:\nSpeaker 0 from 0.00 to 5.00\nSegment 1:\nSpeaker unknown from 10.00 to 15.00\ntext: line 1"
    broken = seg.withColumn("text", F.when((F.col("file") == "y") & (F.col("seg_no") == 4), "fail").otherwise(F.col("text")))
    out = {(r.file, r.seg_no): r for r in refine.refine(broken, client, lambda t: "en", rules).collect()}
    assert not out["y", 0].refined and out["y", 0].text_gpt is None and out["y", 0].error == "wrong reply" and out["x", 0].refined


def test_runs_by_settings(spark):
    settings = run_modes.read_settings("processor: lyric # kind\n# mode: single\nmode: task\nparallel: false\napi_family: a+b\nmax_api_retries: 1\nother: x\ncount: 1\n")
    assert settings == run_modes.RunSettings("task", False, "lyric", "a+b", 1, 4, 1)
    with pytest.raises(ValueError):
        run_modes.read_settings("mode: all")
    families = {"a": {"one": _flagged}, "b": {"two": _flagged}}
    tasks = spark.createDataFrame([("f", 0, [(0.0, 0, "hi", "0")]), ("f", 1, [(1.0, 1, "you", None)])], "file string, batch_id int, segments array<struct<start: double, seg_no: int, text: string, speaker: string>>")
    one = run_modes.run(settings, families, tasks).collect()
    assert [(r.batch_id, r.success) for r in one] == [(0, True)]
    both = run_modes.run(run_modes.RunSettings("task", True, "lyric", "a"), families, tasks, pool=lambda s: next(iter(s.values()))).collect()
    assert sorted((r.batch_id, r.success) for r in both) == [(0, True), (1, True)]
    assert run_modes.run(run_modes.RunSettings("single", api_family="a", prompt="hello"), {"a": {"one": lambda p: p + "!"}})["reply"] == "hello!"
    batch = run_modes.run(run_modes.RunSettings("batch", False, api_family="a"), {"a": {"one": lambda p: p.upper()}}, tasks).collect()
    assert [r.reply for r in batch] == ["HI", "YOU"]
    with pytest.raises(KeyError):
        B.pooled(families, "c")
    with pytest.raises(ValueError):
        B.register("lyric", B.PROCESSORS["lyric"])


def _flagged(prompt):
    return json.dumps([{"text": r["text"], "is_lyric": True} for r in json.loads(prompt.split("\n")[2])])


def test_a_service_that_is_asked_too_often_rests():
    now = [0.0]

    def busy(prompt):
        raise RuntimeError("429 Too Many Requests")

    pool = B.ServicePool({"a": busy, "b": lambda p: "b"}, clock=lambda: now[0])
    assert {pool("x") for _ in range(20)} == {"b"}
    failed = sum(not ok for _, ok in pool.events.get("a", []))
    assert failed <= 1 and B.is_rate_limit(ValueError("Rate limit reached")) and not B.is_rate_limit(ValueError("no"))


def test_results_come_back_in_order():
    assert B.in_order([{"task_id": 2}, {"task_id": 0}]) == [{"task_id": 0}, {"task_id": 2}]


def test_no_local_folder_on_a_cluster(spark, monkeypatch):
    from strophe import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Frame:
        sparkSession = type("S", (), {"sparkContext": Context()})()

    with pytest.raises(RuntimeError):
        session.cut_lineage(Frame())


def test_sounds_of_all_widths():
    import base64
    import io
    import wave

    wanted = tone(0.5)[:4000]
    for width, scale in ((1, 127), (2, 2**15 - 1), (3, 2**23 - 1), (4, 2**31 - 1)):
        data = np.round(wanted * scale).astype(np.int64)
        raw = (data + 128).astype(np.uint8).tobytes() if width == 1 else b"".join(int(x).to_bytes(width, "little", signed=True) for x in data)
        out = io.BytesIO()
        with wave.open(out, "wb") as sound:
            sound.setnchannels(1)
            sound.setsampwidth(width)
            sound.setframerate(16_000)
            sound.writeframes(raw)
        samples, rate = signal.read_wave(out.getvalue())
        assert rate == 16_000 and len(samples) == 4000 and np.abs(samples - wanted).max() < 0.02
        part, _ = signal.read_wave(out.getvalue(), start=0.1, end=0.2)
        assert len(part) == 1600 and np.allclose(part, samples[1600:3200])
        again, _ = signal.read_wave(base64.b64decode(signal.clip_base64(out.getvalue(), 0.1, 0.2)))
        assert len(again) == 1600 and np.abs(again - part).max() < 0.001
    assert np.abs(signal.resampled(tone(1), 16_000, 8_000)[100:-100] - tone(1, 8_000)[100:-100]).max() < 0.01
    assert len(signal.resampled(tone(1), 16_000, 16_000)) == 16_000 and len(signal.resampled(np.zeros(0), 16_000, 8_000)) == 0


def test_archives_episodes_and_checked_lyrics(spark, tmp_path):
    import tarfile

    for name, text in (("x.txt", "one"), ("y.txt", "two")):
        (tmp_path / name).write_text(text)
    (tmp_path / "tars").mkdir()
    with tarfile.open(tmp_path / "tars" / "a.tar.gz", "w:gz") as tar:
        tar.add(tmp_path / "x.txt", "in/x.txt")
        tar.add(tmp_path / "y.txt", "in/y.txt")
    (tmp_path / "tars" / "b.tar").write_bytes(b"broken")
    got = readers.archive_members(spark, str(tmp_path / "tars")).collect()
    assert {(r.archive.rsplit("/", 1)[1], r.name, r.content and bytes(r.content)) for r in got} == {("a.tar.gz", "in/x.txt", b"one"), ("a.tar.gz", "in/y.txt", b"two"), ("b.tar", None, None)}
    (tmp_path / "songs").mkdir()
    (tmp_path / "songs" / "a.lyric.json").write_text('{"audio_path": "a", "error_loading": true, "segments": [{"text": "x", "is_lyric": false}, {"text": "y"}, {"text": "z", "is_lyric": true}]}')
    row = readers.checked_lyrics(readers.read_songs(spark, str(tmp_path / "songs"))).first()
    assert (row.song_id, row.error_loading, [s.text for s in row.segments], [s.text for s in row.side]) == ("a", True, ["y", "z"], ["x"])
    (tmp_path / "ep").mkdir()
    (tmp_path / "ep" / "one.json").write_text('{"id": "1", "title": "T", "description": null}')
    feed = spark.createDataFrame([("T", "l", "told"), (None, "m", "x")], "title string, link string, description string")
    songs = spark.createDataFrame([("one",), ("two",)], "stem string")
    got = {r.stem: (r.id, r.description, r.link) for r in readers.with_metadata(songs, readers.read_episodes(spark, str(tmp_path / "ep")), feed).collect()}
    assert got == {"one": ("1", "told", "l"), "two": (None, None, None)}
    (tmp_path / "meta.json").write_text('[{"id": "1", "t": "a"}, {"id": "2", "t": ""}, {"id": "1", "t": "b"}]')
    assert [tuple(r) for r in readers.read_metadata_array(spark, str(tmp_path / "meta.json"), "id string, t string", "t", "id").collect()] == [("1", "b")]
    writers.write_by_folder(spark.createDataFrame([("/r/a/s.json", 1), ("s.json", 2)], "file string, n int"), "file", str(tmp_path / "out"))
    assert {(r.folder, r.kept_path, r.n) for r in spark.read.json(str(tmp_path / "out")).collect()} == {("a", "a/s.json", 1), ("others", "s.json", 2)}


def test_voice_goes_on_over_chunks(spark, tmp_path):
    from strophe.streaming.voice import voice_stream

    schema = "audio_id string, start double, rate int, samples array<double>, is_final boolean"
    loud, quiet = [0.5] * 20, [0.0] * 20
    first = [("a", 0.2 * i, 100, loud if i in (1, 2) else quiet, False) for i in range(8)] + [("b", 0.0, 100, loud, False)]
    second = [("a", 0.2 * i, 100, loud, i == 9) for i in range(8, 10)] + [("b", 0.2, 100, loud, False), ("b", 0.4, 100, None, True)]
    for i, rows in enumerate((first, second)):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        run_available(voice_stream(spark.readStream.schema(schema).parquet(str(tmp_path / "in"))), str(tmp_path / "c"), lambda df, n, i=i: df.write.mode("append").parquet(str(tmp_path / "out"))).awaitTermination()
    got = sorted((r.audio_id, round(r.start, 2), round(r.end, 2)) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == [("a", 0.2, 0.6), ("a", 1.6, 2.0), ("b", 0.0, 0.4)]


def test_sample_tasks_and_audit_columns():
    rows = [{"text": "some words here", "is_lyric": None}]
    right = {"json": '{"a": 1}', "summary": "words", "translation": "Worte", "code": "```x```", "better": "Some words, here."}
    for name, task in B.SAMPLES.items():
        assert task.check(right[name], rows) is None and task.check("" if name != "json" else "{", rows) == "wrong reply"
        assert task.apply("r", rows)[0]["reply"] == "r"
    assert B.LyricCheck().apply('[{"text": "some words here", "is_lyric": true}]', rows) == [{"text": "some words here", "is_lyric": True, "text_ori_lyric": "some words here", "is_modified_lyric": True}]


def test_files_that_are_done_have_no_task(spark):
    seg = spark.createDataFrame([(f, 0, "t", "a", 0.0, 1.0) for f in ("x", "y", None)], "file string, seg_no int, text string, speaker string, start double, end double")
    done = spark.createDataFrame([("x",)], "file string")
    assert {r.file for r in B.plan_tasks(B.plan_batches(seg, True, 60.0), done).collect()} == {"y", None}
