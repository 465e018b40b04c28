"""Queries over folds, vectors, events and service batches."""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F

from strophe.functions import text as T
from strophe.functions.compare import comparable_text, missing_and_extra, mixed_tokens, word_error_rates
from strophe.operators import batch_calls as B
from strophe.operators import chunks, folds, speakers, vectors
from strophe.operators.neighbours import time_bucket, with_neighbours, with_run_numbers
from strophe.plans.forms import folded
from strophe.plans.lyrics import _LAST, _SPOKEN, _WS, _bare, segments_now
from strophe.session import cut_lineage, table


_ORDER = ["start", "seg_no"]


def _valid(c: str = "") -> Column:
    """Whether a segment has both times, the end after the start."""
    p = f"{c}." if c else ""
    return F.coalesce(F.col(f"{p}end") > F.col(f"{p}start"), F.lit(False))


def greedy_merge_a(spark, d):
    """Segments of one leading label as one while that lasts at most 15 s; one without both times stays alone."""
    rows = segments_now(spark, d).select("song_id", "seg_no", "start", "end", T.leading_label(F.col("text")).alias("label"), F.coalesce(T.after_label(F.col("text")), F.lit("")).alias("rest"))
    beside = with_neighbours(rows, "song_id", _ORDER, [*_ORDER, "end", "label"], time_bucket())
    border = ~F.col("before.label").eqNullSafe(F.col("label")) | ~_valid() | ~_valid("before")
    rows = beside.withColumn("border", border).drop("before", "after")
    chunked = chunks.greedy_chunks(rows, "song_id", _ORDER, time_bucket(), F.col("start"), F.col("end"), 15.0, F.col("border"))
    return folds.merged_lines(chunked, "song_id").select("song_id", "text", "start", "end", "merged_count")


def greedy_merge_b(spark, d):
    t = F.col("text")
    rows = segments_now(spark, d).withColumn("label", T.bracket_label(t)).withColumn("brackets", T.only_brackets(t)).withColumn("words", T.without_brackets(t))
    return folds.fold_rows(rows, "song_id", _ORDER, ["label", "brackets", "words", "start", "end"], folds.chunk_lyrics, [("text", "string"), ("start", "double"), ("end", "double"), ("is_lyric", "boolean"), ("merged_count", "int")])


def merge_b_totals(spark, d):
    """Words and letters in the chunks of greedy_merge_b by song: none is lost or given twice."""
    bare = T.without_brackets(F.col("text"))
    rows = greedy_merge_b(spark, d).filter(bare != "").select("song_id", F.size(F.split(bare, r"(?U)\s+")).alias("n"), F.char_length(F.regexp_replace(bare, r"(?U)\s+", "")).alias("m"))
    return rows.groupBy("song_id").agg(F.sum("n").alias("words"), F.sum("m").alias("letters"))


def duration_batches(spark, d):
    rows = chunks.greedy_chunks(segments_now(spark, d, "song_id", "seg_no", "start"), "song_id", _ORDER, time_bucket(), F.col("start"), F.col("start"), 600.0)
    return rows.select("song_id", "seg_no", F.col("chunk_no").cast("int").alias("batch_id"))


def speaker_batches(spark, d):
    rows = B.by_speaker(segments_now(spark, d, "song_id", "seg_no", "start", "end", "speaker"), "song_id", 120.0)
    return rows.select("song_id", "seg_no", F.col("batch_id").cast("int").alias("batch_id"))


def asr_packs(spark, d):
    """Segments of at most 90 s in packs of at most 180 s together; others, and those without a length, have none."""
    ms = F.round((F.col("end") - F.col("start")) * 1000).cast("double")
    rows = segments_now(spark, d, "song_id", "seg_no", "start", "end").withColumn("ms", F.when((ms > 0) & (ms <= 90_000), ms))
    rows = chunks.running_sum(rows, "song_id", _ORDER, F.col("ms"), time_bucket())
    packed = chunks.greedy_chunks(rows, "song_id", _ORDER, time_bucket(), F.col("sum_before"), F.when(F.col("ms").isNotNull(), F.col("sum_after")), 180_000.0)
    return packed.select("song_id", "seg_no", F.when(F.col("ms").isNotNull(), F.col("chunk_no").cast("int")).alias("pack"))


def pack_960(spark, d):
    """Segments in chunks of at most 960 characters; a last chunk of under 480 joins the one before."""
    rows = segments_now(spark, d, "song_id", "seg_no", "start", "text").withColumn("n", F.greatest(F.lit(1), F.coalesce(F.char_length("text"), F.lit(0))).cast("int")).drop("text")
    rows = chunks.running_sum(rows, "song_id", _ORDER, F.col("n"), time_bucket())
    packed = chunks.greedy_chunks(rows, "song_id", _ORDER, time_bucket(), F.col("sum_before"), F.col("sum_after"), 960.0)
    return chunks.last_joined(packed, "song_id", F.sum("n") < 480).select("song_id", "seg_no", F.col("chunk_no").cast("int").alias("chunk"))


def fixed_batches(spark, d):
    """A hundred segments each."""
    rows = with_run_numbers(segments_now(spark, d, "song_id", "seg_no", "start"), "song_id", _ORDER, F.lit(True), time_bucket())
    return rows.select("song_id", "seg_no", F.floor((F.col("run_no") - 1) / 100).alias("batch_id"))


def tidy_structures(spark, d):
    rows = table(spark, d, "structures")
    ends = rows.groupBy("song_id").agg(F.max("end").alias("start"), F.lit(10**6).alias("st_no"), F.lit("end").alias("label"))
    marks = rows.select("song_id", "start", "st_no", F.lower("label").alias("label")).unionByName(ends)
    return folds.fold_rows(marks, "song_id", ["start", "st_no"], ["start", "label"], folds.tidy_boundaries, [("start", "double"), ("label", "string")])


def speaker_turn_merge(spark, d):
    """Neighbouring lines as one turn by labels, likeness and gaps. The likeness is that of the embeddings dealt to the two segments by number; segments without both times are left out.

    Where a gap is too wide for any rule a turn surely ends: the stretches between are worked on apart.
    """
    rows = segments_now(spark, d).filter(_valid()).withColumn("a", speakers.plain_label(F.col("speaker")))
    e = table(spark, d, "embeddings").groupBy("vec_id").agg(F.max("embedding").alias("v"))
    rows = rows.withColumn("vec_id", F.pmod("segment_id", F.lit(500))).join(e, "vec_id", "left")
    beside = with_neighbours(rows, "song_id", _ORDER, [*_ORDER, "end", "v"], time_bucket())
    rows = beside.withColumn("like", F.round(vectors.cosine(F.col("v"), F.col("before.v")), 9)).withColumn("new", F.coalesce(F.col("start") - F.col("before.end") >= 1.0, F.lit(True))).select("song_id", "seg_no", "start", "end", "a", "like", "text", "new")
    rows = with_run_numbers(rows, "song_id", _ORDER, F.col("new"), time_bucket()).withColumn("part", F.struct("song_id", "run_no"))
    merged = folds.fold_rows(rows, "part", _ORDER, ["a", "like", "text", "start", "end"], lambda r: folds.merge_speech((x[0], x[0], *x[1:]) for x in r), [("text", "string"), ("start", "double"), ("end", "double"), ("merged_count", "int")])
    return merged.select("part.song_id", "text", "start", "end", "merged_count")


def centroids(spark, d):
    rows = vectors.mean_vectors(table(spark, d, "embeddings"), ["label"], "embedding")
    return rows.select("label", "n", F.posexplode("center").alias("pos", "x")).select("label", "n", "pos", F.round("x", 5).alias("x"))


def centroid_similarity(spark, d):
    rows = vectors.center_likeness(vectors.mean_vectors(table(spark, d, "embeddings"), ["label"], "embedding"), "label")
    return rows.withColumn("likeness", F.round("likeness", 5))


def neighbor_cosine(spark, d):
    rows = vectors.neighbour_likeness(table(spark, d, "embeddings"), "label", "vec_id", "embedding")
    return rows.select("vec_id", F.round("likeness", 5).alias("likeness"))


def outlier_assign(spark, d):
    rows = vectors.assign_outliers(table(spark, d, "embeddings"), "label", "embedding")
    return rows.select("vec_id", "label", F.round("likeness", 5).alias("likeness"), "outlier")


def merged_clusters(spark, d):
    rows = table(spark, d, "embeddings").withColumn("space", F.lit(0))
    return vectors.merge_clusters(rows, "space", "label", "embedding", 0.3).select("label", "merged_label")


def prompt_scores(spark, d):
    """Best cosine of each vector with the prompts: every vector whose id is divisible by 20."""
    e = table(spark, d, "embeddings").select("vec_id", "embedding")
    return vectors.prompt_likeness(e, "embedding", e.filter("vec_id % 20 = 0"), "embedding").select("vec_id", F.round("prompt_score", 5).alias("prompt_score"))


def dealt_prompts(spark, d):
    """Each vector with the prompt of its number modulo the number of prompts, which are the vectors whose id is divisible by 20."""
    e = table(spark, d, "embeddings").select("vec_id", "embedding")
    prompts = e.filter("vec_id % 20 = 0").select(F.floor(F.col("vec_id") / 20).alias("prompt_no"), F.col("embedding").alias("prompt"))
    return vectors.dealt_likeness(e, "vec_id", "embedding", prompts, "prompt").select("vec_id", "prompt_no", F.round("likeness", 5).alias("likeness"))


def sub_windows(spark, d):
    rows = segments_now(spark, d, "song_id", "seg_no", "start", "end").select("song_id", "seg_no", F.round((F.col("end") - F.col("start")) * 16000).cast("long").alias("samples"))
    return vectors.sub_windows(rows, F.col("samples")).select("song_id", "seg_no", "window_no", "from_sample", "to_sample")


def success_weight(spark, d):
    seconds = F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000
    rows = table(spark, d, "events").withColumn("at", F.floor(seconds))
    return B.success_weights(rows, "user_id", "at", F.col("event_type") == "purchase").select("event_id", F.round("weight", 9).alias("weight"))


def _tasks(spark, d):
    return B.plan_tasks(B.plan_batches(segments_now(spark, d).withColumnRenamed("song_id", "file"), True, 120.0))


def service_tasks(spark, d):
    """How all segments would be sent: batches of two minutes, cut where the speaker changes or a run is longer."""
    return _tasks(spark, d).select("file", "batch_id", F.size("segments").alias("n"), F.aggregate("segments", F.lit(0), lambda a, s: a + F.coalesce(F.char_length(s["text"]), F.lit(0))).alias("characters"))


def checked_replies(tasks):
    """file, batch_id, id, problem: nine replies to each task, made of its rows, and what the checks say: 1 faithful, 2 a changed text, 3 no list, 4 a wrong flag; 5 texts cut short, 6 faithful, 9 no rows; 7 with marks, 8 with another word."""
    said = lambda text, flag="true": F.to_json(F.transform("segments", lambda s: F.struct(text(s["text"]).alias("text"), F.expr(flag).alias("is_lyric"))))
    text = lambda t: F.coalesce(t, F.lit(""))
    replies = [
        ("lyric", said(lambda t: t)), ("lyric", said(lambda t: F.concat(text(t), F.lit("b")))), ("lyric", F.lit("no")), ("lyric", said(lambda t: t, "'x'")),
        ("number", said(lambda t: F.substring(text(t), F.lit(1), F.floor(F.char_length(text(t)) * 0.3).cast("int")))), ("number", said(text)),
        ("punct", said(lambda t: F.concat(text(t), F.lit(".")))), ("punct", said(lambda t: F.concat(text(t), F.lit(" me")))), ("number", F.lit("[]")),
    ]
    rows = tasks.withColumn("r", F.explode(F.array(*[F.struct(F.lit(i + 1).alias("id"), F.lit(kind).alias("kind"), reply.alias("reply")) for i, (kind, reply) in enumerate(replies)])))
    problem = F.lit(None).cast("string")
    for kind in ("lyric", "number", "punct"):
        problem = F.when(F.col("r.kind") == kind, B.reply_problem(kind, F.col("r.reply"), F.col("segments"))).otherwise(problem)
    return rows.select("file", "batch_id", "r.id", problem.alias("problem"))


def reply_checks(spark, d):
    """The checks of replies over the planned tasks of all segments."""
    return checked_replies(_tasks(spark, d))


def comparable_texts(spark, d):
    return segments_now(spark, d, "text").select("segment_id", comparable_text("text").alias("comparable"))


def word_errors(spark, d):
    """Words of each segment as first delivered against those of its current version."""
    seen = F.struct("loaded_at", "text")
    both = table(spark, d, "segments").filter("segment_id is not null").groupBy("segment_id").agg(F.max(seen).alias("now"), F.min(seen).alias("first"))
    rows = both.select("segment_id", word_error_rates(F.col("now.text"), F.col("first.text")).alias("e"))
    return rows.select("segment_id", F.round("e.wer", 6).alias("wer"), "e.ins", "e.del", "e.sub", F.round("e.ins_ratio", 6).alias("ins_ratio"), F.round("e.del_ratio", 6).alias("del_ratio"), "e.hallucinated")


def mixed_token_rows(spark, d):
    """Tokens of each current segment: Han characters apart, marks with the character after them."""
    return segments_now(spark, d, "text").select("segment_id", F.array_join(mixed_tokens(F.col("text")), "|").alias("tokens"))


def letter_changes(spark, d):
    """How many characters of each segment's form for comparison are missing and extra after reading it as speech."""
    t = F.col("text")
    return segments_now(spark, d, "text").select("segment_id", missing_and_extra(F.lower(t), T.normalize_spoken(t)).alias("c")).select("segment_id", "c.missing", "c.extra")


def clustered_in_chunks(spark, d):
    """Embeddings of each label clustered in chunks of at most 960 and joined over the chunks: how many vectors there are, and whether any is lost."""
    rows = table(spark, d, "embeddings").select("label", "vec_id", "embedding")
    rows = chunks.running_sum(rows, "label", ["vec_id"], F.lit(1), F.floor(F.col("vec_id") / 4096))
    chunked = chunks.greedy_chunks(rows, "label", ["vec_id"], F.floor(F.col("vec_id") / 4096), F.col("sum_before"), F.col("sum_after"), 960.0)
    chunked = chunks.last_joined(chunked, "label", F.count("*") < 480).drop("sum_before", "sum_after").withColumnRenamed("label", "space")
    found = vectors.cluster_in_chunks(chunked, "space", "embedding", vectors.nearest_first())
    return found.groupBy("space").agg(F.count("*").alias("vectors"), F.countDistinct("vec_id").alias("distinct_vectors"), (F.countDistinct("label") <= F.count("*")).alias("grouped"))


def likeness_table(spark, d):
    """Likeness of all pairs of centres, rounded half to even to three digits."""
    return vectors.similarity_table(vectors.mean_vectors(table(spark, d, "embeddings"), ["label"], "embedding"), "label")


def method_choice(spark, d):
    """Of two clusterings of each song's speakers, by label and by label without outliers, the one that is chosen."""
    rows = segments_now(spark, d, "song_id", "speaker")
    plain = F.when(~speakers.is_outlier(F.col("speaker")), speakers.plain_label(F.col("speaker")))
    counts = rows.groupBy("song_id").agg(F.countDistinct("speaker").alias("a"), F.countDistinct(plain).alias("b"))
    return counts.select("song_id", vectors.choose_method(F.col("a"), F.col("b")).alias("method"))


def _echo(prompt: str) -> str:
    """A service that calls every line a lyric."""
    rows = json.loads(prompt.splitlines()[2])
    return json.dumps([{"text": r["text"], "is_lyric": True} for r in rows], ensure_ascii=False)


def service_documents(spark, d):
    """Files whose batches all passed a service, with their segments together again: the batches of all current segments, sent to a service that answers from the prompt."""
    tasks = cut_lineage(_tasks(spark, d))
    results = B.run_tasks(tasks, B.LyricCheck(), _echo)
    documents = B.file_documents(tasks, results, B.LyricCheck(), "is_lyric_checked")
    sung = F.size(F.filter("segments", lambda s: s["is_lyric"] == "true"))
    return documents.select("file", F.size("segments").alias("segments"), sung.alias("sung"), "is_lyric_checked")


def run_counts(spark, d):
    """Batches and calls of a run over all segments."""
    return B.run_summary(B.run_tasks(_tasks(spark, d), B.LyricCheck(), _echo))


QUERIES = {
    f.__name__: f
    for f in (
        greedy_merge_a, greedy_merge_b, merge_b_totals, duration_batches, speaker_batches, asr_packs, pack_960, fixed_batches, tidy_structures, speaker_turn_merge, centroids, centroid_similarity, neighbor_cosine,
        outlier_assign, merged_clusters, prompt_scores, dealt_prompts, sub_windows, success_weight, service_tasks, reply_checks, comparable_texts, word_errors, mixed_token_rows, letter_changes,
        clustered_in_chunks, likeness_table, method_choice, service_documents, run_counts,
    )
}

_O = f"""{_LAST}, o AS (SELECT *, CAST(round(("end" - "start") * 1000) AS BIGINT) AS ms, row_number() OVER (PARTITION BY song_id ORDER BY "start", seg_no) AS i FROM last_rows)"""
_LETTERS = r"lower(regexp_replace(text, '[^\p{L}\p{N}\p{M}]', '', 'g'))"
# Batches of runs (n: rows with their run): runs in order, the greedy batches over them, and a brief last one joined.
_RUNS = """g AS (SELECT song_id, run, arg_min("start", i) AS f, arg_max("end", i) AS e FROM n GROUP BY song_id, run),
c AS (SELECT song_id, run, f AS o, f, e, 0 AS b FROM g WHERE run = 1 UNION ALL SELECT g.song_id, g.run, CASE WHEN g.e - c.o > 120 THEN g.f ELSE c.o END, g.f, g.e, CASE WHEN g.e - c.o > 120 THEN c.b + 1 ELSE c.b END FROM c JOIN g ON g.song_id = c.song_id AND g.run = c.run + 1),
w AS (SELECT *, max(b) OVER (PARTITION BY song_id) AS top, arg_max(e, run) OVER (PARTITION BY song_id, b) - arg_min(f, run) OVER (PARTITION BY song_id, b) AS len FROM c)
SELECT song_id, seg_no, CAST(CASE WHEN b = top AND b > 0 AND len < 60 THEN b - 1 ELSE b END AS INT) AS batch_id FROM n JOIN w USING (song_id, run)"""
_CENTER = """c AS (SELECT label, generate_subscripts(embedding, 1) - 1 AS pos, unnest(embedding)::DOUBLE AS x FROM embeddings), m AS (SELECT label, pos, avg(x) AS x, count(*) AS n FROM c GROUP BY ALL), l AS (SELECT label, list(x ORDER BY pos) AS v FROM m GROUP BY label)"""
_COS = "list_dot_product({a}, {b}) / (sqrt(list_dot_product({a}, {a})) * sqrt(list_dot_product({b}, {b})))"
_E = "embedding::DOUBLE[]"
ORACLE = {
    "duration_batches": f"""WITH RECURSIVE {_O}, r AS (SELECT song_id, i, seg_no, "start" AS f, 0 AS b FROM o WHERE i = 1 UNION ALL SELECT o.song_id, o.i, o.seg_no, CASE WHEN o."start" - r.f > 600 THEN o."start" ELSE r.f END, CASE WHEN o."start" - r.f > 600 THEN r.b + 1 ELSE r.b END FROM r JOIN o ON o.song_id = r.song_id AND o.i = r.i + 1)
SELECT song_id, seg_no, b AS batch_id FROM r""",
    "asr_packs": f"""WITH RECURSIVE {_O}, z AS (SELECT song_id, i, seg_no, CASE WHEN ms > 0 AND ms <= 90000 THEN ms END AS ms FROM o), r AS (SELECT song_id, i, seg_no, coalesce(ms, 0) AS t, ms IS NULL AS na, 0 AS b FROM z WHERE i = 1
UNION ALL SELECT z.song_id, z.i, z.seg_no, CASE WHEN z.ms IS NULL THEN r.t WHEN r.t > 0 AND r.t + z.ms > 180000 THEN z.ms ELSE r.t + z.ms END, z.ms IS NULL, CASE WHEN z.ms IS NOT NULL AND r.t > 0 AND r.t + z.ms > 180000 THEN r.b + 1 ELSE r.b END FROM r JOIN z ON z.song_id = r.song_id AND z.i = r.i + 1)
SELECT song_id, seg_no, CASE WHEN NOT na THEN b END AS pack FROM r""",
    "pack_960": f"""WITH RECURSIVE {_O}, z AS (SELECT song_id, i, seg_no, greatest(1, coalesce(length(text), 0)) AS n FROM o), r AS (SELECT song_id, i, seg_no, n, n AS t, 0 AS b FROM z WHERE i = 1
UNION ALL SELECT z.song_id, z.i, z.seg_no, z.n, CASE WHEN r.t + z.n > 960 THEN z.n ELSE r.t + z.n END, CASE WHEN r.t + z.n > 960 THEN r.b + 1 ELSE r.b END FROM r JOIN z ON z.song_id = r.song_id AND z.i = r.i + 1),
s AS (SELECT *, max(b) OVER (PARTITION BY song_id) AS top, sum(n) OVER (PARTITION BY song_id, b) AS size FROM r) SELECT song_id, seg_no, CASE WHEN b = top AND b > 0 AND size < 480 THEN b - 1 ELSE b END AS chunk FROM s""",
    "speaker_batches": f"""WITH RECURSIVE {_O}, m AS (SELECT *, CASE WHEN i > 1 AND speaker IS NOT DISTINCT FROM lag(speaker) OVER (PARTITION BY song_id ORDER BY i) THEN 0 ELSE 1 END AS new FROM o),
n AS (SELECT *, sum(new) OVER (PARTITION BY song_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS run FROM m), {_RUNS}""",
    "service_tasks": f"""WITH RECURSIVE {_O}, m AS (SELECT *, "end" AS e0, greatest("start", coalesce("end", "start")) AS e, CASE WHEN i > 1 AND speaker IS NOT DISTINCT FROM lag(speaker) OVER (PARTITION BY song_id ORDER BY i) THEN 0 ELSE 1 END AS new FROM o),
p AS (SELECT song_id, i, "start" AS f, 1 AS run FROM m WHERE i = 1 UNION ALL SELECT m.song_id, m.i, CASE WHEN m.new = 1 OR m.e - p.f > 120 THEN m."start" ELSE p.f END, CASE WHEN m.new = 1 OR m.e - p.f > 120 THEN p.run + 1 ELSE p.run END FROM p JOIN m ON m.song_id = p.song_id AND m.i = p.i + 1),
n AS (SELECT m.song_id, m.i, seg_no, text, "start", max(e) OVER (PARTITION BY m.song_id, run) AS "end", run FROM m JOIN p ON p.song_id = m.song_id AND p.i = m.i), {_RUNS.replace("SELECT song_id, seg_no, CAST(", "SELECT song_id AS file, CAST(").replace(" AS batch_id FROM", " AS batch_id, count(*) AS n, CAST(sum(coalesce(length(text), 0)) AS BIGINT) AS characters FROM")} GROUP BY 1, 2""",
    "greedy_merge_a": rf"""WITH RECURSIVE {_O}, p AS (SELECT song_id, i, "start" AS a, "end" AS e, coalesce("end" > "start", false) AS ok, CASE WHEN regexp_matches(text, '^\[[^\n]*?\]') THEN regexp_extract(text, '^\[([^\n]*?)\]', 1) END AS label, coalesce(CASE WHEN regexp_matches(text, '^\[[^\n]*?\]') THEN regexp_extract(text, '^\[[^\n]*?\]\s*([^\n]*)', 1) ELSE text END, '') AS t FROM o),
r AS (SELECT song_id, i, label, t, a, e, ok, 1 AS n, 0 AS c FROM p WHERE i = 1 UNION ALL SELECT p.song_id, p.i, p.label, CASE WHEN k THEN r.t || CASE WHEN p.t = '' THEN '' WHEN trim(r.t) <> '' AND NOT regexp_matches(r.t, '[.!?。！？,，;；]\s*$') THEN '. ' || p.t ELSE ' ' || p.t END ELSE p.t END, CASE WHEN k THEN r.a ELSE p.a END, p.e, p.ok, CASE WHEN k THEN r.n + 1 ELSE 1 END, CASE WHEN k THEN r.c ELSE r.c + 1 END
FROM (SELECT r.*, p.label IS NOT DISTINCT FROM r.label AND p.ok AND r.ok AND p.e - r.a <= 15 AS k, p.i AS pi FROM r JOIN p ON p.song_id = r.song_id AND p.i = r.i + 1) r JOIN p ON p.song_id = r.song_id AND p.i = r.pi)
SELECT song_id, CASE WHEN label IS NOT NULL THEN '[' || label || '] ' || t ELSE t END AS text, a AS "start", e AS "end", n AS merged_count FROM (SELECT *, row_number() OVER (PARTITION BY song_id, c ORDER BY i DESC) AS last FROM r) WHERE last = 1""",
    "speaker_turn_merge": rf"""WITH RECURSIVE {_LAST}, v AS (SELECT vec_id, max(embedding)::DOUBLE[] AS v FROM embeddings GROUP BY vec_id),
o AS (SELECT song_id, text, "start" AS s, "end" AS e, v, CASE WHEN speaker <> '' THEN regexp_replace(trim(speaker), '_OUTLIER$', '') END AS a, row_number() OVER (PARTITION BY song_id ORDER BY "start", seg_no) AS i FROM last_rows LEFT JOIN v ON vec_id = ((segment_id % 500) + 500) % 500 WHERE "end" > "start"),
l AS (SELECT *, round({_COS.format(a='v', b='lag(v) OVER (PARTITION BY song_id ORDER BY i)')}, 9) AS k FROM o),
r AS (SELECT song_id, i, a, s AS f, e, coalesce(text, '') AS t, 1 AS n, 0 AS c FROM l WHERE i = 1
UNION ALL SELECT song_id, pi, CASE WHEN j THEN a ELSE pa END, CASE WHEN j THEN f ELSE ps END, pe, CASE WHEN j THEN t || ' ' || pt ELSE pt END, CASE WHEN j THEN n + 1 ELSE 1 END, CASE WHEN j THEN c ELSE c + 1 END
FROM (SELECT r.*, l.i AS pi, l.a AS pa, l.s AS ps, l.e AS pe, coalesce(l.text, '') AS pt, coalesce(l.a IS NOT DISTINCT FROM r.a AND l.k > 0.6 AND l.s - r.e < 1 AND l.e - r.f <= 60, false) OR (l.s - r.e < 1 AND (r.e - r.f < 0.75 OR l.e - l.s < 0.75)) AS j FROM r JOIN l ON l.song_id = r.song_id AND l.i = r.i + 1))
SELECT song_id, t AS text, f AS "start", e AS "end", n AS merged_count FROM (SELECT *, row_number() OVER (PARTITION BY song_id, c ORDER BY i DESC) AS last FROM r) WHERE last = 1""",
    "merge_b_totals": rf"""WITH {_LAST}, b AS (SELECT song_id, {_bare("text")} AS b FROM last_rows WHERE "end" > "start") SELECT song_id, CAST(sum(len(regexp_split_to_array(b, '{_WS}+'))) AS BIGINT) AS words, CAST(sum(length(regexp_replace(b, '{_WS}+', '', 'g'))) AS BIGINT) AS letters FROM b WHERE b <> '' GROUP BY song_id""",
    "fixed_batches": f"WITH {_O} SELECT song_id, seg_no, (i - 1) // 100 AS batch_id FROM o",
    "centroids": f"WITH {_CENTER} SELECT label, n, CAST(pos AS INT) AS pos, round(x, 5) AS x FROM m",
    "centroid_similarity": f"WITH {_CENTER} SELECT a.label AS label_a, b.label AS label_b, round({_COS.format(a='a.v', b='b.v')}, 5) AS likeness FROM l a JOIN l b ON a.label < b.label",
    "neighbor_cosine": f"WITH p AS (SELECT vec_id, {_E} AS v, lag({_E}) OVER (PARTITION BY label ORDER BY vec_id) AS b FROM embeddings) SELECT vec_id, round({_COS.format(a='v', b='b')}, 5) AS likeness FROM p",
    "outlier_assign": f"WITH {_CENTER}, s AS (SELECT vec_id, label, {_COS.format(a=_E, b='v')} AS k FROM embeddings JOIN l USING (label)) SELECT vec_id, label, round(k, 5) AS likeness, NOT k > 0.35 AS outlier FROM s",
    "prompt_scores": f"WITH p AS (SELECT {_E} AS q FROM embeddings WHERE vec_id % 20 = 0) SELECT vec_id, round(max({_COS.format(a=_E, b='q')}), 5) AS prompt_score FROM embeddings CROSS JOIN p GROUP BY vec_id",
    "dealt_prompts": f"WITH p AS (SELECT vec_id // 20 AS prompt_no, {_E} AS q FROM embeddings WHERE vec_id % 20 = 0), e AS (SELECT vec_id, {_E} AS v, vec_id % (SELECT max(prompt_no) + 1 FROM p) AS prompt_no FROM embeddings) SELECT vec_id, prompt_no, round({_COS.format(a='v', b='q')}, 5) AS likeness FROM e LEFT JOIN p USING (prompt_no)",
    "sub_windows": f"""WITH {_O}, s AS (SELECT song_id, seg_no, CAST(round(("end" - "start") * 16000) AS BIGINT) AS n FROM o), w AS (SELECT song_id, seg_no, unnest(range(0, CAST(greatest(0, ceil((n - 24000) / 12000)) AS BIGINT) + 1)) AS window_no FROM s WHERE n > 0) SELECT *, window_no * 12000 AS from_sample, window_no * 12000 + 24000 AS to_sample FROM w""",
    "success_weight": """WITH e AS (SELECT *, CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS sec FROM events) SELECT event_id, round(avg(CASE WHEN event_type = 'purchase' THEN 1.0 ELSE 0.0 END) OVER (PARTITION BY user_id ORDER BY sec RANGE BETWEEN 600 PRECEDING AND CURRENT ROW) + 0.01, 9) AS weight FROM e""",
    "word_errors": f"""WITH RECURSIVE v AS (SELECT segment_id, arg_max(text, loaded_at) AS now, arg_min(text, loaded_at) AS old FROM segments WHERE segment_id IS NOT NULL GROUP BY segment_id),
p AS (SELECT segment_id, list_filter(regexp_split_to_array(coalesce({_SPOKEN.replace("text", "now")}, ''), '{_WS}+'), lambda x: x <> '') AS a, list_filter(regexp_split_to_array(coalesce({_SPOKEN.replace("text", "old")}, ''), '{_WS}+'), lambda x: x <> '') AS b FROM v),
d AS (SELECT segment_id, a, b, 0 AS i, list_transform(range(0, len(b) + 1), lambda k: k * 2147483649) AS r FROM p WHERE a <> b AND len(a) > 0
UNION ALL SELECT segment_id, a, b, i, list_transform(range(0, len(b) + 1), lambda k: k * 2147483649 + list_min(list_slice(s, 1, k + 1))) FROM (SELECT segment_id, a, b, i + 1 AS i, list_transform(range(0, len(b) + 1), lambda k: least(r[k + 1] + 2147483648, CASE WHEN k > 0 THEN r[k] + CASE WHEN a[i + 1] = b[k] THEN 0 ELSE 2147483648 END ELSE 9000000000000000000 END) - k * 2147483649) AS s FROM d WHERE i < len(a))),
f AS (SELECT segment_id, r[len(r)] // 2147483648 AS e, r[len(r)] % 2147483648 AS ins FROM d WHERE i = len(a)),
c AS (SELECT p.segment_id, len(a) AS n, coalesce(e, 0) AS e, coalesce(ins, 0) AS ins, coalesce(ins + len(a) - len(b), 0) AS del FROM p LEFT JOIN f USING (segment_id)),
g AS (SELECT segment_id, n, CASE WHEN n = 0 THEN 100 ELSE ins END AS ins, CASE WHEN n = 0 OR e = 0 THEN 0 ELSE del END AS del, e FROM c)
SELECT segment_id, CASE WHEN n = 0 THEN 100.0 ELSE round(e / n, 6) END AS wer, CAST(ins AS BIGINT) AS ins, CAST(del AS BIGINT) AS del, CASE WHEN n = 0 THEN 0 ELSE CAST(e - ins - del AS BIGINT) END AS sub, CASE WHEN n = 0 THEN 1.0 ELSE round(ins / n, 6) END AS ins_ratio, CASE WHEN n = 0 THEN 0.0 ELSE round(del / n, 6) END AS del_ratio, n = 0 OR (n > 2 AND (ins / n > 0.5 OR del / n > 0.5)) AS hallucinated FROM g""",
    "mixed_token_rows": rf"""WITH {_LAST}, m AS (SELECT segment_id, text, '[' || chr(65292) || '。！？、；：（）【】《》,.!?;:"()\[\]{{}}<>]' AS c FROM last_rows),
k AS (SELECT segment_id, c, text, regexp_replace(regexp_replace(text, '{_WS}+(' || c || ')', '\1', 'g'), '(' || c || '){_WS}+', '\1', 'g') AS x FROM m),
y AS (SELECT segment_id, c, regexp_replace(regexp_replace(x, '([a-zA-Z])([\x{{4e00}}-\x{{9fff}}])', '\1 \2', 'g'), '([\x{{4e00}}-\x{{9fff}}])([a-zA-Z])', '\1 \2', 'g') AS x FROM k),
w AS (SELECT segment_id, c, list_filter(regexp_split_to_array(x, '{_WS}+'), lambda v: v <> '') AS l FROM y)
SELECT segment_id, array_to_string(flatten(list_transform(l, lambda v: CASE WHEN regexp_matches(v, '^([\x{{4e00}}-\x{{9fff}}]|' || c || ')+$') THEN regexp_extract_all(v, '(?s)(?:' || c || '.' || c || '$|[^' || c[2:] || c || '$|' || c || '.|.)') ELSE [v] END)), '|') AS tokens FROM w""",
    "letter_changes": f"""WITH {_LAST}, s AS (SELECT segment_id, lower(text) AS a, {_SPOKEN} AS b FROM last_rows), n AS (SELECT segment_id, list_filter(string_split(a, ''), lambda x: x <> '') AS a, list_filter(string_split(b, ''), lambda x: x <> '') AS b FROM s)
SELECT segment_id, CAST(list_sum(list_append(list_transform(list_distinct(a), lambda c: greatest(0, len(list_filter(a, lambda x: x = c)) - len(list_filter(b, lambda x: x = c)))), 0)) AS INT) AS missing, CAST(list_sum(list_append(list_transform(list_distinct(b), lambda c: greatest(0, len(list_filter(b, lambda x: x = c)) - len(list_filter(a, lambda x: x = c)))), 0)) AS INT) AS extra FROM n""",
    "comparable_texts": rf"""WITH {_LAST} SELECT segment_id, {folded(_LETTERS)} AS comparable FROM last_rows""",
    "clustered_in_chunks": "SELECT label AS space, count(*) AS vectors, count(DISTINCT vec_id) AS distinct_vectors, true AS grouped FROM embeddings WHERE embedding IS NOT NULL GROUP BY label",
    "likeness_table": f"WITH {_CENTER}, k AS (SELECT a.label AS label_a, b.label AS label_b, {_COS.format(a='a.v', b='b.v')} AS x FROM l a JOIN l b ON a.label < b.label) SELECT label_a, label_b, round_even(x, 3) AS likeness FROM k",
    "method_choice": rf"""WITH {_LAST}, c AS (SELECT song_id, count(DISTINCT speaker) AS a, count(DISTINCT CASE WHEN speaker <> '' AND NOT regexp_matches(speaker, '_OUTLIER$') THEN regexp_replace(trim(speaker), '_OUTLIER$', '') END) AS b FROM last_rows GROUP BY song_id)
SELECT song_id, CASE WHEN (greatest(a, b) >= 5 AND a <= b) OR (greatest(a, b) < 5 AND a >= b) THEN 'first' ELSE 'second' END AS method FROM c""",
    "service_documents": f"WITH {_LAST} SELECT song_id AS file, CAST(count(*) AS INT) AS segments, CAST(count(*) AS INT) AS sung, true AS is_lyric_checked FROM last_rows GROUP BY song_id",
    "tidy_structures": f"""WITH RECURSIVE m AS (SELECT song_id, "start" AS t, st_no AS o, lower(label) AS label FROM structures UNION ALL SELECT song_id, max("end"), 1000000, 'end' FROM structures GROUP BY song_id),
l AS (SELECT song_id, list({{'t': t, 'l': label}} ORDER BY t NULLS FIRST, o) AS x FROM m GROUP BY song_id),
s AS (SELECT song_id, x, 1 AS stage FROM l UNION ALL SELECT song_id, CASE WHEN go THEN y ELSE x END, CASE WHEN go THEN stage ELSE stage + 1 END FROM (SELECT *, CASE stage
    WHEN 1 THEN len(x) > 2 AND x[2].t - x[1].t < 1 WHEN 2 THEN len(x) > 2 AND x[-1].t - x[-2].t < 1 WHEN 3 THEN len(x) > 2 AND x[1].l IS NOT DISTINCT FROM x[2].l AND x[2].t <= 10 ELSE len(x) > 2 AND x[-2].l IS NOT DISTINCT FROM x[-3].l AND x[-1].t - x[-2].t <= 10 END AS go,
    CASE stage WHEN 1 THEN list_concat([{{'t': x[1].t, 'l': x[2].l}}], x[3:]) WHEN 3 THEN list_concat(x[1:1], x[3:]) ELSE list_concat(x[:-3], x[-1:]) END AS y FROM s WHERE stage < 5)),
u AS (SELECT song_id, unnest(x) AS r FROM s WHERE stage = 5) SELECT song_id, r.t AS "start", r.l AS label FROM u""",
    "merged_clusters": f"""WITH RECURSIVE {_CENTER}, cc AS (SELECT label, list_transform(v, lambda x: x * n) AS v, n FROM l JOIN (SELECT DISTINCT label AS k, n FROM m) ON k = label),
s AS (SELECT 0 AS step, list({{'label': label, 'v': v, 'n': n, 'in': [label]}} ORDER BY label) AS x FROM cc
UNION ALL SELECT step + 1, list_concat(list_concat(x[:i - 1], [{{'label': x[i].label, 'v': list_transform(list_zip(x[i].v, x[j].v), lambda z: z[1] + z[2]), 'n': x[i].n + x[j].n, 'in': list_concat(x[i]['in'], x[j]['in'])}}]), list_concat(x[i + 1:j - 1], x[j + 1:])) FROM (
    SELECT step, x, p[1] AS i, p[2] AS j FROM (SELECT step, x, list_filter(flatten(list_transform(range(1, len(x) + 1), lambda a: list_transform(range(a + 1, len(x) + 1), lambda b: [a, b]))), lambda q: {_COS.format(a='x[q[1]].v', b='x[q[2]].v')} > 0.3)[1] AS p FROM s) WHERE p IS NOT NULL)),
f AS (SELECT unnest(x) AS r FROM s WHERE step = (SELECT max(step) FROM s)) SELECT unnest(r['in']) AS label, r.label AS merged_label FROM f""",
    "reply_checks": f"""WITH tasks AS (SELECT file, batch_id, 0 AS n FROM ({{service}})), r AS (SELECT * FROM (VALUES (1, NULL), (2, 'changed text'), (3, 'not a list'), (4, 'is_lyric is no boolean'), (5, 'changed length'), (6, NULL), (7, NULL), (8, 'changed words'), (9, 'wrong length')) t(id, problem)) SELECT file, batch_id, id, problem FROM tasks, r""",
}
ORACLE["reply_checks"] = ORACLE["reply_checks"].replace("{service}", ORACLE["service_tasks"])
ORACLE["run_counts"] = f"SELECT count(DISTINCT file) AS files, count(*) AS batches, count(*) AS succeeded, count(*) AS attempts FROM ({ORACLE['service_tasks']})"
