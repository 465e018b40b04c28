"""Batches of segments through a text service: plan, call with checks and feedback, validate, apply, keep whole files only.

The service is a plain function prompt -> reply that the caller brings; nothing here opens a connection.
"""

from __future__ import annotations

import json
import random
import time
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass, field
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strophe.functions.compare import comparable
from strophe.operators.chunks import greedy_chunks, last_joined
from strophe.operators.neighbours import time_bucket, with_neighbours, with_run_numbers

Client = Callable[[str], str]


class Processor(Protocol):
    """What a kind of task has to say: its prompt, what is wrong with a reply (None if nothing), and the reply's rows."""

    name: str
    by_speaker: bool

    def prompt(self, rows: Sequence[dict], feedback: str | None) -> str: ...
    def check(self, reply: str, rows: Sequence[dict]) -> str | None: ...
    def apply(self, reply: str, rows: Sequence[dict]) -> list[dict]: ...


def unfenced(reply: str) -> str:
    """A reply without the lines of a code fence."""
    return "\n".join(line for line in reply.splitlines() if not line.lstrip().startswith("```")).strip()


def reply_rows(reply: str) -> list[dict] | None:
    try:
        rows = json.loads(unfenced(reply))
    except ValueError:
        return None
    return rows if isinstance(rows, list) and all(isinstance(r, dict) for r in rows) else None


def _ask(task: str, rows: Sequence[dict], feedback: str | None) -> str:
    lines = json.dumps([{"text": r["text"], "speaker": r.get("speaker")} for r in rows], ensure_ascii=False)
    return f"{task}\nReply with a JSON list of as many objects, in order.\n{lines}" + (f"\nThe last reply was wrong: {feedback}" if feedback else "")


@dataclass(frozen=True)
class LyricCheck:
    """Which lines are sung: the reply repeats each text and adds is_lyric."""

    name: str = "lyric"
    by_speaker: bool = False

    def prompt(self, rows: Sequence[dict], feedback: str | None) -> str:
        return _ask("Decide for each line whether it is a line of the lyrics (is_lyric).", rows, feedback)

    def check(self, reply: str, rows: Sequence[dict]) -> str | None:
        found = reply_rows(reply)
        if found is None:
            return "not a list"
        if len(found) != len(rows):
            return "wrong length"
        for got, row in zip(found, rows, strict=True):
            if got.get("text") != row["text"]:
                return "changed text"
            if not isinstance(got.get("is_lyric"), bool):
                return "is_lyric is no boolean"
        return None

    def apply(self, reply: str, rows: Sequence[dict]) -> list[dict]:
        return [dict(row) | {f"text_ori_{self.name}": row["text"], "is_lyric": got["is_lyric"], f"is_modified_{self.name}": row.get("is_lyric") != got["is_lyric"]} for got, row in zip(reply_rows(reply) or [], rows, strict=True)]


@dataclass(frozen=True)
class NumberRewrite:
    """Written-out numbers as digits: texts may change, their length only within bounds; speakers are taken from the input."""

    name: str = "number"
    by_speaker: bool = True
    least: float = 0.3
    most: float = 3.0

    def prompt(self, rows: Sequence[dict], feedback: str | None) -> str:
        return _ask("Write spoken numbers, money, fractions and percentages as digits.", rows, feedback)

    def check(self, reply: str, rows: Sequence[dict]) -> str | None:
        found = reply_rows(reply)
        if found is None:
            return "not a list"
        if len(found) != len(rows):
            return "wrong length"
        for got, row in zip(found, rows, strict=True):
            if not isinstance(got.get("text"), str):
                return "no text"
            if row["text"] and not self.least < len(got["text"]) / len(row["text"]) < self.most:
                return "changed length"
        return None

    def apply(self, reply: str, rows: Sequence[dict]) -> list[dict]:
        return [dict(row) | {f"text_ori_{self.name}": row["text"], "text": got["text"], f"is_modified_{self.name}": got["text"] != row["text"]} for got, row in zip(reply_rows(reply) or [], rows, strict=True)]


@dataclass(frozen=True)
class Punctuate(NumberRewrite):
    """Punctuation: letters and digits must stay the same; differences in spaces pass."""

    name: str = "punc"

    def prompt(self, rows: Sequence[dict], feedback: str | None) -> str:
        return _ask("Add punctuation; change no word.", rows, feedback)

    def check(self, reply: str, rows: Sequence[dict]) -> str | None:
        found = reply_rows(reply)
        if found is None:
            return "not a list"
        if len(found) != len(rows):
            return "wrong length"
        for got, row in zip(found, rows, strict=True):
            if not isinstance(got.get("text"), str):
                return "no text"
            if comparable(got["text"]) != comparable(row["text"] or ""):
                return "changed words"
        return None


@dataclass(frozen=True)
class SimpleTask:
    """A task given by functions: how a row is asked, whether a reply is right, and what becomes of it."""

    ask: Callable[[Sequence[dict]], str] = lambda rows: "\n".join(str(r.get("prompt", r.get("text", ""))) for r in rows)
    right: Callable[[str, Sequence[dict]], bool] = lambda reply, rows: True
    use: Callable[[str, Sequence[dict]], list[dict]] = lambda reply, rows: [dict(r) | {"reply": reply} for r in rows]
    name: str = "simple"
    by_speaker: bool = False

    def prompt(self, rows: Sequence[dict], feedback: str | None) -> str:
        return self.ask(rows) + (f"\nThe last reply was wrong: {feedback}" if feedback else "")

    def check(self, reply: str, rows: Sequence[dict]) -> str | None:
        return None if self.right(reply, rows) else "wrong reply"

    def apply(self, reply: str, rows: Sequence[dict]) -> list[dict]:
        return self.use(reply, rows)


def _is_json(reply: str, rows: Sequence[dict]) -> bool:
    try:
        json.loads(unfenced(reply))
    except ValueError:
        return False
    return True


#: Tasks for any text: an answer in JSON, a summary (shorter than the text), a translation, code (in a fence), a text made better (of a like length).
SAMPLES: dict[str, SimpleTask] = {
    "json": SimpleTask(right=_is_json, name="json"),
    "summary": SimpleTask(right=lambda reply, rows: 0 < len(reply.strip()) < max(2, sum(len(str(r.get("text") or "")) for r in rows)), name="summary"),
    "translation": SimpleTask(right=lambda reply, rows: bool(reply.strip()), name="translation"),
    "code": SimpleTask(right=lambda reply, rows: "```" in reply, name="code"),
    "better": SimpleTask(right=lambda reply, rows: 0.3 < len(reply) / max(1, sum(len(str(r.get("text") or "")) for r in rows)) < 3.0, name="better"),
}


@dataclass(frozen=True)
class Entry:
    """A kind of task as settings name it: its class, and the suffix and flag of its output."""

    processor: Callable[[], Processor]
    suffix: str
    flag: str


PROCESSORS: dict[str, Entry] = {
    "lyric": Entry(LyricCheck, ".lyric", "is_lyric_checked"), "number": Entry(NumberRewrite, ".number", "is_number_processed"), "punctuation": Entry(Punctuate, ".punc", "is_punctuated"),
}


def register(name: str, entry: Entry) -> None:
    """Add a kind of task; a name can't be taken twice."""
    if name in PROCESSORS:
        raise ValueError(f"{name} is registered")
    PROCESSORS[name] = entry


def pooled(families: dict[str, dict[str, Client]], names: str) -> dict[str, Client]:
    """The services of families named with + between them, each once."""
    missing = [n for n in names.split("+") if n not in families]
    if missing:
        raise KeyError(f"no family {missing[0]}")
    return {k: v for n in names.split("+") for k, v in families[n].items()}


@dataclass(frozen=True)
class CallRules:
    calls: int = 8
    checks: int = 4
    pause: tuple[float, float] = (0.0, 0.0)


def is_rate_limit(error: Exception) -> bool:
    """Whether an error says that a service is asked too often."""
    said = f"{type(error).__name__} {error}".lower()
    return getattr(error, "status_code", None) == 429 or any(w in said for w in ("429", "rate limit", "ratelimit", "too many requests", "quota"))


@dataclass
class ServicePool:
    """Several services, tried at random with weights that follow their success in the last `window` seconds (a hundredth more than the share, so that none is ever out)."""

    services: dict[str, Client]
    window: float = 600.0
    clock: Callable[[], float] = time.monotonic
    events: dict[str, list[tuple[float, bool]]] = field(default_factory=dict)
    choose: random.Random = field(default_factory=lambda: random.Random(0))
    rest: float = 30.0
    resting: dict[str, float] = field(default_factory=dict)

    def weight(self, name: str) -> float:
        now = self.clock()
        recent = [e for e in self.events.get(name, []) if now - e[0] <= self.window]
        self.events[name] = recent
        return (sum(ok for _, ok in recent) / len(recent) if recent else 1.0) + 0.01

    def __call__(self, prompt: str) -> str:
        left = dict(self.services)
        error: Exception | None = None
        while left:
            names = sorted(left)
            # A service that said it is asked too often rests for a while, unless there is no other.
            rested = [n for n in names if self.resting.get(n, float("-inf")) <= self.clock()] or names
            name = self.choose.choices(rested, [self.weight(n) for n in rested])[0]
            try:
                reply = left.pop(name)(prompt)
            except Exception as e:  # noqa: BLE001 - any failure of a service means the next one
                self.events.setdefault(name, []).append((self.clock(), False))
                if is_rate_limit(e):
                    self.resting[name] = self.clock() + self.rest
                error = e
                continue
            self.events.setdefault(name, []).append((self.clock(), True))
            return reply
        raise RuntimeError("all services failed") from error


def call_checked(rows: Sequence[dict], processor: Processor, client: Client, rules: CallRules = CallRules()) -> dict:
    """One batch: a reply that passes the check, or the last error. A wrong reply is answered with what is wrong; a failed call is repeated."""
    feedback, attempts = None, 0
    for _ in range(rules.checks):
        reply = None
        for _ in range(rules.calls):
            attempts += 1
            try:
                reply = client(processor.prompt(rows, feedback))
                break
            except Exception as e:  # noqa: BLE001 - kept as the row's error
                feedback_error = str(e)
                if rules.pause[1]:
                    time.sleep(random.uniform(*rules.pause))
        if reply is None:
            return {"success": False, "reply": None, "attempts": attempts, "error": feedback_error}
        feedback = processor.check(reply, rows)
        if feedback is None:
            return {"success": True, "reply": reply, "attempts": attempts, "error": None}
    return {"success": False, "reply": reply, "attempts": attempts, "error": feedback}


def by_speaker(rows: DataFrame, key: str, longest: float, cut: bool = False) -> DataFrame:
    """rows (seg_no, speaker, start, end and more) with batch_id: batches of at most `longest` seconds that end only where the speaker changes (no label is a speaker of its own); a last batch of under half that joins the one before.

    cut: a run longer than `longest` is cut between its rows, of which those without an end take no time, so that a batch is bounded; else a
    run is never cut. Runs are what chunks are made of, and both are found in blocks of time.
    """
    order = ["start", "seg_no"]
    beside = with_neighbours(rows, key, order, [*order, "speaker"], time_bucket())
    new = F.coalesce(~F.col("before.speaker").eqNullSafe(F.col("speaker")), F.lit(True)) | F.col("before").isNull()
    rows = beside.withColumn("__new", new).drop("before", "after")
    end = F.greatest("start", "end") if cut else F.col("end")
    if cut:
        rows = greedy_chunks(rows, key, order, time_bucket(), F.col("start"), end, longest, F.col("__new")).withColumnRenamed("chunk_no", "run_no")
    else:
        rows = with_run_numbers(rows, key, order, F.col("__new"), time_bucket())
    place = F.struct(*order)
    runs = rows.groupBy(F.col(key).alias("__k"), F.col("run_no").alias("__run")).agg(F.min_by("start", place).alias("__from"), (F.max(end) if cut else F.max_by("end", place)).alias("__to"))
    batched = greedy_chunks(runs, "__k", ["__run"], F.floor(F.col("__run") / 4096), F.col("__from"), F.col("__to"), longest)
    batched = last_joined(batched, "__k", F.max_by("__to", "__run") - F.min_by("__from", "__run") < longest / 2)
    batched = batched.select("__k", "__run", F.col("chunk_no").alias("batch_id"))
    return rows.join(batched, F.col(key).eqNullSafe(F.col("__k")) & (F.col("run_no") == F.col("__run"))).drop("__k", "__run", "__new", "run_no")


def plan_batches(segments: DataFrame, of_speakers: bool, longest: float) -> DataFrame:
    """file, seg_no, text, speaker, start, end, batch_id of all segments: by time, or by time at changes of speaker, where a run longer than `longest` is cut.

    The rows pass whole, so one without a file or with another's number is neither lost nor doubled.
    """
    rows = segments.select("file", "seg_no", "text", "speaker", "start", "end")
    if of_speakers:
        batched = by_speaker(rows, "file", longest, cut=True)
    else:
        batched = greedy_chunks(rows, "file", ["start", "seg_no"], time_bucket(), F.col("start"), F.col("start"), longest).withColumnRenamed("chunk_no", "batch_id")
    return batched.withColumn("batch_id", F.col("batch_id").cast("int"))


def plan_tasks(batched: DataFrame, done: DataFrame | None = None) -> DataFrame:
    """file, batch_id, segments: one task for each batch, its segments in order. A batch is bounded by its duration; files in done have none."""
    if done is not None:
        batched = batched.join(done.select("file").distinct(), "file", "left_anti")
    return batched.groupBy("file", "batch_id").agg(F.array_sort(F.collect_list(F.struct("start", "seg_no", "text", "speaker"))).alias("segments"))


def run_tasks(tasks: DataFrame, processor: Processor, client: Client, rules: CallRules = CallRules()) -> DataFrame:
    """file, batch_id, success, reply, attempts, error."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for file, batch, rows in zip(frame["file"], frame["batch_id"], frame["segments"], strict=True):
                out.append({"file": file, "batch_id": batch} | call_checked([dict(r) if isinstance(r, dict) else r.asDict() for r in rows], processor, client, rules))
            yield pd.DataFrame(out, columns=["file", "batch_id", "success", "reply", "attempts", "error"])

    return tasks.select("file", "batch_id", "segments").mapInPandas(run, "file string, batch_id int, success boolean, reply string, attempts int, error string")


def whole_files(results: DataFrame, partial: bool = False) -> DataFrame:
    """file, saved, failed_batches: a file is saved if all of its batches succeeded (partial: if any did)."""
    ok = F.bool_or("success") if partial else F.bool_and("success")
    return results.groupBy("file").agg(ok.alias("saved"), F.count_if(~F.col("success")).alias("failed_batches"))


def file_documents(tasks: DataFrame, results: DataFrame, processor: Processor, flag: str, partial: bool = False) -> DataFrame:
    """file, segments, <flag>, failed_batches: each file's segments as the service left them, in order of batch and row, and a true flag.

    A file of which a batch failed has no row; with `partial` it has one if any batch succeeded, and the segments of failed batches are as
    they were, with is_success 'fail'. Fields of a segment are strings, those that a batch lacks are null. For sinks: a file's segments
    must fit a row.
    """
    fields = ("text", "speaker", "is_lyric", f"text_ori_{processor.name}", f"is_modified_{processor.name}", "is_success")
    element = "struct<start: double, seg_no: int, " + ", ".join(f"{f}: string" for f in fields) + ">"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for file, batch, rows, ok, reply in zip(frame["file"], frame["batch_id"], frame["segments"], frame["success"], frame["reply"], strict=True):
                rows = [dict(r) if isinstance(r, dict) else r.asDict() for r in rows]
                done = processor.apply(reply, rows) if ok else rows
                named = [{f: None if (v := r.get(f)) is None else str(v).lower() if isinstance(v, bool) else str(v) for f in fields[:-1]} | {"is_success": "success" if ok else "fail", "start": r.get("start"), "seg_no": r.get("seg_no")} for r in done]
                out.append((file, batch, bool(ok), named))
            yield pd.DataFrame(out, columns=["file", "batch_id", "success", "rows"])

    both = tasks.join(results.select("file", "batch_id", "success", "reply"), ["file", "batch_id"])
    done = both.select("file", "batch_id", "segments", "success", "reply").mapInPandas(run, f"file string, batch_id int, success boolean, rows array<{element}>")
    keep = F.bool_or("success") if partial else F.bool_and("success")
    files = done.groupBy("file").agg(keep.alias("saved"), F.array_sort(F.collect_list(F.struct("batch_id", "rows"))).alias("parts"), F.array_sort(F.collect_list(F.when(~F.col("success"), F.col("batch_id")))).alias("failed_batches"))
    return files.filter("saved").select("file", F.flatten(F.transform("parts", lambda p: p["rows"])).alias("segments"), F.lit(True).alias(flag), "failed_batches")


def without_fence(reply: Column) -> Column:
    return F.trim(F.regexp_replace(reply, r"(?m)^\s*```.*$", ""))


_REPLY = "array<struct<text string, speaker string, is_lyric string>>"


def reply_problem(kind: str, reply: Column, segments: Column, least: float = 0.3, most: float = 3.0) -> Column:
    """What is wrong with a reply, as a column: the checks of the processors without leaving the JVM. Null if nothing is."""
    rows = F.from_json(without_fence(reply), _REPLY)
    pairs = F.zip_with(rows, segments, lambda r, s: F.struct(r.alias("r"), s.alias("s")))
    base = F.when(rows.isNull(), "not a list").when(F.size(rows) != F.size(segments), "wrong length")
    if kind == "lyric":
        return base.when(F.exists(pairs, lambda p: ~p["r"]["text"].eqNullSafe(p["s"]["text"])), "changed text").when(F.exists(pairs, lambda p: ~F.coalesce(p["r"]["is_lyric"].isin("true", "false"), F.lit(False))), "is_lyric is no boolean")
    base = base.when(F.exists(pairs, lambda p: p["r"]["text"].isNull()), "no text")
    if kind == "number":
        part = lambda p: F.try_divide(F.char_length(p["r"]["text"]).cast("double"), F.char_length(p["s"]["text"]))
        return base.when(F.exists(pairs, lambda p: F.coalesce((part(p) <= least) | (part(p) >= most), F.lit(False))), "changed length")
    bare = lambda t: F.lower(F.regexp_replace(t, r"[^\p{L}\p{N}\p{M}]", ""))
    return base.when(F.exists(pairs, lambda p: bare(p["r"]["text"]) != bare(F.coalesce(p["s"]["text"], F.lit("")))), "changed words")


def run_summary(results: DataFrame) -> DataFrame:
    return results.agg(F.countDistinct("file").alias("files"), F.count("*").alias("batches"), F.count_if(F.col("success")).alias("succeeded"), F.sum("attempts").alias("attempts"))


def success_weights(events: DataFrame, key: str, at_seconds: str, ok: Column, window: int = 600) -> DataFrame:
    """weight: the share of successes of the key's events in the window before and at each event, and 0.01.

    Events are dealt to buckets as long as the window, and once more to the next bucket, where they only count for others: so a key's
    events are never in one task.
    """
    own = F.floor(F.col(at_seconds) / window)
    dealt = events.withColumn("__ok", ok.cast("double")).withColumn("__b", F.explode(F.array(F.struct(own.alias("b"), F.lit(True).alias("own")), F.struct((own + 1).alias("b"), F.lit(False).alias("own")))))
    recent = Window.partitionBy(key, "__b.b").orderBy(at_seconds).rangeBetween(-window, 0)
    return dealt.withColumn("weight", F.avg("__ok").over(recent) + 0.01).filter("__b.own").drop("__b", "__ok")


def in_order(results: Iterable[dict], key: str = "task_id") -> list[dict]:
    return sorted(results, key=lambda r: r[key])
