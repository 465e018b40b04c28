"""A refinement of transcripts by a text service in two stages, file by file.

The first stage sees a sample of a file and its speakers and gives hotwords and the speakers' names; the second
sees the segments in batches, with what the first one found. A file is changed only if all its batches passed.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strophe.operators.batch_calls import Client, unfenced
from strophe.operators.neighbours import time_bucket, with_run_numbers


@dataclass(frozen=True)
class RefineRules:
    """sample: characters of the earliest segments that the language is told from. batch: segments in one call of the second stage. tries: calls for one batch. rounds: of both stages for one file."""

    sample: int = 3_000
    batch: int = 100
    tries: int = 10
    rounds: int = 5


def sample_texts(segments: DataFrame, rules: RefineRules = RefineRules()) -> DataFrame:
    """file, sample: the texts of each file's earliest segments, line by line, up to the one that reaches rules.sample characters. Empty texts and null ones don't count.

    Only segments among a file's first rules.sample ones can matter, so no more of a file is brought together.
    """
    texts = segments.filter("text <> ''").select("file", "start", "seg_no", "text")
    first = with_run_numbers(texts, "file", ["start", "seg_no"], F.lit(True), time_bucket()).filter(F.col("run_no") <= rules.sample)
    rows = first.groupBy("file").agg(F.array_sort(F.collect_list(F.struct("run_no", "text"))).alias("r"))
    step = lambda a, x: F.when(a["n"] >= rules.sample, a).otherwise(F.struct((a["n"] + F.char_length(x["text"])).alias("n"), F.concat(a["t"], F.when(a["n"] > 0, F.lit("\n")).otherwise(F.lit("")), x["text"]).alias("t")))
    start = F.struct(F.lit(0).alias("n"), F.lit("").alias("t"))
    return rows.select("file", F.aggregate("r", start, step)["t"].alias("sample"))


def prompt_lines(segments: Column) -> Column:
    """Segments (no, speaker, start, end, text) as the lines of a prompt; the speaker of an outlier is unknown."""
    who = lambda s: F.when(F.lower(s["speaker"]).contains("outlier"), F.lit("unknown")).otherwise(F.coalesce(s["speaker"], F.lit("None")))
    line = lambda s: F.concat(F.format_string("Segment %d:\nSpeaker %s from %.2f to %.2f", s["no"], who(s), F.coalesce(s["start"], F.lit(0.0)), F.coalesce(s["end"], F.lit(0.0))), F.when(s["text"] != "", F.concat(F.lit("\ntext: "), s["text"])).otherwise(F.lit("")))
    return F.array_join(F.transform(segments, line), "\n")


def refine_batches(segments: DataFrame, rules: RefineRules = RefineRules()) -> DataFrame:
    """file, batch_id, rows, lines: all segments of each file in batches of rules.batch, in order, with their lines for the prompt. A row is one batch, however long a file is."""
    numbered = with_run_numbers(segments, "file", ["start", "seg_no"], F.lit(True), time_bucket()).withColumn("no", (F.col("run_no") - 1).cast("int"))
    rows = numbered.groupBy("file", F.floor(F.col("no") / rules.batch).cast("int").alias("batch_id")).agg(F.array_sort(F.collect_list(F.struct("no", "seg_no", "speaker", "start", "end", "text"))).alias("rows"))
    return rows.withColumn("lines", prompt_lines(F.col("rows")))


def _stage(client: Client, prompt: str, right: Callable[[dict], bool], tries: int) -> tuple[dict | None, str | None]:
    error = None
    for _ in range(tries):
        try:
            found = json.loads(unfenced(client(prompt)))
        except Exception as e:  # noqa: BLE001 - kept as the row's error
            error = f"{type(e).__name__}: {e}"
            continue
        if isinstance(found, dict) and right(found):
            return found, None
        error = "wrong reply"
    return None, error


def refine(segments: DataFrame, client: Client, detect: Callable[[str], str | None], rules: RefineRules = RefineRules()) -> DataFrame:
    """file, seg_no, text, speaker, text_gpt, speaker_gpt, hotwords, language, refined, error for every segment.

    segments needs file, seg_no, start, end, speaker, text. The first stage is one call a file, the second one call a batch of rules.batch
    segments; both are tried again until a reply passes (it has as many segments as the batch). Only where all batches of a file passed are the
    *_gpt columns filled. A null file is a file of its own.
    """

    def first(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for file, sample in zip(frame["file"], frame["sample"], strict=True):
                language = detect(sample) if sample and sample.strip() else None
                found, error = _stage(client, f"stage 1\nlanguage: {language}\n{sample}", lambda f: "hotwords" in f, rules.rounds)
                found = found or {}
                out.append((file, language, json.dumps(found.get("hotwords", []), ensure_ascii=False), json.dumps(found.get("speaker_map", {}), ensure_ascii=False), error))
            yield pd.DataFrame(out, columns=["file", "language", "hotwords", "speaker_map", "error"])

    def second(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for file, batch, rows, lines, hotwords, names, failed in zip(*(frame[c] for c in ("file", "batch_id", "rows", "lines", "hotwords", "speaker_map", "error")), strict=True):
                found, error = None, failed
                if not failed:
                    found, error = _stage(client, f"stage 2\nhotwords: {hotwords}\nspeakers: {names}\n{lines}", lambda f, n=len(rows): isinstance(f.get("data"), list) and len(f["data"]) == n, rules.tries)
                for k, row in enumerate(rows):
                    one = (found["data"][k] or {}) if found else {}
                    out.append((file, batch, row["seg_no"], row["text"], row["speaker"], one.get("text"), one.get("speaker"), error))
            yield pd.DataFrame(out, columns=["file", "batch_id", "seg_no", "text", "speaker", "text_gpt", "speaker_gpt", "error"])

    files = segments.select("file").distinct().select(F.col("file").alias("file_"))
    samples = sample_texts(segments, rules)
    known = files.join(samples, F.expr("file <=> file_"), "left").select(F.col("file_").alias("file"), F.coalesce("sample", F.lit("")).alias("sample")).mapInPandas(first, "file string, language string, hotwords string, speaker_map string, error string")
    known = known.withColumnRenamed("file", "file_")
    batches = refine_batches(segments, rules).join(known, F.expr("file <=> file_"))
    kind = dict(segments.dtypes)["seg_no"]
    done = batches.select("file", "batch_id", "rows", "lines", "hotwords", "speaker_map", "error").mapInPandas(second, f"file string, batch_id int, seg_no {kind}, text string, speaker string, text_gpt string, speaker_gpt string, error string")
    verdict = done.groupBy(F.col("file").alias("f_")).agg(F.max("error").alias("worst"))
    joined = done.join(verdict, F.expr("file <=> f_")).join(known.select("file_", "language", "hotwords"), F.expr("file <=> file_"))
    good = F.col("worst").isNull()
    return joined.select("file", "seg_no", "text", "speaker", F.when(good, F.col("text_gpt")).alias("text_gpt"), F.when(good, F.col("speaker_gpt")).alias("speaker_gpt"), F.when(good, F.col("hotwords")).alias("hotwords"), "language", good.alias("refined"), F.col("worst").alias("error"))
