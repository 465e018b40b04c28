"""Runs of a text service as settings name them: what is asked, of whom, and how."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame

from strophe.operators.batch_calls import PROCESSORS, CallRules, Client, ServicePool, SimpleTask, call_checked, pooled, run_tasks


@dataclass(frozen=True)
class RunSettings:
    """mode: single (one prompt), batch (a prompt a row, no checks) or task (a processor with its checks). count: how many tasks at most, 0 for all."""

    mode: str = "task"
    parallel: bool = True
    processor: str = "lyric"
    api_family: str = ""
    max_api_retries: int = 8
    max_check_retries: int = 4
    count: int = 0
    prompt: str = ""


def read_settings(text: str) -> RunSettings:
    """Settings from lines "name: value" with # comments; names that aren't settings are left to others."""
    known = {f.name: f.type for f in fields(RunSettings)}
    found: dict = {}
    for line in text.splitlines():
        name, colon, value = line.split(" #")[0].partition(":")
        name, value = name.strip(), value.strip().strip("'\"")
        if not colon or name.startswith("#") or name not in known or value == "":
            continue
        kind = known[name]
        found[name] = value.lower() in ("true", "yes", "1") if kind == "bool" else int(value) if kind == "int" else value
    settings = RunSettings(**found)
    if settings.mode not in ("single", "batch", "task"):
        raise ValueError(f"no mode {settings.mode}")
    return settings


def run(settings: RunSettings, families: dict[str, dict[str, Client]], tasks: DataFrame | None = None, pool: Callable[[dict[str, Client]], Client] = ServicePool) -> DataFrame | dict:
    """The results of a run: of a single prompt its one result; else a row for each task (file, batch_id, segments).

    Parallel runs are spread over the tasks' partitions; a sequential one sends one task after the other from the driver, which
    streams them and keeps their results. `count` takes the first tasks by file and batch.
    """
    client = pool(pooled(families, settings.api_family))
    rules = CallRules(settings.max_api_retries, settings.max_check_retries)
    if settings.mode == "single":
        return call_checked([{"prompt": settings.prompt}], SimpleTask(), client, rules)
    if tasks is None:
        raise ValueError(f"mode {settings.mode} needs tasks")
    processor = SimpleTask() if settings.mode == "batch" else PROCESSORS[settings.processor].processor()
    if settings.count:
        tasks = tasks.orderBy("file", "batch_id").limit(settings.count)
    if settings.parallel:
        return run_tasks(tasks, processor, client, rules)
    out = []
    for row in tasks.select("file", "batch_id", "segments").toLocalIterator():
        out.append({"file": row.file, "batch_id": row.batch_id} | call_checked([s.asDict() for s in row.segments], processor, client, rules))
    schema = "file string, batch_id int, success boolean, reply string, attempts int, error string"
    return tasks.sparkSession.createDataFrame(out, schema)
