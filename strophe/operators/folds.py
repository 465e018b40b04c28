"""Ordered folds: what depends on the chunk that is open cannot be a window.

A fold reads a key's rows in order as a stream and gives rows as soon as they are settled, so it holds its
open chunk only, never a whole key. The rows come from one shuffle by key, sorted by Spark (which spills).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strophe.functions.text import ends_with_mark

Fold = Callable[[Iterator[tuple]], Iterable[tuple]]


def fold_rows(df: DataFrame, key: str, order: list[str], columns: list[str], function: Fold, schema: list[tuple[str, str]]) -> DataFrame:
    """key and the rows that `function` gives for the rows (`columns`) of each key, in order. A null key is a key of its own."""
    kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_()}
    names = [n for n, _ in schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types: list[pa.DataType] = []

        def rows() -> Iterator[tuple]:
            for batch in batches:
                types[:] = [batch.schema[0].type]
                yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

        def pack(out: list[tuple]) -> pa.RecordBatch:
            arrays = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), [types[0], *(kinds[k] for _, k in schema)], strict=True)]
            return pa.RecordBatch.from_arrays(arrays, ["key", *names])

        out: list[tuple] = []
        for value, group in groupby(rows(), key=lambda r: r[0]):
            for row in function(r[1:] for r in group):
                out.append((value, *row))
                if len(out) >= 8192:
                    yield pack(out)
                    out = []
        if out:
            yield pack(out)

    spec = f"key {dict(df.dtypes)[key]}, " + ", ".join(f"`{n}` {k}" for n, k in schema)
    slim = df.select(key, *dict.fromkeys([*columns, *order]))
    ordered = slim.repartition(key).sortWithinPartitions(key, *order).select(key, *columns)
    return ordered.mapInArrow(run, spec).withColumnRenamed("key", key)


def merged_lines(chunked: DataFrame, key: str) -> DataFrame:
    """key, text, start, end, merged_count: the rows (label, rest, start, end, seg_no) of each chunk as one line. Texts are joined by a space, after a stop where no mark ends the text before; the label stands in front."""
    row = F.struct("start", "seg_no", "rest", "end")
    whole = chunked.groupBy(key, "chunk_no").agg(F.array_sort(F.collect_list(row)).alias("rows"), F.first("label").alias("label"))
    stop = lambda t: F.when((F.trim(t) != "") & ~ends_with_mark(t), F.lit(".")).otherwise(F.lit(""))
    text = F.aggregate(F.slice("rows", 2, F.greatest(F.size("rows") - 1, F.lit(0))), F.col("rows")[0]["rest"], lambda t, x: F.when(x["rest"] == "", t).otherwise(F.concat(t, stop(t), F.lit(" "), x["rest"])))
    labelled = F.when(F.col("label").isNotNull(), F.concat(F.lit("["), "label", F.lit("] "), text)).otherwise(text)
    return whole.select(key, labelled.alias("text"), F.col("rows")[0]["start"].alias("start"), F.element_at("rows", -1)["end"].alias("end"), F.size("rows").alias("merged_count"))


def chunk_lyrics(rows: Iterator[tuple], size: float = 10.0, least: float = 3.0, mode: int = 3, lead: float = 0.5, brief: float = 2.0) -> Iterator[tuple]:
    """Rows (label, brackets, words, start, end) as chunks (text, start, end, is_lyric, merged_count).

    First, neighbours without words are joined while their labels agree or one is unknown; lyrics of one label up to `size`, half as much
    again for one shorter than `least`; such a short one may also join the chunk before a wordless chunk that it touches, and takes that in.
    In mode 2 and 3 a lyric after a wordless chunk then starts `lead` earlier, at that one's cost; in mode 3 a wordless chunk shorter than `brief`
    between two lyrics is split between them. No chunk is lost and none is given twice. Rows without both times, the end after the start, are left out.
    """
    chunks = _joined(rows, size, least)
    if mode >= 2:
        chunks = _led(chunks, lead)
    if mode >= 3:
        chunks = _split_brief(chunks, brief)
    for c in chunks:
        yield (f"{c['brackets']} {c['words']}".strip(), c["start"], c["end"], bool(c["words"]), c["count"])


def _joined(rows: Iterator[tuple], size: float, least: float) -> Iterator[dict]:
    before: dict | None = None
    now: dict | None = None
    for label, brackets, words, start, end in rows:
        if start is None or end is None or end <= start:
            continue
        new = {"label": label, "brackets": brackets or "", "words": words or "", "start": start, "end": end, "count": 1}
        if now is None:
            now = new
            continue
        length = end - start
        if now["words"] and new["words"]:
            fits = end - now["start"] <= size or (length < least and now["end"] - now["start"] + length <= 1.5 * size)
            join = label == now["label"] and fits
        else:
            join = not now["words"] and not new["words"] and (label == now["label"] or label is None or now["label"] is None)
        if join:
            if new["words"]:
                now["words"] += "\t" + new["words"]
            now["end"] = end
            now["count"] += 1
            continue
        back = before is not None and before["words"] and not now["words"] and new["words"] and length < least and label == before["label"]
        if back and abs(now["start"] - before["end"]) <= 0.01 and end - before["start"] <= 1.5 * size:
            before["words"] += "\t" + new["words"]
            before["end"] = end
            before["count"] += now["count"] + 1
            before, now = None, before
            continue
        if before is not None:
            yield before
        before, now = now, new
    if before is not None:
        yield before
    if now is not None:
        yield now


def _led(chunks: Iterable[dict], lead: float) -> Iterator[dict]:
    before: dict | None = None
    for now in chunks:
        if before is not None and now["words"] and not before["words"]:
            start = max(now["start"] - lead, before["start"])
            if start < now["start"]:
                now["start"] = start
                before["end"] = start
                if start <= before["start"]:
                    before = None
        if before is not None:
            yield before
        before = now
    if before is not None:
        yield before


def _split_brief(chunks: Iterable[dict], brief: float) -> Iterator[dict]:
    held: list[dict] = []
    for now in chunks:
        if now["end"] - now["start"] <= 0:
            continue
        held.append(now)
        if len(held) == 3:
            a, b, c = held
            if a["words"] and not b["words"] and c["words"] and b["end"] - b["start"] < brief:
                a["end"] = c["start"] = (b["start"] + b["end"]) / 2
                held = [a, c]
            yield held.pop(0)
    yield from held


def tidy_boundaries(rows: Iterator[tuple], brief: float = 1.0, edge: float = 10.0) -> Iterator[tuple]:
    """Rows (time, label), the last of them the end: too short first and last stretches are taken in, so are equal neighbours at the edges within `edge`. Holds a song's boundaries."""
    marks = list(rows)
    while len(marks) > 2 and marks[1][0] - marks[0][0] < brief:
        marks[:2] = [(marks[0][0], marks[1][1])]
    while len(marks) > 2 and marks[-1][0] - marks[-2][0] < brief:
        del marks[-2]
    while len(marks) > 2 and marks[0][1] == marks[1][1] and marks[1][0] <= edge:
        del marks[1]
    while len(marks) > 2 and marks[-2][1] == marks[-3][1] and marks[-1][0] - marks[-2][0] <= edge:
        del marks[-2]
    yield from marks


def merge_speech(rows: Iterator[tuple], near: float = 0.6, gap: float = 1.0, longest: float = 60.0, loose_gap: float = 1.0, brief: float = 0.75) -> Iterator[tuple]:
    """Rows (labels_a, labels_b, likeness to the row before, text, start, end) as (text, start, end, count).

    A row joins the one before if either label agrees, they are alike, the gap is small and the whole isn't too long; or if the
    gap is small and either is brief.
    """
    now: list | None = None
    for a, b, like, text, start, end in rows:
        if now is not None:
            space = start - now[3]
            alike = (a == now[0] or b == now[1]) and like is not None and like > near and space < gap and end - now[2] <= longest
            if alike or space < loose_gap and (now[3] - now[2] < brief or end - start < brief):
                now[3] = end
                now[4] += " " + (text or "")
                now[5] += 1
                continue
            yield now[4], now[2], now[3], now[5]
        now = [a, b, start, end, text or "", 1]
    if now is not None:
        yield now[4], now[2], now[3], now[5]
