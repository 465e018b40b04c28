"""Documents in containers of fixed capacity: hierarchical packing over tiers of length.

Only the numbers of items of each length leave the executors: at most as many rows as a container has
tokens. From them the driver makes patterns (which lengths share a container, and in how many containers),
tier by tier: documents are routed to context sizes by length, each tier is packed in windows of its context size,
and gaps are filled from the shorter tiers. Items are then ranked within their length and take the patterns' places, so no item is compared with another.
"""

from __future__ import annotations

import base64
import os
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strophe.session import cut_lineage


@dataclass(frozen=True)
class PackRules:
    """capacity: tokens of a container. tiers: context sizes. vocabulary: file of a public byte-level tokenizer (ranks), which only the driver reads. group: containers of one step. spread: items of one length are ranked in parts of about so many."""

    vocabulary: str = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
    pattern: str = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    capacity: int = 2048
    tiers: tuple[int, ...] = (2048, 1024, 512, 256, 128)
    group: int = 8
    spread: int = 200_000


_encodings: dict = {}


def read_vocabulary(path: str) -> bytes:
    """The ranks file, read by the driver and sent to the executors, which needn't have it."""
    if not os.path.isfile(path):
        raise FileNotFoundError(f"no vocabulary at {path}: give PackRules the file of a byte-level tokenizer")
    if os.path.getsize(path) > 64_000_000:
        raise ValueError(f"{path} is too large to send")
    with open(path, "rb") as lines:
        return lines.read()


def _encoding(ranks: bytes, pattern: str):
    key = hash((ranks, pattern))
    if key not in _encodings:
        import tiktoken

        pairs = (line.split() for line in ranks.splitlines() if line)
        _encodings[key] = tiktoken.Encoding("public", pat_str=pattern, mergeable_ranks={base64.b64decode(a): int(b) for a, b in pairs}, special_tokens={})
    return _encodings[key]


def count_tokens(df: DataFrame, row: str, text: str, rules: PackRules = PackRules()) -> DataFrame:
    """row and tokens, of whole texts. A null or empty text has none."""
    shared = df.sparkSession.sparkContext.broadcast(read_vocabulary(rules.vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoding(shared.value, rules.pattern).encode_ordinary
        for batch in batches:
            counts = [len(encode(t)) if t else 0 for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], ["row", "tokens"])

    return df.select(F.col(row).alias("row"), text).mapInArrow(run, f"row {dict(df.dtypes)[row]}, tokens long").withColumnRenamed("row", row)


def plan_patterns(counts: dict[int, int], rules: PackRules) -> list[tuple[dict[int, int], int, int]]:
    """Patterns (length to number of items), in how many containers each is used, and its tier; tiers from long to short.

    A tier's container consists of windows of its context size. Each window is opened by the longest item left of the tier, and its gap
    is filled from the shorter tiers, longest first (the shortest tier fills its own). What the windows of a container leave over is one
    gap, filled once more from the tier and the shorter ones; two items that close it exactly are preferred. A pattern is
    repeated as often as its lengths last, so each round uses up a length: there are at most as many patterns as lengths.
    """
    left = {size: n for size, n in counts.items() if n and size > 0}
    sizes = sorted(left)
    tiers = sorted({t for t in rules.tiers if t < rules.capacity} | {rules.capacity})
    patterns = []

    def fitting(space: int, most: int, pattern: dict[int, int]) -> int:
        """Index of the longest length up to `space` and `most` of which an item is left, -1 if there is none."""
        at = bisect_right(sizes, min(space, most)) - 1
        while at >= 0 and pattern.get(sizes[at], 0) >= left[sizes[at]]:
            at -= 1
        return at

    def closing(space: int, high: int, pattern: dict[int, int]) -> int | None:
        """The longer of two lengths that fill `space` exactly."""
        low = 0
        while low <= high:
            total = sizes[low] + sizes[high]
            if total == space:
                need = 2 if low == high else 1
                if all(pattern.get(x, 0) + need <= left[x] for x in (sizes[low], sizes[high])):
                    return sizes[high]
            if total > space:
                high -= 1
            else:
                low += 1
        return None

    for number in range(len(tiers) - 1, -1, -1):
        tier, shorter = tiers[number], tiers[number - 1] if number else 0
        fill = shorter or tier
        while sizes and sizes[-1] > shorter:
            pattern: dict[int, int] = {}
            used = 0

            def add(size: int, pattern: dict[int, int] = pattern) -> int:
                pattern[size] = pattern.get(size, 0) + 1
                return size

            for _ in range(max(1, rules.capacity // tier)):
                at = fitting(tier, tier, pattern)
                if at < 0 or sizes[at] <= shorter:
                    break
                window = add(sizes[at])
                while (at := fitting(tier - window, fill, pattern)) >= 0:
                    window += add(sizes[at])
                used += window
            while (at := fitting(rules.capacity - used, tier, pattern)) >= 0:
                take, space = sizes[at], rules.capacity - used
                if 0 < space - take < sizes[0]:
                    take = closing(space, at, pattern) or take
                used += add(take)
            times = min(left[size] // n for size, n in pattern.items())
            patterns.append((pattern, times, tier))
            for size, n in pattern.items():
                left[size] -= n * times
                if not left[size]:
                    del sizes[bisect_left(sizes, size)]
    return patterns


def pack(tokens: DataFrame, row: str, rules: PackRules = PackRules()) -> DataFrame:
    """row, piece_no, tokens, container, tier, step_group for each document, from its number of tokens.

    A document longer than a container is cut into full containers and a rest, which is packed like any other; all others have
    the single piece 0. Documents without tokens take no space; they are dealt out over the containers. tier is the context size
    of the container's windows. Containers are numbered by tier and fill and dealt to groups of steps to and fro, so that groups
    have like shares of every tier and of tokens. A null number of tokens counts as none; repeated documents are packed each.
    """
    c = rules.capacity
    sized = tokens.select(F.col(row).alias("row"), F.coalesce("tokens", F.lit(0)).alias("n"))
    pieces = sized.select("row", F.col("n"), F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.col("n") / c).cast("int") - 1))).alias("piece_no"))
    pieces = pieces.select("row", "piece_no", F.least(F.lit(c), F.col("n") - F.col("piece_no") * c).cast("int").alias("size"))
    total = tokens.count()
    parts = max(1, min(4096, total // rules.spread))
    pieces = pieces.withColumn("part", F.pmod(F.xxhash64("row", "piece_no"), F.lit(parts)).cast("int"))
    counts = pieces.groupBy("size", "part").count()
    by_size = {r[0]: r[1] for r in counts.groupBy("size").agg(F.sum("count")).collect()}
    patterns = plan_patterns({s: n for s, n in by_size.items() if s > 0}, rules)
    # Within a tier the fullest containers first, so that dealing them to and fro gives the groups like numbers of tokens.
    patterns.sort(key=lambda p: (-p[2], -sum(size * n for size, n in p[0].items())))
    containers = max(1, sum(times for _, times, _ in patterns))
    groups = max(1, -(-containers // rules.group))
    slots: dict[int, list[tuple[int, int, int]]] = {}
    used: dict[int, int] = {}
    base = 0
    for pattern, times, _ in patterns:
        for size, n in pattern.items():
            slots.setdefault(size, []).append((used.get(size, 0), times, base))
            used[size] = used.get(size, 0) + n * times
        base += times
    table = {size: tuple(np.array(x, dtype=np.int64) for x in zip(*rows, strict=True)) for size, rows in slots.items()}
    bases = np.cumsum([0] + [times for _, times, _ in patterns])
    tiers = np.array([tier for _, _, tier in patterns] or [min((*rules.tiers, c))])

    ranked = pieces.withColumn("rank", F.row_number().over(Window.partitionBy("size", "part").orderBy("row", "piece_no")) - 1)
    ahead = counts.select(F.col("size").alias("size_"), F.col("part").alias("part_"), (F.sum("count").over(Window.partitionBy("size").orderBy("part")) - F.col("count")).alias("ahead"))
    placed = ranked.join(ahead, F.expr("size = size_ and part = part_")).select("row", "piece_no", "size", (F.col("rank") + F.col("ahead")).cast("long").alias("rank"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, rank = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            container = rank % containers
            for s in np.unique(size[size > 0]).tolist():
                at = np.flatnonzero(size == s)
                start, times, first = table[s]
                i = np.searchsorted(start, rank[at], side="right") - 1
                container[at] = first[i] + (rank[at] - start[i]) % times[i]
            tier = tiers[np.maximum(np.searchsorted(bases, container, side="right") - 1, 0).clip(max=len(tiers) - 1)]
            turn, place = container // groups, container % groups
            group = np.where(turn % 2 == 0, place, groups - 1 - place)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(size, pa.int32()), pa.array(container, pa.int64()), pa.array(tier, pa.int32()), pa.array(group, pa.int64())], ["row", "piece_no", "tokens", "container", "tier", "step_group"])

    return placed.mapInArrow(run, f"row {dict(tokens.dtypes)[row]}, piece_no int, tokens int, container long, tier int, step_group long").withColumnRenamed("row", row)


def pack_texts(df: DataFrame, row: str, text: str, rules: PackRules = PackRules()) -> DataFrame:
    """count_tokens and pack. The counts are written once, since the plan and the assignment both need them."""
    return pack(cut_lineage(count_tokens(df, row, text, rules)), row, rules)
