"""Evaluation texts inside documents: latent semantic retrieval, then alignment.

Passages are TF-IDF vectors over the pairs of neighbouring units that test items hold. Items are worked on in
batches of bounded size, a batch in blocks, and each block has a latent space from a randomised singular value
decomposition of the passages of documents and items: sums over documents are made in the executors, block by
block. A passage is compared by cosine with the passages of those blocks that hold enough of its weight; what is
near is checked by its longest common subsequence with the item, a local alignment, and the item's rarest units.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strophe.llm.units import LARGEST, hashed_units
from strophe.operators.sample import bounded_sample
from strophe.session import cut_lineage

_ONE = np.zeros(1, dtype=np.int64)


@dataclass(frozen=True)
class LeakRules:
    """stride: units between passages at most, in spaced and unspaced scripts; a passage is two strides long, and a stride at most a third of the shortest item
    of its block. rank: of a latent space, fitted with `extra` more. sample: documents that the spaces are fitted on besides all items, summed in `tasks` tasks; corpus: their
    weight against the items'. near: least cosine of a candidate. share: least part of an item's units that must be matched, in order, in one
    passage. reworded, answer: least common subsequence and least share of the rarest units of a reworded item. batch, block: items in one pass over the documents and in one latent space. tiny: items of
    fewer units are looked for unit by unit."""

    stride: tuple[int, int] = (12, 32)
    rank: int = 128
    extra: int = 16
    sample: int = 10_000
    tasks: int = 8
    corpus: float = 0.3
    near: float = 0.42
    share: float = 0.5
    reworded: float = 0.35
    answer: float = 0.8
    batch: int = 1_000
    block: int = 96
    tiny: int = 4
    seed: int = 7


@dataclass
class Space:
    """A block of items: the rows of `basis` for its features (weighted), and its passages in the latent space."""

    stride: int
    items: list[int]
    features: np.ndarray
    basis: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), dtype=np.float32))
    passages: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), dtype=np.float32))
    item_of: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int64))
    offset: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int64))


@dataclass
class LeakIndex:
    """Items and their features. slots: a hash table from pairs of units to features; member_*: the blocks that have a feature, and its row there."""

    ids: list
    units: list[np.ndarray]
    keys: np.ndarray
    slots: np.ndarray
    spaces: list[Space]
    member_first: np.ndarray
    member_count: np.ndarray
    member_block: np.ndarray
    member_local: np.ndarray
    tiny: dict[int, list[int]]
    idf: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.float32))
    unseen: float = 1.0
    answers: list[frozenset[int]] = field(default_factory=list)

    def features(self, pairs: np.ndarray) -> np.ndarray:
        """The feature of each pair, -1 if no item has it."""
        at = (pairs & np.uint64(len(self.slots) - 1)).astype(np.int64)
        found = self.slots[at]
        out = np.where((found >= 0) & (self.keys[np.maximum(found, 0)] == pairs), found, -1) if len(self.keys) else np.full(len(pairs), -1)
        crowded = np.flatnonzero((found >= 0) & (out < 0))
        if len(crowded):
            place = np.minimum(np.searchsorted(self.keys, pairs[crowded]), len(self.keys) - 1)
            out[crowded] = np.where(self.keys[place] == pairs[crowded], place, -1)
        return out


def unit_pairs(units: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A 64-bit key of each unit and the one after it; 0 at the last unit of a text."""
    if not len(units):
        return np.zeros(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        a, b = units.astype(np.uint64), np.concatenate((units[1:], [0])).astype(np.uint64)
        keys = (a * np.uint64(0x9E3779B97F4A7C15)) ^ ((b + np.uint64(0x632BE5AB)) * np.uint64(0xC2B2AE3D27D4EB4F))
        keys ^= keys >> np.uint64(31)
    ends = np.concatenate((first[1:], [len(units)])) - 1
    keys[ends[ends >= 0]] = 0
    return keys


def make_index(rows: list[tuple], rules: LeakRules) -> LeakIndex:
    """Items as (id, text, lang). Items without units can't leak. lang only says which items share a latent space; a pair of units counts in every block that has it."""
    ids, units, sort = [], [], []
    for item, text, lang in rows:
        found, _, single = hashed_units([text])
        if len(found):
            sort.append((bool(single.mean() > 0.5), len(found).bit_length() // 2, (lang or "").strip().lower()[:2], len(ids)))
            ids.append(item)
            units.append(found)
    tiny: dict[int, list[int]] = {}
    blocks: list[list[int]] = []
    last: tuple | None = None
    for loose, length, lang, i in sorted(sort):
        if len(units[i]) < rules.tiny:
            for unit in set(units[i].tolist()):
                tiny.setdefault(unit, []).append(i)
            continue
        if last is None or last[:2] != (loose, length) or len(blocks[-1]) >= (rules.block if last[2] == lang else rules.block // 4):
            blocks.append([])
        blocks[-1].append(i)
        last = (loose, length, lang)
    pairs = {i: unit_pairs(units[i], _ONE)[:-1] for block in blocks for i in block}
    keys = np.unique(np.concatenate([*pairs.values(), np.zeros(0, dtype=np.uint64)]))
    spaces, feature, owner, local = [], [], [], []
    for b, block in enumerate(blocks):
        own = np.searchsorted(keys, np.unique(np.concatenate([pairs[i] for i in block])))
        most = rules.stride[next(int(s[0]) for s in sort if s[3] == block[0])]
        spaces.append(Space(max(1, min(most, min(len(units[i]) for i in block) // 3)), block, own))
        feature.append(own)
        owner.append(np.full(len(own), b, dtype=np.int16))
        local.append(np.arange(len(own)))
    feature, owner, local = (np.concatenate([*x, np.zeros(0, dtype=np.int64)]).astype(t) for x, t in ((feature, np.int64), (owner, np.int16), (local, np.int64)))
    order = np.argsort(feature, kind="stable")
    count = np.bincount(feature, minlength=len(keys)).astype(np.int64)
    size = 1 << max(10, int(np.ceil(np.log2(max(1, len(keys)) * 8))))
    slots = np.full(size, -1, dtype=np.int32)
    slots[(keys & np.uint64(size - 1)).astype(np.int64)[::-1]] = np.arange(len(keys))[::-1]
    return LeakIndex(ids, units, keys, slots, spaces, np.cumsum(count) - count, count, owner[order], local[order], tiny)


def _unit_table(df: DataFrame, row: str, text: str) -> DataFrame:
    """row and its units, four bytes each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                units, first, _ = hashed_units(part.column(1).to_pylist())
                offsets = np.concatenate((first, [len(units)])).astype(np.int32) * 4
                packed = pa.Array.from_buffers(pa.binary(), part.num_rows, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(units.tobytes())])
                yield pa.RecordBatch.from_arrays([part.column(0), packed], ["row", "units"])

    return df.select(F.col(row).alias("row"), text).mapInArrow(run, f"row {dict(df.dtypes)[row]}, units binary")


def _read(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Units of a batch of the unit table, and where each row's begin."""
    column = batch.column(1)
    rows = column.to_pylist()
    lengths = np.fromiter((len(r) // 4 for r in rows), dtype=np.int64, count=len(rows))
    return np.frombuffer(b"".join(rows), dtype=np.uint32), np.concatenate(([0], np.cumsum(lengths)[:-1])).astype(np.int64)


def _hits(index: LeakIndex, units: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found = index.features(unit_pairs(units, first))
    at = np.flatnonzero(found >= 0)
    return at, found[at]


def _by_block(index: LeakIndex, at: np.ndarray, found: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Block, positions and local features, for each block that has any of the features found."""
    count = index.member_count[found]
    total = int(count.sum())
    if not total:
        return
    hit = np.repeat(np.arange(len(found)), count)
    member = index.member_first[found[hit]] + np.arange(total) - np.repeat(np.cumsum(count) - count, count)
    block = index.member_block[member]
    order = np.argsort(block, kind="stable")
    bounds = np.searchsorted(block[order], np.arange(len(index.spaces) + 1))
    for b in np.flatnonzero(np.diff(bounds)).tolist():
        part = order[bounds[b] : bounds[b + 1]]
        yield b, at[hit[part]], index.member_local[member[part]]


def _frequencies(table: DataFrame, shared: Broadcast) -> DataFrame:
    """feature, n: how often each item feature occurs, over all documents; feature -1 counts stretches of 16 units."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        total = np.zeros(len(index.keys) + 1, dtype=np.int64)
        for batch in batches:
            units, first = _read(batch)
            if len(units):
                _, found = _hits(index, units, first)
                total[:-1] += np.bincount(found, minlength=len(index.keys))
                total[-1] += len(units) // 16 + len(first)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.where(seen == len(total) - 1, -1, seen), pa.int64()), pa.array(total[seen], pa.int64())], ["feature", "n"])

    return table.mapInArrow(run, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n"))


@dataclass
class Passages:
    """Passages of two strides: first positions, rows, products with the weights, lengths of their vectors, and the runs of hits that are theirs."""

    start: np.ndarray
    row: np.ndarray
    vectors: np.ndarray
    norm: np.ndarray


def _passages(index: LeakIndex, space: Space, at: np.ndarray, local: np.ndarray, size: int, first: np.ndarray, weights: np.ndarray, near: float) -> Passages:
    """The passages of documents that have at least near² of their squared weight in the block's features: no other can have a cosine of `near` with any of its items.

    Blocks of a stride are numbered over all rows, with a free number after each row.
    """
    stride, idf = space.stride, index.idf[space.features]
    lengths = np.diff(np.concatenate((first, [size])))
    count = lengths // stride + 2
    base = np.concatenate(([0], np.cumsum(count)[:-1]))
    of = np.searchsorted(first, at, side="right") - 1
    block = base[of] + (at - first[of]) // stride
    begin = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1])))
    numbers = block[begin]
    square = np.add.reduceat(idf[local].astype(np.float64) ** 2, begin)
    hits = np.diff(np.concatenate((begin, [len(at)])))
    row = np.searchsorted(base, numbers, side="right") - 1
    inside = np.minimum(stride, lengths[row] - (numbers - base[row]) * stride)
    mass = square + np.maximum(inside - hits, 0) * index.unseen**2
    follows = np.concatenate((numbers[1:] == numbers[:-1] + 1, [False]))
    nxt = np.minimum(np.arange(len(numbers)) + 1, len(numbers) - 1)
    # A next block without any feature still has its mass.
    left = np.clip(lengths[row] - (numbers - base[row] + 1) * stride, 0, stride)
    total = mass + np.where(follows, mass[nxt], left * index.unseen**2)
    good = np.flatnonzero(square + np.where(follows, square[nxt], 0.0) >= near**2 * total)
    if not len(good):
        none = np.zeros(0, dtype=np.int64)
        return Passages(none, none, np.zeros((0, weights.shape[1]), dtype=np.float32), np.zeros(0))
    need = np.zeros(len(numbers), dtype=bool)
    need[good] = True
    need[nxt[good]] |= follows[good]
    wanted = np.flatnonzero(need)
    compact = np.full(len(numbers), -1, dtype=np.int64)
    compact[wanted] = np.arange(len(wanted))
    sums = _sum_runs(weights, local[np.repeat(need, hits)], hits[wanted])
    vectors = sums[compact[good]]
    double = follows[good]
    vectors[double] += sums[compact[nxt[good[double]]]]
    return Passages(first[row[good]] + (numbers[good] - base[row[good]]) * stride, row[good], vectors, np.sqrt(total[good]))


def _sum_runs(weights: np.ndarray, rows: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of `weights` over runs of rows, each run counts[i] long: the j-th rows of all runs are added at once."""
    begin = np.concatenate(([0], np.cumsum(counts)[:-1]))
    order = np.argsort(-counts, kind="stable")
    begin, left = begin[order], counts[order]
    sums = weights[rows[begin]]
    for j in range(1, int(left[0])):
        live = int(np.searchsorted(-left, -j, side="left"))
        sums[:live] += weights[rows[begin[:live] + j]]
    out = np.empty_like(sums)
    out[order] = sums
    return out


def _summed(sample: DataFrame, shared: Broadcast, outer: bool) -> dict[int, np.ndarray]:
    """For each block a sum over the sample's passages a and their products z with the block's weights: of a zᵀ (outer), or of z zᵀ. Tasks send a block's sums one by one, and they are added before they reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, weights, near = shared.value
        out: dict[int, np.ndarray] = {}
        for batch in batches:
            units, first = _read(batch)
            if not len(units):
                continue
            for b, at, local in _by_block(index, *_hits(index, units, first)):
                space = index.spaces[b]
                p = _passages(index, space, at, local, len(units), first, weights[b], near)
                if not len(p.start):
                    continue
                z = p.vectors / np.maximum(p.norm, 1e-9)[:, None].astype(np.float32)
                if b not in out:
                    out[b] = np.zeros(weights[b].shape if outer else (z.shape[1],) * 2, dtype=np.float32)
                if not outer:
                    out[b] += z.T @ z
                    continue
                low = np.searchsorted(at, p.start)
                n = np.searchsorted(at, p.start + 2 * space.stride) - low
                taken = np.repeat(low - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
                passage, feature = np.repeat(np.arange(len(n)), n), local[taken]
                order = np.argsort(feature, kind="stable")
                for i in range(0, len(order), 16_384):
                    part = order[i : i + 16_384]
                    f = feature[part]
                    edge = np.flatnonzero(np.concatenate(([True], f[1:] != f[:-1])))
                    share = index.idf[space.features[f]] / np.maximum(p.norm[passage[part]], 1e-9)
                    out[b][f[edge]] += np.add.reduceat(share[:, None].astype(np.float32) * z[passage[part]], edge)
        for b, sums in out.items():
            yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([sums.tobytes()], pa.binary())], ["block", "sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for b, sums in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                one = np.frombuffer(sums.as_buffer(), dtype=np.float32)
                total[b] = total[b] + one if b in total else one.copy()
        for b, sums in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([sums.tobytes()], pa.binary())], ["block", "sums"])

    schema = "block int, sums binary"
    rows = sample.mapInArrow(run, schema).repartition("block").mapInArrow(add, schema).collect()
    return {r.block: np.frombuffer(bytes(r.sums), dtype=np.float32) for r in rows}


def _item_passages(index: LeakIndex, space: Space) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The block's passages as unit vectors over its features, half a stride apart, their items, and where in the item each begins."""
    rows, items, offsets = [], [], []
    width, step = 2 * space.stride, max(1, space.stride // 2)
    for i in space.items:
        pairs = np.searchsorted(space.features, index.features(unit_pairs(index.units[i], _ONE)[:-1]))
        for a in range(0, max(1, len(index.units[i]) - width + step), step):
            got = pairs[a : a + width]
            if len(got):
                vector = np.bincount(got, index.idf[space.features[got]], len(space.features))
                rows.append((vector / max(float(np.linalg.norm(vector)), 1e-9)).astype(np.float32))
                items.append(i)
                offsets.append(a)
    return np.stack(rows), np.array(items, dtype=np.int64), np.array(offsets, dtype=np.int64)


def fit_spaces(table: DataFrame, index: LeakIndex, rules: LeakRules) -> None:
    """A latent space for each block: a randomised singular value decomposition of the passages of a bounded sample of documents and of all items.

    The first pass multiplies random vectors with the passages' Gram matrix and gives a basis of its range, the second one gives
    the Gram matrix within that basis, whose leading eigenvectors stay. Both are sums over documents made in the executors.
    """
    random = np.random.default_rng(rules.seed)
    context = table.sparkSession.sparkContext
    sample = cut_lineage(bounded_sample(table, ["row"], rules.sample).repartition(rules.tasks))
    near = 0.3
    passages = [_item_passages(index, s) for s in index.spaces]
    start = [random.standard_normal((len(s.features), min(rules.rank + rules.extra, len(s.features)))).astype(np.float32) for s in index.spaces]

    def joint(own: np.ndarray, corpus: np.ndarray | None) -> np.ndarray:
        if corpus is None:
            return own
        corpus = corpus.reshape(own.shape)
        return own + np.float32(min(1.0, rules.corpus * float(np.linalg.norm(own)) / max(float(np.linalg.norm(corpus)), 1e-9))) * corpus

    def corpus_sums(weights: list[np.ndarray], outer: bool) -> dict[int, np.ndarray]:
        shared = context.broadcast((index, [w * index.idf[s.features][:, None] for w, s in zip(weights, index.spaces, strict=True)], near))
        sums = _summed(sample, shared, outer)
        shared.unpersist()
        return sums

    sums = corpus_sums(start, True)
    basis = [np.linalg.qr(joint(a.T @ (a @ omega), sums.get(b)))[0] for b, ((a, _, _), omega) in enumerate(zip(passages, start, strict=True))]
    # Once more over the items alone: their own directions must not be lost among the documents'.
    basis = [np.linalg.qr(a.T @ (a @ q) + np.float32(1e-3) * q)[0] for (a, _, _), q in zip(passages, basis, strict=True)]
    sums = corpus_sums(basis, False)
    for b, (space, (a, items, offsets), q) in enumerate(zip(index.spaces, passages, basis, strict=True)):
        z = a @ q
        values, vectors = np.linalg.eigh(joint(z.T @ z, sums.get(b)).astype(np.float64))
        kept = q @ vectors[:, np.argsort(-values)[: rules.rank]].astype(np.float32)
        latent = a @ kept
        space.basis = (kept * index.idf[space.features][:, None]).astype(np.float32)
        space.passages = (latent / np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-9)).astype(np.float32)
        space.item_of, space.offset = items, offsets


def common_length(item: np.ndarray, part: np.ndarray) -> int:
    """Length of the longest common subsequence, by sums of whole bit rows."""
    masks: dict[int, int] = {}
    for i, unit in enumerate(item.tolist()):
        masks[unit] = masks.get(unit, 0) | 1 << i
    full = (1 << len(item)) - 1
    row = full
    get = masks.get
    for unit in part.tolist():
        mask = get(unit)
        if mask:
            both = row & mask
            row = (row + both | row - both) & full
    return len(item) - row.bit_count()


def aligned_shares(pairs: list[tuple[np.ndarray, np.ndarray]], cells: int = 1 << 17) -> np.ndarray:
    """For each (item, part) how much of the item's units the best local alignment matches. Each unit more or less and each other unit costs what a match earns; of equal alignments the one with most matches counts.

    Pairs of like size are worked on together, diagonal by diagonal. A number holds an alignment's score above its matches.
    """
    out = np.zeros(len(pairs))
    order = sorted((k for k, (item, part) in enumerate(pairs) if len(item) and len(part)), key=lambda k: (len(pairs[k][0]), len(pairs[k][1])))
    while order:
        n = len(pairs[order[-1]][0])
        take, m = [], 1
        while order and (not take or (len(take) + 1) * max(m, len(pairs[order[-1]][1])) <= cells) and len(pairs[order[-1]][0]) * 2 > n:
            m = max(m, len(pairs[order[-1]][1]))
            take.append(order.pop())
        unit, kind = (1 << 12, np.int32) if n < 1 << 12 and m < 1 << 18 else (1 << 31, np.int64)
        items, parts = np.full((n, len(take)), LARGEST + 1, dtype=np.uint32), np.full((m, len(take)), LARGEST + 2, dtype=np.uint32)
        for r, k in enumerate(take):
            items[: len(pairs[k][0]), r] = pairs[k][0]
            parts[m - len(pairs[k][1]) :, r] = pairs[k][1][::-1]
        good, bad = kind(unit + 1), kind(-unit)
        older, old, new = (np.zeros((n + 1, len(take)), dtype=kind) for _ in range(3))
        top = np.zeros((n, len(take)), dtype=kind)
        for s in range(n + m - 1):
            # A diagonal of cells (i, s - i); row i + 1 of the last two diagonals belongs to i.
            i, j = max(0, s - m + 1), min(n, s + 1)
            best = np.where(items[i:j] == parts[m - 1 - s + i : m - 1 - s + j], good, bad)
            best += older[i:j]
            beside = np.maximum(old[i:j], old[i + 1 : j + 1])
            beside += bad
            np.maximum(best, beside, out=best)
            best *= best >= unit
            new[i + 1 : j + 1] = best
            np.maximum(top[i:j], best, out=top[i:j])
            older, old, new = old, new, older
        out[take] = (top.max(axis=0) % unit) / np.array([len(pairs[k][0]) for k in take])
    return out


def aligned_share(item: np.ndarray, part: np.ndarray) -> float:
    return float(aligned_shares([(item, part)])[0])


def matched_span(item: np.ndarray, part: np.ndarray) -> tuple[int, int]:
    """Where in the part the best local alignment with the item begins and ends."""
    n, m = len(item), len(part)
    place = np.arange(1, m + 1, dtype=np.int32)
    table = np.zeros((n + 1, m + 1), dtype=np.int32)
    for i in range(n):
        best = np.where(part == item[i], 1, -1).astype(np.int32) + table[i, :-1]
        best = np.maximum(np.maximum(best, table[i, 1:] - 1), 0) + place
        table[i + 1, 1:] = np.maximum.accumulate(best) - place
    i, j = (int(x) for x in np.unravel_index(int(table.argmax()), table.shape))
    end = j
    while i and j and table[i, j] > 0:
        if table[i, j] == table[i - 1, j - 1] + (1 if item[i - 1] == part[j - 1] else -1):
            i, j = i - 1, j - 1
        elif table[i, j] == table[i - 1, j] - 1:
            i -= 1
        else:
            j -= 1
    return j, end


def _interrupted(index: LeakIndex, units: np.ndarray, begin: int, finish: int, others: list[int], found: list[tuple[int, int, int]], rules: LeakRules) -> Iterator[tuple[int, float, int]]:
    """Items (with share and window) of one document that are whole enough once a leak that stands inside them is taken out. found: verbatim items and their windows."""
    spans: dict[int, tuple[int, int]] = {}
    for i in others:
        item = index.units[i]
        n = len(item)
        for k, (leak, low, high) in enumerate(found):
            if common_length(item, units[max(begin, low - 2 * n) : min(finish, high + 2 * n)]) < rules.share * n - 1e-9:
                continue
            if k not in spans:
                a, b = matched_span(index.units[leak], units[low:high])
                spans[k] = low + a, low + b
            a, b = spans[k]
            start = max(begin, a - n - n // 4)
            share = aligned_share(item, np.concatenate((units[start:a], units[b : min(finish, b + n + n // 4)])))
            if share >= rules.share - 1e-9:
                yield i, share, start
                break


def _rarest(index: LeakIndex, i: int) -> frozenset[int]:
    """The quarter of an item's units (three at least) whose pairs are the rarest: what an answer would hold."""
    units = index.units[i]
    if len(units) < 2:
        return frozenset(units.tolist())
    found = index.features(unit_pairs(units, _ONE)[:-1])
    weight = np.where(found >= 0, index.idf[np.maximum(found, 0)], index.unseen) if len(index.idf) else np.ones(len(found))
    mean = (np.concatenate((weight[:1], weight)) + np.concatenate((weight, weight[-1:]))) / 2
    names, back = np.unique(units, return_inverse=True)
    rare = np.bincount(back, mean) / np.bincount(back)
    return frozenset(names[np.argsort(-rare, kind="stable")[: max(3, len(names) // 4)]].tolist())


def _candidates(index: LeakIndex, units: np.ndarray, first: np.ndarray, rules: LeakRules) -> dict[tuple[int, int], list[int]]:
    """For each (row, item) where the item would begin if a passage that is near one of its own stands in its place."""
    found: dict[tuple[int, int], list[int]] = {}
    for b, at, local in _by_block(index, *_hits(index, units, first)):
        space = index.spaces[b]
        p = _passages(index, space, at, local, len(units), first, space.basis, rules.near)
        for i in range(0, len(p.start), 4096):
            cosine = (p.vectors[i : i + 4096] @ space.passages.T) / p.norm[i : i + 4096, None]
            for a, c in zip(*np.nonzero(cosine >= rules.near), strict=True):
                found.setdefault((int(p.row[i + a]), int(space.item_of[c])), []).append(int(p.start[i + a] - space.offset[c]))
    if index.tiny:
        names = np.array(sorted(index.tiny), dtype=np.uint32)
        place = np.minimum(np.searchsorted(names, units), len(names) - 1)
        at = np.flatnonzero(names[place] == units)
        for p, row in zip(at.tolist(), (np.searchsorted(first, at, side="right") - 1).tolist(), strict=True):
            for i in index.tiny[int(units[p])]:
                found.setdefault((row, i), []).append(p)
    return found


def _search(table: DataFrame, shared: Broadcast, rules: LeakRules, schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            units, first = _read(batch)
            if not len(units):
                continue
            ends = np.concatenate((first[1:], [len(units)]))
            windows: list[tuple[int, int, int, int, int]] = []
            for (r, i), places in sorted(_candidates(index, units, first, rules).items()):
                n, until = len(index.units[i]), None
                for p in sorted(set(places)):
                    if until is None or p > until:
                        low, high = max(int(first[r]), p - n // 2 - 2), min(int(ends[r]), p + n + 3 * n // 4 + 2)
                        if low < high:
                            windows.append((r, i, p, low, high))
                        until = p + n // 4
            shares = aligned_shares([(index.units[i], units[low:high]) for _, i, _, low, high in windows])
            best: dict[tuple[int, int], tuple[str, float, int]] = {}
            for (r, i, p, low, high), share in zip(windows, shares.tolist(), strict=True):
                kind = best.get((r, i), ("",))[0]
                if kind == "verbatim" or kind and share < rules.share - 1e-9:
                    continue
                if share >= rules.share - 1e-9:
                    best[r, i] = ("verbatim", share, low)
                    continue
                item = index.units[i]
                near = units[max(low, p - len(item) // 4) : min(high, p + len(item) + len(item) // 4)]
                wanted = index.answers[i]
                if len(wanted.intersection(near.tolist())) >= rules.answer * len(wanted) and (common := common_length(item, near) / len(item)) >= rules.reworded:
                    best[r, i] = ("reworded", common, low)
            # A leak may stand inside another one, which is then still one passage.
            whole: dict[int, list[tuple[int, int, int]]] = {}
            for r, i, _, low, high in windows:
                if best.get((r, i), ("", 0, -1))[::2] == ("verbatim", low):
                    whole.setdefault(r, []).append((i, low, high))
            left: dict[int, list[int]] = {}
            # The larger one of two parts has at least half of what both must have.
            for r, i in dict.fromkeys(w[:2] for w, share in zip(windows, shares, strict=True) if share >= rules.share / 2):
                if r in whole and best.get((r, i), ("",))[0] != "verbatim":
                    left.setdefault(r, []).append(i)
            for r, others in left.items():
                for i, share, low in _interrupted(index, units, int(first[r]), int(ends[r]), others, whole[r], rules):
                    best[r, i] = ("verbatim", share, low)
            out = [(r, i, kind, share, low - int(first[r])) for (r, i), (kind, share, low) in best.items()]
            if out:
                ids = batch.column(0).take(pa.array([o[0] for o in out]))
                yield pa.RecordBatch.from_arrays([ids, pa.array([index.ids[o[1]] for o in out]), pa.array([o[2] for o in out]), pa.array([o[3] for o in out]), pa.array([o[4] for o in out], pa.int32())], ["doc_id", "item_id", "kind", "share", "from_unit"])

    return table.mapInArrow(run, schema)


def _batches(items: DataFrame, size: int) -> Iterator[list[tuple]]:
    """The items in batches of at most `size`, of which the driver holds one at a time."""
    held: list[tuple] = []
    for row in items.select("item_id", "text", "lang").orderBy("lang", "item_id", "text").toLocalIterator():
        held.append(tuple(row))
        if len(held) == size:
            yield held
            held = []
    if held:
        yield held


def find_leaks(documents: DataFrame, items: DataFrame, rules: LeakRules = LeakRules()) -> DataFrame:
    """doc_id, item_id, kind, share, from_unit: documents that hold test items.

    kind is verbatim if the document holds, as one passage and in order, at least rules.share of the item's units, with fewer strange ones
    between them than that (a leak of another item in between doesn't count); reworded if that is not so but a passage near the item has rules.reworded of them in order and rules.answer of its rarest ones. documents needs doc_id and
    text, items item_id, text and lang. Null and empty texts neither leak nor hold leaks; an item given twice is reported under each of
    its ids, a document under each of its. lang needn't be right or known. Statistics are counted over all documents. There may be any
    number of items: each batch of rules.batch is a pass over the documents' hashed units, which are written once and never shuffled.
    """
    schema = f"doc_id {dict(documents.dtypes)['doc_id']}, item_id {dict(items.dtypes)['item_id']}, kind string, share double, from_unit int"
    spark = documents.sparkSession
    context = spark.sparkContext
    table: DataFrame | None = None
    found: DataFrame | None = None
    for rows in _batches(items, rules.batch):
        index = make_index(rows, rules)
        if not index.ids:
            continue
        if table is None:
            table = cut_lineage(_unit_table(documents, "doc_id", "text"))
        if len(index.keys):
            counts = {r[0]: r[1] for r in _frequencies(table, context.broadcast(index)).collect()}
            total = max(1, counts.pop(-1, 1))
            frequency = np.zeros(len(index.keys))
            frequency[list(counts)] = list(counts.values())
            index.idf = np.log((total + 1) / (frequency + 1)).astype(np.float32) + 0.1
            index.unseen = float(np.quantile(index.idf, 0.5))
            fit_spaces(table, index, rules)
        index.answers = [_rarest(index, i) for i in range(len(index.ids))]
        part = _search(table, context.broadcast(index), rules, schema)
        found = part if found is None else found.unionByName(part)
    return spark.createDataFrame([], schema) if found is None else found
