"""Long segments in pieces: cuts at the deepest valleys of lexical cohesion, in pauses where there are any."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strophe.functions.text import millis


@dataclass(frozen=True)
class SplitRules:
    """Milliseconds: longest piece, overlap of a later piece with the one before, length of one voice activity value. silent: so many silent values
    in a row are a pause. words: of a block whose likeness to the next one is compared, averaged over `smooth` gaps on either side. least: a piece shouldn't be shorter, where there is a choice."""

    longest: int = 30_000
    overlap: int = 500
    step: int = 250
    silent: int = 2
    words: int = 12
    smooth: int = 2
    least: int = 8_000


_UNIT = re.compile(r"[぀-ヿ一-鿿฀-๿]|[^\W_]+(?:['’][^\W_]+)*")


def pauses(voiced: str | None, start: int, end: int, rules: SplitRules) -> list[tuple[int, int]]:
    """Pauses of a written list of 0 and 1 that begins at start, as closed stretches inside (start, end)."""
    found = []
    for run in re.finditer("0{%d,}" % rules.silent, voiced or ""):
        a, b = start + run.start() * rules.step, min(start + run.end() * rules.step, end)
        if a < end:
            found.append((max(a, start + 1), min(b, end - 1)))
    return [(a, b) for a, b in found if a <= b]


def cohesion_depths(text: str, rules: SplitRules) -> tuple[list[str], np.ndarray]:
    """The words of a text and, for each gap between two of them, how deep a valley of likeness is there.

    The likeness of a gap is the cosine of the blocks of words beside it. From a gap one climbs to either side while the likeness
    doesn't fall; the depth is what both peaks rise above the gap. At both ends of the text it is 0.
    """
    words = _UNIT.findall(text.casefold())
    n, k = len(words), rules.words
    depth = np.zeros(n + 1)
    if n < 2:
        return words, depth
    left, right = Counter[str](), Counter(words[:k])
    product, left_size, right_size = 0, 0, sum(c * c for c in right.values())
    like = np.zeros(n - 1)
    for gap in range(1, n):
        # One word goes from the right block to the left one; each block takes or loses a word at its far end.
        moves = [(words[gap - 1], 1, -1)]
        if gap + k - 1 < n:
            moves.append((words[gap + k - 1], 0, 1))
        if gap > k:
            moves.append((words[gap - k - 1], -1, 0))
        for word, a, b in moves:
            x, y = left[word], right[word]
            product += (x + a) * (y + b) - x * y
            left_size += (x + a) ** 2 - x * x
            right_size += (y + b) ** 2 - y * y
            left[word], right[word] = x + a, y + b
        like[gap - 1] = product / (left_size * right_size) ** 0.5
    around = np.ones(2 * rules.smooth + 1)
    like = np.convolve(like, around, "same") / np.convolve(np.ones(n - 1), around, "same") if n - 1 >= len(around) else like
    peak_before, peak_after = like.copy(), like.copy()
    for i in range(1, n - 1):
        if like[i - 1] >= like[i]:
            peak_before[i] = peak_before[i - 1]
        if like[n - 1 - i] >= like[n - 2 - i]:
            peak_after[n - 2 - i] = peak_after[n - 1 - i]
    depth[1:n] = peak_before + peak_after - 2 * like
    return words, depth


def split_segment(text: str | None, start: int, end: int, voiced: str | None, rules: SplitRules = SplitRules()) -> list[tuple[int, int, str, int, int]]:
    """Pieces (from, to, kind of the cut at its end, first word, word after the last) of one segment that is longer than rules.longest.

    The kind is natural for a cut inside a pause, forced for one elsewhere and end for the last piece. If all cuts can lie in
    pauses, they do; else pauses are used as far as they go. Among the pauses a piece can end in, the one at the deepest valley of
    lexical cohesion is taken (of equal ones the longest, then the latest); where there is none, the cut is forced between the two words at the
    deepest valley in reach (of equal ones the latest), or at the limit of a text without words in reach. Words belong to times in proportion to the
    voiced time. A later piece begins rules.overlap before the cut, with the words spoken since then.
    """
    quiet = pauses(voiced, start, end, rules)
    words, depth = cohesion_depths(text or "", rules)
    speech = np.array([c != "0" for c in voiced or ""], dtype=float)
    known = np.concatenate(([0.0], np.cumsum(speech))) if speech.sum() else None
    # Times at which each word begins, the last one the end of the words.
    share = np.arange(len(words) + 1) / max(1, len(words))
    if known is None:
        begins = start + share * (end - start)
    else:
        rising = np.flatnonzero(np.concatenate(([True], np.diff(known) > 0)))
        begins = start + np.interp(share * known[-1], known[rising], rising) * rules.step
    begins = np.minimum(begins, end)

    def word_at(t: int) -> int:
        return int(np.abs(begins - t).argmin()) if len(words) else 0

    # From a cut at or after `safe`, the end can be reached with cuts in pauses only.
    reach = rules.longest - rules.overlap
    safe = earliest_safe(quiet, end, reach)
    natural = safe - start <= rules.longest
    pieces, at, first = [], start, 0
    while end - at > rules.longest:
        limit = at + rules.longest
        low = max(at + rules.overlap + 1, safe if natural else 0)
        options = [(max(a, low), min(b, limit)) for a, b in quiet if max(a, low) <= min(b, limit)]
        fine = [x for x in options if x[1] - at >= rules.least] or options
        if fine:
            a, b = max(fine, key=lambda x: (round(float(depth[word_at((x[0] + x[1]) // 2)]), 9), x[1] - x[0], x[1]))
            cut, kind = (a + b) // 2, "natural"
            word = word_at(cut)
        else:
            cut, kind = limit, "forced"
            inside = np.flatnonzero((begins >= at + rules.least) & (begins <= limit))
            inside = inside[(inside > first) & (inside < len(words))]
            if len(inside):
                deepest = np.round(depth[inside], 9)
                cut = int(begins[inside[np.flatnonzero(deepest == deepest.max())[-1]]])
            word = word_at(cut)
        word = max(first, word)
        pieces.append((at, cut, kind, first, word))
        at = cut - rules.overlap
        first = min(word, int(np.searchsorted(begins[:-1], at)))
    pieces.append((at, end, "end", first, len(words)))
    return pieces


def earliest_safe(quiet: list[tuple[int, int]], end: int, reach: int) -> int:
    """The earliest cut from which every later piece can end in a pause. Any later point of a pause is as good: what is in reach of an earlier cut is in reach of it."""
    safe = end
    for a, b in reversed(quiet):
        if b < safe - reach:
            break
        safe = min(safe, max(a, safe - reach))
    return safe


def split_long(segments: DataFrame, vad: DataFrame, rules: SplitRules = SplitRules()) -> DataFrame:
    """segment_id, piece_no, from_ms, to_ms, cut_kind, text: pieces of every current segment with a valid end that lasts over rules.longest.

    segments needs segment_id, song_id, seg_no, text, start, end. A voice activity list counts from its segment's start; a list that
    is missing, empty, null or unreadable has no pauses. Of several lists of one segment the longest counts, then the one with most
    voice. Segments with a null start, a null end or an end not after the start have no pieces; a null text has no words.
    Only long segments take part in the join.
    """
    spans = segments.select("segment_id", "song_id", "seg_no", "text", millis(F.col("start")).alias("s"), millis(F.col("end")).alias("e")).filter(F.col("e") - F.col("s") > rules.longest)
    written = F.regexp_replace(F.regexp_replace(F.lower("vad_res"), "true", "1"), "false", "0")
    bits = F.translate(F.regexp_replace(written, r"\.0*", ""), "[](){}, \t\n'\"", "")
    lists = vad.select(F.col("song_id").alias("song_"), F.col("seg_no").alias("seg_"), bits.alias("bits")).filter(F.col("bits").rlike("^[01]+$"))
    joined = spans.join(lists, F.expr("song_id = song_ and seg_no = seg_"), "left")
    single = joined.groupBy("segment_id", "s", "e").agg(F.max(F.struct(F.length("bits").alias("n"), "bits")).alias("v"), F.max("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], [], []]
            for row, s, e, voiced, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = _UNIT.finditer(text or "")
                places = [m.start() for m in words]
                for k, (a, b, kind, first, after) in enumerate(split_segment(text, s, e, voiced, rules)):
                    low = 0 if first == 0 else places[first] if first < len(places) else len(text or "")
                    high = places[after] if after < len(places) else len(text or "")
                    for column, value in zip(out, (row, k, a, b, kind, (text or "")[low:high].strip()), strict=True):
                        column.append(value)
            kinds = (batch.schema[0].type, pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], ["segment_id", "piece_no", "from_ms", "to_ms", "cut_kind", "text"])

    schema = f"segment_id {dict(segments.dtypes)['segment_id']}, piece_no int, from_ms long, to_ms long, cut_kind string, text string"
    return single.select("segment_id", "s", "e", "v.bits", "text").mapInArrow(run, schema)
