"""Speaker turns: boosted boundary decisions over adjacent segments, filler classification, speaker normalisation."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strophe.llm.boosting import BoostedTrees
from strophe.llm.fillers import FillerModel, filler_examples
from strophe.llm.markup import label_number, lead_end, read_line, without_marks
from strophe.llm.skeleton import plain, skeleton
from strophe.operators.keyed import map_groups
from strophe.operators.sample import bounded_sample


@dataclass(frozen=True)
class TurnRules:
    """sample: how many rows at most the two models are fitted on. block: seconds of a song that one group holds."""

    sample: int = 20_000
    block: int = 1800
    aliases: int = 10_000


def alias_numbers(voices: DataFrame, most: int) -> dict[str, int]:
    """The table of stage names, which must not have more than `most` rows. Of a name with several numbers the smallest counts."""
    rows = voices.select("alias", "speaker_no").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} stage names")
    found: dict[str, int] = {}
    for alias, number in rows:
        if alias and number is not None:
            key = " ".join(skeleton(alias).split()).casefold()
            found[key] = min(number, found.get(key, number))
    return found


def fit_fillers(segments: DataFrame, aliases: dict[str, int], rules: TurnRules = TurnRules()) -> FillerModel:
    """A filler model from a bounded sample of rows, chosen by their hashes, of which those with a count of words are used."""
    counted = "is_lyric is distinct from false and lyric_count is not null and text <> ''"
    rows = bounded_sample(segments, ["segment_id"], rules.sample).filter(counted).select("text", "lyric_count").limit(2 * rules.sample).collect()
    return FillerModel().fit(filler_examples([(read_line(text, aliases)[1], count) for text, count in rows]))


# Marks at the end of a line and their numbers.
_ENDS = {"?": 3, "？": 3, "!": 2, "！": 2, ".": 1, "。": 1}


def _cue(words: str) -> int:
    """How long a line's words are, how they end, and whether they begin with a small letter, in one number."""
    words = words.strip()
    return len(words) * 8 + _ENDS.get(words[-1:], 0) * 2 + words[:1].islower()


def read_segments(segments: DataFrame, aliases: dict[str, int], fillers: FillerModel, with_text: bool = False) -> DataFrame:
    """Segments with `who` (number of the label in the text or else in the column, null without any), `spoken`, and what the boundary model sees of a line (in_text, cue); `said` is the clean text, if asked for."""
    kept = ["segment_id", "song_id", "seg_no", "start", "loaded_at"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns: dict[str | None, int | None] = {}
        names = frozenset(aliases)
        for batch in batches:
            who, spoken, in_text, cue, said = [], [], [], [], []
            for text, label, lyric in zip(batch.column(5).to_pylist(), batch.column(6).to_pylist(), batch.column(7).to_pylist(), strict=True):
                number, words = read_line(text, aliases) if text else (None, "")
                in_text.append(number is not None)
                cue.append(_cue(words))
                if number is None:
                    if label not in columns:
                        if len(columns) > 100_000:
                            columns.clear()
                        columns[label] = label_number(label, aliases)
                    number = columns[label]
                who.append(number)
                spoken.append(lyric is not False and fillers.has_words(words))
                if with_text:
                    line = plain(text or "")
                    said.append(" ".join(fillers.without(without_marks(line[lead_end(line, names):])).split()))
            arrays = [*(batch.column(i) for i in range(5)), pa.array(who, pa.int32()), pa.array(spoken, pa.bool_()), pa.array(in_text, pa.bool_()), pa.array(cue, pa.int32())]
            fields = [*kept, "who", "spoken", "in_text", "cue"]
            if with_text:
                arrays.append(pa.array(said, pa.string()))
                fields.append("said")
            yield pa.RecordBatch.from_arrays(arrays, fields)

    kinds = dict(segments.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in kept) + ", who int, spoken boolean, in_text boolean, cue int" + ", said string" * with_text
    return segments.select(*kept, "text", "speaker", "is_lyric").mapInArrow(run, schema)


FEATURES = ("agree", "gap", "in_text", "since", "run", "ahead", "length", "length_before", "mark", "mark_before", "small")


def _pairs(start: np.ndarray, who: np.ndarray, in_text: np.ndarray, cue: np.ndarray, fresh: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """FEATURES of each row against the rows around it, and the speaker known so far (-1: none). fresh: the first rows of their groups.

    agree: 0 without a label, 1 if none is known so far, 2 for the known speaker's, 3 for another one's. since: rows since the last label;
    run: labels since the last change; ahead: whether the next label is the known speaker's (1) or not (2).
    """
    n = len(start)
    rows = np.arange(n)
    if not n:
        return np.zeros((0, len(FEATURES))), who
    group_at = np.maximum.accumulate(np.where(fresh, rows, 0))
    known = who >= 0
    labelled = np.maximum.accumulate(np.where(known, rows, -1))
    before = np.concatenate(([-1], labelled[:-1]))
    before = np.where(before >= group_at, before, -1)
    carried = np.where(before >= 0, who[np.maximum(before, 0)], -1)
    agree = np.where(~known, 0, np.where(carried < 0, 1, np.where(who == carried, 2, 3)))
    gap = np.where(fresh, np.nan, start - np.concatenate(([np.nan], start[:-1])))
    change = np.maximum.accumulate(np.where(known & (who != carried), rows, -1))
    count = np.concatenate(([0], np.cumsum(known)))
    change = np.maximum(np.concatenate(([-1], change[:-1])), group_at)
    run = count[rows] - count[change]
    nearest = np.minimum.accumulate(np.where(known, rows, n)[::-1])[::-1]
    following = np.concatenate((nearest[1:], [n]))
    last = np.concatenate((np.flatnonzero(fresh)[1:], [n]))[np.cumsum(fresh) - 1]
    inside = following < last
    ahead = np.where(inside & (carried >= 0), np.where(who[np.minimum(following, n - 1)] == carried, 1, 2), 0)
    back = np.concatenate((cue[:1], cue[:-1]))
    x = [agree, np.clip(gap, 0, 600), in_text, np.where(carried >= 0, rows - before, np.nan), run, ahead, cue // 8, back // 8, cue // 2 % 4, back // 2 % 4, cue % 2]
    return np.column_stack(x).astype(float), carried


def examples(read: DataFrame, rules: TurnRules = TurnRules()) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, whether the speaker changed, and which rows have their label hidden: each labelled segment of a bounded sample after a known speaker, once with its label and once without.

    The sample is whole blocks of songs, chosen by their hashes.
    """
    part = F.floor(F.col("start") / rules.block)
    sample = bounded_sample(read.withColumn("part", part), ["song_id", "part"], rules.sample).filter("spoken")
    found = sample.select(F.xxhash64("song_id", "part").alias("h"), "start", "seg_no", "who", "in_text", "cue").orderBy("h", "start", "seg_no").limit(2 * rules.sample).collect()
    fresh = np.array([i == 0 or found[i][0] != found[i - 1][0] for i in range(len(found))], dtype=bool)
    start = np.array([np.nan if r[1] is None else r[1] for r in found], dtype=float)
    who = np.array([-1 if r[3] is None else r[3] for r in found], dtype=np.int64)
    x, carried = _pairs(start, who, np.array([bool(r[4]) for r in found], dtype=float), np.array([r[5] or 0 for r in found], dtype=np.int64), fresh)
    use = (who >= 0) & (carried >= 0)
    shown, y = x[use], (who != carried)[use].astype(float)
    hidden = shown.copy()
    hidden[:, [FEATURES.index("agree"), FEATURES.index("in_text")]] = 0
    return np.concatenate((shown, hidden)), np.concatenate((y, y)), np.repeat([False, True], len(shown))


def fit_boundaries(read: DataFrame, rules: TurnRules = TurnRules()) -> BoostedTrees:
    """Boundary decisions fitted on adjacent spoken segments, with labels shown and hidden."""
    x, y, _ = examples(read, rules)
    return BoostedTrees().fit(x, y)


def _blocks(read: DataFrame, rules: TurnRules, *more: str) -> DataFrame:
    """Spoken rows by song and block of time, starts in whole milliseconds (what is less is noise, and would upset the order); those without a start are first, and spread by number."""
    start = F.round("start", 3)
    block = F.coalesce(F.floor(start / rules.block), F.floor(F.col("seg_no") / 4096) - F.lit(2**40), F.lit(-(2**41))).cast("long")
    return read.filter("spoken").select("song_id", block.alias("block"), F.coalesce(start, F.lit(-1e300)).alias("start"), "seg_no", F.coalesce("who", F.lit(-1)).alias("who"), "in_text", "cue", *more)


def _seen(table: pa.Table, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Features of a table of whole blocks, known speakers, labels and first rows."""
    fresh = np.zeros(table.num_rows, dtype=bool)
    fresh[starts] = True
    who = table["who"].to_numpy().astype(np.int64)
    x, carried = _pairs(table["start"].to_numpy(), who, table["in_text"].to_numpy(zero_copy_only=False).astype(float), table["cue"].to_numpy().astype(np.int64), fresh)
    return x, carried, who, fresh


def boundary_chances(read: DataFrame, boundaries: BoostedTrees, rules: TurnRules = TurnRules()) -> DataFrame:
    """song_id, seg_no, labelled, chance: for each spoken segment after another one of its block how likely the speaker changes there, be it labelled or not."""

    def run(table: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        x, _, who, fresh = _seen(table, starts)
        at = pa.array(np.flatnonzero(~fresh))
        chance = 1 / (1 + np.exp(-boundaries.decide(x)))
        yield from pa.Table.from_arrays([table["song_id"].take(at), table["seg_no"].take(at), pa.array(who >= 0).take(at), pa.array(chance).take(at)], ["song_id", "seg_no", "labelled", "chance"]).combine_chunks().to_batches()

    return map_groups(_blocks(read, rules), ["song_id", "block"], ["start", "seg_no"], run, f"song_id string, seg_no {dict(read.dtypes)['seg_no']}, labelled boolean, chance double")


def speaker_turns(read: DataFrame, boundaries: BoostedTrees, rules: TurnRules = TurnRules(), with_text: bool = False) -> DataFrame:
    """song_id, first_seg_no, last_seg_no, speaker_no: the turns of current segments as read_segments gives them.

    with_text also gives their clean text, a row (part_no, text) for each block that a turn goes through, so that no text grows with
    the song.

    Segments are ordered by start (null first, then), then seg_no; those that aren't spoken neither count nor break a turn. Before a
    song's first label the speaker is null. Rows of a null song are one song.
    A song may hold a third of all rows: turns are found in blocks of time, and only the first two runs and the last run of each
    block meet in the window over the song that decides which of them go on.
    """
    rows = _blocks(read, rules, *["said"] * with_text)

    def run(table: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        n = table.num_rows
        x, carried, who, fresh = _seen(table, starts)
        # A segment without a label has nobody to change to: it goes on, whatever the model thinks.
        change = (boundaries.decide(x) > 0) & (who >= 0) & (carried >= 0)
        change |= (who >= 0) & (carried < 0)  # the block's first label: whether it goes on is settled over the blocks
        new = fresh | change
        at = np.flatnonzero(new)
        group = np.cumsum(fresh) - 1
        first_run = np.searchsorted(at, starts)
        number = np.arange(len(at)) - first_run[group[at]]
        runs_in = np.diff(np.concatenate((first_run, [len(at)])))
        last = np.concatenate((at[1:], [n])) - 1
        speaker = who[at]
        picked = table.take(pa.array(at))
        seg = table["seg_no"]
        arrays = [picked["song_id"], picked["block"], pa.array(number, pa.int64()), pa.array(number == runs_in[group[at]] - 1), pa.array(speaker, pa.int32(), mask=speaker < 0), picked["seg_no"], seg.take(pa.array(last))]
        names = ["song_id", "block", "run", "is_last", "speaker_no", "first_seg_no", "last_seg_no"]
        if with_text:
            said = table["said"].to_pylist()
            arrays.append(pa.array([" ".join(filter(None, said[i : j + 1])) for i, j in zip(at.tolist(), last.tolist(), strict=True)], pa.string()))
            names.append("text")
        yield from pa.Table.from_arrays(arrays, names).combine_chunks().to_batches()

    runs = map_groups(rows, ["song_id", "block"], ["start", "seg_no"], run, f"song_id string, block long, run long, is_last boolean, speaker_no int, first_seg_no {dict(read.dtypes)['seg_no']}, last_seg_no {dict(read.dtypes)['seg_no']}" + ", text string" * with_text)
    names = ["song_id", "first_seg_no", "last_seg_no", "speaker_no"]
    inner = runs.filter("run > 1 and not is_last")
    song = Window.partitionBy("song_id").orderBy("block", "run")
    edges = runs.filter("run <= 1 or is_last").withColumn("speaker_no", F.last("speaker_no", ignorenulls=True).over(song.rowsBetween(Window.unboundedPreceding, 0)))
    before = F.lag(F.struct("speaker_no")).over(song)
    edges = edges.withColumn("new", (before.isNull() | (F.col("run") > 1) | ~before["speaker_no"].eqNullSafe(F.col("speaker_no"))).cast("int"))
    edges = edges.withColumn("turn", F.sum("new").over(song.rowsBetween(Window.unboundedPreceding, 0)))
    place = F.struct("block", "run")
    joined = edges.groupBy("song_id", "turn").agg(F.min_by("first_seg_no", place).alias("first_seg_no"), F.max_by("last_seg_no", place).alias("last_seg_no"), F.first("speaker_no").alias("speaker_no"))
    if not with_text:
        return joined.drop("turn").unionByName(inner.select(*names)).select(*names)
    whole = joined.select(F.col("song_id").alias("song_"), F.col("turn").alias("turn_"), "first_seg_no", "last_seg_no", "speaker_no")
    parts = edges.select("song_id", "turn", "block", "run", "text").join(whole, F.expr("song_id <=> song_ and turn = turn_"))
    part_no = F.row_number().over(Window.partitionBy("song_id", "turn").orderBy("block", "run")) - 1
    return parts.withColumn("part_no", part_no).select(*names, "part_no", "text").unionByName(inner.select(*names, F.lit(0).alias("part_no"), "text"))
