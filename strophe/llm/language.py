"""The language of each segment, and of each stretch of a segment in several languages."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strophe.llm.fillers import FillerModel
from strophe.llm.hyper import LanguageModel, bundle, letters
from strophe.llm.markup import lead_end, without_marks
from strophe.llm.skeleton import plain
from strophe.operators.sample import bounded_sample

@dataclass(frozen=True)
class LanguageRules:
    """sample: how many rows at most the prototypes are fitted on. words, characters: a stretch's least length in spaced and unspaced scripts.
    lone: how many labelled rows at least a language needs to get a prototype. languages: codes of labels that may train one."""

    sample: int = 30_000
    words: int = 3
    characters: int = 4
    lone: int = 5
    languages: tuple[str, ...] = ("de", "en", "es", "fr", "ja", "ko", "ru", "th", "zh")


def label_code(label: Column) -> Column:
    """A label without case, region and white space; null for a placeholder."""
    code = F.lower(F.regexp_extract(F.trim(label), r"^([A-Za-z]+)", 1))
    return F.when(code.isin("", "und", "unknown", "none", "null", "auto", "na", "n", "nan", "mul", "zxx", "xx", "unk", "tbd", "other"), F.lit(None).cast("string")).otherwise(code)


def _bare(text: str, aliases: frozenset[str], fillers: FillerModel) -> str:
    """The words of a line in one consistent form, without marks, label and fillers."""
    text = plain(text)
    text = without_marks(text[lead_end(text, aliases) :])
    return fillers.without(text)


def _tokens(small: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where tokens begin and their parts of a least stretch: spaced words, single letters of unspaced scripts. The end of a text is part of its last token."""
    letter = (small != 32) & (small != 10)
    loose = (small >= 0x0E00) & (small < 0x0E80) | (small >= 0x3040) & (small < 0xA000)
    before = np.concatenate(([False], letter[:-1]))
    before_loose = np.concatenate(([False], loose[:-1]))
    start = letter & (~before | loose | before_loose)
    first = np.concatenate(([True], small[:-1] == 10))
    begins = np.flatnonzero(start | first)
    weight = np.where(loose[begins], np.float32(0.25), np.float32(1 / 3))
    weight[~letter[begins]] = 0
    return begins, weight


def analyse(texts: list[str], model: LanguageModel, norms: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """For each text: product with each prototype, least stretches it is long, best place to split it in two, gain of doing so, the two languages. norms is filled with the lengths of the texts' vectors.

    The gain says how much better the best language on each side of the split explains the text than one language. Both sides
    must be as long as a least stretch.
    """
    small, begin = letters(texts)
    scores = model.position_scores(small, norms)
    begins, weight = _tokens(small)
    token = np.add.reduceat(scores, begins, axis=0).astype(np.float64)
    n = len(texts)
    first = np.searchsorted(begins, begin)
    last = np.concatenate((first[1:], [len(begins)])) - 1
    row = np.repeat(np.arange(n), last - first + 1)
    prefix = np.cumsum(token, axis=0)
    before = np.where((first > 0)[:, None], prefix[np.maximum(first - 1, 0)], 0.0)
    prefix -= before[row]
    total = prefix[last]
    length = np.cumsum(weight.astype(np.float64))
    length -= np.where(first > 0, length[np.maximum(first - 1, 0)], 0.0)[row]
    size = length[last]
    rest = total[row] - prefix
    gain = prefix.max(axis=1) + rest.max(axis=1) - total.max(axis=1)[row]
    gain[(length < 1 - 1e-6) | (size[row] - length < 1 - 1e-6)] = -np.inf
    best = np.maximum.reduceat(gain, first)
    place = np.full(n, len(gain), dtype=np.int64)
    hit = np.flatnonzero(gain == best[row])
    np.minimum.at(place, row[hit], hit)
    at = np.where(place + 1 < len(begins), begins[np.minimum(place + 1, len(begins) - 1)], len(small)) - begin
    return total, size, at, best, prefix[place].argmax(axis=1), rest[place].argmax(axis=1)


def cosines(texts: list[str], model: LanguageModel) -> tuple[np.ndarray, tuple[np.ndarray, ...]]:
    """Cosines of the texts with the prototypes, and what analyse gives. A text without letters has none: zeros."""
    norms = np.zeros(len(texts))
    found = analyse(texts, model, norms)
    return found[0] / np.maximum(norms, 1e-9)[:, None], found


def _confidence(like: np.ndarray, model: LanguageModel) -> np.ndarray:
    """How much of the weight of all languages, exponential in the cosine, the nearest one has."""
    odds = model.sharp * 8 * like
    odds = np.exp(odds - odds.max(axis=1, keepdims=True))
    return odds.max(axis=1) / odds.sum(axis=1)


def stretches(text: str, model: LanguageModel) -> list[tuple[int, int, int]]:
    """(from, to, language number) of a text's stretches: it is split in two while that explains it better, then each part again."""
    found: list[tuple[int, int, int]] = []
    todo = [(0, len(text))]
    while todo:
        a, b = todo.pop()
        total, _, at, gain, left, right = (x[0] for x in analyse([text[a:b]], model))
        if gain > model.split and left != right:
            todo += [(a + int(at), b), (a, a + int(at))]
        elif found and found[-1][2] == int(total.argmax()):
            found[-1] = (found[-1][0], b, found[-1][2])
        else:
            found.append((a, b, int(total.argmax())))
    return found


def fit_languages(segments: DataFrame, aliases: frozenset[str], fillers: FillerModel, rules: LanguageRules = LanguageRules()) -> LanguageModel:
    """Prototypes from a bounded sample of rows labelled with one of the nine languages; wrong labels are sorted out by a second pass.

    The gain that makes a split lies three fifths of the way between what all but a twentieth of these rows have and what all but a hundredth of
    pairs of them put together have.
    """
    labelled = bounded_sample(segments, ["segment_id"], rules.sample).filter("is_lyric is distinct from false and length(text) > 8").withColumn("code", label_code(F.col("lang_type")))
    rows = labelled.filter(F.col("code").isin(*rules.languages)).select("text", "code").orderBy("code", F.xxhash64("text"), "text").limit(rules.sample).collect()
    texts = [(_bare(t, aliases, fillers), code) for t, code in rows]
    by: dict[str, list[str]] = {}
    for text, code in texts:
        by.setdefault(code, []).append(text)
    by = {code: list(dict.fromkeys(lines)) for code, lines in by.items() if len(lines) >= rules.lone}
    if len(by) < 2:
        return bundle(by or {"en": [""]})
    for _ in range(2):
        model = bundle(by)
        kept: dict[str, list[str]] = {}
        everything = [(t, code) for code, lines in by.items() for t in lines]
        total = analyse([t for t, _ in everything], model)[0]
        for (text, code), best in zip(everything, total.argmax(axis=1), strict=True):
            if model.languages[best] == code:
                kept.setdefault(code, []).append(text)
        by = {code: kept.get(code, lines) for code, lines in by.items()}
    model = bundle(by)
    singles = [(t, code) for code, lines in sorted(by.items()) for t in lines[:400]]
    total, _, _, gain, _, _ = analyse([t for t, _ in singles], model)
    mixed = [a + " " + b for (a, x), (b, y) in zip(singles, singles[len(singles) // 2 :] + singles[: len(singles) // 2], strict=True) if x != y]
    gain2 = analyse(mixed, model)[3] if mixed else np.zeros(0)
    gain, gain2 = gain[np.isfinite(gain)], gain2[np.isfinite(gain2)]
    if len(gain) and len(gain2):
        low, high = float(np.quantile(gain, 0.95)), float(np.quantile(gain2, 0.01))
        model.split = max(0.4 * low + 0.6 * high, 1e-6)
    return model


def with_languages(segments: DataFrame, kept: list[str], model: LanguageModel, aliases: frozenset[str], fillers: FillerModel, texts: bool = False) -> DataFrame:
    """The kept columns and, for each stretch, stretch_no, lang, confidence, enough (it is as long as a least stretch), mixed; `part` is its text, if asked for.

    A text without letters gets no row; a null text neither.
    """
    languages = model.languages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column(len(kept)).to_pylist()
            bare = [_bare(t, aliases, fillers) if t else "" for t in raw]
            like, (_, size, _, gain, _, _) = cosines(bare, model)
            best = like.argmax(axis=1)
            rows, number, lang, sure, mixed, parts = [], [], [], [], [], []
            split = np.flatnonzero(gain > model.split)
            several = {int(i): s for i in split if len(s := stretches(bare[i], model)) > 1}
            trust = _confidence(like, model)
            for i in np.flatnonzero(size > 0).tolist():
                if i in several:
                    for k, (a, b, which) in enumerate(several[i]):
                        rows.append(i)
                        number.append(k)
                        lang.append(languages[which])
                        sure.append(float(trust[i]))
                        mixed.append(True)
                        parts.append(bare[i][a:b].strip())
                else:
                    rows.append(i)
                    number.append(0)
                    lang.append(languages[best[i]])
                    sure.append(float(trust[i]))
                    mixed.append(False)
                    parts.append(bare[i].strip())
            at = np.array(rows, dtype=np.int64)
            if not len(at):
                continue
            # Three words or four characters: a word and a letter of an unspaced script weigh that part each.
            enough = (size[at] >= 1 - 1e-4) | np.array(mixed)
            if several:
                redo = [j for j in range(len(rows)) if mixed[j]]
                for j, p in zip(redo, _confidence(cosines([parts[j] for j in redo], model)[0], model), strict=True):
                    sure[j] = float(p)
            picked = pa.Table.from_batches([batch]).select(list(range(len(kept)))).take(pa.array(at))
            arrays = [*(picked[c].combine_chunks() for c in kept), pa.array(number, pa.int32()), pa.array(lang, pa.string()), pa.array(sure, pa.float64()), pa.array(enough), pa.array(mixed, pa.bool_())]
            names = [*kept, "stretch_no", "lang", "confidence", "enough", "mixed"]
            if texts:
                arrays.append(pa.array(parts, pa.string()))
                names.append("part")
            for out in pa.Table.from_arrays(arrays, names).to_batches():
                yield out

    kinds = dict(segments.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in kept) + ", stretch_no int, lang string, confidence double, enough boolean, mixed boolean" + ", part string" * texts
    return segments.select(*kept, "text").mapInArrow(run, schema)
