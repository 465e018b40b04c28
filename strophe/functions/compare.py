"""Comparing texts: one form, tokens of mixed scripts, errors of words, missing characters."""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as t
from pyspark.sql.functions import arrow_udf, pandas_udf

from strophe.functions.text import normalize_spoken


def comparable(text: str, keep_space: bool = False) -> str:
    """Small letters, digits and marks in compatibility form."""
    kept = [c if unicodedata.category(c)[0] in "LNM" or keep_space and c.isspace() else " " if keep_space and unicodedata.category(c) == "Pd" else "" for c in text]
    return unicodedata.normalize("NFKC", "".join(kept).lower())


@arrow_udf(t.StringType())
def _compatible(texts: pa.Array) -> pa.Array:
    return pa.array([None if x is None else unicodedata.normalize("NFKC", x) for x in texts.to_pylist()], pa.string())


def comparable_text(text: Column | str) -> Column:
    """comparable() as a column: letters are picked in the JVM, and only texts beyond ASCII are sent out to be normalised, a batch at a time."""
    text = F.col(text) if isinstance(text, str) else text
    bare = F.lower(F.regexp_replace(text, r"[^\p{L}\p{N}\p{M}]", ""))
    strange = bare.rlike(r"[^\x00-\x7f]")
    return F.coalesce(_compatible(F.when(strange, bare)), bare)


# Marks that stand with a Han character.
_MARKS = "，。！？、；：（）【】《》,.!?;:\"()\\[\\]{}<>"


def mixed_tokens(text: Column) -> Column:
    """Han characters one by one and western words; a mark goes to the character after it, at the end of a word to the one before. White space around marks is dropped."""
    close = F.regexp_replace(F.regexp_replace(text, rf"(?U)\s+([{_MARKS}])", "$1"), rf"(?U)([{_MARKS}])\s+", "$1")
    apart = F.regexp_replace(F.regexp_replace(close, r"([a-zA-Z])([\x{4e00}-\x{9fff}])", "$1 $2"), r"([\x{4e00}-\x{9fff}])([a-zA-Z])", "$1 $2")
    words = F.filter(F.split(apart, r"(?U)\s+"), lambda w: w != "")
    mark, other = f"[{_MARKS}]", f"[^{_MARKS}]"
    parts = F.lit(f"(?s)({mark}.{mark}$|{other}{mark}$|{mark}.|.)")
    return F.flatten(F.transform(words, lambda w: F.when(w.rlike(rf"^[\x{{4e00}}-\x{{9fff}}{_MARKS}]+$"), F.regexp_extract_all(w, parts, F.lit(1))).otherwise(F.array(w))))


def word_error_counts(pairs: list[tuple[list[str], list[str]]], cells: int = 1 << 18) -> np.ndarray:
    """For each (reference, heard) the added, missing and wrong words of the alignment with fewest errors (of equal ones the one with fewest added words).

    Pairs of like size are worked on together, diagonal by diagonal; a number holds an alignment's errors above its added words.
    """
    out = np.zeros((len(pairs), 3), dtype=np.int64)
    unit = np.int64(1 << 31)
    order = sorted(range(len(pairs)), key=lambda k: (len(pairs[k][0]), len(pairs[k][1])))
    while order:
        n = len(pairs[order[-1]][0])
        take, m = [], 0
        while order and (not take or (len(take) + 1) * max(n, m, len(pairs[order[-1]][1])) <= cells) and len(pairs[order[-1]][0]) * 2 >= n - 8:
            m = max(m, len(pairs[order[-1]][1]))
            take.append(order.pop())
        number: dict[str, int] = {}
        a, b = np.full((n + 1, len(take)), -1, dtype=np.int64), np.full((m + 1, len(take)), -2, dtype=np.int64)
        sizes = np.array([(len(pairs[k][0]), len(pairs[k][1])) for k in take])
        for r, k in enumerate(take):
            a[1 : len(pairs[k][0]) + 1, r] = [number.setdefault(w, len(number)) for w in pairs[k][0]]
            b[m - len(pairs[k][1]) : m, r] = [number.setdefault(w, len(number)) for w in reversed(pairs[k][1])]
        far = np.int64(1 << 62)
        older, old, new = (np.full((n + 2, len(take)), far) for _ in range(3))
        best = np.zeros(len(take), dtype=np.int64)
        at = np.arange(len(take))
        for s in range(n + m + 1):
            # Cells (i, s - i), row i + 1; a step in i misses a word, one in j adds one.
            i, j = max(0, s - m), min(n, s) + 1
            cell = np.minimum(old[i:j] + unit, old[i + 1 : j + 1] + unit + 1)
            same = a[i:j] == b[m - s + i : m - s + j]
            np.minimum(cell, older[i:j] + np.where(same, np.int64(0), unit), out=cell)
            if s == 0:
                cell[:] = 0
            new[:] = far
            new[i + 1 : j + 1] = cell
            done = np.flatnonzero(sizes.sum(axis=1) == s)
            best[done] = new[sizes[done, 0] + 1, at[done]]
            older, old, new = old, new, older
        errors, added = best >> 31, best & (unit - 1)
        missing = added + sizes[:, 0] - sizes[:, 1]
        out[take] = np.column_stack((added, missing, errors - added - missing))
    return out


_RATES = t.StructType([t.StructField("wer", t.DoubleType()), *(t.StructField(n, t.LongType()) for n in ("ins", "del", "sub")), *(t.StructField(f"{n}_ratio", t.DoubleType()) for n in ("ins", "del", "sub")), t.StructField("hallucinated", t.BooleanType())])


def rates_of(sizes: np.ndarray, counts: np.ndarray) -> pd.DataFrame:
    """Rates by the reference's words. Of an empty reference everything is wrong by definition: 100 added, a ratio of 1, hallucinated."""
    empty = sizes == 0
    n = np.maximum(sizes, 1)
    ratios = counts / n[:, None]
    odd = ((ratios[:, 0] > 0.5) | (ratios[:, 1] > 0.5)) & (sizes > 2)
    counts = np.where(empty[:, None], np.array([100, 0, 0]), counts)
    ratios = np.where(empty[:, None], np.array([1.0, 0.0, 0.0]), ratios)
    wer = np.where(empty, 100.0, counts.sum(axis=1) / n)
    return pd.DataFrame({"wer": wer, "ins": counts[:, 0], "del": counts[:, 1], "sub": counts[:, 2], "ins_ratio": ratios[:, 0], "del_ratio": ratios[:, 1], "sub_ratio": ratios[:, 2], "hallucinated": odd | empty})


@pandas_udf(_RATES)
def _word_error_rates(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    for reference, heard in pairs:
        words = [((a or "").split(), (b or "").split()) for a, b in zip(reference, heard, strict=True)]
        yield rates_of(np.array([len(a) for a, _ in words]), word_error_counts(words))


def word_error_rates(reference: Column, heard: Column) -> Column:
    """wer, ins, del, sub, their ratios, hallucinated: wrong words of recognised speech, both texts in spoken form. A null text counts as empty."""
    return _word_error_rates(normalize_spoken(reference), normalize_spoken(heard))


def character_difference(before: str, after: str) -> tuple[str, str]:
    """Characters that are missing and that are extra, in order of code."""
    a, b = Counter(before), Counter(after)
    return "".join(sorted((a - b).elements())), "".join(sorted((b - a).elements()))


def missing_and_extra(before: Column, after: Column) -> Column:
    """character_difference() as a column of counts: how many characters are missing and how many are extra."""
    letters = lambda x: F.array_distinct(F.filter(F.split(x, ""), lambda c: c != ""))
    count = lambda x, c: F.char_length(x) - F.char_length(F.replace(x, c, F.lit("")))
    more = lambda x, y: F.aggregate(letters(x), F.lit(0), lambda s, c: s + F.greatest(F.lit(0), count(x, c) - count(y, c)))
    # One round of a lambda binds both texts, so that what they are made of is worked out once.
    both = F.array(F.struct(before.alias("x"), after.alias("y")))
    return F.transform(both, lambda p: F.struct(more(p["x"], p["y"]).alias("missing"), more(p["y"], p["x"]).alias("extra")))[0]
