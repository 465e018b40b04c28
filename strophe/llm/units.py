"""Texts as hashed units: words, or single characters of scripts without spaces.

Case, punctuation, marks, character forms and look-alike letters make no difference. All texts of a batch are
worked on at once, by tables over character codes.
"""

from __future__ import annotations

import re
import unicodedata

import numpy as np

from strophe.llm.markup import TIME
from strophe.llm.skeleton import _FIRST, _LETTERS

_TIMES = re.compile(TIME)
_JAMO = re.compile("[ᄀ-ᇿ]")
_HINT = re.compile(r"\d:\d\d|<\d")
_SPACE, _DROP = 32, 0
#: The largest hash of a unit; the numbers above are free for those who pad.
LARGEST = 0xFFFFFFF0
_table: np.ndarray | None = None


def _fold_table() -> np.ndarray:
    """For each code of the basic plane its folded letter or digit, 32 for white space, 0 for what is dropped."""
    table = np.zeros(0x10000, dtype=np.uint32)
    for code in range(0x10000):
        if 0xD800 <= code < 0xE000:
            continue
        char = chr(code)
        if char.isspace() or code in (0x85, 0x2028, 0x2029):
            table[code] = _SPACE
            continue
        first = _FIRST[code]
        if first == _SPACE:
            table[code] = _SPACE
        elif isinstance(first, str) and first:
            base = chr(code) if 0xAC00 <= code < 0xD7B0 else first[0]
            base = _LETTERS.get(ord(base), base)
            base = base.lower()[0]
            category = unicodedata.category(base)
            if category[0] in "LN" or category[0] == "M" and ord(base) >= 0x0900 and not 0x3099 <= ord(base) <= 0x309A and ord(base) != 0x0E4D:
                table[code] = ord(base)
    table[0x0E33] = 0x0E32
    return table


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = x * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(29))


def is_unspaced(codes: np.ndarray) -> np.ndarray:
    """Whether folded codes are of a script without spaces."""
    return (codes >= 0x0E00) & (codes < 0x0E80) | (codes >= 0x3040) & (codes < 0xA000)


def hashed_units(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Units of all texts as 32-bit hashes, where each text's units begin, and which units are characters of unspaced scripts. A null text has none."""
    global _table
    if _table is None:
        _table = _fold_table()
    clean = []
    for text in texts:
        text = text or ""
        if not text.isascii() and _JAMO.search(text):
            text = unicodedata.normalize("NFC", text)
        if _HINT.search(text):
            text = _TIMES.sub(" ", text)
        clean.append(text)
    lengths = np.fromiter((len(t) + 1 for t in clean), dtype=np.int64, count=len(clean))
    codes = np.frombuffer(("\n".join(clean) + "\n").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    folded = _table[np.minimum(codes, 0xFFFF)]
    high = codes > 0xFFFF
    if high.any():
        folded = np.where(high, codes, folded)
    ends = np.cumsum(lengths) - 1
    folded[ends] = 1
    kept = np.flatnonzero(folded)
    folded = folded[kept]
    space = (folded == _SPACE) | (folded == 1)
    loose = is_unspaced(folded)
    mark = loose & (((folded >= 0x0E31) & (folded <= 0x0E3A) & (folded != 0x0E32)) | ((folded >= 0x0E47) & (folded <= 0x0E4E)))
    before_space = np.concatenate(([True], space[:-1]))
    before_loose = np.concatenate(([False], loose[:-1]))
    start = ~space & (before_space | before_loose | loose) & ~(mark & ~before_space)
    begins = np.flatnonzero(start)
    text_no = np.cumsum(np.concatenate(([0], (folded[:-1] == 1).astype(np.int64)))) if len(folded) else np.zeros(0, dtype=np.int64)
    if not len(begins):
        return np.zeros(0, dtype=np.uint32), np.zeros(len(texts), dtype=np.int64), np.zeros(0, dtype=bool)
    unit = np.cumsum(start) - 1
    place = np.arange(len(folded)) - begins[np.maximum(unit, 0)]
    with np.errstate(over="ignore"):
        mixed = _mix(folded.astype(np.uint64) + (place.astype(np.uint64) + np.uint64(1)) * np.uint64(0x10000019B))
    mixed[space] = 0
    sums = np.add.reduceat(mixed, begins)
    hashes = np.minimum(_mix(sums) >> np.uint64(32), np.uint64(LARGEST)).astype(np.uint32)
    first = np.searchsorted(text_no[begins], np.arange(len(texts)))
    return hashes, first, loose[begins]
