"""Hyperdimensional language profiles.

Every letter has a random vector of +1 and -1. An n-gram's vector binds the vectors of its letters, each
permuted by its place; a language's prototype bundles the vectors of its n-grams. Texts are compared with
the prototypes by cosine. A text's vector bundles those of its n-grams too, so its product with a prototype is the
sum of its n-grams' products: these are worked out once for each n-gram and kept.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass

import numpy as np

DIMENSIONS = 4096
_WORDS = DIMENSIONS // 64
_SLOTS = 1 << 22


def _letter_table() -> np.ndarray:
    """For each code of the basic plane the small letter, or 32 for what is no letter or mark."""
    table = np.full(0x10000, 32, dtype=np.uint64)
    for code in range(0x10000):
        if 0xD800 <= code < 0xE000:
            continue
        char = chr(code)
        if unicodedata.category(char)[0] in "LM":
            low = char.lower()
            table[code] = ord(low) if len(low) == 1 else code
    return table


_letters: np.ndarray | None = None


def letters(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The letters of all texts, each text ended by a 10, and where the texts begin. Anything but letters and marks is 32."""
    global _letters
    if _letters is None:
        _letters = _letter_table()
    codes = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    small = _letters[np.minimum(codes, 0xFFFF)]
    high = codes > 0xFFFF
    if high.any():
        small = np.where(high, codes.astype(np.uint64), small)
    ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts)))
    small[ends - 1] = 10
    return small, np.concatenate(([0], ends[:-1]))


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x + np.uint64(0x9E3779B97F4A7C15)).astype(np.uint64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def ngram_vectors(keys: np.ndarray) -> np.ndarray:
    """Vectors of +1 and -1 for n-grams of up to three letters, as letters() codes them: 21 bits for each letter, the last one lowest."""
    bits = np.zeros((len(keys), _WORDS), dtype=np.uint64)
    place = np.arange(_WORDS, dtype=np.uint64)
    for at in range(3):
        letter = (keys >> np.uint64(21 * at)) & np.uint64((1 << 21) - 1)
        vector = _mix(letter[:, None] * np.uint64(_WORDS) + place)
        turn = np.uint64(13 * at)
        if at:
            vector = np.roll((vector << turn) | (vector >> (np.uint64(64) - turn)), at, axis=1)
        bits ^= np.where((letter > 0)[:, None], vector, np.uint64(0))
    return 1 - 2 * np.unpackbits(bits.view(np.uint8), axis=1).astype(np.float32)


def ngram_keys(small: np.ndarray) -> list[np.ndarray]:
    """At each position the n-grams of one, two and three letters that end there, 0 where there is none: one letter only beyond the
    alphabets (it says nothing there), longer ones not across the ends of texts or two spaces."""
    shift = np.uint64(21)
    none = np.uint64(0)
    text = np.where(small == 10, np.uint64(32), small)
    one = np.where(text > 0x2FF, text, none)
    before = np.concatenate(([np.uint64(32)], text[:-1]))
    before2 = np.concatenate(([np.uint64(32)] * 2, text[:-2]))[: len(text)]
    start = np.concatenate(([True], small[:-1] == 10))
    before = np.where(start, np.uint64(32), before)
    second = np.concatenate(([True, True], small[:-2] == 10))[: len(text)] | start
    before2 = np.where(second, np.uint64(32), before2)
    blank = (text == 32) & (before == 32)
    two = np.where(blank | (small == 10) & (before == 32), none, (before << shift) | text)
    three = np.where((before == 32) & ((text == 32) | (before2 == 32)), none, (before2 << (shift + shift)) | (before << shift) | text)
    return [one, two, three]


_kept: dict[int, dict] = {}


@dataclass
class LanguageModel:
    """prototypes: one unit vector for each language, of what differs from their mean. sharp: turns cosines into confidences. split: how much two languages must explain better than one."""

    languages: list[str]
    prototypes: np.ndarray
    sharp: float = 40.0
    split: float = 10.0

    @property
    def _rows(self) -> dict:
        """What is kept of n-grams' products: in the process, since each task gets a copy of the model."""
        name = self.__dict__.get("_name") or hash(self.prototypes.tobytes())
        self.__dict__["_name"] = name
        if name not in _kept:
            _kept.clear()
            _kept[name] = {}
        return _kept[name]

    def _lookup(self, keys: np.ndarray) -> np.ndarray:
        """Row of each n-gram in the kept table of products."""
        cache = self._rows
        if "slots" not in cache or cache["used"] > 600_000:
            cache.clear()
            cache.update(slots=np.zeros(_SLOTS, dtype=np.uint64), row=np.zeros(_SLOTS, dtype=np.int32), scores=np.zeros((4096, len(self.languages)), dtype=np.float32), used=1)
        slot = (_mix(keys) & np.uint64(_SLOTS - 1)).astype(np.int64)
        rows = cache["row"][slot]
        missing = np.flatnonzero(cache["slots"][slot] != keys)
        if len(missing):
            fresh, back = np.unique(keys[missing], return_inverse=True)
            known = fresh > 0
            scores = np.zeros((len(fresh), len(self.languages)), dtype=np.float32)
            for i in range(0, len(fresh), 2048):
                part = fresh[i : i + 2048]
                scores[i : i + 2048] = ngram_vectors(part) @ self.prototypes.T
            scores[~known] = 0
            base = cache["used"]
            cache["used"] = base + len(scores)
            if cache["used"] > len(cache["scores"]):
                room = np.zeros((2 * cache["used"], len(self.languages)), dtype=np.float32)
                room[:base] = cache["scores"][:base]
                cache["scores"] = room
            cache["scores"][base : base + len(scores)] = scores
            at = (_mix(fresh) & np.uint64(_SLOTS - 1)).astype(np.int64)
            free = cache["slots"][at] == 0
            cache["slots"][at[free]] = fresh[free]
            cache["row"][at[free]] = base + np.flatnonzero(free)
            rows[missing] = base + back
        return rows

    def position_scores(self, small: np.ndarray, lengths: np.ndarray | None = None) -> np.ndarray:
        """At each letter the products of the n-grams ending there with the prototypes. lengths, one for each text, is filled with the lengths of the texts' bundled vectors.

        N-grams' vectors are all of one length and nearly at right angles, so a bundle's squared length is the dimensions times the sum of its squared counts.
        """
        total = np.zeros((len(small), len(self.languages)), dtype=np.float32)
        text = np.cumsum(np.concatenate(([0], small[:-1] == 10))) if lengths is not None else None
        square = np.zeros(len(lengths)) if lengths is not None else None
        for keys in ngram_keys(small):
            use = np.flatnonzero(keys)
            rows = self._lookup(keys[use])
            total[use] += self._rows["scores"][rows]  # a position has each length once
            if text is not None:
                pairs = np.sort(text[use] << 32 | rows)
                begin = np.flatnonzero(np.concatenate(([True], pairs[1:] != pairs[:-1]))) if len(pairs) else np.zeros(0, dtype=np.int64)
                count = np.diff(np.concatenate((begin, [len(pairs)])))
                square += np.bincount(pairs[begin] >> 32, count.astype(float) ** 2, len(square))
        if lengths is not None:
            lengths[:] = np.sqrt(square * DIMENSIONS)
        return total


def count_ngrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    small, _ = letters(texts)
    keys = np.concatenate([k[k > 0] for k in ngram_keys(small)])
    return np.unique(keys, return_counts=True)


def bundle(by_language: dict[str, list[str]], dampen: float = 0.5) -> LanguageModel:
    """Prototypes from texts by language: each n-gram's vector counts as often as it occurs, to the power `dampen`."""
    languages = sorted(by_language)
    counted = [count_ngrams(by_language[language]) for language in languages]
    keys = np.unique(np.concatenate([k for k, _ in counted]))
    weight = np.zeros((len(languages), len(keys)), dtype=np.float32)
    for i, (own, counts) in enumerate(counted):
        weight[i, np.searchsorted(keys, own)] = counts.astype(np.float32) ** dampen
    prototypes = np.zeros((len(languages), DIMENSIONS), dtype=np.float32)
    for j in range(0, len(keys), 2048):
        prototypes += weight[:, j : j + 2048] @ ngram_vectors(keys[j : j + 2048])
    prototypes /= np.maximum(np.linalg.norm(prototypes, axis=1, keepdims=True), 1e-9)
    if len(languages) > 1:
        prototypes -= prototypes.mean(axis=0)
        prototypes /= np.maximum(np.linalg.norm(prototypes, axis=1, keepdims=True), 1e-9)
    return LanguageModel(languages, prototypes)
