"""Token-level classification of fillers: sounds and phrases of hesitation."""

from __future__ import annotations

import re
from collections import defaultdict
from dataclasses import dataclass, field

import numpy as np

from strophe.llm.skeleton import skeleton

# Well-known fillers of the nine languages. The classifier starts from them.
SEEDS = (
    "uh", "um", "er", "erm", "hmm", "mm", "you know", "i mean", "eh", "este", "o sea", "mmm", "euh", "ben", "hum", "bah", "äh", "ähm", "hm", "öh",
    "эээ", "ммм", "э", "ну это", "ну", "嗯", "呃", "那个", "啊", "あの", "えっと", "うーん", "えー", "ええと", "음", "어", "그게", "저기", "เอ่อ", "อืม", "อ่า",
)
_SPLIT = re.compile(r"[,，、;；.。…!?！？\s]+")
_COMMA = re.compile(r"([,，、]\s*)")
_UNIT = re.compile(r"[^,，、]+")
_WORDY = re.compile(r"\w")


def _key(unit: str) -> str:
    """A unit in the skeleton's form, so that look-alike letters make no difference."""
    return " ".join(_SPLIT.split(skeleton(unit))).strip().casefold()


@dataclass
class FillerModel:
    """What is known of units that were seen, of whatever length, and for others a logistic regression over character n-grams, length and seed.

    An unseen filler is a sound: one word of at most `sound` letters that scores above margin. A unit is what stands between commas, or a word before a comma.
    """

    size: int = 4096
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    seeds: frozenset[str] = frozenset(skeleton(s).casefold() for s in SEEDS)
    margin: float = 1.5
    sound: int = 6
    known: dict[str, bool] = field(default_factory=dict)
    seen: dict[str, bool] = field(default_factory=dict, repr=False)

    def features(self, unit: str) -> list[int]:
        import zlib

        padded = f"^{unit}$"
        grams = {padded[i : i + n] for n in (1, 2, 3) for i in range(len(padded) - n + 1)} | {f"={unit}"}
        out = [3 + zlib.crc32(g.encode("utf-8", "surrogatepass")) % (self.size - 3) for g in grams]
        out.append(0)
        if len(unit) > 6:
            out.append(1)
        if unit in self.seeds:
            out.append(2)
        return out

    def fit(self, units: dict[str, tuple[float, float]], steps: int = 20) -> FillerModel:
        """units: for each unit how often it was a filler and how often it was not. The seeds are examples too."""
        examples = defaultdict(lambda: [0.0, 0.0], {u: list(c) for u, c in units.items()})
        for seed in self.seeds:
            examples[seed][0] += 3
        self.weights = np.zeros(self.size)
        self.weights[2] = 1.0
        # The regression decides on sounds only; all others are known or no fillers.
        rows = [(self.features(u), yes, no) for u, (yes, no) in sorted(examples.items()) if u in self.seeds or yes > no or " " not in u and len(u) <= 2 * self.sound]
        rate = 0.5
        more = max(1.0, sum(no > yes for _, yes, no in rows) / max(1, sum(yes > no for _, yes, no in rows)))
        for step in range(steps):
            for at, yes, no in rows:
                total = yes + no
                if total:
                    p = 1 / (1 + np.exp(-np.clip(self.weights[at].sum(), -30, 30)))
                    weight = min(total, 5) / 5 * (min(more, 20) if yes > no else 1)
                    self.weights[at] += rate / (1 + step / 10) * weight * (yes / total - p) / len(at) ** 0.5
        self.seen = {}
        self.known = {u: yes > no for u, (yes, no) in examples.items() if yes + no >= 2}
        return self

    def __getstate__(self) -> dict:
        return self.__dict__ | {"seen": {}}

    def is_filler(self, unit: str) -> bool:
        """Whether a unit as written is a filler. Answers are kept, but for those to sentences, which don't come again."""
        found = self.seen.get(unit)
        if found is None:
            found = self._decide(_key(unit))
            if (found or len(unit) < 32) and len(self.seen) < 100_000:
                self.seen[unit] = found
        return found

    def _decide(self, unit: str) -> bool:
        if not unit:
            return False
        found = self.known.get(unit)
        if found is None:
            found = unit in self.seeds or bool(len(self.weights) and " " not in unit and len(unit) <= self.sound and self.weights[self.features(unit)].sum() > self.margin)
        return found

    def is_sure(self, word: str) -> bool:
        """Whether a word was seen to be a filler or is a seed; for words that don't stand alone."""
        word = _key(word)
        return word in self.seeds or self.known.get(word) is True

    def without(self, words: str) -> str:
        """The words without fillers: whole units between commas, and a word or two at the end of a unit that goes on after a comma."""
        out = ""
        pieces = _COMMA.split(words)
        for i in range(0, len(pieces), 2):
            unit, comma = pieces[i], pieces[i + 1] if i + 1 < len(pieces) else ""
            if not unit.strip() or self.is_filler(unit):
                continue
            parts = unit.rstrip().split(" ")
            for n in (2, 1) if comma else ():
                if len(parts) > n and self.is_filler(" ".join(parts[-n:])):
                    unit, comma = " ".join(parts[:-n]) + " ", ""
                    break
            out += unit + comma
        return out.strip().rstrip(",，、")

    def has_words(self, words: str) -> bool:
        """Whether anything but fillers is left."""
        return any(_WORDY.search(u) and not self.is_filler(u) and not all(self.is_sure(p) or not _WORDY.search(p) for p in u.split()) for u in _UNIT.findall(words))


def filler_examples(lines: list[tuple[str, int | None]]) -> dict[str, tuple[float, float]]:
    """From cleaned lines with their counts of words: units of lines without any word are fillers, the only unit of another line is none,
    and words inside longer units count a little as such (but for the seeds, which may stand in a sentence)."""
    counts: dict[str, list[float]] = defaultdict(lambda: [0.0, 0.0])
    for words, number in lines:
        units = [k for u in _UNIT.findall(words) if (k := _key(u)) and _WORDY.search(k)]
        if number == 0:
            for unit in units:
                counts[unit][0] += 1
        elif number and len(units) == 1:
            counts[units[0]][1] += 1
        if number:
            for unit in units:
                for word in unit.split(" ")[1:-1]:
                    if _WORDY.search(word) and word not in FillerModel.seeds:
                        counts[word][1] += 0.2
    return {u: (a, b) for u, (a, b) in counts.items()}
