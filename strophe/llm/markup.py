"""What stands around the words of a transcript line: time marks, speaker labels, annotations, tags."""

from __future__ import annotations

import re

from strophe.llm.skeleton import skeleton

TIME = r"\[\d{1,3}:\d{2}(?:[:.,]\d+)*\]|\(\d{1,3}:\d{2}(?:[:.,]\d+)*\)|<\d+(?:\.\d+)?s>|\d{1,2}:\d{2}:\d{2}(?:[.,]\d{1,3})?(?:\s*-->\s*\d{1,2}:\d{2}:\d{2}(?:[.,]\d{1,3})?)?"
#: One word, short enough to be no clause in scripts without spaces (hangul may be decomposed).
_ONE = "(?:[^\\W\\d_\u0e00-\u0e7f\u1100-\u11ff\u3040-\u9fff\uac00-\ud7af]{1,14}|[\u3040-\u9fff\uac00-\ud7af]{1,4}|[\u1100-\u11ff]{1,10}|[\u0e00-\u0e7f]{1,10})"
#: Words in brackets, one word in parentheses, <noise>, *coughs*, notes of music.
NOTE = rf"\[[^\[\]]*\]|\({_ONE}\)|（{_ONE}）|<[^\W\d_]{{2,14}}>|\*[^*\n]{{1,30}}\*|[♪♫♬]+"
# How speakers are called in the nine languages.
SPEAKER_WORDS = ("speaker", "spk", "s", "说话人", "說話人", "話者", "화자", "sprecher", "locuteur", "hablante", "спикер", "ผู้พูด")

_WORD = "|".join(re.escape(w) for w in sorted({*SPEAKER_WORDS, *map(skeleton, SPEAKER_WORDS)}, key=lambda w: (-len(w), w)))
_NUMBERED = rf"(?:{_WORD})[\s_\-]*(\d{{1,3}})"
_NAMED = r"([^\s:：\[\]()<>*♪]{2,30})"
_LEAD = re.compile(rf"\s*(?:(?P<time>{TIME}|>>)|\[(?:{_NUMBERED}|{_NAMED})\]|(?:{_NUMBERED}|{_NAMED})(?:\s*[:：]|\s+-\s)|(?P<note>{NOTE}))\s*", re.IGNORECASE)
_CLEAN = re.compile(rf"{TIME}|{NOTE}")
_COLUMN = re.compile(rf"(?:{_WORD})?[\s_\-]*(\d{{1,4}})(?:\.0*)?(?:_outlier)?", re.IGNORECASE)
_SPACES = re.compile(r"\s+")


def label_number(label: str | None, aliases: dict[str, int]) -> int | None:
    """The number of a label as written in its own column; None for a missing or unknown one."""
    if not label:
        return None
    seen = _SPACES.sub(" ", skeleton(label)).strip().casefold()
    if seen in aliases:
        return aliases[seen]
    found = _COLUMN.fullmatch(seen)
    return int(found[1]) if found else None


def read_line(text: str, aliases: dict[str, int]) -> tuple[int | None, str]:
    """The number of the label at the start of a line, if there is one, and the line's words without marks, in the skeleton's form.

    The label may stand after time marks and annotations. A name is a label only if it is one of the aliases.
    """
    seen = skeleton(text)
    who, at = None, 0
    while found := _LEAD.match(seen, at):
        number = found[2] or found[4]
        name = found[3] or found[5]
        if number is not None:
            if who is not None:
                break
            who = int(number)
        elif name is not None:
            alias = aliases.get(name.casefold())
            if alias is None or who is not None:
                if seen[found.start() : found.end()].lstrip().startswith("["):
                    at = found.end()
                    continue
                break
            who = alias
        at = found.end()
    return who, _CLEAN.sub(" ", seen[at:])


def lead_end(text: str, aliases: frozenset[str] = frozenset()) -> int:
    """Where a line's words begin, after time marks, labels and annotations, in the text's own characters. Names count as labels if they are aliases."""
    at = 0
    while found := _LEAD.match(text, at):
        name = found[3] or found[5]
        if name is not None and name.casefold() not in aliases and not text[found.start() : found.end()].lstrip().startswith("["):
            break
        at = found.end()
    return at


def without_marks(text: str) -> str:
    """The text without time marks and annotations."""
    return _CLEAN.sub(" ", text)
