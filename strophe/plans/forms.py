"""SQL that folds compatible forms of letters, for checks in an engine without such a function."""

from __future__ import annotations

import unicodedata
from functools import cache

#: Blocks of code points with compatible forms: signs and letters of Latin, Thai vowels, radicals, letters in circles, kana, ligatures, forms of other widths.
BLOCKS = ((0xA0, 0x250), (0x0E33, 0x0E34), (0x1E00, 0x1F00), (0x2100, 0x2190), (0x2E80, 0x2FE0), (0x3130, 0x3190), (0x3200, 0x3400), (0xFB00, 0xFB07), (0xFF00, 0xFFF0))


@cache
def forms() -> str:
    """A MAP of the characters whose compatible form is another one, once decomposed and composed."""
    found = [(chr(c), unicodedata.normalize("NFKC", chr(c))) for a, b in BLOCKS for c in range(a, b) if unicodedata.category(chr(c)) != "Cn"]
    found = [(a, b) for a, b in found if a != b and unicodedata.normalize("NFC", a) == a]
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    return "MAP([" + ", ".join(quote(a) for a, _ in found) + "], [" + ", ".join(quote(b) for _, b in found) + "])"


def folded(text: str) -> str:
    """SQL of a text in compatible form, composed."""
    letter = f"coalesce({forms()}[x], x)"
    return f"CASE WHEN regexp_matches({text}, '[^\\x00-\\x7f]') THEN nfc_normalize(array_to_string(list_transform(string_split(nfc_normalize({text}), ''), lambda x: {letter}), '')) ELSE {text} END"
