"""Text functions as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The ranges that count as one family of scripts (Han, kana, hangul, Thai).
CJK_CLASS = r"[\x{4e00}-\x{9fff}\x{3040}-\x{30ff}\x{ac00}-\x{d7af}\x{0e00}-\x{0e7f}]"


def without_brackets(text: Column) -> Column:
    """The text without its [..] parts, trimmed of all Unicode white space."""
    return trim_all(F.regexp_replace(text, r"\[[^\]]*\]", ""))


def trim_all(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def is_cjk(text: Column) -> Column:
    """Whether any character is of the cjk family."""
    return text.rlike(CJK_CLASS)


def millis(seconds: Column) -> Column:
    """Whole milliseconds of a DOUBLE of seconds; null for NaN and infinity."""
    return F.when(F.abs(seconds) < 1e15, F.round(seconds * 1000).cast("long"))


# Letters of one run of a western word; marks that are no characters of a text.
LATIN_LETTERS = "a-zA-ZàâäéèêëïîôùûüÿœæçÀÂÄÉÈÊËÏÎÔÙÛÜŸŒÆÇäöüÄÖÜßáéíóúñÁÉÍÓÚÑ"
LOOSE_MARKS = r"""[\s\.,!?;:'"()\[\]{}，。！？；：、（）【】]"""
SENTENCE_MARKS = r"[.!?。！？,，;；]\s*$"


def only_brackets(text: Column) -> Column:
    """All [..] parts of the text, joined."""
    return F.array_join(F.regexp_extract_all(text, F.lit(r"(\[[^\]]*\])"), F.lit(1)), "")


def bracket_label(text: Column) -> Column:
    """The first non-empty [..] label, small and trimmed; null without one."""
    label = F.regexp_extract(text, r"\[([^\]]+)\]", 1)
    return F.when(label != "", trim_all(F.lower(label)))


def leading_label(text: Column) -> Column:
    """The label the text begins with, as written; null without one."""
    return F.when(text.rlike(r"^\[[^\n]*?\]"), F.regexp_extract(text, r"^\[([^\n]*?)\]", 1))


def after_label(text: Column) -> Column:
    """What follows the label on its line; the whole text if it begins with none."""
    return F.when(text.rlike(r"^\[[^\n]*?\]"), F.regexp_extract(text, r"^\[[^\n]*?\]\s*([^\n]*)", 1)).otherwise(text)


def language_family(text: Column) -> Column:
    return F.when(is_cjk(text), "cjk").otherwise("western")


def count_words(text: Column) -> Column:
    """Words of western text: by white space, of a single word its runs of Latin letters, else its characters but marks (1 at least). 0 for a text of brackets only."""
    bare = without_brackets(text)
    parts = F.size(F.split(bare, r"(?U)\s+"))
    latin = F.regexp_count(bare, F.lit(f"[{LATIN_LETTERS}]+"))
    rest = F.char_length(F.regexp_replace(bare, LOOSE_MARKS, ""))
    return F.when(bare == "", 0).when(parts > 1, parts).when(latin > 0, latin).when(bare.isNotNull(), F.greatest(rest, F.lit(1)))


def count_characters(text: Column) -> Column:
    """Characters of the cjk family outside brackets."""
    return F.regexp_count(without_brackets(text), F.lit(CJK_CLASS))


def normalize_spoken(text: Column) -> Column:
    """Text to compare with recognised speech: a space between Han characters, letters, digits and apostrophes only, small."""
    spaced = F.regexp_replace(text, r"([\x{4e00}-\x{9fff}])(?=[\x{4e00}-\x{9fff}])", "$1 ")
    kept = F.regexp_replace(spaced, r"(?U)[^\p{L}\p{N}_\s']", "")
    return F.lower(trim_all(F.regexp_replace(kept, r"(?U)\s+", " ")))


def count_mixed(text: Column) -> Column:
    """Han characters one each, any other token one; a token of both counts its Han characters and one more."""
    plain = normalize_spoken(text)
    han = F.regexp_count(plain, F.lit(r"[\x{4e00}-\x{9fff}]"))
    others = F.size(F.filter(F.split(plain, r"(?U)\s+"), lambda t: F.regexp_replace(t, r"[\x{4e00}-\x{9fff}]", "") != ""))
    return F.when(text.isNotNull(), han + others)


def without_punctuation(text: Column, keep_space: bool = False) -> Column:
    """Letters, digits and marks only; keep_space turns dashes into spaces and keeps white space."""
    if keep_space:
        return F.regexp_replace(F.translate(text, "-‐‑‒–—―−", "        "), r"(?U)[^\p{L}\p{N}\p{M}\s]", "")
    return F.regexp_replace(text, r"[^\p{L}\p{N}\p{M}]", "")


def ends_with_mark(text: Column) -> Column:
    return text.rlike(SENTENCE_MARKS)


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)/*$", 1)


def file_stem(path: Column) -> Column:
    """The file name without its last suffix; a leading dot starts no suffix."""
    return F.regexp_replace(file_name(path), r"(?<=.)\.[^.]*$", "")


def file_suffix(path: Column) -> Column:
    return F.lower(F.regexp_extract(file_name(path), r".(\.[^.]*)$", 1))


def singer_text(path: Column) -> Column:
    """What stands before the first " - " of a file's name (all of it without one), less a known double suffix."""
    bare = F.regexp_replace(file_name(path), r"(\.(flac|mp3|wav|m4a))?\.json$", "")
    return trim_all(F.split(bare, " - ")[0])


def diarized_singer_text(path: Column) -> Column:
    """singer_text(), but of a name without " - " what stands before its first hyphen."""
    bare = F.regexp_replace(file_name(path), r"(\.(flac|mp3|wav|m4a))?\.json$", "")
    return trim_all(F.when(bare.contains(" - "), F.split(bare, " - ")[0]).otherwise(F.split(bare, "-")[0]))


def kept_path(path: Column, parts: int = 2) -> Column:
    """The last parts of a path: where a file goes below another root."""
    return F.array_join(F.slice(F.split(path, "/"), -parts, parts), "/") if parts == 1 else F.when(F.size(F.split(path, "/")) >= parts, F.array_join(F.slice(F.split(path, "/"), -parts, parts), "/")).otherwise(path)


def singers(path: Column) -> Column:
    return F.filter(F.transform(F.split(singer_text(path), "、"), trim_all), lambda s: s != "")


def clean_laughter(text: Column) -> Column:
    """Without "laughter" and the marks after it, spaces squeezed; a lone "noise" becomes [noise]."""
    bare = trim_all(F.regexp_replace(F.regexp_replace(text, r"""(?i)laughter[.,!?'"]*""", ""), r"(?U)\s+", " "))
    return F.when(F.lower(F.regexp_replace(bare, r"[\[\].]", "")) == "noise", F.lit("[noise]")).otherwise(bare)


def approximate_tokens(text: Column) -> Column:
    return F.floor(F.char_length(text) / 4)
