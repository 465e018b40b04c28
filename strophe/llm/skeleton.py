"""Visually identical text: a skeleton that look-alike texts share.

A text is decomposed, every character is replaced by the prototype of its look-alikes, and the result
is decomposed again. Equal skeletons mean equal looks: width of letters, kana and spaces, invisible
characters, composition and look-alike letters make no difference; case, accents and punctuation do.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strophe.session import cut_lineage

# Letters of other scripts and the Latin letters they look like.
LOOK_ALIKE = {
    "cyrillic": ("АВЕЅІЈКМНОРСТУХҮԚԜаеоԁӏсһіјрԛѕԝхуѵҽ", "ABESIJKMHOPCTYXYQWaeodlchijpqswxyve"),
    "greek": ("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧαγιικνορυχϲϳ", "ABEZHIKMNOPTYXayiikvopuxcj"),
    "armenian": ("Օսոցհյց", "Ouoghjg"),
    "cherokee": ("ᎠᎡᎢᎥᎪᎫᎬᎳᎷᎻᏀᏃᏙᏚᏞᏟᏢᏦᏧᏴ", "DRTiAJEWMHGZVSLCPKdB"),
    "coptic": ("ⲀⲂⲈⲎⲒⲔⲘⲚⲞⲢⲤⲦⲨⲬⲟⲣⲥ", "ABEHIKMNOPCTYXopc"),
    "lisu": ("ꓐꓑꓓꓔꓖꓗꓙꓚꓜꓝꓟꓠꓡꓢꓣꓦꓧꓪꓫꓬꓮꓰꓲꓳꓴ", "BPDTGKJCZFMNLSRVHWXYAEIOU"),
    "other": ("ıȷɑɡɩʏℓ", "ijagiYl"),
}
# Characters that are never drawn, besides those of the category of format characters.
INVISIBLE = "­͏ᅟᅠ឴឵᠋᠌᠍᠎᠏ㅤﾠ"

# Compatibility forms that are drawn differently.
UNLIKE = ("<circle>", "<super>", "<sub>", "<fraction>", "<square>", "<vertical>", "<small>")


class _Prototypes(dict):
    """A table for str.translate that works a character out when it is first met."""

    def __missing__(self, code: int) -> int | str | None:
        char = chr(code)
        category = unicodedata.category(char)
        if category == "Cf" or char in INVISIBLE or 0xFE00 <= code <= 0xFE0F or 0xE0100 <= code <= 0xE01EF:
            value: int | str | None = None
        elif category in ("Zs", "Zl", "Zp") or char in "\t\v\f\x85":
            value = 32
        else:
            apart = unicodedata.normalize("NFKD", char)
            tag = unicodedata.decomposition(char).partition(" ")[0]
            seen = tag in UNLIKE or category[0] in "PS" and not apart.isalnum()
            value = code if seen else apart
        self[code] = value
        return value


_FIRST = _Prototypes()
_LETTERS = {ord(a): b for strange, plain in LOOK_ALIKE.values() for a, b in zip(strange, plain, strict=True)}


def add_look_alikes(lines: Iterable[str]) -> int:
    """Take more single characters from lines "code ; codes of its prototype ; ..." in hexadecimal, as the public table of confusables has them. Gives how many were new.

    Call it where the texts are worked on. A prototype is reduced by what is known already; characters that are drawn as several stay as they are.
    """
    new = 0
    for line in lines:
        fields = line.split("#")[0].split(";")
        if len(fields) > 1 and len(fields[0].split()) == len(fields[1].split()) == 1:
            code, prototype = int(fields[0], 16), int(fields[1], 16)
            if code > 127 and code not in _LETTERS:
                _LETTERS[code] = _LETTERS.get(prototype, chr(prototype))
                new += 1
    return new


def skeleton(text: str) -> str:
    """The skeleton of a text. Punctuation and symbols keep their own form; an ASCII text is its own skeleton."""
    if text.isascii():
        return text.replace("\t", " ") if "\t" in text else text
    apart = unicodedata.normalize("NFD", text).translate(_FIRST)
    return unicodedata.normalize("NFD", apart.translate(_LETTERS))


def plain(text: str) -> str:
    """One consistent readable form: compatible letters, no invisible characters, look-alikes in the script of their word, composed."""
    if text.isascii():
        return text
    text = unicodedata.normalize("NFC", unicodedata.normalize("NFD", text).translate(_FIRST))
    if any("Ͱ" <= c <= "ӿ" for c in text) and any("A" <= c <= "z" for c in text):
        text = " ".join(_one_script(word) for word in text.split(" "))
    return text


_TO_CYRILLIC = {ord(b): a for a, b in zip(*LOOK_ALIKE["cyrillic"], strict=True) if a in "АВЕКМНОРСТХаеорсху"}


def _one_script(word: str) -> str:
    """A word that mixes Latin with Cyrillic or Greek, in the script of most of the letters that have no look-alike."""
    if not any("A" <= c <= "z" and c.isalpha() for c in word) or not any("Ͱ" <= c <= "ӿ" for c in word):
        return word
    strict_latin = sum("A" <= c <= "z" and c.isalpha() and ord(c) not in _TO_CYRILLIC for c in word)
    strict_other = sum("Ͱ" <= c <= "ӿ" and ord(c) not in _LETTERS for c in word)
    if strict_other > strict_latin:
        return word.translate(_TO_CYRILLIC)
    return "".join(_LETTERS.get(ord(c), c) for c in word)


def _digest(text: str) -> bytes:
    return blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def with_skeletons(df: DataFrame, text: str) -> DataFrame:
    """df with `skeleton_key` and `text_key`, 16 bytes each, instead of its text; both null for a null text. Keys stand for the texts in shuffles."""
    kept = [c for c in df.columns if c != text]
    at = [*kept, text].index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            looks = pa.array([None if t is None else _digest(skeleton(t)) for t in texts], pa.binary())
            exact = pa.array([None if t is None else _digest(t) for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(kept))), looks, exact], [*kept, "skeleton_key", "text_key"])

    kinds = dict(df.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in kept) + ", skeleton_key binary, text_key binary"
    return df.select(*kept, text).mapInArrow(run, schema)


def skeletons(df: DataFrame, row: str, text: str) -> DataFrame:
    """row, skeleton, plain: the skeleton of each text and the readable form that it should be kept in. Null stays null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([None if t is None else skeleton(t) for t in texts], pa.string()), pa.array([None if t is None else plain(t) for t in texts], pa.string())], ["row", "skeleton", "plain"])

    return df.select(row, text).mapInArrow(run, f"row {dict(df.dtypes)[row]}, skeleton string, plain string").withColumnRenamed("row", row)


def _keyed(df: DataFrame, group: str, row: str, text: str) -> DataFrame:
    """g, r, skeleton_key, text_key of the rows without nulls, written once: 16-byte keys, since they are read several times and skeletons are dear."""
    return cut_lineage(with_skeletons(df.select(F.col(group).alias("g"), F.col(row).alias("r"), F.col(text).alias("t")).dropna(), "t"))


def look_classes(df: DataFrame, group: str, row: str, text: str) -> DataFrame:
    """group, look, rows, spellings: the looks of each group's texts (16 bytes as hexadecimal digits), how many rows have each and in how many spellings.

    Rows with a null group, text or row are left out. A look that a third of all rows have is counted by spelling first, with a map-side part.
    """
    spelled = _keyed(df, group, row, text).groupBy("g", "skeleton_key", "text_key").count()
    return spelled.groupBy("g", "skeleton_key").agg(F.sum("count").alias("rows"), F.count("*").alias("spellings")).select(F.col("g").alias(group), F.lower(F.hex("skeleton_key")).alias("look"), "rows", "spellings")


def look_alike_pairs(df: DataFrame, group: str, row: str, text: str) -> DataFrame:
    """row_a, row_b (row_a < row_b): pairs of rows of one group whose texts look the same but are not the same code points.

    Rows with a null group, text or row are in no pair; empty texts look like texts of nothing but invisible characters. A pair of
    rows of equal code points is never made: copies only meet the other spellings of their look.
    Groups of one spelling are dropped by an aggregate with a map-side part before anything is joined.
    """
    keyed = _keyed(df, group, row, text)
    varied = keyed.groupBy("g", "skeleton_key").agg(F.min("text_key").alias("a"), F.max("text_key").alias("b")).filter("a <> b").select(F.col("g").alias("vg"), F.col("skeleton_key").alias("vk"))
    rows = keyed.join(varied, F.expr("g = vg and skeleton_key = vk"), "left_semi")
    left = rows.select(F.col("g"), F.col("skeleton_key").alias("k"), F.col("r").alias("row_a"), F.col("text_key").alias("t_a"))
    right = rows.select(F.col("g").alias("g_"), F.col("skeleton_key").alias("k_"), F.col("r").alias("row_b"), F.col("text_key").alias("t_b"))
    return left.join(right, F.expr("g = g_ and k = k_ and row_a < row_b and t_a <> t_b")).select("row_a", "row_b")
