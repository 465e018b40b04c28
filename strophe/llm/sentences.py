"""Sentence boundaries: characters are tagged as boundary or inside by a linear-chain model and Viterbi decoding.

Most characters can't end a sentence, so their tag is certain and the chain runs over the rest: ends of
sentence marks, and spaces beside letters of a script without marks. The model is trained here on texts tagged by
rules that need capitals, once as they are and once without them, so that it also reads texts in lower case; for
the script without marks it is trained on lines whose marks and ends are stripped, with the ends as boundaries.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

from strophe.llm.markup import lead_end
from strophe.operators.sample import bounded_sample


@dataclass(frozen=True)
class SentenceRules:
    """sample: documents at most that the model is trained on. rounds: of training. aliases: names that are labels of speakers. prose: the kind in which only a blank line ends a line's sentence.
    lines: the kind whose lines are single sentences, which train the script without marks."""

    sample: int = 1500
    rounds: int = 6
    prose: str = "prose"
    lines: str = "verse"


# Abbreviations after which a sentence goes on, whatever follows.
GO_ON = frozenset(
    "dr mr mrs ms st prof no vol p pp fig ed vs feat approx ca nr s z b d h u bzw evtl ggf env ex n m mme mlle pág núm aprox sr sra srta ул т е см стр им гл рис ดร พ.ศ นพ".split()
)
# Abbreviations that may also be a sentence's last word.
MAY_END = frozenset("etc a.m p.m jr usw ff др г гг тыс млн b.p.m i.e e.g inc ltd co a cf al".split())
_OPENERS = {"”": "“", "“": "„", "»": "«", "」": "「", "』": "『", '"': '"', "’": "‘"}
_THAI = "ก-ๅ็-๎"
_BLANKS = "[ \xa0　]+"
_MARK = re.compile(rf"[.!?。！？｡．…]+(?:[ \xa0 ]?»|[\"”“’')\]）」』】》〉])*|(?<=[{_THAI}ๆA-Za-z0-9]){_BLANKS}(?=[{_THAI}])|(?<=[{_THAI}ๆ]){_BLANKS}(?=[ๆA-Za-z0-9“«\"])")
_BREAK = re.compile(r"\r\n|\n|\r")
_BLANK = re.compile(r"(?:\r\n|\n|\r)[ \t\xa0　]*(?:\r\n|\n|\r)\s*")
_NEXT = re.compile(r"(\s*)(([^\W\d_]+)|\S|\Z)")
_LETTER = re.compile(f"[{_THAI}]")
_STRIPPED = re.compile(r"[.!?…,;:“”\"'()«»]+")


def _script(char: str) -> str:
    code = ord(char)
    if 0x0E00 <= code < 0x0E80:
        return "thai"
    if 0x3040 <= code < 0xA000:
        return "han"
    if 0xAC00 <= code < 0xD7B0:
        return "hangul"
    return ""


def _class(char: str) -> str:
    if not char:
        return "end"
    if char.isalpha():
        return _script(char) or ("upper" if char.isupper() else "lower")
    if char.isdigit():
        return "digit"
    if char in "“«„「『\"‘‹《【(（¡¿[<♪*":
        return "open"
    if char in "—–-":
        return "dash"
    return "mark"


def segments(text: str, prose: bool) -> Iterator[tuple[int, int]]:
    """Stretches that no sentence crosses: paragraphs of prose, lines of anything else; without white space around them."""
    at = 0
    for found in (_BLANK if prose else _BREAK).finditer(text):
        yield at, found.start()
        at = found.end()
    yield at, len(text)


def _beside(char: str) -> str:
    """What a space of the script without marks has beside it."""
    return "again" if char == "ๆ" else "thai" if _script(char) else "digit" if char.isdigit() else "latin" if char.isalpha() else "open"


def _word_start(text: str, a: int, i: int, known: dict[int, int]) -> int:
    """Where the letters that end at i begin; single dots between letters belong to them. known: the starts found at earlier dots."""
    at = i
    while at > a:
        char = text[at - 1]
        if char == "." and at < i and at - 2 >= a and text[at - 2].isalpha():
            if at - 1 in known:
                at = known[at - 1]
                break
            at -= 1
        elif not char.isalpha():
            break
        else:
            at -= 1
    known[i] = at
    return at


def candidates(text: str, a: int, b: int, lead: int, caseless: bool) -> list[tuple[int, tuple]]:
    """Positions in text[a:b] that may end a sentence, with what the model sees there."""
    out = []
    words: dict[int, int] = {}
    places: dict[str, list[int]] = {}
    intros: dict[int, str] = {}

    def last(char: str, i: int) -> int:
        """The last place of a character in text[a:i], -1 if there is none."""
        if char not in places:
            places[char] = [m.start() for m in re.finditer(re.escape(char), text[a:b])]
        k = bisect_left(places[char], i - a) - 1
        return a + places[char][k] if k >= 0 else -1

    for found in _MARK.finditer(text, a, b):
        i, j = found.span()
        first = text[i]
        if first.isspace():
            word = text[max(text.rfind(" ", a, i), text.rfind("\xa0", a, i), text.rfind("　", a, i), a - 1) + 1 : i]
            out.append((i, ("space", "", "go" if word in GO_ON else "word", _beside(text[j]), "", 1, _beside(text[i - 1]), "", False)))
            continue
        turned = text.find("“", i, j)
        if turned >= 0 and last("„", i) <= last("“", i):
            # It closes nothing that „ opened, so it opens what follows.
            j = turned
        if j >= b:
            continue
        after = text[j]
        if first == "." and j == i + 1:
            before = text[i - 1] if i > a else " "
            if before.isdigit() and after.isdigit() or after in "_/@" or before == "_":
                continue
            if after.isalnum() and not (after.isupper() and before.islower()) and not (before.isalpha() and _script(before)):
                start = _word_start(text, a, i, words)
                if not (caseless and i - start > 3 and text.find(".", start, i) < 0 and after.isalpha()):
                    continue
        marks = text[i:j].rstrip("\"”“»’')]）」』】》〉 \xa0 ")
        if "…" in marks or marks.startswith(".."):
            if not any(c in "!?。！？" for c in marks):
                continue
            kind = "…!"
        else:
            kind = "." if marks in (".", "．") else "。" if marks[0] in "。｡" else "!"
        word = ""
        if kind == ".":
            start = _word_start(text, a, i, words)
            if start < i:
                word = "#" if start > a and text[start - 1] in "_0123456789" else text[start:i].casefold()
            else:
                # A number of up to two digits may be an ordinal.
                word = "#" if i > a and text[i - 1].isdigit() and not text[max(a, i - 3) : i].isdigit() else ""
        shape = "one" if len(word) == 1 else "dots" if "." in word else "go" if word in GO_ON else "may" if word in MAY_END else "none" if not word else "word"
        if shape in ("one", "dots"):
            shape = "may" if word in MAY_END and word not in ("a",) else "go" if word in GO_ON or shape == "one" and not _script(word) else "dots" if shape == "dots" else "word"
        follow = _NEXT.match(text, j, b)
        blank, token, name = follow[1], follow[2], follow[3]
        sort = _class(token[:1])
        closing = text[j - 1] if j - i > len(marks) else ""
        quote, intro = "", ""
        if closing in _OPENERS:
            quote = "close"
            opener = last(_OPENERS[closing], i)
            if opener >= 0:
                if opener not in intros:
                    k = opener - 1
                    while k >= a and text[k].isspace():
                        k -= 1
                    intros[opener] = "first" if k < a or opener <= lead or text[k] in ".!?。！？”»」\"“" else "colon" if text[k] in ":：" else "comma" if text[k] in ",，、" else "mid"
                intro = intros[opener]
        elif closing:
            quote = "bracket"
        if caseless and sort in ("upper", "lower"):
            sort = "letter"
        word = word if len(word) < 2 or not _script(word[-1]) or shape != "word" else "word"
        token = (name or token).casefold() if caseless and not (name and _script(name[0])) else ""
        out.append((j, (kind, word, shape, sort, token, min(len(blank), 2), quote, intro, caseless)))
    return out


def by_rule(seen: tuple, text: str = "") -> bool:
    """Tag of a candidate in a text with capitals; what the model is trained on."""
    kind, word, shape, sort, _, blank, quote, intro, _ = seen
    if kind == "space":
        return shape != "go" and quote == "thai" and sort in ("thai", "open")
    if sort == "end":
        return True
    if sort == "lower":
        # A small letter goes on with the sentence, unless a whole word or a question stands before it and nothing is quoted.
        return not quote and blank > 0 and (kind == "!" or kind == "." and shape == "word" and len(word) > 3)
    if sort in ("mark", "dash"):
        return False
    if quote == "close":
        return intro == "colon" and (blank > 0 or sort in ("han", "upper", "open"))
    if kind == "." and shape == "go":
        return False
    if kind == "." and sort in ("thai", "han") and shape != "none":
        return False
    if kind == "." and shape in ("may", "dots"):
        return sort in ("upper", "open", "hangul", "digit") and blank > 0 or sort == "upper"
    if kind == "." and word == "#" and not blank:
        return False
    return True


def _features(seen: tuple) -> list[tuple]:
    kind, word, shape, sort, token, blank, quote, intro, caseless = seen
    return [
        (0, kind, shape, sort, quote, intro, caseless),
        (1, kind, sort, blank > 0, quote, intro, caseless),
        (2, word if kind == "." else kind, sort if not caseless else "letter", caseless),
        (3, token if caseless else "", quote, intro, shape if kind == "." else kind, caseless),
        (4, kind, shape, caseless),
        (5, word if shape in ("may", "dots") and caseless else "", token if caseless else "", caseless),
        (6, quote, intro, sort),
    ]


@dataclass
class ChainModel:
    """Weights of features for the tag boundary, and of a boundary soon after another one."""

    weights: dict = field(default_factory=dict)
    close: float = 0.0
    scores: dict = field(default_factory=dict, repr=False)

    def __getstate__(self) -> dict:
        return {"weights": self.weights, "close": self.close, "scores": {}}

    def score(self, seen: tuple) -> float:
        found = self.scores.get(seen)
        if found is None:
            get = self.weights.get
            found = sum(get(f, 0.0) for f in _features(seen))
            if len(self.scores) < 300_000:
                self.scores[seen] = found
        return found

    def tags(self, chain: list[tuple[int, tuple]], against: list[bool] | None = None) -> list[bool]:
        """The best tags of a chain of candidates (Viterbi; the score of inside is 0, and two boundaries within three characters cost `close`).

        In training each tag other than the one in `against` gets one point more, so that right tags are learned with a margin.
        """
        inside, boundary = 0.0, -1e9
        back: list[tuple[bool, bool]] = []
        last = -100
        for k, (place, seen) in enumerate(chain):
            score = self.score(seen)
            if against is not None:
                score += -1.0 if against[k] else 1.0
            after = boundary - self.close if place - last < 3 else boundary
            back.append((boundary > inside, after > inside))
            inside, boundary = max(inside, boundary), max(inside, after) + score
            last = place
        tag = boundary > inside
        out = [False] * len(chain)
        for k in range(len(chain) - 1, -1, -1):
            out[k] = tag
            tag = back[k][1] if tag else back[k][0]
        return out

    def fit(self, chains: list[tuple[list[tuple[int, tuple]], list[bool]]], rounds: int) -> ChainModel:
        """Averaged structured perceptron."""
        weights: dict = defaultdict(float)
        total: dict = defaultdict(float)
        self.weights, step = weights, 1
        self.close = 1.0
        for _ in range(rounds):
            for chain, gold in chains:
                self.scores = {}
                for (_, seen), guess, want in zip(chain, self.tags(chain, gold), gold, strict=True):
                    if guess != want:
                        for f in _features(seen):
                            weights[f] += 1.0 if want else -1.0
                            total[f] += step * (1.0 if want else -1.0)
                step += 1
        self.weights = {f: w - total[f] / step for f, w in weights.items() if w - total[f] / step}
        self.scores = {}
        return self


def _caseless(text: str) -> bool:
    """Whether a text has letters that could be capitals but none is one."""
    return text.lower() == text != text.upper()


def sentence_ends(text: str | None, prose: bool, model: ChainModel, aliases: frozenset[str]) -> list[int]:
    """For each sentence of a text the number of code points up to its last character, closing marks included."""
    out: list[int] = []
    if not text:
        return out
    caseless = _caseless(text)
    for a, b in segments(text, prose):
        while b > a and text[b - 1].isspace():
            b -= 1
        while a < b and text[a].isspace():
            a += 1
        if a == b:
            continue
        lead = a if prose else a + lead_end(text[a:b], aliases)
        chain = candidates(text, a, b, lead, caseless)
        if chain:
            out += [place for (place, _), tag in zip(chain, model.tags(chain), strict=True) if tag]
        out.append(b)
    return out


def stripped_chain(sentences: list[str]) -> tuple[list[tuple[int, tuple]], list[bool]]:
    """Sentences as one text without marks: its candidate spaces in the script without marks, and which of them stand between two sentences."""
    whole, ends = "", set()
    for sentence in sentences:
        bare = " ".join(_STRIPPED.sub(" ", sentence).split())
        if bare:
            if whole:
                ends.add(len(whole))
                whole += " "
            whole += bare
    chain = [c for c in candidates(whole, 0, len(whole), 0, False) if c[1][0] == "space"]
    return chain, [place in ends for place, _ in chain]


def train_sentences(documents: DataFrame, aliases: frozenset[str], rules: SentenceRules = SentenceRules()) -> ChainModel:
    """The model, trained on a bounded sample of documents chosen by their hashes; texts without any capital aren't used."""
    sample = bounded_sample(documents.select("doc_id", "text", "doc_kind"), ["doc_id"], rules.sample)
    chains = []
    for text, kind in sample.select("text", "doc_kind").orderBy("doc_id", "text").limit(2 * rules.sample).collect():
        if not text:
            continue
        if kind == rules.lines and _LETTER.search(text):
            chains.append(stripped_chain(_BREAK.split(text)))
        if _caseless(text):
            continue
        prose = kind is None or kind == rules.prose
        for a, b in segments(text, prose):
            lead = a if prose else a + lead_end(text[a:b], aliases)
            chain = candidates(text, a, b, lead, False)
            if not chain:
                continue
            gold = [by_rule(seen) for _, seen in chain]
            chains.append((chain, gold))
            if kind != rules.lines and _LETTER.search(text, a, b):
                ends = [p for (p, _), tag in zip(chain, gold, strict=True) if tag]
                chains.append(stripped_chain([text[i:j] for i, j in zip([a, *ends], [*ends, b], strict=True)]))
            # The same stretch with some sentences beginning small and some ending with a number, which is rare in what there is.
            altered = list(text[:b])
            for k, ((p, seen), tag) in enumerate(zip(chain, gold, strict=True)):
                if tag and seen[3] == "upper" and seen[2] == "word" and len(seen[1]) > 3 and not seen[6]:
                    if k % 2:
                        at = p + len(_NEXT.match(text, p, b)[1])
                        if len(altered[at].lower()) == 1:
                            altered[at] = altered[at].lower()
                    elif text[p - 1] == ".":
                        altered[p - 1 - len(seen[1]) : p - 1] = "1" * len(seen[1])
            other = candidates("".join(altered), a, b, lead, False)
            chains.append((other, [by_rule(seen) for _, seen in other]))
            small = text[a:b].lower()
            if len(small) == b - a:
                # The same stretch without capitals, with the tags of the original at the same places.
                tags = dict(zip((p for p, _ in chain), gold, strict=True))
                lower = [(p + a, seen) for p, seen in candidates(small, 0, len(small), lead - a, True)]
                chains.append((lower, [tags.get(p, False) for p, _ in lower]))
    return ChainModel().fit(chains, rules.rounds)


def find_sentences(documents: DataFrame, aliases: frozenset[str] = frozenset(), rules: SentenceRules = SentenceRules(), with_text: bool = False) -> DataFrame:
    """doc_id, sent_end: every sentence of every document; with_text adds sent_no, sent_start and the sentence.

    A null or blank text has no sentence. A null kind counts as prose. Repeated documents have each their sentences.
    """
    model = train_sentences(documents, aliases, rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, ends, numbers, starts, parts = [], [], [], [], []
            for i, (text, kind) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                found = sentence_ends(text, kind is None or kind == rules.prose, model, aliases)
                rows += [i] * len(found)
                ends += found
                if with_text:
                    at = 0
                    for k, end in enumerate(found):
                        while at < end and text[at].isspace():
                            at += 1
                        numbers.append(k)
                        starts.append(at)
                        parts.append(text[at:end])
                        at = end
            ids = batch.column(0).take(pa.array(rows, pa.int64()))
            arrays, names = [ids, pa.array(ends, pa.int32())], ["doc_id", "sent_end"]
            if with_text:
                arrays += [pa.array(numbers, pa.int32()), pa.array(starts, pa.int32()), pa.array(parts, pa.string())]
                names += ["sent_no", "sent_start", "sentence"]
            yield pa.RecordBatch.from_arrays(arrays, names)

    schema = f"doc_id {dict(documents.dtypes)['doc_id']}, sent_end int" + ", sent_no int, sent_start int, sentence string" * with_text
    return documents.select("doc_id", "text", "doc_kind").mapInArrow(run, schema)
