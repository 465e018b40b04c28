"""Skeletons, marks, fillers, sentences, languages."""

import random
import time

import numpy as np
import pytest

from strophe.llm.boosting import BoostedTrees
from strophe.llm.fillers import FillerModel, filler_examples
from strophe.llm.hyper import bundle, count_ngrams, ngram_vectors
from strophe.llm.language import analyse, cosines, fit_languages, stretches, with_languages
from strophe.llm.markup import label_number, read_line
from strophe.llm.sentences import ChainModel, find_sentences, sentence_ends, stripped_chain, train_sentences
from strophe.llm.skeleton import look_alike_pairs, plain, skeleton

ALIASES = {"ozmer": 0, "tivka": 1, "yorrick-b": 3}


@pytest.mark.parametrize(("a", "b"), [
    ("perdu", "ｐｅｒｄｕ"), ("café", "café"), ("a b", "a b"), ("a b", "a　b"), ("ab", "a​b"), ("score", "ѕсоrе"), ("ガ", "ｶﾞ"), ("กำลัง", "กําลัง"),
    ("한국", "한국"), ("水色", "⽔⾊"), ("fl", "ﬂ"), ("１2", "12"), ("ab", "a­b"),
])
def test_same_look(a, b):
    assert skeleton(a) == skeleton(b) and skeleton(skeleton(a)) == skeleton(a)


@pytest.mark.parametrize(("a", "b"), [("a", "A"), ("e", "é"), ("a!", "a"), ("...", "…"), ("か", "が"), ("a b", "ab"), ("x²", "x2"), ("①", "1"), ("!", "！")])
def test_other_look(a, b):
    assert skeleton(a) != skeleton(b)


def test_plain_form_is_readable():
    assert plain("гpyстная худoжницa") == "грустная художница" and plain("lооk мир") == "look мир" and plain("é") == "é"


def test_pairs_against_brute_force(spark):
    random.seed(2)
    texts = ["score", "ѕcore", "sсore", "ｓcore", "Score", "scorе", "", "​", " ", None]
    rows = [(i, random.choice(["x", "y", None]), random.choice(texts)) for i in range(120)]
    got = {tuple(r) for r in look_alike_pairs(spark.createDataFrame(rows, "id long, song string, text string"), "song", "id", "text").collect()}
    want = {(a[0], b[0]) for a in rows for b in rows if a[0] < b[0] and a[1] and a[1] == b[1] and a[2] is not None and b[2] is not None and a[2] != b[2] and skeleton(a[2]) == skeleton(b[2])}
    assert got == want and want


@pytest.mark.parametrize(("label", "number"), [
    ("SPEAKER_00", 0), ("Speaker 3", 3), ("S2", 2), ("Spk-1", 1), ("０", 0), ("2.0", 2), ("1_OUTLIER", 1), (" 0 ", 0), ("ozmer ", 0), ("TIVKA", 1), ("N/A", None), ("?", None), ("", None), (None, None), ("unknown", None), ("03", 3),
])
def test_labels(label, number):
    assert label_number(label, ALIASES) == number


@pytest.mark.parametrize(("line", "who", "words"), [
    ("S2: er, We talked", 2, "er, We talked"), ("[03:19.45] TIVKA: And then", 1, "And then"), ("00:01:11,051 --> 00:01:14,051 >> Ozmer: hi", 0, "hi"), ("(04:53) you know", None, "you know"),
    ("♪♪ [Speaker 3] so [breath] it", 3, "so   it"), ("Yorrick-B - uh", 3, "uh"), ("说话人1：我们", 1, "我们"), ("[music]", None, ""), ("<1.7s> <noise> (applause)", None, ""), ("Nobody: said", None, "Nobody: said"), ("(我们失去了低沉的楼梯)", None, "(我们失去了低沉的楼梯)"), ("(笑) a (laughs)", None, "a"), ("", None, ""),
])
def test_lines(line, who, words):
    got = read_line(line, ALIASES)
    assert (got[0], got[1].strip()) == (who, words)


def test_fillers():
    lines = [("uh, um", 0), ("hrmf", 0), ("hrmf", 0), ("hrmf", 0), ("exactly right", 2), ("good point", 2), ("yes", 1), ("yes", 1), ("We keep every old house near that green door today", 10), ("some large boats sail past this small town at noon", 10)] * 6
    model = FillerModel().fit(filler_examples(lines))
    assert model.is_filler("hrmf") and model.is_filler("uh") and not model.is_filler("good point") and not model.is_filler("yes")
    assert not model.has_words("uh, um") and model.has_words("uh, good point") and not model.has_words("") and not model.has_words("嗯，呃")
    assert model.without("um, We kept the uh, door") == "We kept the door" and model.without("um") == "" and model.without("a, b") == "a, b"


def test_boosted_trees():
    random = np.random.default_rng(0)
    x = random.random((500, 3))
    x[::7, 0] = np.nan
    y = ((x[:, 0] > 0.5) & (x[:, 1] < 0.7)).astype(float)
    assert ((BoostedTrees().fit(x, y).decide(x) > 0) == y).mean() > 0.97
    assert (BoostedTrees().fit(x[:0], y[:0]).decide(x) < 0).all()


def test_vectors_are_nearly_orthogonal():
    v = ngram_vectors(np.arange(1, 200, dtype=np.uint64) * np.uint64(12345677))
    like = v @ v.T / v.shape[1]
    assert np.allclose(np.diag(like), 1) and np.abs(like - np.eye(len(v))).max() < 0.12


def test_cosines_are_those_of_bundled_vectors():
    """Prototypes are unit vectors, and the cosine of a text is that of the vectors of its n-grams, really put together."""
    by = {"a": ["the cat sat on the mat", "a dog and a cat"], "b": ["der hund und die katze", "eine matte"], "c": ["猫坐在垫子上", "狗和猫"]}
    model = bundle(by)
    assert np.allclose(np.linalg.norm(model.prototypes, axis=1), 1, atol=1e-5)
    texts = ["the dog sat and sat and sat on a mat", "die katze und der hund", "猫和狗猫和狗", "", "x", "the katze 猫 on der mat " * 30]
    like, found = cosines(texts, model)
    for i, text in enumerate(texts):
        keys, counts = count_ngrams([text])
        vector = (ngram_vectors(keys) * counts[:, None]).sum(axis=0)
        length = np.linalg.norm(vector)
        if length:
            assert np.abs(like[i] - model.prototypes @ vector / length).max() < 0.05 * max(0.1, np.abs(like[i]).max()) + 0.01
    assert like.argmax(axis=1)[:3].tolist() == [0, 1, 2] and len(found) == 6


def test_fillers_of_any_length():
    long = "what i am trying to say here"
    model = FillerModel().fit(filler_examples([(long, 0)] * 4 + [("a house by the sea where nobody lives any more", 10)] * 4))
    assert model.is_filler(long) and not model.is_filler("a house by the sea where nobody lives any more")
    assert model.without(f"{long}, we left") == "we left" and not model.has_words(f"{long}, uh")


def test_languages(spark, medium):
    segments = spark.read.parquet(f"{medium}/segments.parquet")
    model = fit_languages(segments, frozenset(ALIASES), FillerModel())
    texts = {"en": "the lonely baker borrows the silver kettle", "es": "la guitarrista solemne guarda la taza azul", "fr": "la pianiste fragile lève la fenêtre utile", "de": "der stille Fischer vergisst die leere Brücke", "ru": "старая швея хвалит зимнюю лампу", "zh": "小心的司机测量了冰冷的车站", "ja": "若い庭師は曲がった茶碗を忘れた", "ko": "외로운 운전사는 빛바랜 차표를 세었다", "th": "คนสวนคนเงียบล้างหุบเขาสีเขียว"}
    total, _, _, gain, _, _ = analyse(list(texts.values()), model)
    assert [model.languages[i] for i in total.argmax(axis=1)] == list(texts) and (gain < model.split).all()
    for a, b in (("en", "de"), ("zh", "en"), ("fr", "es"), ("ja", "zh"), ("ko", "th")):
        found = stretches(f"{texts[a]} {texts[b]}", model)
        assert [model.languages[s[2]] for s in found] == [a, b]
    rows = [(1, None), (2, ""), (3, "[music]"), (4, "ok"), (5, "nous avons perdu la tasse magique dans le théâtre vide, oh"), (6, "我们失去了冰冷的河流 DJ")]
    got = {r.id: (r.lang, r.mixed, r.enough) for r in with_languages(spark.createDataFrame(rows, "id int, text string"), ["id"], model, frozenset(), FillerModel()).collect()}
    assert got[5] == ("fr", False, True) and got[6] == ("zh", False, True) and not got[4][2] and not {1, 2, 3} & set(got)


def cut(text, model, prose=True):
    out, at = [], 0
    for end in sentence_ends(text, prose, model, frozenset(ALIASES)):
        out.append(text[at:end].strip())
        at = end
    return out


@pytest.fixture(scope="module")
def sentences(spark, medium):
    return train_sentences(spark.read.parquet(f"{medium}/documents.parquet"), frozenset(ALIASES))


@pytest.mark.parametrize("parts", [
    ["Dr. A. Bell went home at 6 p.m.", "That tailor waits."], ["We kept the red ticket, the old map, etc.", "Vol. 3, ed. by Ivo et al., shows it."], ["“Keep the tape rolling!” said Nusol Lane.", "Go on?!", "Yes."],
    ["Ms. Dar wrote: “The harbour must stay.”", "One sailor asked, “Who knows?” and left."], ["The file take_05.wav lasts 16.7 seconds; nobody minds.", "One door closes… but another opens."],
    ["Am 28. April misst der Fahrer die Wiese, z. B. wenn es regnet.", "„Lasst das Band laufen!“, sagt Mel Dar.", "Ende."], ["« Ne coupez pas ! » dit Mel Dar.", "M. Kel écrit : « Tout reste ici. »", "Fin."],
    ["“不要停下磁带！”梅梅喊道。", "Dr. 莫说过，司机看着它。", "维写道：“必须留下。”", "听啊！"], ["「テープを止めないで！」とリトメは言った。", "長さは20.4秒だった。"], ['"테이프를 멈추지 마!"라고 달 씨가 말했다.', "조용한 가수는 잊었다."],
    ["См. стр. 15: швея чинит лампу.", "«Не трогайте!» — говорит Мос.", "В 57 г. до записи тихо."], ["¿Por qué nadie ve el río?", "El Sr. Dar mide la guitarra, aprox. 3.5 veces."],
])
def test_sentences(sentences, parts):
    joint = "" if parts[0][-1] in "。」" else " "
    assert cut(joint.join(parts), sentences) == parts
    wrapped = joint.join(parts).replace(" ", "\n", 3)
    assert [p.replace("\n", " ") for p in cut(wrapped, sentences)] == parts


def test_sentences_without_capitals_and_spaces(sentences):
    assert cut("the quiet driver went home at 6 p.m. is it true? ms. dar asked, “who knows?” and left.", sentences) == ["the quiet driver went home at 6 p.m.", "is it true?", "ms. dar asked, “who knows?” and left."]
    assert cut("Nobody listens. we kept the map. It was built in 1999. Then it rained.", sentences) == ["Nobody listens.", "we kept the map.", "It was built in 1999.", "Then it rained."]
    assert cut("One door closes.Another opens.", sentences) == ["One door closes.", "Another opens."]
    assert cut("คนสวนล้างหุบเขา ดร. ทามลืมโคมไฟ 10 ครั้ง ช้าๆ ในห้อง คนขับรถนับตั๋ว", sentences) == ["คนสวนล้างหุบเขา", "ดร. ทามลืมโคมไฟ 10 ครั้ง", "ช้าๆ ในห้อง", "คนขับรถนับตั๋ว"]
    assert cut("ไฟล์ mix_17.mp3 ยาว 24 วินาที ดร ทามลืมโคมไฟ นักร้องฝังเพลง", sentences) == ["ไฟล์ mix_17.mp3 ยาว 24 วินาที", "ดร ทามลืมโคมไฟ", "นักร้องฝังเพลง"]
    space = [(1, ("space", "", "word", "thai", "", 1, "thai", "", False))]
    assert ChainModel().tags(space) == [False] and sentences.tags(space) == [True]  # learned, not a rule of the operator
    assert cut("Heading\n\nOne line\nbroken. Two.", sentences) == ["Heading", "One line\nbroken.", "Two."]
    assert cut("[verse 1]\r\nOne line\nTwo. Three", sentences, prose=False) == ["[verse 1]", "One line", "Two.", "Three"]
    assert cut("", sentences) == cut(" \n ", sentences) == []
    assert sentence_ends(None, True, sentences, frozenset()) == []


def test_sentences_cover_the_text(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    found = {}
    for r in find_sentences(docs, frozenset(ALIASES), with_text=True).collect():
        found.setdefault(r.doc_id, []).append(r)
    for doc in docs.filter("text is not null").collect():
        rows = sorted(found.get(doc.doc_id, []), key=lambda r: r.sent_no)
        assert "".join("".join(r.sentence.split()) for r in rows) == "".join(doc.text.split())
        assert all(doc.text[r.sent_start : r.sent_end] == r.sentence for r in rows)


def test_long_stretches_and_quotations(sentences):
    """Neither a far opening quote nor a long word is out of sight, and odd texts take no quadratic time."""
    far = "“" + "a word and " * 1_000 + "one more!” said Dar. Then it rained."
    assert cut(far, sentences) == [far[: -len(" Then it rained.")], "Then it rained."]
    assert cut("x" * 5_000 + ". Then it rained.", sentences)[-1] == "Then it rained."
    began = time.time()
    for text in ("a." * 30_000, "“" * 20_000 + ".”" * 20_000, "คำ" * 30_000 + ".", " ." * 30_000):
        cut(text, sentences)
    assert time.time() - began < 20


def test_stripped_sentences_train_spaces():
    chain, gold = stripped_chain(["คนสวนล้าง 10 ครั้ง!", "ดร. ทามลืม", "ช้าๆ ในห้อง."])
    assert gold.count(True) == 2 and len(gold) > 2 and all(seen[0] == "space" for _, seen in chain)
