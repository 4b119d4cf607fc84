import os
import random

import numpy as np
import pytest

from gradelex.llm import langid as L
from tests.conftest import rows_of

PROFILE = [("en", "english", "English", "English"), ("de", "german", "German", "Deutsch"), ("fr", "french", "French", "français"), ("zh", "chinese", "Chinese", "中文")]
PARTS = {
    "en": ("the dog", "my sister", "the old baker", "sees", "has forgotten", "looks for", "the stone", "the bread", "in the morning", "because it rained"),
    "de": ("der Hund", "meine Schwester", "der alte Bäcker", "sieht", "vergisst", "sucht", "den Stein", "das Brot", "am Morgen", "wegen des Regens"),
    "fr": ("le chien", "ma sœur", "le vieux boulanger", "voit", "a oublié", "cherche", "la pierre", "le pain", "ce matin", "à cause de la pluie"),
    "zh": ("狗", "我妹妹", "老面包师", "看见", "忘了", "在找", "石头", "面包", "早上", "因为下雨"),
}


def sentence(r, lang):
    p = PARTS[lang]
    words = [r.choice(p[:3]), r.choice(p[3:6]), r.choice(p[6:8]), r.choice(p[8:])]
    return "".join(words) + "。" if lang == "zh" else (" ".join(words)).capitalize() + "."


@pytest.fixture(scope="module")
def model():
    r = random.Random(2)
    texts, labels = [], []
    for _ in range(240):
        lang = r.choice(list(PARTS))
        texts.append(" ".join(sentence(r, lang) for _ in range(4)))
        labels.append(lang if r.random() > 0.12 else r.choice(list(PARTS)))
    return L.fit(texts, labels, [p[0] for p in PROFILE])


def names():
    return L.label_codes([dict(zip(("code", "directory", "display_name", "endonym"), p, strict=True)) for p in PROFILE])


def test_codewords_are_far_apart():
    for n in (2, 4, 8, 9, 30):
        w = L.codewords(n)
        gaps = [(w[i] != w[j]).sum() for i in range(n) for j in range(i)]
        assert min(gaps) >= w.shape[1] // 2


def test_held_out_accuracy(model):
    r = random.Random(77)
    want = [r.choice(list(PARTS)) for _ in range(400)]
    got = L.identify([sentence(r, x) for x in want], model)
    right = sum(model.codes[g[0][2]] == x for g, x in zip(got, want, strict=True))
    assert right / 400 > 0.99


def test_segments_quotes_and_fragments(model):
    r = random.Random(5)
    de, en, zh = sentence(r, "de"), sentence(r, "en"), sentence(r, "zh")
    text = f"{de} {de} {en}\n{zh}"
    got = L.identify([text, f"{de} “{en}” „{en}“ {de}", f"{de}\nsong – chanson – 歌", "““", "12 - 3 / 4", "", de.upper(), de[:-1], f"{de} 3.5 Der Hund sieht 1.250 Steine am Morgen."], model)
    langs = lambda g: [model.codes[y] for _, _, y, _, w in g if w]
    assert langs(got[0]) == ["de", "en", "zh"]
    assert [text[a:b].strip() for a, b, *_ in got[0]] == [f"{de} {de}", en, zh]
    assert set(langs(got[1])) == set(langs(got[2])) == set(langs(got[6])) == set(langs(got[7])) == set(langs(got[8])) == {"de"}
    assert got[3] == got[4] == got[5] == []


def test_short_whole_sentences_and_long_quotes(model):
    r = random.Random(5)
    de, en = sentence(r, "de"), sentence(r, "en")
    long = " ".join([en[:-1]] * 12)
    got = L.identify([f"{de} {de} Le pain.", f"{de} {de} 面包。", f"{de} Das Brot.", f"{de} “{long}” {de}", f"{de} “{long}.” {de}"], model)
    langs = [[model.codes[y] for _, _, y, _, w in g if w] for g in got]
    assert len(long) > 200 and langs == [["de", "fr"], ["de", "zh"], ["de"], ["de"], ["de"]]


def test_chunks_do_not_show(model, monkeypatch):
    r = random.Random(6)
    texts = [sentence(r, r.choice(list(PARTS))) * r.randrange(4) for _ in range(60)]
    whole = [x for t in texts for x in L.identify([t], model)]
    assert L.identify(texts, model) == whole
    s, parts = L.sentences(texts), None
    monkeypatch.setattr(L, "CHUNK", 50)
    parts = L.joined(texts)
    for f in ("doc", "start", "end", "whole", "size", "grams", "count"):
        assert np.array_equal(getattr(s, f), getattr(parts, f)), f


def test_labels():
    n = names()
    for text, code in (("de", "de"), (" DE ", "de"), ("German", "de"), ("Deutsch", "de"), ("de-AT", "de"), ("ger", "de"), ("zh_CN", "zh"), ("中文", "zh"), ("und", None), ("", None), (None, None), ("?", None), ("en-GB", "en"), ("French (Canada)", "fr")):
        assert L.read_label(text, n) == code, text


SCHEMA = "doc_id bigint, text string, lang string, label string, langs string, segments string"


def test_documents(spark, model):
    r = random.Random(9)
    de, fr = sentence(r, "de"), sentence(r, "fr")
    rows = [(1, de, "de"), (2, de, "German"), (3, de, "fr"), (4, de, None), (5, f"{de} {fr}", "de"), (6, None, None), (7, "...", "xx"), (8, "", "de"), (3, de, "fr"), (9, (de + " ") * 5000, "en")]
    df = spark.createDataFrame([(*x, "a", "b", "c") for x in rows], SCHEMA).repartition(3)
    found = L.detect_languages(df, model, names())
    assert rows_of(L.mislabelled(found)) == [(3, "de"), (3, "de"), (4, "de"), (5, "de"), (5, "fr"), (9, "de")]
    assert rows_of(found.where("doc_id in (6, 7, 8)"), "doc_id", "lang", "ambiguous") == [(6, None, None), (7, None, None), (8, None, None)]
    assert L.mislabelled(L.detect_languages(df.limit(0), model, names())).count() == 0


def test_training_is_bounded(spark):
    r = random.Random(1)
    rows = [(i, sentence(r, x) * 3, x, "", "", "") for i in range(900) for x in ["de" if i % 3 else r.choice(list(PARTS))]]
    profile = spark.createDataFrame(PROFILE, "code string, directory string, display_name string, endonym string")
    m, n = L.train(spark.createDataFrame(rows, SCHEMA), profile)
    assert m.codes == ["en", "de", "fr", "zh"] and n["german"] == "de"
    with pytest.raises(ValueError):
        L.train(spark.createDataFrame([], SCHEMA), profile)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
def test_on_documents(spark):
    from gradelex.llm import queries

    assert queries.p10_found(spark, "/root/testdata/sf0.001").count() > 0
