import random

from gradelex.llm import matching
from gradelex.llm.matching import match_records
from tests.conftest import rows_of

SV = "sv_id bigint, swedish_lemma string, english_lemma string, chinese_lemma string, pos string, c string, e string, n string"
FR = "fr_id bigint, french_lemma string, english_lemma string, chinese_lemma string, pos string, c string, e string, n string"


def run(spark, sv, fr, **kw):
    a = spark.createDataFrame([(i, "", *r, "x", "y", "z") for i, r in enumerate(sv)], SV)
    b = spark.createDataFrame([(i, "", *r, "x", "y", "z") for i, r in enumerate(fr)], FR)
    return match_records(a, "sv_id", b, "fr_id", **kw)


def pairs(df):
    return rows_of(df, "sv_id", "fr_id")


def test_spellings_of_a_gloss(spark):
    sv = [("long jimiba ring", "长金米巴戒指", "NOUN"), ("to wash a fire", "洗火", "VERB"), ("rare tajafu street", "稀塔贾福街", "NOUN"), ("tajafu street", "塔贾福街", "NOUN")]
    fr = [
        ("ring, long jimiba", "长金米巴戒指（名）", None), ("LONG-JIMIBA-RINGS", None, "n."), ("long jimiba ring (noun)", "长 金米巴戒指。", "PROPN"), ("(to) wash the fire *", None, "AUX"),
        ("rare tajafu street;", "塔贾福街", "Noun"), ("tajafu street", "塔贾福街", None), (None, "洗火", "v."), (None, None, "NOUN"),
    ]
    assert pairs(run(spark, sv, fr)) == [(0, 0), (0, 1), (0, 2), (1, 3), (1, 6), (2, 4), (3, 5)]


def test_senses_and_qualifiers_stay_apart(spark):
    sv = [("old bank", "旧银行", "NOUN"), ("old bank", "旧河岸", "NOUN"), ("bank", "银行", "NOUN"), ("light", "光", "NOUN")]
    fr = [("old bank", "旧河岸", "NOUN"), ("old bank", None, "NOUN"), ("light", "光", "VERB"), ("bank", "旧银行", "NOUN")]
    # a gloss of two senses without pivot is left alone, as is another tag
    assert pairs(run(spark, sv, fr)) == [(1, 0)]


def test_typos(spark):
    sv = [("quiet gaziru apple", "静加齐鲁苹果", "NOUN"), ("cold kitala apple", "冷基塔拉苹果", "NOUN"), ("cold fitala sea", "冷菲塔拉海", "NOUN")]
    fr = [("quiet-gaairu-apple", "静加齐鲁苹果", None), ("quei tgaziru apple", "静加齐鲁苹果", None), ("cold kiatla apple", None, "NOUN"), ("cold kitala sea", None, "NOUN")]
    got = pairs(run(spark, sv, fr))
    assert (0, 0) in got and (0, 1) in got and (1, 2) in got


def test_typos_beside_repeated_and_further_words(spark):
    sv = [("buy window window", "买窗窗", "NOUN"), ("thin fire fire", "薄火火", "NOUN"), ("long ring", "长戒指", "NOUN"), ("cold ka kata", "冷卡塔", "NOUN")]
    fr = [("buy window windoww", None, "NOUN"), ("thin fier fire", None, "NOUN"), ("long x ring", None, "NOUN"), ("cold kata ka", None, "NOUN")]
    # a letter that stands alone is a word more, and the same words in another order are no typo
    assert pairs(run(spark, sv, fr)) == [(0, 0), (1, 1)]


ADJECTIVES = ["quiet", "cold", "rare", "heavy", "empty", "simple"]
NOUNS = ["apple", "river", "engine", "window", "bottle", "garden"]


def common_words(without):
    """Glosses of common words only, with pivots."""
    return [(f"{a} {n}", f"{chr(0x5000 + i)}{chr(0x6000 + j)}", "NOUN") for i, a in enumerate(ADJECTIVES) for j, n in enumerate(NOUNS) if (i, j) not in without]


def test_every_mistyped_gloss_with_pivot_is_tried(spark):
    own = [(i, i) for i in range(6)]
    clean = [(f"{a} {n}", None, "NOUN") for a, n in zip(ADJECTIVES, NOUNS, strict=True)]
    wrong = [(f"{a}{a[-1]} {n}", f"{chr(0x5000 + i)}{chr(0x6000 + i)}", "NOUN") for i, (a, n) in enumerate(zip(ADJECTIVES, NOUNS, strict=True))]
    got = pairs(run(spark, clean + common_words(own), wrong + common_words(own)))
    assert got == sorted([(i, i) for i in range(36)], key=repr)


def test_a_resolved_mistyped_gloss_is_tried_for_open_ones(spark):
    own = [(i, i) for i in range(6)]
    clean = [(f"{a} {n}", None, "NOUN") for a, n in zip(ADJECTIVES, NOUNS, strict=True)]
    full = [(f"{a} {n}", f"{chr(0x5000 + i)}{chr(0x6000 + i)}", "NOUN") for i, (a, n) in enumerate(zip(ADJECTIVES, NOUNS, strict=True))]
    wrong = [(f"{e[: e.index(' ')]}{e[e.index(' ') - 1]} {e[e.index(' ') + 1 :]}", z, p) for e, z, p in full]
    got = pairs(run(spark, clean + full + common_words(own), wrong + common_words(own)))
    assert got == sorted([(k, i) for i in range(6) for k in (i, 6 + i)] + [(12 + i, 6 + i) for i in range(30)], key=repr)


def test_a_repeated_variant_of_a_common_word_is_tried(spark):
    own = [(f"{a} harbour", f"{chr(0x5000 + i)}港", "NOUN") for i, a in enumerate(ADJECTIVES)]
    more = [(f"{w}{v} harbour", f"{chr(0x5100 + i)}港", "NOUN") for i, (w, v) in enumerate((w, v) for w in ("kato", "lumi", "zefa") for v in ("ru", "nosi", "bade", "ti", "wug", "ximo"))]
    variant = [(f"{a} harbor", None, "NOUN") for a in ADJECTIVES]
    got = pairs(run(spark, own + more + common_words(()), variant + more + common_words(())))
    assert got == sorted([(i, i) for i in range(6 + 18 + 36)], key=repr)


def test_repeats_count_and_large_classes(spark, monkeypatch):
    sv = [("deep well", "深井", "NOUN")] * 40 + [(f"w{i} stone", f"石{chr(0x4E00 + i)}", "NOUN") for i in range(30)]
    fr = [("deep well", "深井", "NOUN")] * 30 + [("Deep wells", "深井", None)] * 2 + [(f"w{i} stone", f"石{chr(0x4E00 + i)}", "NOUN") for i in range(20)]
    want = sorted([(i, j) for i in range(40) for j in range(32)] + [(40 + i, 32 + i) for i in range(20)], key=repr)
    assert pairs(run(spark, sv, fr)) == want
    monkeypatch.setattr(matching, "CLASSES", 5)
    monkeypatch.setattr(matching, "MEMBERS", 7)
    assert pairs(run(spark, sv, fr)) == want


def test_a_pivot_of_many_classes(spark, monkeypatch):
    sv = [(f"w{chr(97 + i)}{chr(97 + i % 7)}", "井", "NOUN") for i in range(20)] + [("long " * 20 + f"stone{i}", None, "NOUN") for i in range(20)]
    fr = [(f"v{chr(97 + i)}{chr(98 + i % 5)}", "井", "NOUN") for i in range(15)] + [("long " * 20 + f"stane{i}", None, "NOUN") for i in range(20)]
    want = pairs(run(spark, sv, fr))
    assert {(i, j) for i in range(20) for j in range(15)} <= set(want)
    monkeypatch.setattr(matching, "CLASSES", 4)
    assert pairs(run(spark, sv, fr)) == want


def test_classes_and_members(spark):
    sv = [("deep well", "深井", "NOUN")] * 3 + [("w stone", "石", "NOUN")]
    fr = [("deep well", "深井", "NOUN")] * 2 + [("Deep wells", "深井", None)]
    a = spark.createDataFrame([(i, "", *r, "x", "y", "z") for i, r in enumerate(sv)], SV)
    b = spark.createDataFrame([(i, "", *r, "x", "y", "z") for i, r in enumerate(fr)], FR)
    got, members = matching.match_classes(a, "sv_id", b, "fr_id")
    assert rows_of(got, "first1", "n1", "first2", "n2") == [(0, 3, 0, 2), (0, 3, 2, 1)]
    assert members.count() == 7 and members.select("c").distinct().count() == 4


def test_confidence_of_rules_by_held_back_attributes(spark):
    tags = ["NOUN", "VERB"]
    sv = [(f"red w{i}", f"红{chr(0x5000 + i)}", tags[i % 2]) for i in range(40)]
    fr = [(f"red w{i}", f"红{chr(0x5000 + i)}", tags[(i < 4) ^ (i % 2)]) for i in range(40)] + [("red w5", None, "VERB")]
    by_rule = {r.rule: r.confidence for r in run(spark, sv, fr).collect()}
    # 4 of 40 pairs differ in the tag, and two tags agree by chance in half of all cases: 4 of the 36 are expected to be wrong
    chance = (20 * 20 + 20 * 20) / (40 * 40)
    wrong = 4 * chance / (1 - chance)
    assert abs(by_rule["gloss+pivot+pos"] - (36 - wrong + 1) / (36 + 2)) < 0.01


def test_synonyms_are_learnt(spark):
    words = [f"{a}{b}{c}" for a in ("ka", "lu", "mi") for b in ("to", "ra") for c in ("zu", "fi")]
    sv = [(f"dry {w} blanket", f"干{chr(0x5000 + i)}毯", "NOUN") for i, w in enumerate(words)]
    fr = [(f"dry {w} quilt", None if i == 3 else f"干{chr(0x5000 + i)}毯", "NOUN") for i, w in enumerate(words)]
    assert pairs(run(spark, sv, fr)) == sorted([(i, i) for i in range(len(words))], key=repr)


def test_confidence(spark):
    sv = [(f"red w{i}", f"红{chr(0x5000 + i)}", "NOUN") for i in range(20)]
    df = run(spark, sv, sv)
    assert {round(r.confidence, 6) for r in df.collect()} == {round(21 / 22, 6)}
    labels = spark.createDataFrame([(i, i, i < 3) for i in range(4)], "sv_id bigint, fr_id bigint, same boolean")
    assert {round(r.confidence, 6) for r in run(spark, sv, sv, labels=labels).collect()} == {round(4 / 6, 6)}


def test_nulls_long_and_empty(spark):
    r = random.Random(1)
    long = " ".join("".join(r.choice("abc") for _ in range(5)) for _ in range(2000))
    sv = [(None, None, None), ("", "", ""), (long, None, None), ("...", "。", "?")]
    assert pairs(run(spark, sv, sv)) == [(2, 2)]
    assert run(spark, [], sv).count() == 0 and run(spark, sv, []).count() == 0
