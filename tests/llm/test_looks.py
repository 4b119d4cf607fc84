import random
import time
import unicodedata
from types import SimpleNamespace

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gradelex.llm import looks
from gradelex.llm.looks import look_alikes, normalise_looks, same_look
from tests.conftest import rows_of


def one(*texts):
    return same_look(pa.array(list(texts), pa.string())).to_pylist()


def test_equal_looks():
    assert len(set(one("Haus", "Ｈaus", "Hаus", "H​aus", " Haus ", "H­aus", "﻿Haus"))) == 1
    assert len(set(one("été", "été", "ét‍é"))) == 1
    assert len(set(one("ＡＢ c", "AB c", "AB c"))) == 1
    assert len(set(one("كتاب", "ﻛﺘﺎب", "کتاب"))) == 1
    assert len(set(one("إيجاد", "إیجاد", "إيجاد"))) == 1
    assert len(set(one("车金面", "⻋金⾯"))) == 1
    assert len(set(one("x（书）", "x(书)"))) == 1


def test_different_looks():
    for a, b in (("été", "ete"), ("Haus", "haus"), ("مدرسة", "مدرسه"), ("أمل", "امل"), ("علي", "على"), ("a b", "ab"), ("a  b", "a b"), ("rn", "m"), ("ß", "ss")):
        assert len(set(one(a, b))) == 2, (a, b)
    # without a joining letter after it, Farsi yeh has no dots
    assert one("علی") == one("على") != one("علي")


def test_marks_compose_as_unicode_says():
    r = random.Random(1)
    alphabet = "abe ézß中가각x" + "̧̣́̈ٔ" + "او"
    texts = ["".join(r.choice(alphabet) for _ in range(r.randrange(12))) for _ in range(5000)]
    assert one(*texts) == [unicodedata.normalize("NFC", t).strip(" ") for t in texts]


def test_many_marks_on_one_letter():
    r = random.Random(2)
    texts = ["a" + "".join(r.choice("\u0301\u0302\u0323\u0327\u0308") for _ in range(k)) + "b" for k in (1, 5, 300)] + ["e" + "\u0301" * 40_000, "ᄀ" + "ᅡ" * 3000, "x" + "\u0323\u0301" * 20_000]
    began = time.perf_counter()
    assert one(*texts) == [unicodedata.normalize("NFC", t) for t in texts]
    assert time.perf_counter() - began < 5


def test_confusables(spark):
    more = looks.confusables(spark)
    assert all(more[a] == b for a, b in zip("ρ𝐀аΑѕ", "pAaAs", strict=True))
    assert same_look(pa.array(["ρ𝐀", "pA", "я", "жд"]), tuple(more.items())).to_pylist() == ["pA", "pA", "я", "жд"]
    # capitals stay capitals, and no letter of the targets changes
    assert all(a not in looks.TARGETS and (a.isupper() <= b.isupper()) for a, b in more.items())


def test_confusables_without_the_library_are_an_error():
    def session(**icu):
        return SimpleNamespace(_jvm=SimpleNamespace(com=SimpleNamespace(ibm=SimpleNamespace(icu=SimpleNamespace(text=SimpleNamespace(**icu))))))

    def broken():
        raise ValueError("no data")

    checker = SimpleNamespace(getSkeleton=lambda text: text.replace("\n", " "))  # one skeleton for all letters
    short = session(**{"SpoofChecker$Builder": lambda: SimpleNamespace(build=lambda: checker)})
    for spark in (SimpleNamespace(), SimpleNamespace(_jvm=None), session(), session(**{"SpoofChecker$Builder": broken}), short):
        with pytest.raises(RuntimeError, match="ICU library"):
            looks.confusables(spark)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=30)), max_size=8))
def test_any_text(texts):
    texts = [t if t is None else t.encode("utf-8", "ignore").decode() for t in texts]
    got = one(*texts)
    assert [g is None for g in got] == [t is None for t in texts]
    assert one(*got) == got
    assert [one(t)[0] for t in texts] == got  # neighbours do not matter


def test_slices_and_empty():
    a = pa.array([None, "", " ", "a", "é"])
    assert same_look(a.slice(1, 4)).to_pylist() == ["", "", "a", "é"]
    assert same_look(pa.array([], pa.string())).to_pylist() == []
    assert same_look(pa.array(["х" * 500_000])).to_pylist() == ["x" * 500_000]


SCHEMA = "row_id bigint, t string, pos string, id string, f1 string, v0 string, n_rows string"


def test_groups(spark):
    rows = [(3, "Haus", "N"), (1, "Hаus ", "N"), (2, "Haus", "V"), (5, None, "N"), (4, None, "N"), (6, "", "N"), (7, "Haus", None), (8, "Haus", None), (8, "Haus", None)]
    df = spark.createDataFrame([(*r, "x", "y", "z", "w") for r in rows], SCHEMA)
    want = [(1, 1, 2), (2, 2, 1), (3, 1, 2), (4, 4, 2), (5, 4, 2), (6, 6, 1), (7, 7, 3), (8, 7, 3), (8, 7, 3)]
    assert rows_of(look_alikes(df, "row_id", ["t"], ["pos"]), "row_id", "first_id", "n_rows") == want
    assert look_alikes(df.limit(0), "row_id", ["t"], ["pos"]).count() == 0
    assert normalise_looks(df, ["t"]).columns == df.columns
