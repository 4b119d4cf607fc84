from pyspark.sql import functions as F

from gradelex.functions import rules
from gradelex.functions.text import casefold, key64, nfc, nfc_fold, strip_ws


def value(spark, f, *args):
    df = spark.createDataFrame([tuple(args)], ", ".join(f"c{i} {'double' if isinstance(a, float) else 'string'}" for i, a in enumerate(args)))
    return df.select(f(*[F.col(f"c{i}") for i in range(len(args))]).alias("x")).collect()[0].x


def test_glosses(spark):
    for text, want in (("to be called", "be called"), ("  House  ", "house"), (" to be called ", "to be called"), ("\thouse\t", "\thouse\t"), ("", "")):
        assert value(spark, rules.norm_gloss, text) == want
    assert value(spark, rules.norm_pivot, "上 / 上面") == "上/上面"
    assert value(spark, rules.clean_gloss, "fiancé (male)") == "fiance male"
    assert value(spark, rules.clean_gloss, "apple/pear") == "apple pear"
    assert [value(spark, rules.ascii_gloss, t) for t in ("to be", "café", "", "a (b)", "it's co-op.")] == [True, False, False, False, True]
    assert [value(spark, rules.word_count, t) for t in ("", "  ", "a", " a  b\tc ")] == [0, 0, 1, 3]


def test_quotes(spark):
    for text, want in (('""word""', '"word"'), ('"simple"', "simple"), (' "a ""b"" c" ', 'a "b" c'), ('"', ""), ("plain", "plain"), ("", "")):
        assert value(spark, rules.unquote, text) == want
    assert value(spark, rules.clean_lemma, ' a\t"b"\r') == "a b"


def test_tags_and_digits(spark):
    assert [value(spark, rules.gloss_pos, t) for t in ("to run", "self-ed", "hidden", " To go", "")] == ["VERB", "ADJ", "", "VERB", ""]
    assert [value(spark, rules.coarse_pos, t) for t in ("AUX", "PROPN", "ADP")] == ["V", "N", "ADP"]
    assert [value(spark, rules.digits_allowed, t) for t in ("7", "2e", "22de", "1ste", "5G", "CO2", "3D打印", "12", "a1")] == [True] * 7 + [False] * 2


def test_model_text(spark):
    assert value(spark, rules.last_json, 'x {"a": 1} y {"b": 2}') == '{"b": 2}'
    assert value(spark, rules.last_json, "```json\n[1]\n``` then ```\n[2]\n```") == "[2]"
    assert value(spark, rules.last_json, "none") is None
    assert value(spark, rules.strip_thoughts, "<think>hm\nhm</think> yes") == "yes"
    assert value(spark, lambda c: rules.redact(c, "key1"), "a key1 b") == "a [redacted] b"
    assert value(spark, lambda c: rules.clip(c, 3), "abcd") == "abc…"
    assert [value(spark, rules.duration, x) for x in (float("nan"), -1.0, 0.0, 61.0, 7322.0)] == ["?", "?", "0s", "1m01s", "2h02m"]
    assert value(spark, rules.duration, 59.9) == "59s"
    assert [value(spark, rules.retry_delay, a, b) for a, b in (("2", None), ("9", None), ("1", "7"), ("1", "Mon"))] == [4.0, 60.0, 7.0, 2.0]


def test_unicode(spark):
    assert value(spark, strip_ws, " 　a b\t") == "a b"
    assert value(spark, nfc, "é") == "é" and value(spark, casefold, "ẞa") == "ssa"
    assert value(spark, nfc_fold, " STRASSE ") == value(spark, nfc_fold, "straße")
    assert value(spark, rules.strip_arabic_marks, "مَسُوس") == "مسوس"
    assert [value(spark, rules.strip_article, t) for t in ("الكساب", "الا")] == ["كساب", "الا"]


def test_hash_tells_nulls_apart(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None), (None, "a", "b"), ("a", "", "b"), ("ab", "", "")], "x string, y string, z string")
    assert df.select(key64(F.col("x"), F.col("y"), F.col("z")).alias("h")).distinct().count() == 5


def test_unicode_functions_agree_with_python(spark):
    import random
    import unicodedata

    from gradelex.functions import text

    r = random.Random(1)
    pool = [chr(c) for c in range(1, 0x3000) if unicodedata.category(chr(c)) != "Cn"] + list("ßẞİıſﬁ가각Å①²")
    words = ["".join(r.choice(pool) for _ in range(r.randrange(6))) for _ in range(3000)] + ["", "Straße", "abc"]
    df = spark.createDataFrame([(w,) for w in words] + [(None,)], "x string")
    rows = df.select("x", text.nfc("x").alias("a"), text.casefold("x").alias("b"), text.nfkd_plain("x").alias("c"), text.nfc_fold("x").alias("d"), text.word_key("x").alias("e")).collect()
    for x, *got in rows:
        if x is None:
            assert got == [None] * 5
            continue
        plain = "".join(c for c in unicodedata.normalize("NFKD", x) if not unicodedata.combining(c))
        folded = unicodedata.normalize("NFC", unicodedata.normalize("NFD", x.strip()).casefold())
        assert got == [unicodedata.normalize("NFC", x), x.casefold(), plain, folded, unicodedata.normalize("NFC", x.strip()).casefold()], ascii(x)


class Letters:
    """An encoding whose tokens are letters."""

    def encode_ordinary(self, text):
        return list(text)


def test_token_count(spark):
    from gradelex.functions import rules

    df = spark.createDataFrame([("abcd efgh",), ("",), (None,)], "x string")
    got = df.select(rules.token_count(df.x).alias("a"), rules.token_count(df.x, Letters).alias("b")).collect()
    assert [tuple(r) for r in got] == [(3, 9), (1, 0), (None, None)]
