"""Row-level rules of vocabulary lists as column expressions."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import Any

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from gradelex.functions.text import UPOS, nfkd_plain, strip_ws

# fixed values of the data contract
GLOSS_ASCII = r"\A[A-Za-z '.-]+\z"
ARABIC = r"[؀-ۿݐ-ݿࢠ-ࣿ]"
HAN = r"[一-鿿㐀-䶿]"
HAN_WIDE = r"[㐀-䶿一-鿿豈-﫿]"
JUNK_LEMMAS = ("词", "复合词", "名词", "动词", "形容词", "副词", "介词", "代词", "连词", "感叹词", "X")
FUNCTION_PREFIXES = ("to ", "the ", "a ", "an ", "of ", "in ", "at ", "on ", "by ", "for ", "with ", "from ", "his ", "her ", "their ", "our ", "my ", "your ", "its ")
PLACEHOLDERS = ("Word_", "svord_", "word_")
#: of these, those that a delivery leaves out
DELIVERY_PLACEHOLDERS = ("Word_", "svord_")
SPECIAL = r"""[?!@#$%^&*()_=+\[\]{};:"\\|<>~`]"""
DIGIT_LEMMA = r"(?i)\A([0-9]|[0-9]+e|[0-9]+de|[0-9]+ste|[0-9]+g|co2|3d|.*打印)\z"
TARGETS = {"A1": 600, "A2": 600, "B1": 1000, "B2": 2000, "C1": 4000}
COARSE = {"VERB": "V", "AUX": "V", "NOUN": "N", "PROPN": "N", "ADJ": "ADJ", "ADV": "ADV"}
FORBIDDEN_UPOS = ("PROPN", "PUNCT", "SYM", "X")
COVERAGE = 0.60


def unquote(c: Column) -> Column:
    """Without outer white space and one pair of enclosing quotes, whose doubled quotes become single."""
    s = strip_ws(c)
    inner = F.replace(F.substring(s, F.lit(2), F.greatest(F.length(s) - 2, F.lit(0))), F.lit('""'), F.lit('"'))
    return F.when(s.startswith('"') & s.endswith('"'), inner).otherwise(s)


def clean_lemma(c: Column) -> Column:
    return strip_ws(F.translate(F.replace(c, F.lit('"'), F.lit("")), "\t\r", "  "))


def norm_gloss(c: Column) -> Column:
    """Lower case, without one leading "to " and outer blanks (U+0020 only), in this order."""
    return F.trim(F.regexp_replace(F.lower(c), r"\Ato ", ""))


def norm_pivot(c: Column) -> Column:
    return strip_ws(F.replace(c, F.lit(" "), F.lit("")))


def clean_gloss(c: Column) -> Column:
    """Accents folded, brackets and slashes as blanks, white space runs as one blank."""
    return strip_ws(F.regexp_replace(F.regexp_replace(nfkd_plain(c), r"[()/]", " "), r"(?U)\s+", " "))


def ascii_gloss(c: Column) -> Column:
    return c.rlike(GLOSS_ASCII)


def word_count(c: Column) -> Column:
    return F.size(F.filter(F.split(c, r"(?U)\s+"), lambda w: w != "")).cast("bigint")


def digits_allowed(lemma: Column) -> Column:
    return lemma.rlike(DIGIT_LEMMA)


def coarse_pos(pos: Column) -> Column:
    return reduce(lambda acc, kv: acc.when(pos == kv[0], kv[1]), COARSE.items(), F.when(F.lit(False), "")).otherwise(pos)


def gloss_pos(gloss: Column) -> Column:
    """Tag suggested by a gloss: VERB after "to ", ADJ for a suffix written with its hyphen, else blank."""
    g = F.lower(strip_ws(gloss))
    suffix = g.endswith("-ed") | g.endswith("-ing") | g.endswith("-ous") | g.endswith("-ish")
    return F.when(g.startswith("to "), "VERB").when(suffix, "ADJ").otherwise("")


def token_estimate(text: Column) -> Column:
    return F.when(text.isNotNull(), F.greatest(F.lit(1), F.ceil(F.octet_length(text) / 4))).cast("bigint")


def token_count(text: Column, encoding: Callable[[], Any] | None = None) -> Column:
    """Tokens of a text: those of an encoding, which a function that runs on the executors makes once (an object with encode_ordinary, as
    tiktoken's), or the estimate where there is none. Null texts have none."""
    if encoding is None:
        return token_estimate(text)
    made: list[Any] = []

    def count(texts: pd.Series) -> pd.Series:
        if not made:
            made.append(encoding())
        return pd.Series([None if t is None else len(made[0].encode_ordinary(t)) for t in texts], dtype="Int64")

    return F.pandas_udf(count, LongType())(text)


def duration(seconds: Column) -> Column:
    """h/m/s form of a number of seconds; ? for null, negative and NaN."""
    s = F.floor(seconds).cast("bigint")
    h, m, r = F.floor(s / 3600), F.floor(F.pmod(s, F.lit(3600)) / 60), F.pmod(s, F.lit(60))
    return (
        F.when(seconds.isNull() | F.isnan(seconds) | (seconds < 0), "?")
        .when(h > 0, F.concat(h.cast("string"), F.lit("h"), F.lpad(m.cast("string"), 2, "0"), F.lit("m")))
        .when(m > 0, F.concat(m.cast("string"), F.lit("m"), F.lpad(r.cast("string"), 2, "0"), F.lit("s")))
        .otherwise(F.concat(r.cast("string"), F.lit("s")))
    )


def clip(text: Column, length: int, mark: str = "…") -> Column:
    return F.when(F.length(text) > length, F.concat(F.substring(text, 1, length), F.lit(mark))).otherwise(text)


def concept_key(gloss: Column, pos: Column) -> Column:
    blank_as = lambda c, v: F.coalesce(F.nullif(c, F.lit("")), F.lit(v))
    return F.concat_ws("-", blank_as(norm_gloss(gloss), "blank"), blank_as(pos, "X"))


def fingerprint(*parts: Column) -> Column:
    """Parts joined by U+001F; apply nfc() to parts that may not be composed."""
    return F.concat_ws("\u001f", *parts)


def strip_arabic_marks(c: Column) -> Column:
    return F.regexp_replace(c, r"[ً-ٰٟ]", "")


def strip_article(c: Column) -> Column:
    return F.when(c.startswith("ال") & (F.length(c) > 3), F.substring(c, F.lit(3), F.length(c))).otherwise(c)


def placeholder(lemma: Column, marks: tuple[str, ...] = PLACEHOLDERS) -> Column:
    return reduce(lambda a, b: a | b, [lemma.startswith(p) for p in marks])


def latin_pivot(lang: Column, chinese: Column) -> Column:
    return (lang != "zh") & chinese.rlike("[A-Za-z]") & ~chinese.rlike(r"[一-鿿]")


def known_upos(pos: Column) -> Column:
    return pos.isin(*UPOS)


def text_problem(c: Column) -> Column:
    """Why a text field is not acceptable, or null: empty, or a line break or tab inside."""
    return F.when(c.isNull() | (strip_ws(c) == ""), "empty").when(c.rlike(r"[\n\r\t]"), "control")


def last_json(text: Column) -> Column:
    """The last fenced, braced or bracketed block of a model's answer, or null."""
    fenced = F.try_element_at(F.regexp_extract_all(text, F.lit(r"(?s)```(?:json)?\s*(.*?)```"), 1), F.lit(-1))
    bare = F.try_element_at(F.regexp_extract_all(text, F.lit(r"(\{[^{}]*\}|\[[^\[\]]*\])"), 1), F.lit(-1))
    return F.coalesce(F.when(text.contains("```"), strip_ws(fenced)), bare)


def strip_thoughts(text: Column) -> Column:
    """Without thought blocks, and without a code fence around the whole."""
    shown = strip_ws(F.regexp_replace(text, r"(?is)<think>.*?</think>", ""))
    return F.regexp_replace(shown, r"(?s)\A```\w*\s*(.*?)\s*```\z", "$1")


def redact(text: Column, secret: str, length: int = 4000) -> Column:
    return F.substring(F.replace(text, F.lit(secret), F.lit("[redacted]")), 1, length)


def retry_delay(attempt: Column, retry_after: Column, most: float = 60.0, now: Column | None = None, jitter: Column | None = None) -> Column:
    """Seconds to wait: the server's Retry-After, a number of seconds or an HTTP date after now, else two to the attempt and some jitter
    (none by default), at most `most`."""
    date = F.try_to_timestamp(F.regexp_replace(retry_after, r"\A\w+, ", ""), F.lit("dd MMM yyyy HH:mm:ss zzz"))
    ahead = (F.unix_timestamp(date) - F.unix_timestamp(now if now is not None else F.current_timestamp())).cast("double")
    told = F.coalesce(retry_after.try_cast("double"), F.when(ahead < 0, 0.0).otherwise(ahead))
    return F.coalesce(told, F.least(F.lit(most), F.pow(F.lit(2.0), attempt) + (F.lit(0.0) if jitter is None else jitter)))
