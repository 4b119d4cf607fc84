"""Text expressions, all inside the JVM."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

LEVELS = ("A1", "A2", "B1", "B2", "C1")
UPOS = ("ADJ", "ADP", "ADV", "AUX", "CCONJ", "DET", "INTJ", "NOUN", "NUM", "PART", "PRON", "PROPN", "PUNCT", "SCONJ", "SYM", "VERB", "X")


def strip_ws(c: Column) -> Column:
    """Removes Unicode white space and separator controls at both ends (trim() removes U+0020 only)."""
    return F.regexp_replace(c, r"(?U)^[\s\x1C-\x1F]+|[\s\x1C-\x1F]+\z", "")


def level_index(c: Column) -> Column:
    """1 for A1 to 5 for C1; null for anything else."""
    return F.when(c.isin(*LEVELS), F.array_position(F.array(*[F.lit(x) for x in LEVELS]), c).cast("int"))


def key64(*cols: Column, seed: int = 0) -> Column:
    """64-bit hash in which null differs from every value and columns do not run together."""
    parts = [F.lit(seed)]
    for c in cols:
        parts += [c.isNull(), c]
    return F.xxhash64(*parts)


def char_class(keep: Callable[[str], bool]) -> str:
    """A Java character class of the characters below U+20000 that keep() wants, as ranges."""
    ranges: list[list[int]] = []
    for c in range(0x80, 0x20000):
        if not 0xD800 <= c < 0xE000 and keep(chr(c)):
            if ranges and ranges[-1][1] == c - 1:
                ranges[-1][1] = c
            else:
                ranges.append([c, c])
    return "[" + "".join(f"\\x{{{a:X}}}" if a == b else f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in ranges) + "]"


#: characters that a decomposition leaves beside their letters
MARKS = char_class(lambda c: unicodedata.combining(c) > 0)
#: digits of any script, also raised, lowered and circled ones
DIGITS = "[0-9]|" + char_class(str.isdigit)
_ASCII = r"\A\p{ASCII}*\z"


def _icu(method: str, c: Column, flag: bool) -> Column:
    """A static method of Spark's own ICU library on a text that is not null: no row leaves the JVM."""
    return F.reflect(F.lit("com.ibm.icu." + method.rpartition(".")[0]), F.lit(method.rpartition(".")[2]), c, F.lit(flag))


def _unless_ascii(c: Column | str, plain: Callable[[Column], Column], other: Callable[[Column], Column]) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.rlike(_ASCII), plain(c)).when(c.isNotNull(), other(c))


def nfc(c: Column | str) -> Column:
    """Canonical composition (NFC)."""
    return _unless_ascii(c, lambda x: x, lambda x: _icu("text.Normalizer.compose", x, False))


def nfkd_plain(c: Column | str) -> Column:
    """NFKD without combining marks."""
    return _unless_ascii(c, lambda x: x, lambda x: F.regexp_replace(_icu("text.Normalizer.decompose", x, True), MARKS, ""))


def casefold(c: Column | str) -> Column:
    """Full case folding: ß and ẞ become ss."""
    return _unless_ascii(c, F.lower, lambda x: _icu("lang.UCharacter.foldCase", x, True))


def nfc_fold(c: Column | str) -> Column:
    """Outer white space, letter case and canonically equivalent spellings removed."""
    folded = lambda x: _icu("text.Normalizer.compose", _icu("lang.UCharacter.foldCase", _icu("text.Normalizer.decompose", x, False), True), False)
    return _unless_ascii(strip_ws(F.col(c) if isinstance(c, str) else c), F.lower, folded)


def word_key(c: Column | str) -> Column:
    """What lemmas are compared by in reviews: trimmed, composed, case folded."""
    return casefold(nfc(strip_ws(F.col(c) if isinstance(c, str) else c)))
