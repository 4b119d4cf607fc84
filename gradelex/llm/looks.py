"""Visually identical text with different characters: a vectorised normaliser over code-point arrays."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradelex.llm.groups import group_rows

#: Letters that look like a Latin letter; fixed values. Each pair of strings maps position by position.
LATIN_LOOKS = (
    ("АВЕЅІЈКМНОРСТУХҮԚԜ", "ABESIJKMHOPCTYXYQW"),  # Cyrillic capitals
    ("аеорсухѕіјһԛԝӏ", "aeopcyxsijhqwl"),  # Cyrillic small letters
    ("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "ABEZHIKMNOPTYX"),  # Greek capitals
    ("οϲϳν", "ocjv"),  # Greek small letters
    ("ՕՍՏցհոսօ", "OUSghnuo"),  # Armenian
    ("ɡɑ", "ga"),  # Latin doubles
    ("‐‑‒−﹣", "-----"),  # hyphens and minus
    ("’‘ʼʹ′", "'''''"),  # apostrophes
)
#: Arabic letters and digits of other alphabets with the same look
ARABIC_LOOKS = (("کڪہھە", "ككههه"), ("۰۱۲۳۷۸۹", "٠١٢٣٧٨٩"))
#: CJK radicals that look like an ideograph but have no compatibility mapping
RADICALS = (
    "⺀⺈⺉⺊⺌⺍⺛⺝⺟⺠⺩⺪⺭⺮⺰⺱⺳⺶⺷⺸⺻⺼⺾⺿⻀⻁⻂⻄⻅⻆⻈⻉⻋⻌⻍⻎⻏⻐⻒⻓⻔⻖⻗⻘⻙⻚⻛⻜⻝⻟⻠⻢⻣⻤⻥⻦⻧⻨⻩⻪⻫⻬⻭⻮⻯⻰⻱⻲",
    "冫𠂊刂卜小小旡月母民王疋礻竹纟罒罒羊羊羊聿月艹艹艹虎衤西见角讠贝车辶辶辶邑钅长长门阝雨青韦页风飞食食饣马骨鬼鱼鸟卤麦黄黾斉齐歯齿竜龙龟亀",
)
VISIBLE_SPACE = (0x0009, 0x000A, 0x000B, 0x000C, 0x000D, 0x0085, 0x2028, 0x2029)
BLANK_LETTERS = (0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x180B, 0x180C, 0x180D, 0x180F, 0x3164, 0xFFA0)
FARSI_YEH, YEH, MAKSURA, HAMZA_ABOVE = 0x06CC, 0x064A, 0x0649, 0x0654
SIZE = 0x110000
KEPT_FORMS = ("<wide>", "<narrow>", "<noBreak>", "<initial>", "<medial>", "<final>", "<isolated>")


#: alphabets whose letters may look like a Latin one, by the first word of their letters' names
ALPHABETS = ("ARMENIAN", "CHEROKEE", "COPTIC", "CYRILLIC", "GREEK", "LISU", "MATHEMATICAL")
TARGETS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyzß"


def confusables(spark: SparkSession) -> dict[str, str]:
    """Letters of ALPHABETS with the Latin letter of the same case that they look like, from the Unicode confusables data that Spark's ICU
    library carries. An error where a session has no such library or it fails: without these letters rows that look the same would count as different."""
    letters = [chr(c) for c in range(0x370, 0x1F000) if unicodedata.name(chr(c), "").split(" ")[0] in ALPHABETS and unicodedata.category(chr(c)) in ("Lu", "Ll", "Lo", "Lt")]
    try:
        icu = spark._jvm.com.ibm.icu.text
        checker = getattr(icu, "SpoofChecker$Builder")().build()
        shapes = checker.getSkeleton("\n".join([*TARGETS, *letters])).split("\n")
    except Exception as e:  # another JVM, or none
        raise RuntimeError("look-alikes need the Unicode confusables data of the ICU library in Spark's JVM, which this session does not give") from e
    if len(shapes) != len(TARGETS) + len(letters):
        raise RuntimeError(f"the ICU library gave {len(shapes)} skeletons for {len(TARGETS) + len(letters)} letters")
    upper = {s: t for s, t in zip(shapes, TARGETS, strict=False) if t.isupper()}
    lower = {s: t for s, t in zip(shapes, TARGETS, strict=False) if t.islower()}
    out = {}
    for c, s in zip(letters, shapes[len(TARGETS) :], strict=True):
        to = lower.get(s) if unicodedata.category(c) == "Ll" else upper.get(s) if unicodedata.category(c) in ("Lu", "Lt") else (upper.get(s) or lower.get(s))
        if to:
            out[c] = to
    return out


def _whole_forms(c: int) -> bool:
    """Compatibility characters that look like what they stand for: radicals, ligatures, digraph letters, Roman numerals."""
    return 0x2E80 <= c <= 0x2FD5 or 0xFB00 <= c <= 0xFB4F or 0x0132 <= c <= 0x0133 or 0x01C4 <= c <= 0x01CC or 0x01F1 <= c <= 0x01F3 or 0x2160 <= c <= 0x217F


class Tables:
    """Lookup tables over all code points, built from the Unicode data by rule."""

    def __init__(self, more: tuple[tuple[str, str], ...] = ()) -> None:
        looks = dict(more) | dict(zip(*RADICALS, strict=True))
        for a, b in (*LATIN_LOOKS, *ARABIC_LOOKS):
            looks |= dict(zip(a, b, strict=True))
        single = np.arange(SIZE, dtype=np.uint32)
        length = np.ones(SIZE, np.int8)
        ccc = np.zeros(SIZE, np.uint8)
        many: dict[int, list[int]] = {}
        pairs: dict[int, int] = {}

        def parts(c: int) -> list[int]:
            d = unicodedata.decomposition(chr(c))
            if d:
                form, _, rest = d.rpartition("> ") if d[0] == "<" else ("", "", d)
                if not form or form + ">" in KEPT_FORMS or _whole_forms(c):
                    return [p for x in rest.split() for p in parts(int(x, 16))]
            return [ord(looks.get(chr(c), chr(c)))]

        # ideographs and Hangul syllables have neither mappings nor marks
        for c in (*range(0x3400), *range(0xA000, 0xAC00), *range(0xD7B0, 0xD800), *range(0xE000, 0x20000), *range(0x2F800, 0x2FA20), *range(0xE0000, 0xE0200)):
            ch = chr(c)
            kind = unicodedata.category(ch)
            ccc[c] = unicodedata.combining(ch)
            if c in VISIBLE_SPACE or kind == "Zs":
                single[c] = 32
            elif kind in ("Cf", "Cc") or c in BLANK_LETTERS or 0xFE00 <= c <= 0xFE0F or 0xE0100 <= c <= 0xE01EF:
                length[c] = 0
            else:
                to = parts(c)
                if len(to) == 1:
                    single[c] = to[0]
                else:
                    many[c], length[c] = to, len(to)
            d = unicodedata.decomposition(ch)
            if d and d[0] != "<" and " " in d and unicodedata.normalize("NFC", ch) == ch:
                a, b = (int(x, 16) for x in d.split())
                pairs[(a << 21) | b] = c
        # Hangul syllables are not in the data but follow from their letters' numbers: 19 first, 21 middle and 27 last letters
        for i in range(19 * 21):
            syllable = 0xAC00 + 28 * i
            pairs[(0x1100 + i // 21) << 21 | (0x1161 + i % 21)] = syllable
            pairs |= {syllable << 21 | (0x11A7 + k): syllable + k for k in range(1, 28)}
        self.single, self.length, self.ccc = single, length, ccc
        self.start = np.zeros(SIZE, np.int32)
        flat: list[int] = []
        for c, to in many.items():
            self.start[c] = len(flat)
            flat += to
        self.flat = np.array(flat, np.uint32)
        self.pair = np.array(sorted(pairs), np.int64)
        self.whole = np.array([pairs[k] for k in sorted(pairs)], np.uint32)
        self.second = np.zeros(SIZE, bool)  # can join the letter before it
        self.second[np.unique(self.pair & 0x1FFFFF)] = True
        self.second |= ccc > 0
        self.joining = np.zeros(SIZE, bool)
        for c in (*range(0x0620, 0x064B), *range(0x066E, 0x0700), *range(0x0750, 0x0780)):
            self.joining[c] = unicodedata.category(chr(c)) == "Lo"


@lru_cache(2)
def tables(more: tuple[tuple[str, str], ...] = ()) -> Tables:
    return Tables(more)


def _compose(cp: np.ndarray, row: np.ndarray, t: Tables) -> tuple[np.ndarray, np.ndarray]:
    """Orders marks by class and joins them to their letters, for all rows at once.

    Each step tries one mark of every letter that still has some. A mark that does not join hides the others of its class, so the
    next step goes on with the next class: a letter takes as many steps as it has classes of marks and marks that join it (a
    few dozen at most), however many marks follow it."""
    n = len(cp)
    if not n:
        return cp, row
    new_row = np.ones(n, bool)
    new_row[1:] = row[1:] != row[:-1]
    marks = np.flatnonzero(t.ccc[cp])
    if len(marks):
        runs = np.cumsum((t.ccc[cp] == 0) | new_row)[marks]
        cp = cp.copy()
        cp[marks] = cp[marks][np.lexsort((t.ccc[cp[marks]], runs))]
    heads = ~t.second[cp] | new_row
    base_at = np.flatnonzero(heads)
    ends = np.append(base_at[1:], n)
    active = np.flatnonzero(ends - base_at > 1)
    if not len(active):
        return cp, row
    cp = cp.copy()
    ccc = t.ccc[cp].astype(np.int16)
    # where the next class begins after each place
    fresh = heads | (ccc == 0)
    fresh[1:] |= ccc[1:] != ccc[:-1]
    begins = np.append(np.flatnonzero(fresh), n)
    after = begins[np.cumsum(fresh)]
    gone = np.zeros(n, bool)
    held = np.zeros(len(base_at), np.int16)  # class of the last mark that stays
    at = base_at + 1
    while len(active):
        here = at[active]
        base, mark, cc = cp[base_at[active]].astype(np.int64), cp[here].astype(np.int64), ccc[here]
        key = (base << 21) | mark
        pos = np.minimum(np.searchsorted(t.pair, key), len(t.pair) - 1)
        joins = (t.pair[pos] == key) & ((held[active] == 0) | (held[active] < cc))
        cp[base_at[active[joins]]] = t.whole[pos[joins]]
        gone[here[joins]] = True
        held[active[~joins]] = np.maximum(held[active[~joins]], cc[~joins])
        at[active] = np.where(joins, here + 1, after[here])
        # nothing joins across a letter that stays
        active = active[(joins | (cc > 0)) & (at[active] < ends[active])]
    return cp[~gone], row[~gone]


def same_look(values: pa.Array, more: tuple[tuple[str, str], ...] = ()) -> pa.Array:
    """The texts with one form for everything that looks the same; null stays null.

    All rows are handled as one code-point array: blanks become U+0020, invisible characters and outer blanks are
    dropped, wide, narrow, presentation and compatibility letters and look-alikes of other scripts are replaced
    by table lookups, one-to-many ones by expansion offsets, and marks are ordered and composed. Letter case,
    accents, Arabic dots and hamza stay. Farsi yeh has dots only where the next letter joins it. more: further pairs of a letter
    and the one it looks like, as confusables() gives them.
    """
    t = tables(more)
    values = values.cast(pa.large_string())
    n = len(values)
    filled = values.fill_null("")
    offsets = np.frombuffer(filled.buffers()[1], np.int64, n + 1, filled.offset * 8)
    data = filled.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and n else np.zeros(0, np.uint8)
    cp = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    heads = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    counts = np.diff(heads[offsets - offsets[0]])
    row = np.repeat(np.arange(n), counts)
    # expansion: as many slots per character as its table entry has
    size = t.length[cp]
    to = np.repeat(np.arange(len(cp)), size)
    within = np.arange(len(to)) - np.repeat(np.cumsum(size) - size, size)
    src, row = cp[to], row[to]
    cp = np.where(size[to] == 1, t.single[src], t.flat[np.minimum(t.start[src] + within, len(t.flat) - 1)])
    yeh = np.flatnonzero(cp == FARSI_YEH)
    if len(yeh):
        following = np.append(cp[1:], 0)[yeh]
        same_row = np.append(row[1:], -1)[yeh] == row[yeh]
        cp[yeh] = np.where(same_row & (t.joining[following] | (following == HAMZA_ABOVE)), YEH, MAKSURA)
    cp, row = _compose(cp, row, t)
    # outer blanks: those before the first and after the last visible character of a row
    seen = np.flatnonzero(cp != 32)
    first, last = np.full(n, len(cp)), np.full(n, -1)
    first[row[seen[::-1]]] = seen[::-1]
    last[row[seen]] = seen
    at = np.arange(len(cp))
    keep = (at >= first[row]) & (at <= last[row])
    cp, row = cp[keep], row[keep]
    size = 1 + (cp >= 0x80).astype(np.int64) + (cp >= 0x800) + (cp >= 0x10000)
    ends = np.concatenate([[0], np.cumsum(np.bincount(row, weights=size, minlength=n)).astype(np.int64)]) if n else np.zeros(1, np.int64)
    out = np.ascontiguousarray(cp, np.uint32).tobytes().decode("utf-32-le").encode("utf-8")
    valid = None if values.null_count == 0 else pa.array(np.asarray(values.is_valid())).buffers()[1]
    return pa.Array.from_buffers(pa.large_string(), n, [valid, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(out)])


def normalise_looks(df: DataFrame, columns: list[str]) -> DataFrame:
    """df with each of the columns replaced by its same_look form; other columns stay as they are."""
    names, schema = df.columns, df.schema
    at = [names.index(c) for c in columns]
    more = tuple(sorted(confusables(df.sparkSession).items()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = list(b.columns)
            for i in at:
                cols[i] = same_look(cols[i], more).cast(pa.string())
            yield pa.RecordBatch.from_arrays(cols, names=b.schema.names)

    return df.mapInArrow(run, schema)


def look_alikes(df: DataFrame, id_col: str, texts: list[str], exact: list[str]) -> DataFrame:
    """(id_col, first_id, n_rows) for each row: the smallest id of the rows that look the same in all texts
    and are equal in the exact columns, and how many those are. Null only equals null; repeated rows count each.
    Rows are grouped by a 128-bit hash of the normalised values with a map-side combine, and the values under one hash verified.
    """
    slim = df.select(F.col(id_col).alias("id"), *[F.col(c).cast("string").alias(f"v{i}") for i, c in enumerate([*texts, *exact])])
    v = slim.columns[1:]
    parts = [p for c in v for p in (F.col(c).isNull(), F.col(c))]
    shown = normalise_looks(slim, v[: len(texts)]).withColumn("f1", F.xxhash64(F.lit(1), *parts)).withColumn("f2", F.xxhash64(F.lit(2), *parts))
    return group_rows(shown, v, lambda x, y: x.eqNullSafe(y)).select(F.col("id").alias(id_col), "first_id", F.col("n").alias("n_rows"))
