"""Missing or wrong language labels: error-correcting output codes over hashed n-grams, sentence by sentence."""

from __future__ import annotations

import pickle
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 1 << 17
CHUNK = 400_000
#: bound of the training sample: labelled documents of each language and their length
SAMPLE_DOCS, SAMPLE_CHARS = 400, 2000
#: languages a profile table may list
MOST_LANGUAGES = 1000
#: ISO 639-2 and 639-3 codes of the languages the profile table may name: fixed values
ISO_CODES = {
    "eng": "en", "deu": "de", "ger": "de", "fra": "fr", "fre": "fr", "spa": "es", "nld": "nl", "dut": "nl", "swe": "sv", "ara": "ar", "zho": "zh", "chi": "zh", "cmn": "zh",
    "ita": "it", "por": "pt", "dan": "da", "nor": "no", "fin": "fi", "rus": "ru", "pol": "pl", "jpn": "ja", "kor": "ko", "tur": "tr",
}
QUOTED = re.compile("[“„”«\"][^“„”«»\"\n]*[“”»\"]")
ENDS = ".!?。！？؟۔"


@dataclass
class Model:
    codes: list[str]
    words: np.ndarray  # codeword of each language, -1 and 1
    weights: np.ndarray  # bucket x bit
    bias: np.ndarray
    trust: np.ndarray  # weight of each bit in decoding


def codewords(n: int) -> np.ndarray:
    """n rows of a simplex code: any two differ in just over half of their bits."""
    k = max(3, int(np.ceil(np.log2(max(n, 2)))) + 1)
    masks = np.arange(1, 1 << k)
    rows = np.arange(1, n + 1)[:, None] & masks[None, :]
    ones = sum((rows >> i) & 1 for i in range(k))
    return np.where(ones % 2 == 1, 1, -1).astype(np.float32)


@lru_cache(1)
def _letters() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of every code point: whether it is a letter or mark, its lower and upper case, and how much it counts (an ideograph as three)."""
    is_letter = np.zeros(0x110000, bool)
    lower, upper = np.arange(0x110000, dtype=np.uint32), np.arange(0x110000, dtype=np.uint32)
    size = np.ones(0x110000, np.int8)
    for c in range(0x1E944):
        ch = chr(c)
        is_letter[c] = unicodedata.category(ch)[0] in "LM"
        for table, other in ((lower, ch.lower()), (upper, ch.upper())):
            if len(other) == 1:
                table[c] = ord(other)
    is_letter[0x20000:0x32000] = True
    size[0x3400:0xA000] = 3
    size[0x20000:0x32000] = 3
    return is_letter, lower, upper, size


@dataclass
class Sentences:
    doc: np.ndarray  # index of the text
    start: np.ndarray  # code points from the start of the text
    end: np.ndarray
    whole: np.ndarray  # closed by a full stop or its like
    size: np.ndarray  # letters outside quotes
    grams: np.ndarray  # bucket of each n-gram
    head: np.ndarray  # first n-gram of each sentence
    count: np.ndarray


def sentences(texts: list[str]) -> Sentences:
    """Sentences with letters outside quotes, of all texts at once. A sentence ends after . ! ? or the like, unless
    digits stand on both sides, and at a line break; only one closed by such a mark is whole."""
    is_letter, lower, upper, size = _letters()
    joined = "\n".join(texts) + "\n"
    cp = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    n = len(cp)
    lengths = np.array([len(t) for t in texts], np.int64)
    begin = np.cumsum(lengths + 1) - lengths - 1
    doc = np.repeat(np.arange(len(texts)), lengths + 1)
    hidden = np.zeros(n + 1, np.int32)
    for m in QUOTED.finditer(joined):
        hidden[m.start()] += 1
        hidden[m.end()] -= 1
    open_ = np.cumsum(hidden[:-1]) == 0
    digit = (cp >= 48) & (cp <= 57)
    inner = np.concatenate([[False], digit[:-1]]) & np.append(digit[1:], False)
    mark = np.isin(cp, [ord(c) for c in ENDS]) & ~inner & open_
    breaks = np.flatnonzero((cp == 10) | (cp == 13))
    seen = np.flatnonzero(~np.isin(cp, (9, 10, 13, 32)))
    after = np.append(seen, n - 1)[np.searchsorted(seen, breaks)]
    # CR LF before a small letter or a blank is a break inside a sentence
    blank_next = np.append(cp, [10, 10])[breaks + 1 + (cp[breaks] == 13)] == 32
    small_next = is_letter[cp[after]] & (upper[cp[after]] != cp[after]) & (doc[after] == doc[breaks])
    inside = (small_next | blank_next) & ((cp[breaks] == 13) | (cp[np.maximum(breaks - 1, 0)] == 13))
    stop = mark.copy()
    stop[breaks[~inside]] = True
    sent = np.cumsum(stop) - stop
    letter = is_letter[cp] & open_
    text = np.where(letter, lower[cp], 32).astype(np.uint64)
    # n-grams that end at a letter or just after a word; those never span two sentences as marks become blanks
    blank = np.full(2, 32, np.uint64)
    p1, p2 = np.concatenate([blank[:1], text[:-1]]), np.concatenate([blank, text[:-2]])[: len(text)]
    edge = ~letter & np.concatenate([[False], letter[:-1]])
    use = np.flatnonzero(letter | edge)
    word = np.cumsum(~letter)
    mult = np.uint64(0x9E3779B97F4A7C15)
    a, b, c = text[use], p1[use], p2[use]
    mix = lambda x, salt: ((x + np.uint64(salt)) * mult) >> np.uint64(47)
    uni, bi, tri = mix(a, 1 << 60), mix(a | (b << np.uint64(21)), 2 << 60), mix(a | (b << np.uint64(21)) | (c << np.uint64(42)), 0)
    # whole words: the sum of letter hashes weighted by place
    at = np.arange(n) - np.maximum.accumulate(np.where(~letter, np.arange(n), -1))
    part = np.where(letter, (text + np.uint64(7)) * (mult ^ (at.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F) | np.uint64(1))), np.uint64(0))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(part, dtype=np.uint64)])
    first_of_word = np.searchsorted(word, word[np.maximum(use - 1, 0)], side="left")
    whole_word = mix(sums[use] - sums[first_of_word], 3 << 60)
    grams = np.stack([uni, bi, tri, np.where(edge[use], whole_word, uni)], 1).astype(np.int32)
    # an edge belongs to the sentence of the letter before it
    of = np.where(edge[use], sent[np.maximum(use - 1, 0)], sent[use])
    heads = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]])) if len(of) else np.zeros(0, np.int64)
    ids = of[heads]
    stops = np.flatnonzero(stop)
    ends = stops[ids]
    starts = np.where(ids > 0, stops[np.maximum(ids - 1, 0)] + 1, 0)
    weight = np.bincount(sent, weights=size[cp] * letter, minlength=len(stops))[ids]
    d = doc[ends]
    return Sentences(d, starts - begin[d], ends - begin[d] + mark[ends], mark[ends], weight, grams.ravel(), heads * 4, np.diff(np.append(heads, len(of))) * 4)


def joined(texts: list[str]) -> Sentences:
    """sentences() of many texts, made chunk by chunk so that only their n-grams stay in memory."""
    parts, at, docs, grams = [], 0, 0, 0
    while at < len(texts):
        to, room = at, CHUNK
        while to < len(texts) and (to == at or room >= len(texts[to])):
            room -= len(texts[to])
            to += 1
        s = sentences(texts[at:to])
        s.doc, s.head = s.doc + docs, s.head + grams
        docs, grams, at = docs + to - at, grams + len(s.grams), to
        parts.append(s)
    return Sentences(*[np.concatenate([getattr(p, f) for p in parts]) for f in ("doc", "start", "end", "whole", "size", "grams", "head", "count")])


def _scores(s: Sentences, weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
    if not len(s.head):
        return np.zeros((0, len(bias)), np.float32)
    # block by block of sentences, so that the gathered weights stay small
    total = []
    for at in range(0, len(s.head), 4096):
        head, count = s.head[at : at + 4096], s.count[at : at + 4096]
        first, last = head[0], head[-1] + count[-1]
        if last - first == count.sum():
            total.append(np.add.reduceat(weights[s.grams[first:last]], head - first, axis=0))
        else:
            grams = s.grams[np.repeat(head - np.cumsum(count) + count, count) + np.arange(count.sum())]
            total.append(np.add.reduceat(weights[grams], np.cumsum(count) - count, axis=0))
    return np.concatenate(total) / np.sqrt(s.count)[:, None] + bias


def decode(scores: np.ndarray, m: Model) -> tuple[np.ndarray, np.ndarray]:
    """(language of the nearest codeword by weighted logistic loss, confidence of every language)."""
    loss = np.stack([(np.logaddexp(0, -scores * w) * m.trust).sum(1) for w in m.words], 1)
    p = np.exp(loss.min(1, keepdims=True) - loss)
    return loss.argmin(1), p / p.sum(1, keepdims=True)


def _fit(s: Sentences, label: np.ndarray, codes: list[str], epochs: int, rate: float = 0.5) -> Model:
    """One logistic classifier per bit of the codewords, by Adagrad over blocks of sentences in a fixed order."""
    words = codewords(len(codes))
    bits = words.shape[1]
    w, g2 = np.zeros((BUCKETS, bits), np.float32), np.full((BUCKETS, bits), 1e-3, np.float32)
    bias, b2 = np.zeros(bits, np.float32), np.full(bits, 1e-3, np.float32)
    order = np.random.default_rng(11).permutation(len(label))
    target = (words[label] + 1) / 2
    for _ in range(epochs):
        for block in np.array_split(order, max(1, len(order) // 500)):
            count = s.count[block]
            rows = np.repeat(np.arange(len(block)), count)
            grams = s.grams[np.repeat(s.head[block] - np.cumsum(count) + count, count) + np.arange(count.sum())]
            root = np.sqrt(count).astype(np.float32)[:, None]
            z = np.add.reduceat(w[grams], np.cumsum(count) - count, axis=0) / root + bias
            err = (1 / (1 + np.exp(-z)) - target[block]).astype(np.float32)
            used, back = np.unique(grams, return_inverse=True)
            step = np.stack([np.bincount(back, weights=(err / root)[rows, j], minlength=len(used)) for j in range(bits)], 1).astype(np.float32) / len(block)
            g2[used] += step**2
            w[used] -= rate * step / np.sqrt(g2[used])
            db = err.mean(0)
            b2 += db**2
            bias -= rate * db / np.sqrt(b2)
    return Model(codes, words, w, bias, np.ones(bits, np.float32))


def _rough(s: Sentences, label: np.ndarray, n: int) -> np.ndarray:
    """Language of each sentence by n-gram counts under the given labels, refined once by its own judgement.
    Counts bear wrong labels well, as those only add a little of every n-gram to another language."""
    seg = np.repeat(np.arange(len(s.head), dtype=np.int32), s.count)
    for _ in range(2):
        counts = np.stack([np.bincount(s.grams[(label == y)[seg]], minlength=BUCKETS) for y in range(n)], 1).astype(np.float32) + 0.1
        logs = np.log(counts / counts.sum(0)).astype(np.float32)
        label = _scores(s, logs, np.zeros(n, np.float32)).argmax(1)
    return label


def fit(texts: list[str], labels: list[str], codes: list[str], epochs: int = 4) -> Model:
    """Trains on labelled texts of which some labels are wrong: first the sentences are found that agree
    with the label, by counts of n-grams, and the classifiers are fitted to those sentences and their forms without
    accents. The weight of a bit in decoding is the log-odds of its accuracy on a held-out fifth."""
    known = [(t, codes.index(x)) for t, x in zip(texts, labels, strict=True) if x in codes and t]
    if not known:
        raise ValueError("no labelled text to learn languages from")
    plain = ["".join(c for c in unicodedata.normalize("NFD", t) if not unicodedata.combining(c)) for t, _ in known]
    s = joined([t for t, _ in known] + plain)
    label = np.array([y for _, y in known] * 2)[s.doc]
    agree = _rough(s, label, len(codes)) == label
    held = s.doc % len(known) % 5 == 4

    def subset(keep: np.ndarray) -> tuple[Sentences, np.ndarray]:
        at = np.flatnonzero(keep)
        return Sentences(s.doc[at], s.start[at], s.end[at], s.whole[at], s.size[at], s.grams, s.head[at], s.count[at]), label[at]

    model = _fit(*subset(agree & ~held if (agree & ~held).any() else agree), codes, epochs)
    test, truth = subset(agree & held)
    if len(truth):
        right = (np.sign(_scores(test, model.weights, model.bias)) == model.words[truth]).mean(0)
        odds = np.log((right * len(truth) + 1) / ((1 - right) * len(truth) + 1))
        model.trust = np.maximum(odds / odds.mean(), 0.05).astype(np.float32)
    return model


def label_codes(profile: list[dict]) -> dict[str, str]:
    """Every known spelling, in lower case, of each language of the profile table, with its code."""
    names = {}
    for p in profile:
        for v in (p["code"], p["directory"], p["display_name"], p["endonym"]):
            if v:
                names[v.strip().casefold()] = p["code"]
    codes = {p["code"] for p in profile}
    return {k: v for k, v in ISO_CODES.items() if v in codes} | names


def read_label(label: str | None, names: dict[str, str]) -> str | None:
    """Code of the language a label names in any spelling: case, outer blanks, and a region or script after - _ ( or
    a blank make no difference. None if it names none."""
    if label is None:
        return None
    text = label.strip().casefold()
    return names.get(text) or names.get(re.split(r"[-_ (,;/.]", text, maxsplit=1)[0])


def train(docs: DataFrame, profile: DataFrame) -> tuple[Model, dict[str, str]]:
    """Model fitted to at most SAMPLE_DOCS documents of each label, of at most SAMPLE_CHARS characters, those with the smallest hash of
    doc_id and text. The sample is a windowed top-n, whose limit Spark applies before the shuffle too, so a frequent label moves no more
    rows than a rare one; one task fits the model to it. Only the model (8 MB) and the language table (at most MOST_LANGUAGES rows, else
    an error) reach the driver."""
    rows = [r.asDict() for r in profile.select("code", "directory", "display_name", "endonym").where("code is not null").limit(MOST_LANGUAGES + 1).collect()]
    if len(rows) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    names = label_codes(rows)
    spelled = F.trim(F.lower("lang"))
    code = F.element_at(F.create_map(*[F.lit(x) for kv in names.items() for x in kv]), spelled)
    usable = docs.where(spelled.isin(*names) & (F.length("text") <= SAMPLE_CHARS) & (F.length("text") > 20)).select("text", "lang", code.alias("code"), F.xxhash64("doc_id", "text").alias("h"))
    place = F.row_number().over(Window.partitionBy("code").orderBy("h", "text", "lang"))
    sample = usable.withColumn("k", place).where(F.col("k") <= SAMPLE_DOCS).select("code", "k", "text", "lang")
    codes = [r["code"] for r in rows]

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = sorted(tuple(r.values()) for b in batches for r in b.to_pylist())
        if seen:
            model = fit([t for _, _, t, _ in seen], [read_label(x, names) for *_, x in seen], codes)
            yield pa.RecordBatch.from_pydict({"model": [pickle.dumps(model)]}, schema=pa.schema([("model", pa.binary())]))

    got = sample.repartition(1).mapInArrow(learn, "model binary").first()
    if got is None:
        raise ValueError("no labelled text to learn languages from")
    return pickle.loads(bytes(got[0])), names


#: a second language is sure by a sentence of this many letters (an ideograph counts as three) and this confidence
LEAST_LETTERS, LEAST_CONFIDENCE = 8, 0.9
#: prior of a language that no sure sentence of the text has
UNSEEN = 0.02


@dataclass
class Segments:
    """Neighbouring sentences of one language, in the order of the texts."""

    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    lang: np.ndarray
    confidence: np.ndarray
    whole: np.ndarray


def segments(texts: list[str], m: Model) -> Segments:
    """The segments of all texts, with the least confidence of a segment's whole sentences, or its first sentence's if none is whole.

    A sentence of low confidence or few letters is judged with the shares of the text's surely found languages as a prior, in
    which every other language has UNSEEN. Sentences that are not whole only count if no sentence of the text is; else they go with a language it has.
    """
    s = sentences(texts)
    if not len(s.head):
        return Segments(*[np.zeros(0, np.int64)] * 4, np.zeros(0), np.zeros(0, bool))
    _, p = decode(_scores(s, m.weights, m.bias), m)
    k = len(m.codes)
    has_whole = np.zeros(len(texts), bool)
    has_whole[s.doc[s.whole]] = True
    use = s.whole | ~has_whole[s.doc]
    mass = np.zeros((len(texts), k))
    np.add.at(mass, s.doc, p * (s.size * use)[:, None])
    main = mass.argmax(1)
    lang = p.argmax(1)
    sure = (p.max(1) >= LEAST_CONFIDENCE) & (s.size >= LEAST_LETTERS) & use
    share = np.zeros((len(texts), k))
    np.add.at(share, (s.doc[sure], lang[sure]), s.size[sure])
    share[np.arange(len(texts)), main] += 1
    share /= share.sum(1, keepdims=True)
    lang = np.where(sure, lang, (p * (share[s.doc] + UNSEEN)).argmax(1))
    few = ~use & (share[s.doc, lang] == 0)
    lang[few] = main[s.doc[few]]
    conf = p[np.arange(len(lang)), lang]
    heads = np.flatnonzero(np.concatenate([[True], (s.doc[1:] != s.doc[:-1]) | (lang[1:] != lang[:-1])]))
    low = np.minimum.reduceat(np.where(use, conf, np.inf), heads)
    tails = np.append(heads[1:], len(lang)) - 1
    return Segments(s.doc[heads], s.start[heads], s.end[tails], lang[heads], np.where(np.isinf(low), conf[heads], low), ~np.isinf(low))


def identify(texts: list[str], m: Model) -> list[list[tuple[int, int, int, float, bool]]]:
    """segments() as (start, end, language, confidence, whole) for each text."""
    out: list[list[tuple[int, int, int, float, bool]]] = [[] for _ in texts]
    s = segments(texts, m)
    for d, *rest in zip(s.doc.tolist(), s.start.tolist(), s.end.tolist(), s.lang.tolist(), s.confidence.tolist(), s.whole.tolist(), strict=True):
        out[d].append(tuple(rest))
    return out


_SEGMENT = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string()), ("confidence", pa.float64())])
_OUT = "`{0}` {1}, label string, lang string, confidence double, ambiguous boolean, langs array<string>, segments array<struct<start:bigint,end:bigint,lang:string,confidence:double>>"


def _columns(s: Segments, n: int, codes: pa.Array) -> list[pa.Array]:
    """lang, confidence, ambiguous, langs and segments of n texts. A text's languages are those of its whole sentences, the one with most
    characters first, of equal ones the one seen first."""
    w = np.flatnonzero(s.whole)
    pair, first, at = np.unique(s.doc[w] * len(codes) + s.lang[w], return_index=True, return_inverse=True)
    chars = np.bincount(at, weights=(s.end - s.start)[w], minlength=len(pair))
    low = np.full(len(pair), np.inf)
    np.minimum.at(low, at, s.confidence[w])
    doc, lang = pair // len(codes), pair % len(codes)
    order = np.lexsort((first, -chars, doc))
    doc, lang, low = doc[order], lang[order], low[order]
    top = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]])) if len(doc) else np.zeros(0, np.int64)
    main, conf, none = np.zeros(n, np.int64), np.zeros(n), np.ones(n, bool)
    main[doc[top]], conf[doc[top]], none[doc[top]] = lang[top], low[top], False
    ends = lambda d: pa.array(np.concatenate([[0], np.cumsum(np.bincount(d, minlength=n))]).astype(np.int32))
    name = lambda x: codes.take(pa.array(x, pa.int64()))
    parts = pa.StructArray.from_arrays([pa.array(s.start, pa.int64()), pa.array(s.end, pa.int64()), name(s.lang), pa.array(s.confidence, pa.float64())], fields=list(_SEGMENT))
    return [
        codes.take(pa.array(main, mask=none)), pa.array(conf, pa.float64(), mask=none), pa.array(conf < LEAST_CONFIDENCE, mask=none),
        pa.ListArray.from_arrays(ends(doc), name(lang)), pa.ListArray.from_arrays(ends(s.doc), parts),
    ]


def detect_languages(docs: DataFrame, model: Model, names: dict[str, str], id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang") -> DataFrame:
    """For each row its id and: label, the code its label names (null if none); lang and confidence of the text
    (null without words); ambiguous, when the confidence is under LEAST_CONFIDENCE; langs, the languages of its whole
    sentences, the main one first; and segments with start, end (code points), lang and confidence, which cover every
    sentence with letters outside quotes. Null and wordless texts have null lang and empty lists. Repeated rows and null ids are
    kept; further columns are ignored. The model (8 MB) is broadcast; texts are judged whole, where they are read."""
    slim = docs.select(id_col, text_col, label_col)
    kind = slim.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        codes = pa.array(m.codes, pa.string())
        for b in batches:
            texts = [x or "" for x in b.column(1).to_pylist()]
            at, label = 0, [read_label(x, names) for x in b.column(2).to_pylist()]
            while at < len(texts):
                to, room = at, CHUNK
                while to < len(texts) and (to == at or room >= len(texts[to])):
                    room -= len(texts[to])
                    to += 1
                cols = _columns(segments(texts[at:to], m), to - at, codes)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, to - at), pa.array(label[at:to], pa.string()), *cols], names=[id_col, "label", "lang", "confidence", "ambiguous", "langs", "segments"])
                at = to

    return slim.mapInArrow(run, _OUT.format(id_col, kind))


def mislabelled(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id_col, lang) for each document with words whose label names no language or another one, or which mixes languages."""
    wrong = F.col("lang").isNotNull() & (F.col("label").isNull() | (F.col("label") != F.col("lang")) | (F.size("langs") > 1))
    return found.where(wrong).select(id_col, F.explode("langs").alias("lang"))
