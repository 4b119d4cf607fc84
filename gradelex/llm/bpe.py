"""Encoding of the whole corpus with a public byte-level tokenizer: vectorised splitting, cached pair merging."""

from __future__ import annotations

import base64
import os
import sys
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession

DEFAULT_DIR = "/opt/tokenizers"
CHUNK = 1_000_000  # code points handled at once; a longer text is handled alone
CACHE_ENTRIES, CACHED_BYTES = 200_000, 48
_shipped: set[tuple[str, str]] = set()

#: White_Space property of Unicode: fixed values
SPACES = (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
#: The splitting pattern's contractions: fixed values
SHORT_ENDS, LONG_ENDS = "stmd", ("re", "ve", "ll")

# symbols the automaton reads: other white space, U+0020, letter, number, other, apostrophe with one or two letters of a contraction after it
W, B, L, N, O, Q1, Q2 = range(7)  # noqa: E741
# states after a character: other white space or start of text, U+0020, letter, number, other, one or two letters of a contraction to come, contraction complete
S0, S1, SL, SN, SO, C1, C2, CE = range(8)


def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """next state by [symbol, state]; whether a token starts before the symbol by [symbol, state].
    White space starts are completed in token_starts, as they depend on what follows."""
    to, starts = np.zeros((7, 8), np.uint8), np.zeros((7, 8), bool)
    for s in range(8):
        to[W, s], to[B, s] = S0, S1
        to[L, s] = {C1: CE, C2: C1}.get(s, SL)
        to[N, s], to[O, s] = SN, SO
        eligible = s not in (S1, SO)
        to[Q1, s], to[Q2, s] = (C1, C2) if eligible else (SO, SO)
        starts[W, s] = starts[B, s] = s not in (S0, S1)
        starts[L, s] = s not in (SL, S1, C1, C2)
        starts[N, s] = s not in (SN, S1)
        starts[O, s] = starts[Q1, s] = starts[Q2, s] = s not in (SO, S1)
    return to, starts


NEXT, STARTS = _automaton()


@lru_cache(1)
def symbol_table() -> np.ndarray:
    """L, N, O, W or B of every code point, from the Unicode categories."""
    t = np.full(0x110000, O, np.uint8)
    for c in range(sys.maxunicode + 1):
        if 0x3400 < c < 0x4DBF or 0x4E00 < c < 0x9FFF or 0xAC00 < c < 0xD7A3 or 0x20000 < c < 0x2A6DF:
            t[c] = L
        elif c < 0x33480 or 0xE0000 <= c < 0xE0200:
            kind = unicodedata.category(chr(c))[0]
            if kind in "LN":
                t[c] = L if kind == "L" else N
    t[list(SPACES)] = W
    t[0x20] = B
    return t


#: state after a symbol whatever was before, where that is so
PLAIN = np.array([S0, S1, SL, SN, SO, SO, SO], np.uint8)


def _scan(f: np.ndarray, at: np.ndarray, known: np.ndarray, first: np.ndarray) -> np.ndarray:
    """States after the places at, whose functions are f, by doubling. Places with a known state before them, or the start of a text, come out of
    it at once; the others are composed with those 1, 2, 4, … places before until all functions are constant."""
    head = np.ones(len(at), bool)
    head[1:] = (np.diff(at) != 1) | first[at[1:]]
    before = np.where(first[at[head]] | (at[head] == 0), S0, known[at[head] - 1])
    f[head] = np.take_along_axis(f[head], before[:, None].astype(np.int64), axis=1)
    k = 1
    while k < len(at):
        still = np.flatnonzero((f[k:] != f[k:, :1]).any(axis=1)) + k
        if not len(still):
            break
        f[still] = np.take_along_axis(f[still], f[still - k].astype(np.int64), axis=1)
        k *= 2
    return f[:, 0]


def token_starts(cp: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where tokens start in a run of texts; first marks each text's first character.

    Every character is a function from the automaton's state before it to the state after it. Functions compose
    associatively, so the state after each character comes from a scan by doubling over those that are not constant; it ends as soon as all
    composed functions are, which takes as many steps as the longest dependence has binary digits.
    """
    n = len(cp)
    sym = symbol_table()[cp]
    # apostrophes with a contraction's letters after them in the same text
    at = np.flatnonzero(cp == 0x27)
    if len(at):
        same = lambda k: (at + k < n) & ~first[np.minimum(at + k, n - 1)]
        one, two = cp[np.minimum(at + 1, n - 1)], cp[np.minimum(at + 2, n - 1)]
        short = same(1) & np.isin(one, [ord(c) for c in SHORT_ENDS])
        long_ = np.zeros(len(at), bool)
        for a, b in LONG_ENDS:
            long_ |= same(1) & same(2) & (one == ord(a)) & (two == ord(b))
        sym[at[short]] = Q1
        sym[at[long_]] = Q2
    # most functions are constant; a letter's is but in the two places after such an apostrophe, where a contraction may be on its way
    after = PLAIN[sym]
    quotes = at[sym[at] >= Q1] if len(at) else at
    if len(quotes):
        near = np.zeros(n, bool)
        near[quotes] = True
        for step in (1, 2):
            later = quotes[quotes + step < n] + step
            near[later[sym[later] == L]] = True
        open_at = np.flatnonzero(near)
        after[open_at] = _scan(NEXT[sym[open_at]], open_at, after, first)
    before = np.empty(n, np.uint8)
    before[0], before[1:] = S0, after[:-1]
    before[first] = S0
    starts = STARTS.ravel()[sym * np.uint8(8) + before] | first
    # the last of several blanks stands apart if something visible follows
    blank = sym <= B
    follows = np.zeros(n, bool)
    follows[:-1] = ~blank[1:] & ~first[1:]
    return starts | (blank & follows)


class Merger:
    """Ids of byte slices: merges of pairs by rank, with a bounded cache of short slices."""

    def __init__(self, path: str) -> None:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        # a pattern that takes the whole slice: what is left for the library is merging one slice, a run of whole characters
        merge = tiktoken.Encoding("own", pat_str=r"(?s:.+)", mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.merge = lambda piece: merge(piece.decode("utf-8"))
        self.words = {i: w for w, i in ranks.items()}
        self.lengths = np.zeros(max(self.words) + 1, np.int64)
        self.lengths[list(self.words)] = [len(w) for w in self.words.values()]
        self.start = np.cumsum(self.lengths) - self.lengths
        self.octets = np.frombuffer(b"".join(self.words.get(i, b"") for i in range(len(self.lengths))), np.uint8)
        self.cache: dict[bytes, tuple[int, ...]] = {w: (i,) for w, i in ranks.items() if len(w) <= CACHED_BYTES}
        self.fixed = len(self.cache)

    def __call__(self, piece: bytes) -> tuple[int, ...]:
        ids = self.cache.get(piece)
        if ids is None:
            ids = tuple(self.merge(piece))
            if len(piece) <= CACHED_BYTES:
                if len(self.cache) >= self.fixed + CACHE_ENTRIES:
                    for old in list(self.cache)[self.fixed :]:
                        del self.cache[old]
                self.cache[piece] = ids
        return ids


@lru_cache(2)
def merger(path: str) -> Merger:
    return Merger(path)


def _chunks(texts: pa.Array) -> Iterator[pa.Array]:
    """Slices of the array with about CHUNK bytes each."""
    ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(texts), 0)))
    at = 0
    while at < len(texts):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + CHUNK, side="right")))
        yield texts.slice(at, to - at)
        at = to


@lru_cache(1)
def _weights(n: int) -> np.ndarray:
    """n odd numbers, the same in every process."""
    return np.random.default_rng(5).integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def distinct_slices(octets: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places of slices that differ, for each slice the one it equals among them). Slices lie one after the other from the starts on.

    Slices are told apart by a hash of their bytes, weighted by place; then the bytes of every slice are compared with those of the one it is
    said to equal, and one that differs, as hashes may collide, stands for itself."""
    size = np.diff(np.append(start, len(octets)))
    at = np.arange(len(octets)) - np.repeat(start, size)
    part = (octets.astype(np.uint64) + np.uint64(1)) * _weights(1 << int(size.max()).bit_length())[at]
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(part, dtype=np.uint64)])
    _, unlike, of = np.unique(sums[start + size] - sums[start], return_index=True, return_inverse=True)
    twin = unlike[of]
    same = size == size[twin]
    mirror = np.minimum(np.repeat(start[twin], size) + at, len(octets) - 1)
    same[np.repeat(np.arange(len(start)), size)[octets != octets[mirror]]] = False
    alone = np.flatnonzero(~same)
    of[alone] = len(unlike) + np.arange(len(alone))
    return np.concatenate([unlike, alone]), of


def encode(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids of all texts, number of ids of each text, end of each id's bytes within its text)."""
    m = merger(path)
    all_ids, all_counts, all_ends = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for part in _chunks(texts.cast(pa.large_string())):
        n = len(part)
        filled = part.fill_null("")
        offsets = np.frombuffer(filled.buffers()[1], np.int64, n + 1, filled.offset * 8)
        raw = filled.buffers()[2].to_pybytes()[offsets[0] : offsets[-1]] if offsets[-1] > offsets[0] else b""
        if not raw:
            all_counts.append(np.zeros(n, np.int64))
            continue
        octets = np.frombuffer(raw, np.uint8)
        head_at = np.flatnonzero((octets & 0xC0) != 0x80)
        cp = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), np.uint32)
        text_at = np.unique(offsets[:-1][np.diff(offsets) > 0] - offsets[0])
        first = np.zeros(len(cp), bool)
        first[np.searchsorted(head_at, text_at)] = True
        cut_at = head_at[token_starts(cp, first)]
        unlike, of = distinct_slices(octets, cut_at)
        bounds = np.append(cut_at, len(raw))
        pieces = [m(raw[a:b]) for a, b in zip(cut_at[unlike].tolist(), bounds[unlike + 1].tolist(), strict=True)]
        own = np.fromiter(map(len, pieces), np.int64, len(pieces))
        flat = np.fromiter(chain.from_iterable(pieces), np.int32, int(own.sum()))
        sizes = own[of]
        ids = flat[np.repeat((np.cumsum(own) - own)[of] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())]
        upto = np.concatenate([[0], np.cumsum(sizes)])
        edge = upto[np.searchsorted(cut_at, offsets - offsets[0])]
        all_ids.append(ids)
        all_counts.append(np.diff(edge))
        total = np.concatenate([[0], np.cumsum(m.lengths[ids])])
        all_ends.append(total[1:] - np.repeat(total[edge[:-1]], np.diff(edge)))
    return np.concatenate(all_ids), np.concatenate(all_counts), np.concatenate(all_ends)


def vocabulary(directory: str, name: str = "byte_bpe_50k") -> str:
    return os.path.join(directory, name + ".tiktoken")


def shipped(spark: SparkSession, path: str) -> Callable[[], str]:
    """Gives the executors the vocabulary file; what is returned tells its place there, or the path itself where it is the driver's disk."""
    name = os.path.basename(path)
    if not os.path.exists(path):  # only the executors have it
        return lambda: path
    key = (spark.sparkContext.applicationId, path)
    if key not in _shipped:
        spark.sparkContext.addFile(path)
        _shipped.add(key)

    def place() -> str:
        own = SparkFiles.get(name)
        return own if os.path.exists(own) else path

    return place


def encode_texts(df: DataFrame, id_col: str, text_col: str, directory: str = DEFAULT_DIR, offsets: bool = False) -> DataFrame:
    """id_col and ids of every row, without special tokens; text that looks like one is plain text.

    Empty and null texts have the empty list. offsets: also `ends`, where each id's bytes end within the text's UTF-8
    form, so that decode_ids and any substring of ids can be traced back. Rows are encoded where they are read,
    without a shuffle; no text is cut or left out. Repeated rows and null ids are kept; further columns are ignored.
    """
    path = shipped(df.sparkSession, vocabulary(directory))
    slim = df.select(id_col, text_col)
    kind = slim.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, counts, ends = encode(b.column(1), path())
            at = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
            cols = [b.column(0), pa.ListArray.from_arrays(at, pa.array(ids, pa.int32()))]
            if offsets:
                cols.append(pa.ListArray.from_arrays(at, pa.array(ends, pa.int64())))
            yield pa.RecordBatch.from_arrays(cols, names=[id_col, "ids", "ends"][: len(cols)])

    return slim.mapInArrow(run, f"`{id_col}` {kind}, ids array<int>" + (", ends array<bigint>" if offsets else ""))


def decode(ids: pa.Array, path: str) -> pa.Array:
    """The texts of lists of ids: the bytes of all ids gathered at once. Only lists whose bytes are no whole text are read one by one, each
    byte that belongs to no character becoming U+FFFD."""
    m = merger(path)
    n = len(ids)
    counts = np.asarray(pc.fill_null(pc.list_value_length(ids), 0))
    flat = np.asarray(ids.flatten())
    size = m.lengths[flat]
    at = np.repeat(m.start[flat] - (np.cumsum(size) - size), size) + np.arange(size.sum())
    raw = m.octets[at]
    ends = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(counts)])]
    valid = None if ids.null_count == 0 else pa.array(np.asarray(ids.is_valid())).buffers()[1]
    body = raw.tobytes()
    inside = np.concatenate([(raw & 0xC0) == 0x80, [False]])[ends[:-1]] & (ends[1:] > ends[:-1])
    try:
        body.decode("utf-8")
        whole = not inside.any()
    except UnicodeDecodeError:
        whole = False
    if whole:
        return pa.Array.from_buffers(pa.large_string(), n, [valid, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(body)])
    known = np.asarray(ids.is_valid())
    return pa.array([body[a:b].decode("utf-8", "replace") if k else None for a, b, k in zip(ends[:-1].tolist(), ends[1:].tolist(), known.tolist(), strict=True)], pa.large_string())


def decode_ids(df: DataFrame, id_col: str, ids_col: str = "ids", directory: str = DEFAULT_DIR) -> DataFrame:
    """id_col and text of every row of ids; null ids give a null text, the empty list the empty text."""
    path = shipped(df.sparkSession, vocabulary(directory))
    slim = df.select(id_col, ids_col)
    kind = slim.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), decode(b.column(1), path()).cast(pa.string())], names=[id_col, "text"])

    return slim.mapInArrow(run, f"`{id_col}` {kind}, text string")


def count_tokens(texts: pa.Array, path: str) -> np.ndarray:
    return encode(texts, path)[1]
