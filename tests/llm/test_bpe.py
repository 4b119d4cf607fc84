import os
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gradelex.llm import bpe
from tests.conftest import rows_of

DIR = os.environ.get("GRADELEX_TOKENIZERS", bpe.DEFAULT_DIR)
PATH = bpe.vocabulary(DIR)
pytestmark = pytest.mark.skipif(not os.path.exists(PATH), reason="no tokenizer files")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(os.path.join(DIR, "byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return lambda texts: [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def mine(texts):
    ids, counts, ends = bpe.encode(pa.array(texts, pa.string()), PATH)
    out, at = [], 0
    for n in counts.tolist():
        out.append((ids[at : at + n].tolist(), ends[at : at + n].tolist()))
        at += n
    return out


def check(texts, library):
    got = mine(texts)
    assert [g[0] for g in got] == library(texts)
    words = bpe.merger(PATH).words
    for t, (ids, ends) in zip(texts, got, strict=True):
        assert b"".join(words[i] for i in ids) == (t or "").encode()
        assert (ends[-1] if ends else 0) == len((t or "").encode())


def test_contractions_blanks_and_classes(library):
    r = random.Random(3)
    alphabet = list("''''  \n\t\xa0sstmdrevellaé1²٣中،!?-　​ 🙂́\x1f\x85")
    check(["".join(r.choice(alphabet) for _ in range(r.randrange(25))) for _ in range(8000)], library)


def test_known_cases(library):
    check(["", None, "<|endoftext|>", "it's he'll we've 'tis '' 'S", "   ", " a", "a ", "a  b", "\r\n\r\n x", "'re're", "x" * 5000, "中" * 3000, "a'" * 700], library)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=6))
def test_any_text(library, texts):
    check([t.encode("utf-8", "ignore").decode() for t in texts], library)


def test_chunks_do_not_show(library, monkeypatch):
    texts = ["it's", None, "a b", "", "中文 字", "'ll", " x"] * 9
    whole = mine(texts)
    monkeypatch.setattr(bpe, "CHUNK", 7)
    assert mine(texts) == whole


def test_cache_is_bounded(monkeypatch):
    m = bpe.Merger(PATH)
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 5)
    for i in range(40):
        assert m(b" zq%dx" % i) == m(b" zq%dx" % i)
    assert len(m.cache) <= m.fixed + 5


def test_round_trip(spark):
    texts = [(1, "Hello, <|endoftext|> wörld 中\n"), (2, ""), (3, None), (None, "x"), (2, "")]
    df = spark.createDataFrame([(a, b, "clash") for a, b in texts], "doc_id bigint, text string, ids string")
    ids = bpe.encode_texts(df, "doc_id", "text", DIR)
    assert [r.ids for r in ids.where("doc_id in (2, 3)").collect()] == [[], [], []]
    assert rows_of(bpe.decode_ids(ids, "doc_id", "ids", DIR)) == sorted([(a, b or "") for a, b in texts], key=repr)
    assert bpe.encode_texts(df.limit(0), "doc_id", "text", DIR, offsets=True).count() == 0


def test_decoding_of_whole_and_broken_texts():
    texts = ["", "a", None, "été 中 🙂", "x" * 3000]
    ids, counts, _ = bpe.encode(pa.array(texts, pa.string()), PATH)
    at = np.concatenate([[0], np.cumsum(counts)]).tolist()
    lists = [None if t is None else ids[a:b].tolist() for t, a, b in zip(texts, at, at[1:], strict=False)]
    assert bpe.decode(pa.array(lists, pa.list_(pa.int32())), PATH).to_pylist() == texts
    words = bpe.merger(PATH).words
    broken = [next(i for i, w in words.items() if w == bytes([b])) for b in "é".encode()]
    assert bpe.decode(pa.array([broken[:1], broken[1:], broken, None, []], pa.list_(pa.int32())), PATH).to_pylist() == ["\ufffd", "\ufffd", "é", None, ""]


def test_slices_are_told_apart(library, monkeypatch):
    text = b"abcabcabdxab"
    start = np.array([0, 3, 6, 9, 10])
    unlike, of = bpe.distinct_slices(np.frombuffer(text, np.uint8), start)
    assert of[0] == of[1] and len(set(of.tolist())) == 4 and all(start[unlike[of[i]]] in (0, start[i]) for i in range(5))
    # with a hash that tells nothing apart, the comparison of bytes must
    monkeypatch.setattr(bpe, "_weights", lambda n: np.zeros(n, np.uint64))
    check(["it's he'll 12 12 12", "it's not", "", None, "中文 中文"], library)
