import os

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gradelex.llm import bpe, fill
from tests.conftest import rows_of


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=120), st.sampled_from(["norm", "dot"]), st.integers(2, 9))
def test_every_constraint_holds(sizes, rule, docs):
    s = np.array(sizes, np.int64)
    b = fill.best_fit(s, 50, docs, 50**2, rule)
    assert len(b) == len(s)
    for k in set(b.tolist()):
        own = s[b == k]
        assert own.sum() <= 50 and len(own) <= docs and (own**2).sum() <= 2500
    if len(s):
        # a container is opened only for an item that fits no open one, so no two under half full by tokens alone remain unless documents bind
        load = np.bincount(b, weights=s)
        full = np.bincount(b) >= docs
        assert ((load * 2 <= 50) & ~full).sum() <= 1


def test_attention_cost_binds_below_the_square_of_the_capacity():
    s = np.array([20, 20, 20, 20, 5, 5])
    for rule in ("norm", "dot"):
        b = fill.best_fit(s, 50, 9, 50**2 * 0.2, rule)
        assert b.max() + 1 == 4 and all((s[b == k] ** 2).sum() <= 500 for k in range(4))
        assert fill.best_fit(s, 50, 9, 50**2, rule).max() + 1 == 2


def test_an_item_over_the_attention_cost_stands_alone():
    b = fill.best_fit(np.array([48, 47, 10, 3]), 50, 9, 50**2 * 0.8)
    assert len({b[0], b[1], b[2]}) == 3 and b[2] == b[3]


def test_close_to_the_least_number():
    r = np.random.default_rng(2)
    s = np.minimum(r.lognormal(5, 1, 8192).astype(np.int64) + 1, 2048)
    for rule in ("norm", "dot"):
        n = fill.best_fit(s, 2048, 128, 2048**2, rule).max() + 1
        assert s.sum() / (n * 2048) > 0.98


@pytest.mark.skipif(not os.path.exists(bpe.vocabulary(bpe.DEFAULT_DIR)), reason="no tokenizer files")
def test_documents(spark, monkeypatch):
    texts = [(i, "word " * (i % 40)) for i in range(200)] + [(1000, "long " * 3000), (1001, None), (1002, ""), (5, "word " * 5), (None, "x")]
    docs = spark.createDataFrame([(a, b, "c", 1) for a, b in texts], "doc_id bigint, text string, container string, piece int").repartition(3)
    budgets = spark.createDataFrame([("s", 64), ("m", 512)], "pack_name string, capacity_tokens int")
    out = fill.pack_documents(docs, budgets).toPandas()
    sizes = {i: len(x) for i, x in bpe.encode_texts(docs, "doc_id", "text").collect()}
    for name, capacity in (("s", 64), ("m", 512)):
        own = out[out.pack_name == name]
        assert own.groupby("container").n_tokens.sum().max() <= capacity
        assert own[own.doc_id.isin([1001, 1002])].container.isna().all()
        for doc, part in own.groupby("doc_id"):
            if doc != 5:
                assert part.n_tokens.sum() == sizes[doc]
                assert (len(part) == 1) == (sizes[doc] <= capacity)
                p = part.sort_values("piece")
                assert (p.first_token == p.n_tokens.cumsum() - p.n_tokens).all()
        assert len(own[own.doc_id == 5]) == 2 and own.doc_id.isna().sum() == 1
    assert fill.pack_documents(docs.limit(0), budgets).count() == 0
    # the same containers however the input is split, and by several ways of unfolding equal rows
    want = rows_of(fill.pack_documents(docs, budgets))
    assert rows_of(fill.pack_documents(docs.repartition(1), budgets)) == want
    monkeypatch.setattr(fill, "UNFOLD", 1)
    assert rows_of(fill.pack_documents(docs, budgets)) == want
    report = {r.pack_name: r for r in fill.fill_report(fill.pack_documents(docs.coalesce(1), budgets), budgets).collect()}
    assert report["s"].fullest <= 64 and report["m"].fill > 0.9
