"""Language model: counts and scores against a plain model, packing, weights, edges."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from salesmart.llm import lm_scoring as lm
from salesmart.llm import queries as Q

SF = "/root/testdata/sf0.01"


def tokens_of(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), None]


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 1


def plain_model(rows):
    """Deleted interpolation with plain dictionaries: (rows' results, N, weights)."""
    uni, bi = Counter(), Counter()
    for doc_id, text in rows:
        if not held(doc_id):
            w = tokens_of(text)
            uni.update(w)
            bi.update(zip([None, *w], w))
    n, types = sum(uni.values()), len(uni)
    cells = Counter()
    quant = lambda p: 0 if p <= 0 else 1 + round(-lm.GRID * math.log2(p))
    bucket = lambda c: c.bit_length()
    for doc_id, text in rows:
        if not held(doc_id):
            w = tokens_of(text)
            for h, x in zip([None, *w], w):
                rest = uni[h] - 1
                p2 = (bi[h, x] - 1) / rest if rest else 0.0
                cells[bucket(rest), quant(p2), quant((uni[x] - 1) / max(n - 1, 1))] += 1
    keys = sorted(cells)
    packed = np.array([a << 40 | b << 20 | c for a, b, c in keys], np.int64)
    weights = lm.learn_weights(packed, np.array([cells[k] for k in keys], np.int64), types)
    out = []
    for doc_id, text in rows:
        w = tokens_of(text)
        base = sum(math.log10((uni[x] + 0.5) / (n + 0.5 * (types + 1))) for x in w)
        score = 0.0
        for h, x in zip([None, *w], w):
            l2, l1, l0 = weights[bucket(uni[h])]
            p2 = bi[h, x] / uni[h] if uni[h] else 0.0
            score += math.log10(l2 * p2 + l1 * uni[x] / max(n, 1) + l0 / (types + 1))
        out.append((doc_id, held(doc_id), len(w), sum(uni[x] > 0 for x in w), n, base, score))
    return out


def check(got, want):
    got = sorted(map(tuple, got), key=lambda r: (r[0] is None, r[0] or 0, r[5]))
    want = sorted(want, key=lambda r: (r[0] is None, r[0] or 0, r[5]))
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for g, w in zip(got, want):
        assert g[5] == pytest.approx(w[5], abs=1e-6) and g[6] == pytest.approx(w[6], abs=1e-4)


def test_query_equals_the_plain_model(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = Q.op1_lm_scoring(spark, SF).collect()
    check(got, plain_model(rows))
    out = [r for r in got if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_edges(spark, monkeypatch):
    rows = [(1, None), (2, ""), (None, "A b a\x0bb"), (3, "a b a b"), (3, "a b a b"), (4, "Z\xa0q " * 5), (5, "é" * 90_000)]
    docs = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, score double")
    check(lm.score_documents(docs).collect(), plain_model(rows))
    assert lm.score_documents(docs.limit(0)).count() == 0
    only = next(i for i in range(100) if held(i))
    check(lm.score_documents(spark.createDataFrame([(only, "x y")], "doc_id long, text string")).collect(), plain_model([(only, "x y")]))


def test_many_chunks_equal_one(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 150").select("doc_id", "text")
    want = plain_model([tuple(r) for r in docs.collect()])
    check(lm.score_documents(docs.repartition(13)).collect(), want)


def test_probabilities_sum_to_one():
    weights = lm.learn_weights(np.array([0, 3 << 40 | 2 << 20 | 5, 3 << 40 | 7]), np.array([2, 5, 1]), 9)
    assert weights.sum(axis=1) == pytest.approx(np.ones(len(weights)))
    assert (weights[:, 2] > 0).all()
    assert lm.learn_weights(np.empty(0, np.int64), np.empty(0, np.int64), 0).tolist()[0] == [0.0, 0.0, 1.0]


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1)), st.lists(st.integers(0, 2**40)))
def test_packing_round_trips(keys, counts):
    k = np.array(sorted(keys), np.uint64)
    assert lm.unpack_sorted(lm.pack_sorted(k)).tolist() == k.tolist()
    c = np.array(counts, np.int64)
    assert lm.unpack_counts(lm.pack_counts(c)).tolist() == c.tolist()
