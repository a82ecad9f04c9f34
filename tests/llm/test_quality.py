from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wakeline.llm import quality_classifier as qc
from wakeline.llm import quality_rules as qr

from .conftest import SCHEMA, edge_rows, prose


def brute_rules(text):
    words = (text or "").encode().split()
    grams = Counter(zip(words, words[1:], words[2:]))  # noqa: B905
    covered = set()
    for i in range(len(words) - 2):
        if grams[tuple(words[i : i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    return (
        len(words),
        sum(len(w.decode()) for w in words),
        sum(c in "#*$%&|<>" for c in text or ""),
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_rules_match_brute_force(spark, edge_docs):
    r = random.Random(5)
    texts = ["".join(r.choice(["a", "b", " ", "\n", "ab ", "#", "|"]) for _ in range(r.randint(0, 60))) for _ in range(200)]
    texts += [None, "", "a a a a", "a b a b a b", "x\n\nx\n x"]
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)]
    got = {x.doc_id: x for x in qr.quality_rules(spark.createDataFrame(rows, SCHEMA)).collect()}
    for i, t in enumerate(texts):
        x = got[i]
        assert (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words) == brute_rules(t), t
        n, _, _, _, rep = brute_rules(t)
        assert x.base_failed == (n < 50 or 100 * rep > 50 * n)
        assert not (x.base_failed and x.kept)


def test_rules_edges(edge_docs, clashing_docs, empty_docs):
    want = sorted((i, brute_rules(t)[0]) for i, t, *_ in edge_rows() if i is not None)
    for docs in (edge_docs, clashing_docs):
        got = qr.quality_rules(docs).select("doc_id", "n_words").where("doc_id is not null").collect()
        assert sorted((r.doc_id, r.n_words) for r in got) == want
    assert qr.quality_rules(empty_docs).count() == 0


def test_rules_use_no_python(edge_docs):
    plan = qr.quality_rules(edge_docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


@pytest.fixture(scope="module")
def labelled(spark):
    good = [(i, prose(100 + i, 60), "en", "a", 0) for i in range(120)]
    bad = [(1000 + i, " ".join(w + "%%%" for w in prose(i, 40).split()), "en", "a", 0) for i in range(40)]
    docs = spark.createDataFrame(good + bad, SCHEMA)
    labels = spark.createDataFrame([(r[0], int(r[0] < 1000), 0) for r in good + bad] + [(None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    return docs, labels


def test_classifier_separates_held_out_rows(labelled):
    docs, labels = labelled
    got = {r.doc_id: r for r in qc.score_documents(docs, qc.train(docs, labels)).collect()}
    held = [r for r in got.values() if r.held_out]
    assert len(held) > 15
    assert all((r.predicted == 1) == (r.doc_id < 1000) for r in held)
    assert all(0 <= r.score <= 1 and (r.score >= 0.7) == bool(r.predicted) for r in got.values())


def test_classifier_edges(labelled, edge_docs, clashing_docs, empty_docs, spark):
    docs, labels = labelled
    model = qc.train(docs, labels)
    for d in (edge_docs, clashing_docs):
        rows = qc.score_documents(d, model).collect()
        assert len(rows) == len(edge_rows()) and all(not math.isnan(r.score) for r in rows)
        by = {}
        for r in rows:
            assert by.setdefault(r.doc_id, r.score) == r.score
        assert by[1] == by[2]
    assert qc.score_documents(empty_docs, model).count() == 0
    none = qc.train(docs, labels.limit(0))
    assert {r.predicted for r in qc.score_documents(edge_docs, none).collect()} == {1}
    assert qc.keep_good(clashing_docs, none).columns == clashing_docs.columns


@settings(max_examples=50, deadline=None)
@given(st.text())
def test_features_are_sorted_and_bounded(text):
    f = qc.features(text)
    assert list(f) == sorted(set(f)) and (len(f) == 0 or 0 <= f[0] <= f[-1] < qc.FEATURES)


def test_dual_coordinate_descent_reaches_the_optimum():
    import numpy as np

    rng = np.random.default_rng(0)
    x = rng.normal(size=(60, 5))
    y = np.sign(x[:, 0] + 0.3 * x[:, 1])
    rows = [(np.arange(5), v) for v in x]
    old, qc.EPOCHS = qc.EPOCHS, 400
    try:
        w, b = qc.dual_coordinate_descent(rows, y, np.ones(60), 5)
    finally:
        qc.EPOCHS = old

    def loss(w, b):
        return 0.5 * (w @ w + b * b) + np.maximum(0, 1 - y * (x @ w + b)).sum()

    at = loss(w, b)
    assert all(loss(w + d[:5], b + d[5]) >= at - 1e-3 for d in rng.normal(0, 0.05, (300, 6)))


def test_sample_is_held_in_two_arrays():
    """The driver keeps two bytes a feature and eight a value, in memory that goes back as a whole."""
    texts = [prose(i, 40) for i in range(5)] + [""]
    ratio = np.linspace(-1, 2, qc.FEATURES)
    data = qc.unpacked(pd.Series([qc.packed(qc.features(t)) for t in texts]), ratio)
    for t, (f, v) in zip(texts, data, strict=True):
        want = ratio[qc.features(t)]
        assert f.tolist() == qc.features(t).tolist() and np.array_equal(v, want / (np.sqrt(want @ want) or 1.0))
    for part in zip(*data, strict=True):
        assert len({id(x.base) for x in part}) == 1 and part[0].base.nbytes == part[0].itemsize * sum(map(len, part))
