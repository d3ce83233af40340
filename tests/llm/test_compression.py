"""Held-out accuracy of the compression classifier, and the cases its docstrings define."""

import random

import numpy as np
import pytest

from hitloom.llm import compression as C

SCHEMA = "doc_id long, text string, score string, quality int"
LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(4)
    words = ["".join(rng.choice("etaoinsr") for _ in range(rng.randrange(2, 8))) for _ in range(500)]
    docs, labels = [], []
    for k in range(1200):
        text = [rng.choice(words) for _ in range(rng.randrange(5, 120))]
        bad = k % 5 == 0
        if bad:
            text = [w + rng.choice(["###", "%%%", "$$$"]) for w in text]
        docs.append((k, " ".join(text), "clash", 9))
        labels.append((k, int(not bad), 0))
    docs += [(2000, None, "", 1), (2001, "", "", 1), (None, "no id", "", 1), (0, docs[0][1], "", 1), (2002, "word " * 300_000, "", 1)]
    labels += [(0, 1, 1), (None, 0, 1), (5, None, 0), (4000, 0, 1)]
    return docs, labels


def test_scores_of_held_out_documents(spark, corpus):
    docs, labels = spark.createDataFrame(corpus[0], SCHEMA), spark.createDataFrame(corpus[1], LABELS)
    rows = C.score_documents(docs, labels).collect()
    assert len(rows) == len(corpus[0])
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id is not None and r.doc_id < 1200]
    assert 150 < len(held) < 330
    assert sum(r.predicted == int(r.doc_id % 5 != 0) for r in held) >= 0.98 * len(held)
    assert {r.held_out for r in rows if r.doc_id is None} == {False}
    empty = {r.score for r in rows if r.doc_id in (2000, 2001)}
    assert len(empty) == 1


def test_labels_of_the_held_out_fold_have_no_influence(spark, corpus):
    from zlib import crc32

    docs = spark.createDataFrame(corpus[0], SCHEMA)
    turned = [(k, q if k is None or crc32(str(k).encode()) % 5 or q is None else 1 - q, t) for k, q, t in corpus[1]]
    assert turned != corpus[1]
    one, other = (C.score_documents(docs, spark.createDataFrame(x, LABELS)) for x in (corpus[1], turned))
    assert sorted(one.select("doc_id", "score").dropna().collect()) == sorted(other.select("doc_id", "score").dropna().collect())


def test_no_labels_one_class_and_no_documents(spark, corpus):
    docs = spark.createDataFrame(corpus[0][:40], SCHEMA)
    none = spark.createDataFrame([], LABELS)
    assert {r.score for r in C.score_documents(docs, none).collect()} == {0.5}
    assert C.score_documents(docs.limit(0), none).collect() == []
    good = spark.createDataFrame([(k, 1, 0) for k in range(40)], LABELS)
    assert len({r.score for r in C.score_documents(docs, good).collect() if r.score > 0.5}) == 1


def test_sample_is_bounded_and_weighted(spark, corpus):
    docs, labels = spark.createDataFrame(corpus[0], SCHEMA), spark.createDataFrame(corpus[1], LABELS)
    sample = C.labelled_sample(docs, labels, rows=100).toPandas()
    assert 200 <= len(sample) <= 202 and set(sample.quality) == {0, 1}
    assert abs(sample[sample.quality == 1].weight.iloc[0] - 9.6) < 0.05


def test_whole_texts_count():
    model = C.Model(b"", C.dictionary([b"alpha beta gamma delta %d" % k for k in range(200)]))
    plain = b"qwxz " * 2000
    last = plain + b"alpha beta gamma delta " * 3
    apart = C.differences([plain, last, b""], model)
    assert apart[1] < apart[0] and apart[2] == 0
    assert b"".join(C.pieces(last)) == last and C.pieces(b"") == []


def test_curve():
    rng = np.random.default_rng(5)
    x = rng.normal(size=4000)
    y = (rng.random(4000) < 1 / (1 + np.exp(-(0.7 - 1.5 * x)))).astype(float)
    base, slope = C.fit_curve(x, y, np.ones(4000))
    assert abs(base - 0.7) < 0.15 and abs(slope + 1.5) < 0.15
    base, slope = C.fit_curve(np.array([-1.0, 1.0]), np.array([1.0, 0.0]), np.ones(2))
    assert np.isfinite(base) and slope < 0
    assert C.fit_curve(np.zeros(0), np.zeros(0), np.zeros(0)) == (0.0, 0.0)
