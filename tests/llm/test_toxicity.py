"""Held-out accuracy of the classifier, and the cases its docstrings define."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hitloom.llm import toxicity

SCHEMA = "doc_id long, text string, score string, toxic int"


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(2)
    words = [f"w{k}" for k in range(400)]
    docs, labels = [], []
    for k in range(900):
        text = [rng.choice(words) for _ in range(rng.randrange(5, 80))]
        toxic = k % 6 == 0
        if toxic:
            for _ in range(3):
                text.insert(rng.randrange(len(text)), rng.choice(["Scoundrel", "knave,", "villain!"]))
        docs.append((k, " ".join(text), "clash", 9))
        labels.append((k, 1, int(toxic)))
    docs += [(1000, None, "", 1), (1001, "", "", 1), (None, "no id knave", "", 1), (0, docs[0][1], "", 1), (1002, "w1 " * 200_000, "", 1)]
    labels += [(0, 1, 1), (None, 0, 1), (5, 0, None), (4000, 0, 1)]
    return docs, labels


def test_scores_of_held_out_documents(spark, corpus):
    docs = spark.createDataFrame(corpus[0], SCHEMA)
    labels = spark.createDataFrame(corpus[1], "doc_id long, quality int, toxic int")
    rows = toxicity.score_documents(docs, labels).collect()
    assert len(rows) == len(corpus[0])
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id is not None and r.doc_id < 900]
    assert 100 < len(held) < 260
    right = sum(r.predicted == (r.doc_id % 6 == 0) for r in held)
    assert right >= 0.97 * len(held)
    assert {r.held_out for r in rows if r.doc_id is None} == {False}
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert {1000, 1001, 1002} <= ids and sum(k not in ids for k in range(0, 900, 6)) > 140
    assert sum(k in ids for k in range(900) if k % 6) > 740


def test_no_labels_and_no_documents(spark, corpus):
    docs = spark.createDataFrame(corpus[0][:5], SCHEMA)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in toxicity.score_documents(docs, none).collect()} == {0.5}
    assert toxicity.score_documents(docs.limit(0), none).collect() == []


def test_weights_are_sparse_and_follow_the_update_rule():
    z, n = np.zeros(toxicity.SIZE), np.zeros(toxicity.SIZE)
    at = np.array([3, 7])
    toxicity._learn([at], np.array([1]), z, n, 1)
    assert np.allclose(z[at], -0.5) and np.allclose(n[at], 0.25)
    assert not toxicity._weights(z, n).any()
    one = toxicity._weights(np.array([-toxicity.L1 - 1]), np.array([4.0]))
    assert np.allclose(one, 1 / ((toxicity.BETA + 2) / toxicity.ALPHA + toxicity.L2))


def test_features_see_case_gaps_and_order():
    a, b = toxicity.coordinates(b"Bad, DOG"), toxicity.coordinates(b"bad dog")
    assert (a == b).all() and len(a) == 4
    assert set(toxicity.coordinates(b"dog bad")) != set(a)
    assert len(toxicity.coordinates(b"a b c d")) == 4 + 3 + 2 + 1 + 1
    assert toxicity.coordinates(None).tolist() == [toxicity.SIZE - 1]


def test_sample_is_bounded(spark, corpus):
    docs = spark.createDataFrame(corpus[0], SCHEMA)
    labels = spark.createDataFrame(corpus[1], "doc_id long, quality int, toxic int")
    sample = toxicity.labelled_sample(docs, labels, rows=50)
    assert sample.select("doc_id").distinct().count() <= 50
    assert sample.where(F.col("toxic").isNull()).count() == 0
