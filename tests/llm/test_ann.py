"""Recall and exactness against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hitloom.llm import ann

SCHEMA = "vec_id long, embedding array<float>, rank int, score string"


@pytest.fixture(scope="module")
def table():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 16))
    x = centres[rng.integers(0, 12, 1500)] + rng.normal(size=(1500, 16)) * 0.4
    x[700:1100] = x[700] + rng.normal(size=(400, 16)) * 0.001
    x[1200:1230] = x[1200]
    return x.astype(np.float32)


def brute(x, ids, query, k=20):
    scores = (x.astype(np.float64) * x[query].astype(np.float64)).sum(1)
    order = sorted((i for i in range(len(x)) if i != query), key=lambda i: (-scores[i], ids[i]))[:k]
    return [(ids[i], scores[i]) for i in order]


def test_recall_and_scores(spark, table):
    ids = list(range(len(table)))
    bad = [(5000, None), (5001, [0.0] * 16), (5020, [None] + [1.0] * 15), (5002, [math.nan] * 16), (5003, [math.inf] * 16), (5004, [1.0, 2.0]), (5040, [])]
    rows = [(i, x.tolist(), 1, "clash") for i, x in zip(ids, table)] + [(i, x, 1, "clash") for i, x in bad]
    got = {}
    for r in ann.nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert sorted(got) == [i for i in ids if i % 20 == 0]
    hit = 0
    for query, found in got.items():
        found.sort()
        assert [f[0] for f in found] == list(range(1, 21))
        assert query not in [f[1] for f in found] and len({f[1] for f in found}) == 20
        for (_, i, score), (_, j, after) in zip(found, found[1:]):
            assert score > after or (score == after and i < j)
        for _, i, score in found:
            assert abs(score - table[i].astype(np.float64) @ table[query].astype(np.float64)) < 1e-9
        hit += len({f[1] for f in found} & {i for i, _ in brute(table, ids, query)})
    assert hit >= 0.95 * 20 * len(got)


def test_equal_vectors_go_by_id(spark, table):
    rows = [(k, table[0].tolist(), 1, "") for k in random.Random(0).sample(range(40), 40)] + [(100 + k, table[k].tolist(), 1, "") for k in range(1, 30)]
    found = ann.nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") == 20).orderBy("rank").collect()
    want = brute(np.array([r[1] for r in sorted(rows)], dtype=np.float32), [r[0] for r in sorted(rows)], 20)
    assert [r.vec_id for r in found] == [i for i, _ in want]


def test_few_repeated_and_no_rows(spark):
    rows = [(0, [1.0, 2.0], 1, ""), (0, [1.0, 2.0], 1, ""), (3, [2.0, 1.0], 1, ""), (None, [1.0, 1.0], 1, "")]
    df = spark.createDataFrame(rows, SCHEMA)
    found = ann.nearest(df, F.col("vec_id") % 20 == 0).collect()
    assert sorted((r.query_id, r["rank"], str(r.vec_id)) for r in found) == [(0, 1, "0"), (0, 1, "0"), (0, 2, "3"), (0, 2, "3"), (0, 3, "None"), (0, 3, "None")]
    assert ann.nearest(df.limit(0), F.lit(True)).collect() == []
    assert ann.nearest(df.where("vec_id = 3"), F.lit(True)).collect() == []


def test_graph_search_reaches_all_within_ratio(table):
    centres = table[::10].astype(np.float64)
    graph = ann._graph(centres)
    found = ann.search_graph(table[:50].astype(np.float64), centres, graph, np.inf)
    assert np.isfinite(found).all()
    assert np.allclose(found, np.sqrt(ann._squared(table[:50].astype(np.float64), centres)), atol=1e-6)
