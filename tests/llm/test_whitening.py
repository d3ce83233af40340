"""Whitening against numpy on the distinct integer vectors, and the cases its docstrings define."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hitloom.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, n int, component string"


def integers(vectors):
    return np.floor(64 * np.array(vectors, dtype=np.float32).astype(np.float64)).astype(np.int64) + W.SHIFT


def vectors(count, size, seed=1):
    rng = np.random.default_rng(seed)
    mixed = rng.normal(size=(count, size)) @ rng.normal(size=(size, size))
    return [[float(c) for c in v] for v in mixed]


def by_numpy(x, size):
    fit = np.unique(x, axis=0)
    n, total = len(fit), fit.sum(0)
    y = fit - total / n
    values, axes = np.linalg.eigh(y.T @ y / n)
    values, axes = values[::-1], axes[:, ::-1]
    return n, total, values, (x - total / n) @ axes[:, :size] / np.sqrt(values[:size])


def test_equals_numpy(spark):
    rows = vectors(600, 20)
    # A third of all rows is one vector; it counts once.
    rows += [rows[7]] * 300
    df = spark.createDataFrame([(k, v, 5, "x") for k, v in enumerate(rows)], SCHEMA).repartition(7)
    got = W.whiten(df).toPandas()
    x = integers(rows)
    n, total, values, want = by_numpy(x, 16)
    assert n == 600 and set(got.n) == {600} and len(got) == 900 * 16
    table = got.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    sign = np.sign((table * want).sum(0))
    assert np.allclose(table * sign, want, atol=1e-8)
    share = got[got.vec_id == 0].sort_values("component").explained.to_numpy()
    assert np.allclose(share, values[:16] / values.sum(), rtol=1e-9)
    assert got.identity_error.nunique() == 1 and got.identity_error[0] < 1e-9
    apart = ((n * x - total) ** 2).sum(1)
    assert {(r.vec_id, r.deviation) for r in got.itertuples()} == set(enumerate(apart.tolist()))


def test_rows_that_take_no_part(spark):
    nan, inf = math.nan, math.inf
    good = vectors(30, 3, 2)
    bad = [None, [], [1.0, None, 2.0], [1.0, nan, 2.0], [inf, 0.0, 1.0], [1.0, 2.0]]
    rows = [(k, v) for k, v in enumerate(good)] + [(100 + k, v) for k, v in enumerate(bad)] + [(None, good[0]), (3, good[3])]
    df = spark.createDataFrame([(k, v, 1, "") for k, v in rows], SCHEMA)
    got = W.whiten(df).toPandas()
    assert set(got.component) == {1, 2, 3} and set(got.n) == {30}
    assert len(got) == 3 * 32 and got.vec_id.isna().sum() == 3 and (got.vec_id == 3).sum() == 6
    assert not (got.vec_id >= 100).any()
    assert W.whiten(df.limit(0)).collect() == []
    assert W.whiten(df.where("vec_id >= 100 AND size(embedding) != 2")).collect() == []


def test_zero_is_a_vector_and_flat_dimensions_have_no_component(spark):
    df = spark.createDataFrame([(k, [float(k), 0.0, 2.0 * k], 0, "") for k in range(5)], SCHEMA)
    got = W.whiten(df).toPandas().sort_values(["vec_id", "component"])
    assert set(got.n) == {5} and got.identity_error[0] < 1e-9
    assert np.allclose(got[got.component == 1].explained, 1) and (got[got.component > 1].whitened == 0).all()
    one = W.whiten(df.limit(1)).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained) for r in one] == [(1, 0, 0.0, 0.0)] * 3


def test_large_entries_stay_exact(spark):
    rng = random.Random(3)
    rows = [[rng.choice([-1, 1]) * float(2 ** rng.randrange(20, 56)) for _ in range(3)] for _ in range(12)]
    df = spark.createDataFrame([(k, v) for k, v in enumerate(rows)], "vec_id long, embedding array<double>")
    distinct = W.integer_vectors(df).select("packed").distinct()
    n, total, matrix = W.covariance(distinct)
    x = [[math.floor(64 * c) + W.SHIFT for c in v] for v in rows]
    assert n == 12 and total == [sum(c) for c in zip(*x)]
    for i in range(3):
        for j in range(3):
            exact = sum((n * v[i] - total[i]) * (n * v[j] - total[j]) for v in x) / n**3
            assert matrix[i, j] == pytest.approx(exact, rel=1e-15)
    assert {r.deviation for r in W.whiten(df).collect()} == {None}
    huge = spark.createDataFrame([(1, [1e300, 0.0]), (2, [0.0, 1.0]), (3, [0.5, 3.0])], "vec_id long, embedding array<double>")
    assert W.whiten(huge).count() == 6


def test_polarisation_is_of_sums():
    y = np.array([[1, 2, 3], [4, 5, 7]])
    assert W.polar_squares(y) == [17, 29, 58, 9 + 81, 16 + 121, 25 + 144]


def test_packing_is_exact_and_canonical():
    x = np.array([[0, 1], [127, -128], [128, 0], [-40000, 5], [2**40, -1]]) + W.SHIFT
    packed = W.pack(x)
    assert [p[0] for p in packed] == [1, 1, 2, 4, 8]
    assert (np.concatenate([W.unpack([p]) for p in packed]) + W.SHIFT == x).all()


def test_floor_of_halves(spark):
    df = spark.createDataFrame([(1, [-0.001, 0.5 / 64, 1.0])], "vec_id long, embedding array<double>")
    packed = W.integer_vectors(df).select(F.hex("packed").alias("p")).first().p
    assert W.unpack([bytes.fromhex(packed)]).tolist() == [[-1, 0, 64]]
