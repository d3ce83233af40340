"""Chunked windows against a plain sort in Python; one key holds most rows."""

import random

import pytest
from pyspark.sql import functions as F

from hitloom.operators.ordering import heavy_keys, number_rows, number_within, previous_value

CUT = {"share": 0.05, "min_rows": 5}
PLAIN = {"min_rows": 10**9}


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(3)
    made = []
    for n in range(600):
        key = rnd.choice(["hot"] * 6 + [None, "a", "b", "c"])
        at = None if rnd.random() < 0.1 else rnd.randrange(40)
        made.append((key, at, n, f"u{rnd.randrange(4)}" if rnd.random() < 0.9 else None))
    return made


def in_order(rows):
    none_first = lambda v: (v is not None, v if v is not None else 0)
    return sorted(rows, key=lambda r: (none_first(r[1]), r[2]))


@pytest.mark.parametrize("limits", [CUT, PLAIN])
def test_previous_value(spark, rows, limits):
    df = spark.createDataFrame(rows, "k string, at int, n int, url string")
    got = {r.n: r.before for r in previous_value(df, ["k"], ["at", "n"], "url", "before", **limits).collect()}
    want, last = {}, {}
    for key, _, n, url in in_order(rows):
        want[n] = last.get(key)
        last[key] = url
    assert got == want


@pytest.mark.parametrize("limits", [CUT, PLAIN])
def test_number_within(spark, rows, limits):
    df = spark.createDataFrame(rows, "k string, at int, n int, url string")
    got = {r.n: r.nth for r in number_within(df, ["k"], ["at", "n"], "nth", **limits).collect()}
    want, seen = {}, {}
    for key, _, n, _ in in_order(rows):
        seen[key] = want[n] = seen.get(key, 0) + 1
    assert got == want


def test_number_within_a_hot_pair(spark):
    """One (visitor, time) pair holds most rows; others share its visitor."""
    rows = [("v", 1, n) for n in range(80)] + [("v", 2, n) for n in range(5)] + [("w", 1, n) for n in range(15)]
    df = spark.createDataFrame(rows, "v string, at int, n int")
    got = number_within(df, ["v", "at"], ["n"], "nth", **CUT)
    assert got.filter("nth != n + 1").isEmpty() and got.count() == 100


@pytest.mark.parametrize("limits", [CUT, PLAIN])
def test_number_rows(spark, rows, limits):
    df = spark.createDataFrame(rows, "k string, at int, n int, url string")
    bucket = F.coalesce((F.col("at") / 20).cast("int"), F.lit(-1))
    got = {r.n: r.nth for r in number_rows(df, bucket, ["at", "n"], "nth", **limits).collect()}
    assert got == {row[2]: nth for nth, row in enumerate(in_order(rows), start=1)}


def test_leaves_split_the_hot_key(spark, rows):
    """No window group of the cut plan holds more than the limit, and nothing else is cut."""
    df = spark.createDataFrame(rows, "k string, at int, n int, url string")
    from hitloom.operators import ordering as O

    heavy = O._few(heavy_keys(O._sizes(df, ["k"]), share=0.2, min_rows=5))
    parts = O.pieces(df.schema, ["at", "n"])
    levels = O._cut(df.filter("k = 'hot'"), heavy, ["k"], parts)
    leaves = O._with_leaf(df, levels, ["k"], parts).groupBy("k", "_leaf").count().collect()
    assert max(r["count"] for r in leaves if r.k == "hot") <= 0.2 * len(rows) < sum(r["count"] for r in leaves if r.k == "hot")
    assert sorted(r.k or "" for r in leaves if r.k != "hot") == ["", "a", "b", "c"]


def test_times_are_cut_only_where_they_are_hot(spark):
    from hitloom.operators import ordering as O

    made = [(f"2024-01-{1 + n % 20:02d} 10:00:00",) for n in range(100)] + [(f"2024-01-07 12:30:{n % 50:02d}",) for n in range(200)]
    df = spark.createDataFrame(made, "t string").selectExpr("CAST(t AS TIMESTAMP) AS t", "monotonically_increasing_id() AS n")
    day = F.to_date("t")
    got = number_rows(df, day, ["t", "n"], "nth", share=0.1, min_rows=5)
    assert "array" not in got._jdf.queryExecution().optimizedPlan().toString().lower()
    want = {r.n: nth for nth, r in enumerate(sorted(df.collect(), key=lambda r: (r.t, r.n)), start=1)}
    assert {r.n: r.nth for r in got.collect()} == want
    parts = O.pieces(df.schema, ["t", "n"])
    tagged = df.withColumn("_bucket", day)
    heavy = O._few(heavy_keys(O._sizes(tagged, ["_bucket"]), share=0.1, min_rows=5))
    assert heavy.count() == 1
    leaves = O._with_leaf(tagged, O._cut(tagged, heavy, ["_bucket"], parts), ["_bucket"], parts)
    sizes = [r["count"] for r in leaves.groupBy("_leaf").count().collect()]
    # Nineteen other days whole; the hot one by second from its hot minute on.
    assert sorted(sizes) == sorted([5] * 19 + [5] + [4] * 50)


def test_rows_equal_in_all_sort_columns_are_cut_too(spark):
    from hitloom.operators import ordering as O

    df = spark.createDataFrame([("v", 1, n) for n in range(400)], "v string, at int, other int")
    got = number_within(df, ["v"], ["at"], "nth", **CUT)
    assert sorted(r.nth for r in got.collect()) == list(range(1, 401))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64" in plan
    twice = df.withColumn("other", F.lit(0))
    assert sorted(r.nth for r in number_within(twice, ["v"], ["at"], "nth", **CUT).collect()) == list(range(1, 401))
    ties = spark.createDataFrame([("v", 1, f"u{n % 7}") for n in range(300)], "v string, at int, url string")
    seen = previous_value(ties, ["v"], ["at"], "url", "before", **CUT).collect()
    assert sum(r.before is None for r in seen) == 1
    assert sum(r.before is not None and r.before != r.url for r in seen) == 6
    assert O.TIE_BITS == 16


@pytest.mark.parametrize("limits", [CUT, PLAIN])
def test_empty_tables(spark, limits):
    df = spark.createDataFrame([], "k string, at timestamp, n int, url string")
    assert previous_value(df, ["k"], ["at", "n"], "url", "before", **limits).collect() == []
    assert number_within(df, ["k"], ["at"], "nth", **limits).collect() == []
    assert number_rows(df, F.to_date("at"), ["at"], "nth", **limits).collect() == []


def test_heavy_keys_are_few(spark):
    sizes = spark.createDataFrame([(str(n), 10) for n in range(50)], "k string, _rows long")
    assert heavy_keys(sizes, share=0.02, min_rows=1).count() == 0
    assert heavy_keys(sizes, share=0.019, min_rows=1).count() == 50
