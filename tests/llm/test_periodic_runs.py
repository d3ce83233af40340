"""Runs against a search over all periods, collapsed texts, and the digest query by hand."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from hitloom.llm import periodic_runs as P


def by_all_periods(words, times, least):
    found = {}
    n = len(words)
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(times * q, least):
                found.setdefault((i, j - i + q), q)  # the smallest period comes first
            i = j + 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=12), st.integers(1, 8), st.integers(1, 90)), min_size=1, max_size=5), st.sampled_from([(3, 24), (2, 1), (2, 4), (3, 6)]))
def test_runs_equal_search_over_all_periods(parts, rule):
    codes = [c for block, times, cut in parts for c in (block * times)[:cut]]
    assert P.find_runs(np.array(codes), *rule) == by_all_periods(codes, *rule)


def test_large_classes_and_many_texts_at_once():
    assert P.find_runs(np.zeros(30_000, dtype=np.int64)) == [(0, 30_000, 1)]
    assert P.find_runs(np.tile(np.arange(700), 9)) == [(0, 6300, 700)]
    texts = [b"a b " * 12, b"a b " * 11, b"", b"x " + b"a b " * 12 + b"b"]
    assert P._piece(texts, 3, 24) == [
        (24, [(0, 24, 2)], b"a b"),
        (22, [], b" ".join([b"a b"] * 11)),
        (0, [], b""),
        (26, [(1, 24, 2)], b"x a b b"),
    ]


def test_positions_in_order():
    rng = random.Random(6)
    values = rng.sample(range(100_000), 9_000)
    held, plain = P.Positions(values[0]), [values[0]]
    for v in values[1:]:
        before, after = held.add(v)
        if len(plain) < 300:
            plain = sorted(plain)
            assert before == max((x for x in plain if x < v), default=-1)
            assert after == min((x for x in plain if x > v), default=-1)
            plain.append(v)
    assert list(held) == sorted(values) and held.size == 9_000


def planted(doc_id, text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    out = [(k, " ".join(rng.choice(["to", "be", "ör", "not", "the"]) + rng.choice(["", "\n", "\t "]) for _ in range(rng.randrange(0, 60) if k % 4 == 0 else rng.randrange(150, 300)))) for k in range(499)]
    out += [(500, None), (501, ""), (502, " \n\x0b"), (None, "so " * 40), (3, out[3][1]), (504, "so " * 40), (505, "la la ti " * 20 + "so " * 40), (506, "a b " * 24)]
    return out


def test_report_equals_reckoning_by_hand(spark, rows):
    df = spark.createDataFrame([(k, t, 1, "x") for k, t in rows], "doc_id long, text string, n_runs int, runs string").repartition(3)
    got = P.run_report(df)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    want, planted_runs = [], 0
    for k, t in rows:
        words = planted(k, t)
        runs = by_all_periods(words, 3, 24)
        planted_runs += len(runs)
        best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2])) if runs else (None,) * 3
        kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in runs)]
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        milli = 1000 * best[1] // best[2] if runs else None
        want.append((k, len(runs), *best, milli, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(b" ".join(kept)).hexdigest()))
    assert planted_runs > 30
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert P.run_report(df.limit(0)).collect() == []


def test_operator_keeps_columns_and_refuses_clashes(spark):
    df = spark.createDataFrame([(1, "la " * 30, "k")], "doc_id long, text string, runs string")
    row = P.periodic_runs(df, ["doc_id", "text"]).first()
    assert row.n_words == 30 and [tuple(r) for r in row.runs] == [(0, 30, 1)] and row.collapsed == "la" and row.text == "la " * 30
    with pytest.raises(ValueError):
        P.periodic_runs(df, ["runs"])
    assert [tuple(r) for r in P.periodic_runs(df, [], times=2, least=2).first().runs] == [(0, 30, 1)]
