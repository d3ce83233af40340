"""The mixture against its definition computed in plain Python."""

import hashlib
import math
import random

import pytest

from hitloom.llm import mixing as M

SCHEMA = "row_id long, source string, n_tokens long, epoch int, block string"


def number(*parts):
    return int(hashlib.md5("|".join("" if p is None else str(p) for p in parts).encode()).hexdigest()[:13], 16)


def slow_exponent(tokens, budget, entropy, repeats):
    def measures(a):
        p = [t**a for t in tokens]
        w = [x / sum(p) for x in p]
        h = -sum(x * math.log(x) for x in w) / math.log(len(w)) if len(w) > 1 else 1.0
        return h, max(x * budget / t for x, t in zip(w, tokens))

    if measures(1)[0] >= entropy:
        return 1.0
    low, high = 0.0, 1.0
    for _ in range(M.STEPS):
        mid = (low + high) / 2
        h, r = measures(mid)
        low, high = (mid, high) if h >= entropy or r > repeats else (low, mid)
    return high


def slow_mix(rows, budget, entropy, repeats, seed, block_tokens):
    sources = {}
    for row_id, source, n in rows:
        sources.setdefault(source, []).append((row_id, n or 0))
    totals = {s: sum(n for _, n in d) for s, d in sources.items()}
    totals = {s: t for s, t in totals.items() if t}
    budget = sum(totals.values()) if budget is None else budget
    a = slow_exponent(list(totals.values()), budget, entropy, repeats)
    whole = sum(t**a for t in totals.values())
    out = []
    for source, total in totals.items():
        quota = round(total**a / whole * budget)
        blocks = {}
        for row_id, n in sources[source]:
            blocks.setdefault(number(seed, row_id) % math.ceil(total / block_tokens), []).append((row_id, n))
        for epoch in range(quota // total + 1):
            start = 0
            for block in sorted(blocks, key=lambda b: (number(seed, epoch, "block", b), b)):
                for row_id, n in sorted(blocks[block], key=lambda d: (number(seed, epoch, d[0]), d)):
                    full = epoch < quota // total
                    if full or (quota % total > 0 and start + n <= quota % total):
                        out.append((row_id, source, n, epoch, block, start))
                    start += n
    return sorted(out, key=str), a


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)
    rows = [(k, "big", rng.randrange(200)) for k in range(300)] + [(1000 + k, "mid", rng.randrange(50)) for k in range(60)]
    rows += [(2000 + k, None, 7) for k in range(9)] + [(3000, "empty", 0), (3001, "none", None), (2000, None, 7), (4000, "mid", 0)]
    return rows


@pytest.mark.parametrize("options", [{}, {"entropy": 0.99, "repeats": 2.5, "block_tokens": 300}, {"entropy": 1.0, "repeats": 50.0, "budget": 9000, "block_tokens": 50}])
def test_plan_equals_definition(spark, rows, options):
    df = spark.createDataFrame([(*r, 5, "clash") for r in rows], SCHEMA)
    given = {"budget": None, "entropy": M.TARGET_ENTROPY, "repeats": M.MAX_REPEATS, "seed": M.SEED, "block_tokens": M.BLOCK_TOKENS, **options}
    want, exponent = slow_mix(rows, **given)
    got = M.mix(df, **options).collect()
    assert sorted((tuple(r) for r in got), key=str) == want
    assert 0 < exponent < 1
    used = {}
    for r in got:
        used[r.source] = used.get(r.source, 0) + r.n_tokens
    whole = {s: sum(n or 0 for _, t, n in rows if t == s) for s in used}
    assert all(used[s] <= given["repeats"] * whole[s] + 1 for s in used)


def test_budget_that_repeats_everything_too_often(spark, rows):
    df = spark.createDataFrame([(*r, 5, "clash") for r in rows], SCHEMA)
    with pytest.raises(ValueError):
        M.mix(df, budget=10**9)


def test_texts_keep_their_columns(spark):
    docs = spark.createDataFrame(
        [(1, "a b c", "s", "x"), (1, "a b c", "s", "x"), (2, None, "s", "x"), (3, "", None, "x"), (None, "d e", "t", "x")],
        "doc_id long, text string, source string, epoch string",
    )
    mixed = M.mixed_texts(docs)
    assert mixed.columns == ["doc_id", "text", "source", "epoch", "block", "start"]
    rows = mixed.collect()
    assert {r.epoch for r in rows} == {"x"} and [r.text for r in rows].count("a b c") >= 1
    assert M.mixed_texts(docs.limit(0)).collect() == []
    assert M.mix_documents(docs.limit(0)).collect() == []
