"""Held-out accuracy and mixtures of known proportions."""

import random

import numpy as np
import pytest

from hitloom.llm import langmix as L

SCHEMA = "doc_id long, text string, lang string, score string, languages int"
SYLLABLES = {"aa": "ka lo mi tur sen".split(), "bb": "shri gho vam dhé tla".split(), "cc": "ña quel rro ció mente".split()}


def words(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    rows = [(k, words(rng, lang, rng.randrange(3, 60)).capitalize(), lang, "clash", 1) for k, lang in enumerate(["aa", "bb", "cc"] * 120)]
    rows += [(1000, None, "aa", "", 1), (1001, "", "aa", "", 1), (1002, "12 -- 34!", "bb", "", 1), (1003, words(rng, "cc", 300_000), "cc", "", 1)]
    rows += [(None, words(rng, "bb", 20), None, "", 1), (0, rows[0][1], "aa", "", 1), (1004, words(rng, "aa", 500) + " " + words(rng, "cc", 120), "aa", "", 1)]
    return rows


def test_held_out_accuracy_and_edges(spark, rows):
    got = L.identify_documents(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    lang = {r[0]: r[2] for r in rows}
    held = [r for r in got if r.held_out and r.doc_id < 1000]
    assert 80 < len(held) < 160 and sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.98 * len(held)
    by_id = {r.doc_id: r for r in got}
    assert [by_id[k].lang_pred for k in (1000, 1001, 1002, 1003, None)] == ["und", "und", "und", "cc", "bb"]
    assert not by_id[None].held_out
    shares = {x.lang: x.share for x in by_id[1004].languages}
    assert set(shares) == {"aa", "cc"} and 0.5 < shares["aa"] < 0.9
    assert by_id[1004].lang_pred == "aa" and abs(by_id[1004].score - shares["aa"]) < 1e-6


def test_nothing_to_learn_from_and_empty(spark, rows):
    df = spark.createDataFrame(rows[:4], SCHEMA)
    assert {r.lang_pred for r in L.identify_documents(df.withColumn("lang", L.F.lit(None).cast("string"))).collect()} == {"und"}
    assert L.identify_documents(df.limit(0)).collect() == []


def test_em_equals_a_plain_loop():
    rng = np.random.default_rng(0)
    likelihood = rng.dirichlet(np.ones(50), 3).T.astype(np.float32)
    counts = rng.integers(1, 9, 50)
    share, fit = L._Batch(np.zeros(50, dtype=int), counts, likelihood).fit(np.full((1, 3), 1 / 3, dtype=np.float32))
    want = np.full(3, 1 / 3)
    for _ in range(L.STEPS):
        post = likelihood * want
        post /= post.sum(1, keepdims=True)
        after = (post * counts[:, None]).sum(0) / counts.sum()
        moved, want = np.abs(after - want).max(), after
        if moved < 1e-3:
            break
    assert np.allclose(share[0], want, atol=1e-3)
    assert np.allclose(fit[0], (counts * np.log(likelihood @ want)).sum(), rtol=1e-4)


def test_pieces_cover_long_texts():
    text = "ab cd " * 400_000
    whole = np.bincount(L.grams(text.encode()), minlength=L.BUCKETS)
    parts = sum(np.bincount(L.grams(p), minlength=L.BUCKETS) for p in L._pieces(text))
    assert (whole == parts).all()
