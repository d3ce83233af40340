"""Contamination against a scan of all windows."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from hitloom.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, term string, item long"


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def slow(docs, items, window=10):
    out = []
    for doc_id, text in docs:
        w = words(text)
        hit, found = set(), set()
        for item_id, item in items:
            v = words(item)
            n = min(window, len(v))
            for s in range(len(v) - n + 1 if n else 0):
                for at in range(len(w) - n + 1):
                    if w[at : at + n] == v[s : s + n]:
                        hit |= set(range(at, at + n))
                        found.add(str(item_id))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((str(doc_id), len(w), len(hit), len(found), digest, bool(hit)))
    return sorted(out)


@pytest.fixture(scope="module")
def case():
    rng = random.Random(3)
    vocabulary = ["the", "of", "Élan", "a1", "naïve", "word"] + [f"w{k}" for k in range(60)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(k, text(rng.randrange(12, 40))) for k in range(12)]
    items += [(20, "Short Item"), (21, "the"), (22, ""), (23, None), (24, items[0][1]), (25, "the the the the the the the the the the the")]
    docs = []
    for k in range(60):
        item = rng.choice(items)[1] or ""
        cut = item.split()[rng.randrange(4) :]
        docs.append((k, f"{text(rng.randrange(30))}, {' '.join(cut).upper() if k % 3 else ' - '.join(cut)}! {text(rng.randrange(30))}"))
    docs += [(70, None), (71, ""), (72, "..."), (None, items[1][1]), (3, docs[3][1]), (3, docs[3][1]), (73, "the " * 30), (74, items[2][1] + " " + items[2][1])]
    docs.append((75, " ".join(f"x{k}" for k in range(30000)) + " " + items[4][1]))
    return docs, items


def test_contamination_equals_scan(spark, case):
    docs, items = case
    df = spark.createDataFrame([(*d, "clash", 1) for d in docs], DOCS)
    bench = spark.createDataFrame([(*i, 7) for i in items], "item_id long, text string, words int")
    got = D.contamination(df, bench).collect()
    assert sorted((str(r.doc_id), *r[1:]) for r in got) == slow(docs, items)


def test_drop_contaminated_keeps_the_rest_whole(spark, case):
    docs, items = case
    df = spark.createDataFrame([(*d, "clash", 1) for d in docs], DOCS)
    bench = spark.createDataFrame(items, "item_id long, text string")
    kept = D.drop_contaminated(df, bench)
    assert kept.columns == df.columns
    clean = sorted(str(r[0]) for r in slow(docs, items) if not r[5])
    assert sorted(str(r.doc_id) for r in kept.collect()) == clean


def test_empty_tables(spark, case):
    docs, items = case
    df = spark.createDataFrame([(*d, "clash", 1) for d in docs], DOCS)
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert D.contamination(df.limit(0), bench).collect() == []
    none = D.contamination(df, bench.limit(0)).collect()
    assert len(none) == len(docs) and not any(r.contaminated for r in none)


def test_proximity(spark):
    items = spark.createDataFrame([(1, "red green blue"), (2, "one")], "item_id long, text string")
    docs = [(1, "x red y green z blue"), (2, "blue green red"), (3, "red a b c d e green blue"), (4, "One red green blue")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = D.proximity_matches(df, items, slack=2)
    named = got.join(df.select("doc_id", D.common.text_key(F.col("text")).alias("text_key")), "text_key")
    assert {(r.doc_id, r.item_id) for r in named.collect()} == {(1, 1), (4, 1), (4, 2)}


def test_proximity_equals_brute_force(spark):
    import itertools
    import random

    rng = random.Random(12)
    vocabulary = ["a", "b", "c", "d"]
    items = [(k, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 5)))) for k in range(25)] + [(90, None), (91, "")]
    docs = [(k, " ".join(rng.choice([*vocabulary, "x", "y", "z"]) for _ in range(rng.randrange(0, 14)))) for k in range(60)] + [(70, None), (71, "a b c d " * 300)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for slack in (0, 1, 3):
        want = {}
        for (i, item), (k, text) in itertools.product(items, docs):
            words, seen = (item or "").split(), (text or "").split()
            shifts = [{p - place for p, w in enumerate(seen) if w == word} for place, word in enumerate(words)]
            firsts = [s for s in set().union(*shifts) if all(any(s <= v <= s + slack for v in near) for near in shifts)]
            if words and firsts:
                want[(k, i)] = min(firsts)
        got = D.proximity_matches(df, spark.createDataFrame(items, "item_id long, text string"), slack=slack)
        named = got.join(df.select("doc_id", D.common.text_key(F.col("text")).alias("text_key")), "text_key")
        assert {(r.doc_id, r.item_id): r.near for r in named.collect()} == want and len(want) > 40
