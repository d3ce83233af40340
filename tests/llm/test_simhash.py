"""SimHash components against all pairs, and the cases their docstrings define."""

import itertools
import random

import pytest
import xxhash
from pyspark.sql import functions as F

from hitloom.llm import common, simhash

SCHEMA = "doc_id long, text string, fingerprint string, node int"


def slow_print(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in words.replace("\t", " ").replace("\n", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def slow_components(prints, links):
    parent = {p: p for p in prints}

    def find(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for a, b in links:
        parent[find(a)] = find(b)
    return {p: find(p) for p in prints}


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    base = " ".join(rng.choice(["alpha", "Beta", "gamma", "ÉTÉ", "delta", "eps", "zeta"]) + str(rng.randrange(90)) for _ in range(400))
    rows = [(k, base) for k in range(5)]
    for k in range(5, 40):
        words = base.split()
        for _ in range(rng.randrange(4)):
            words[rng.randrange(len(words))] = f"w{rng.randrange(1000)}"
        rows.append((k, "\n".join(words)))
    rows += [(50, None), (51, ""), (52, " \t\n"), (53, "One"), (54, "one"), (None, "one"), (54, "one"), (55, "a b"), (None, None)]
    rows += [(60, "lone text of a null id's neighbour"), (61, " ".join(f"long{k}" for k in range(90000)))]
    return rows


def test_components_equal_all_pairs(spark, corpus):
    rows = [(i, t, "clash", 1) for i, t in corpus]
    got = simhash.simhash_components(spark.createDataFrame(rows, SCHEMA)).collect()
    prints = {t: slow_print(t) for _, t in corpus}
    values = set(prints.values())
    links = [(a, b) for a, b in itertools.combinations(values, 2) if (a ^ b).bit_count() <= 2]
    assert links
    roots = slow_components(values, links)
    least = {}
    for i, t in corpus:
        if i is not None:
            root = roots[prints[t]]
            least[root] = min(least.get(root, i), i)
    want = sorted((str(i), f"{prints[t]:016x}", least.get(roots[prints[t]])) for i, t in corpus)
    assert sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in got) == want


def test_covering_finds_every_near_pair(spark):
    rng = random.Random(1)
    values = set()
    for _ in range(60):
        value = rng.getrandbits(64)
        values.add(value)
        for _ in range(6):
            near = value
            for bit in rng.sample(range(64), rng.randrange(4)):
                near ^= 1 << bit
            values.add(near)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    df = spark.createDataFrame([(v,) for v in signed], "fingerprint long")
    for distance in (0, 1, 2, 3):
        got = {(r.a, r.b) for r in simhash.linked_fingerprints(df, distance).collect()}
        mask = (1 << 64) - 1
        want = {(min(a, b), max(a, b)) for a, b in itertools.combinations(signed, 2) if ((a ^ b) & mask).bit_count() <= distance}
        assert got == want
    with pytest.raises(ValueError):
        simhash.linked_fingerprints(df, 4)


def test_keep_one_row_of_each_component(spark, corpus):
    rows = [(i, t, "clash", 1) for i, t in corpus]
    df = spark.createDataFrame(rows, SCHEMA)
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    labels = simhash.simhash_components(df)
    groups = labels.select(F.coalesce(F.col("component_id").cast("string"), "fingerprint")).distinct().count()
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == groups and 0 in ids and 50 in ids and 53 in ids


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert simhash.simhash_components(empty).collect() == []
    assert simhash.keep_one(empty).collect() == []


def test_components_of_chains_and_hubs(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (3, 2)]
    got = {r.node: r.component for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(1, 41)}, **{k: 100 for k in range(101, 160)}}
    assert common.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_replicated_fingerprints_are_not_broadcast(spark):
    """Few fingerprints are many visits; a join that gathers them on the driver would outgrow it."""
    prints = spark.range(5_000).select(F.xxhash64("id").alias("fingerprint"))
    links = simhash.linked_fingerprints(prints.union(prints.select(F.col("fingerprint").bitwiseXOR(F.lit(1)))))
    assert links.count() == 5_000
    plan = links._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_the_pipeline_stage_broadcasts_no_replicated_fingerprints(spark, monkeypatch):
    plans, components = [], common.components

    def planned(edges, name):
        plans.append(edges._jdf.queryExecution().executedPlan().toString())
        return components(edges, name)

    monkeypatch.setattr(common, "components", planned)
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(["one two three", "one two three", "four five six", ""])], "doc_id long, text string")
    assert sorted(r.doc_id for r in simhash.keep_one(docs).collect()) == [0, 2, 3]
    assert len(plans) == 1 and "SortMergeJoin" in plans[0] and "Broadcast" not in plans[0]
