"""Each stage's decisions on planted cases, and all stages in order."""

import random

import pytest

import corpus_pipeline


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents with one planted case each, their labels and a benchmark."""
    path = str(tmp_path_factory.mktemp("sf"))
    rng = random.Random(7)
    vocabulary = [f"{a}{b}{c}" for a in "bcdfghkl" for b in "aeiou" for c in ("nt", "rm", "st", "lk", "sh")]
    text = lambda n: " ".join(rng.choice(vocabulary) + rng.choice(vocabulary) for _ in range(n))
    rows = [(k, text(60) + "\n" + text(60)) for k in range(240)]
    item = text(30)
    toxic = [(k, text(40) + " vilescum knavedog " + text(40) + " vilescum") for k in range(300, 360)]
    leak = (400, text(50) + "\n" + item + "\n" + text(20))
    line = rows[0][1].split("\n")[0]
    repeat = (401, text(50) + "\n" + line.upper() + ".\n" + text(20))
    near = (402, rows[1][1].replace("\n", " "))
    rows = [*rows, *toxic, leak, repeat, near, (403, None), (404, ""), (1, rows[1][1])]
    docs = [(i, t, "en", "s0" if i % 3 else "s1", len(t or ""), "clash") for i, t in rows]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long, score string").write.parquet(f"{path}/documents.parquet")
    labels = [(i, 1, int(300 <= i < 360)) for i, _ in rows if i < 360]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages_in_order(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        path = f"{folder}/out-{name}"
        out.write.parquet(path)
        following = spark.read.parquet(path)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert following.columns == docs.columns
        seen[name] = {}
        for r in following.collect():
            seen[name].setdefault(r.doc_id, []).append(r.text)
        docs = following
    clean = set(range(240))
    assert clean <= set(seen["toxicity"]) and len(set(range(300, 360)) & set(seen["toxicity"])) <= 3
    assert clean - {1} <= set(seen["line_dedup"]) and 400 in seen["line_dedup"]
    assert len(seen["line_dedup"][401][0].split("\n")) == 2
    # 402 says in one line what 1 says in two: that is for the next stage.
    assert 402 in seen["line_dedup"] and 402 not in seen["simhash"]
    assert clean <= set(seen["simhash"]) and len(seen["simhash"][1]) == 1
    assert len({403, 404} & set(seen["simhash"])) == 1
    assert clean <= set(seen["decontaminate"]) and 400 not in seen["decontaminate"]
    assert len(clean - set(seen["mixing"])) < 40 and set(seen["mixing"]) <= set(seen["decontaminate"])


def test_run_writes_each_stage(spark, folder):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "simhash", "decontaminate", "mixing"]
    rows = corpus_pipeline.run(spark, folder)
    assert {"epoch", "block", "start"} <= set(rows.columns) and rows.count() > 200


def test_near_duplicates_are_those_of_the_simhash_operator(spark, tmp_path):
    """One document of each component stays, by the operator's own shingles and distance; rows without ids or words too."""
    from hitloom.llm import simhash

    rng = random.Random(11)
    rows = []
    for k in range(40):
        words = [f"w{rng.randrange(5000)}" for _ in range((20, 200, 2000)[k % 3])]
        rows.append((3 * k, " ".join(words)))
        rows.append((3 * k + 1, "\n".join(w.upper() for w in words)))
        words[len(words) // 2] = "new"
        rows.append((3 * k + 2, " ".join(words)))
    rows += [(None, rows[0][1]), (None, "only here and nowhere else"), (500, None), (501, ""), (502, " \n "), (0, rows[0][1])]
    docs = spark.createDataFrame([(i, t, "en", "s", 0, "") for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, score string")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns
    got = [(r.doc_id, r.text) for r in kept.collect()]
    labels = {(r.doc_id, r.fingerprint): r.component_id for r in simhash.simhash_components(docs).collect()}
    groups = {c if c is not None else f for (_, f), c in labels.items()}
    assert len(got) == len(groups) and {3 * k for k in range(40)} <= {i for i, _ in got}
    assert not {3 * k + 1 for k in range(40)} & {i for i, _ in got}
    assert {i for i, t in got if i in (500, 501, 502)} == {500} and (None, "only here and nowhere else") in got
    assert corpus_pipeline.drop_near_duplicates(spark, docs.limit(0), str(tmp_path)).collect() == []


def test_stages_of_an_empty_table(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        assert out.collect() == []
